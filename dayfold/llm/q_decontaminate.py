"""Query of benchmark decontamination."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.decontaminate import find_contamination, find_near_passages
from dayfold.llm.registry import Tables, query

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, w[s + 1 : s + least(10, len(w))] AS win FROM starts),
sizes AS (SELECT DISTINCT len(win) AS l FROM iw),
ds AS (SELECT rid, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM d, sizes WHERE len(w) >= l),
h AS (SELECT rid, s, l, item_id FROM (SELECT rid, s, l, w[s + 1 : s + l] AS win FROM ds) JOIN iw USING (win)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM h) GROUP BY rid),
t AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""


@query("op6_decontamination", DECONTAMINATION_SQL)
def op6_decontamination(t: Tables) -> DataFrame:
    """Passages of the benchmark in all documents."""
    found = find_contamination(t.documents, t.benchmark)
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")


NEAR_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w
    FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)
),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, w[s + 1 : s + least(10, len(w))] AS win FROM starts),
wins AS (SELECT row_number() OVER () AS wid, win FROM (SELECT DISTINCT win FROM iw)),
dw AS (SELECT rid, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS p FROM d),
ww AS (SELECT wid, len(win) AS l, unnest(win) AS t, generate_subscripts(win, 1) - 1 AS o FROM wins),
near AS (SELECT rid, wid, l, o, unnest(range(p - o - 2, p - o + 3)) AS s FROM dw JOIN ww USING (t)),
met AS (SELECT rid, wid, l, s, count(DISTINCT o) AS n FROM near GROUP BY ALL HAVING count(DISTINCT o) >= 0.8 * l)
SELECT doc_id, item_id, any_value(l)::INTEGER AS window_words, count(DISTINCT wid) AS n_windows, max(n)::INTEGER AS most_met,
       min(s)::BIGINT AS first_start
FROM met JOIN wins USING (wid) JOIN iw USING (win) JOIN d USING (rid)
GROUP BY rid, doc_id, item_id
"""


@query("near_benchmark_passages", NEAR_SQL)
def near_benchmark_passages(t: Tables) -> DataFrame:
    """Passages of the benchmark in all documents of which up to a fifth of the words were changed."""
    return find_near_passages(t.documents, t.benchmark)
