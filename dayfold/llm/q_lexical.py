"""Query of ranked lexical search."""

from pyspark.sql import DataFrame

from dayfold.llm.lexical import lexical_search
from dayfold.llm.registry import Tables, query

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
sizes AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS iid, item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark),
tf AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
       FROM tf, sizes GROUP BY t),
s AS (
    SELECT iid, item_id, rid, doc_id,
           sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM i JOIN tf USING (t) JOIN df USING (t), sizes GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""


@query("op11_lexical_search", SEARCH_SQL)
def op11_lexical_search(t: Tables) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return lexical_search(t.documents, t.benchmark)
