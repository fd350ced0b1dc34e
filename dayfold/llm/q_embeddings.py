"""Query of near duplicates among embeddings."""

from pyspark.sql import DataFrame

from dayfold.llm.embeddings import embedding_near_dedup
from dayfold.llm.registry import Tables, query

EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
    SELECT * FROM v WHERE label IS NOT NULL AND coalesce(len(e), 0) > 0
    AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))
),
p AS (
    SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b ON a.label = b.label AND a.rid <> b.rid
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(rid, other) AS (SELECT rid, rid FROM v UNION SELECT r.rid, p.b FROM reach r JOIN p ON r.other = p.a),
c AS (SELECT r.rid, min(o.vec_id) AS component_id FROM reach r JOIN v o ON o.rid = r.other GROUP BY r.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (rid) LEFT JOIN n USING (rid)
"""


@query("op13_embedding_near_dedup", EMBEDDINGS_SQL)
def op13_embedding_near_dedup(t: Tables) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_near_dedup(t.embeddings)
