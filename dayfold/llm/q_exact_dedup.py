"""Query of exact dedup."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.exact_dedup import exact_dedup
from dayfold.llm.registry import Tables, query
from dayfold.llm.tables import known_text

EXACT_DEDUP_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op10_exact_dedup", EXACT_DEDUP_SQL)
def op10_exact_dedup(t: Tables) -> DataFrame:
    """Every document with the one of its equal texts that stays."""
    digest = F.unhex(F.sha2(known_text("text"), 256))
    docs = t.documents.select("doc_id", "text", digest.alias("digest"))
    found = exact_dedup(docs, carry=["digest"])
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
