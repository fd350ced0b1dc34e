"""Query of near duplicates."""

from pyspark.sql import DataFrame

from dayfold.llm.near_dedup import near_dedup
from dayfold.llm.registry import Tables, query


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(t: Tables) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_dedup(t.documents)
