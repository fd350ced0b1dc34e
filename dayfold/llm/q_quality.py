"""Query of the quality classifier."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.quality import fit_rules, score_quality
from dayfold.llm.registry import Tables, query


@query("op1_quality_classifier")
def op1_quality_classifier(t: Tables) -> DataFrame:
    """Quality of all documents, learned from the labels of two thirds of the ids."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    ensemble = fit_rules(t.documents, t.labels, train=~held_out)
    return score_quality(t.documents, ensemble).select("doc_id", held_out.alias("held_out"), "score", "predicted")
