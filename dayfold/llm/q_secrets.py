"""Query of the secret scan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.registry import Tables, query
from dayfold.llm.secrets import BASE_RULES, Ledger, scan_secrets
from dayfold.session import work_folder


@query("op7_secret_scan")
def op7_secret_scan(t: Tables) -> DataFrame:
    """Secrets in all documents, by a ledger that starts empty."""
    found = scan_secrets(t.documents, Ledger(t.spark, work_folder(t.spark, "ledger")))
    base = [r.kind for r in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(written(of_base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
