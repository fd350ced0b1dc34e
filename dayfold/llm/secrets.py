"""Secret scans over a ledger of content-addressed text versions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayfold.llm.tables import Scratch, known_text, need


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches of ``pattern`` that do not overlap.

    A match counts only if its group ``group`` has ``at_least`` characters. A new
    ``version`` makes the ledger scan old texts again for this rule alone.
    """

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    at_least: int = 0


# Fixed values. A run of a class is taken whole, so for `access` and `hex` a least
# length in the pattern is the same as dropping shorter matches.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)

# Further kinds in public formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


def blob_id(text: Column) -> Column:
    """The address of a text version: the digest of its bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _matches(text: Column, rule: Rule) -> Column:
    """One entry per match with the characters before it since the last one and its own.

    Only texts in which the rule matches at all are cut at its matches.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    entries = F.transform(
        F.arrays_zip(whole.alias("whole"), between.alias("between"), tested.alias("tested")),
        lambda m, n: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            n.alias("n"),
            F.length(m["between"]).cast("bigint").alias("before"),
            F.length(m["whole"]).cast("bigint").alias("size"),
            (F.length(m["tested"]) >= rule.at_least).alias("counts"),
        ),
    )
    # The zipped row behind the last match has only the rest of the text.
    entries = F.filter(entries, lambda m: m["size"].isNotNull())
    return F.when(text.rlike(rule.pattern), entries)


def find_spans(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings of ``blobs`` (blob, text, todo): blob, kind, version, start, end.

    ``todo`` lists the rules to run, as ``kind:version``. Positions are code points,
    ``end`` is exclusive. A match starts where the lengths of all matches and gaps before it add up to.
    """
    found = [
        F.when(F.array_contains("todo", f"{r.kind}:{r.version}"), _matches(F.col("text"), r)) for r in rules
    ]
    empty = F.filter(found[0], lambda m: F.lit(False))
    every = F.concat(*[F.coalesce(f, F.array().cast(_ENTRY)) for f in found]) if found else empty
    rows = blobs.select("blob", F.explode(every).alias("m")).select("blob", "m.*")
    so_far = Window.partitionBy("blob", "kind", "version").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("end", F.sum(F.col("before") + F.col("size")).over(so_far))
        .where("counts")
        .select("blob", "kind", "version", (F.col("end") - F.col("size")).alias("start"), "end")
    )


_ENTRY = "array<struct<kind:string,version:int,n:int,before:bigint,size:bigint,counts:boolean>>"


class Ledger:
    """What was scanned by which rule version, and what was found, in one shared folder.

    ``scanned`` has the blobs and rule versions done, ``findings`` the spans. A scan
    writes its findings before it marks blobs as scanned, so one that is broken off is
    done again; findings are read as distinct rows.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(str(path.toString()))

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, done array<string>")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, kind string, version int, start bigint, end bigint").distinct()

    def scan(self, versions: DataFrame, rules: Sequence[Rule]) -> None:
        """Run ``rules`` on the texts of ``versions`` (blob, text) that have not met them yet."""
        names = [f"{r.kind}:{r.version}" for r in rules]
        wanted = F.array(*[F.lit(n) for n in names])
        # One text per blob: map tasks combine copies before the shuffle.
        texts = versions.groupBy("blob").agg(F.first("text").alias("text"))
        done = self.scanned()
        if done.isEmpty():
            blobs = texts.withColumn("todo", wanted)
        else:
            before = done.select("blob", F.explode("done").alias("rule")).groupBy("blob").agg(
                F.collect_set("rule").alias("done")
            )
            left = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
            blobs = texts.join(before, "blob", "left").select("blob", "text", left.alias("todo"))
            blobs = blobs.where(F.size("todo") > 0)
        found = find_spans(blobs, rules).write.mode("append").option("compression", "zstd")
        found.parquet(f"{self.folder}/findings")
        addresses = versions.select("blob").distinct().withColumn("done", wanted)
        if not done.isEmpty():
            old = done.select("blob", F.explode("done").alias("rule"))
            fresh = addresses.select("blob", F.explode("done").alias("rule")).join(old, ["blob", "rule"], "left_anti")
            addresses = fresh.groupBy("blob").agg(F.collect_list("rule").alias("done"))
        addresses.write.mode("append").option("compression", "zstd").parquet(f"{self.folder}/scanned")


def scan_secrets(
    docs: DataFrame,
    ledger: Ledger,
    rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
    paths: Sequence[str] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """Scan what the ledger has not seen and give every path the findings of its text.

    ``docs`` may hold any number of historical versions; ``paths`` are the columns that tell
    them apart. Each distinct text is stored in the ledger by its digest and scanned once per rule
    version, however many paths have it. Returns one row per input row: the path
    columns, ``blob``, and ``spans``, an array of (start, end, kind) of this rule set, in order
    of start and then of the rules. NULL text counts as empty. An empty table gives no rows.
    """
    need(docs, [*paths, text_col])
    text = known_text(text_col)
    ledger.scan(docs.select(blob_id(text).alias("blob"), text.alias("text")), rules)
    current = reduce(
        lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules]
    )
    place = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    spans = F.sort_array(F.collect_list(F.struct("start", place.alias("rule"), "end", "kind")))
    found = ledger.findings().where(current).groupBy("blob").agg(spans.alias("spans"))
    # Written, so that AQE can split the join where many paths share one blob.
    found = Scratch(docs.sparkSession, "secret-spans").write(found)
    rows = docs.select(*[F.col(p).alias(f"__{n}") for n, p in enumerate(paths)], blob_id(text).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>")
    return (
        rows.join(found, "blob", "left")
        .select(
            *[F.col(f"__{n}").alias(p) for n, p in enumerate(paths)],
            "blob",
            F.coalesce("spans", none).alias("spans"),
        )
    )
