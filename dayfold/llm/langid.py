"""Languages of texts by fusing several kinds of evidence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.tables import Scratch, known_text, need

BUCKETS = 1 << 15  # of hashed character trigrams
NO_LANGUAGE = "und"


def _trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of letters; other characters act as one blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    other = (points < 97) | ((points > 122) & (points < 0xAA)) | ((points >= 0x2000) & (points < 0x2C00))
    points = np.where(other, np.uint32(32), points)
    if len(points) > 1:
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    if len(points) < 3:
        return np.empty(0, dtype="int64")
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return (mixed >> np.uint32(17)).astype("int64")


@dataclass
class TextModel:
    """Logarithms of trigram shares per language."""

    languages: list[str]
    table: np.ndarray  # BUCKETS x languages

    def likelihoods(self, text: str) -> tuple[np.ndarray, int]:
        found = _trigrams(text)
        if not len(self.languages):
            return np.zeros(0), len(found)
        # Counts per bucket keep the table rows read bounded for very long texts.
        if len(found) > BUCKETS:
            counts = np.bincount(found, minlength=BUCKETS)
            return counts @ self.table, len(found)
        return self.table[found].sum(axis=0), len(found)


def fit_text_model(
    docs: DataFrame,
    declared_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_language: int = 1500,
    least_rows: int = 10,
    most_languages: int = 1000,
) -> TextModel:
    """Trigram shares of the declared languages.

    Fitted on whole texts of at most ``rows_per_language`` rows of each declared language, those
    with the smallest hashes of their ids. Declared values are counted first: one with fewer than ``least_rows``
    rows is no language, and of more than ``most_languages`` (a table of ``BUCKETS`` numbers each) the most frequent are. Rows whose
    hash is too large for the sample are left out where they are read, so that of a language with any number of rows
    about twice the sample is shuffled. The counts of trigrams are summed by Spark; what reaches the driver is at most
    ``BUCKETS`` numbers per language. Rows with a NULL id or an empty declared value tell nothing here; an empty table
    gives a model without languages.
    """
    named = docs.select(F.col(id_col).alias("id"), F.lower(F.trim(declared_col)).alias("language")).where(
        (F.col("language") != "") & F.col("id").isNotNull()
    )
    scratch = Scratch(docs.sparkSession, "language-sample")
    sizes = named.groupBy("language").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least_rows)
    # At most most_languages rows.
    sizes = F.broadcast(scratch.write(sizes.orderBy(F.desc("size"), "language").limit(most_languages)))
    # A number from 0 to 1 that is spread evenly over ids.
    at = F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") / F.lit(float(1 << 53))
    near = named.join(sizes, "language").where(at * F.col("size") <= 2 * rows_per_language)
    by_hash = Window.partitionBy("language").orderBy(at, "id")
    chosen = near.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= rows_per_language)
    chosen = scratch.write(chosen.select("id", "language").distinct())
    texts = docs.select(F.col(id_col).alias("id"), known_text(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            rows: dict[str, int] = {}
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.bincount(_trigrams(text), minlength=BUCKETS)
                sums[language] = sums[language] + own if language in sums else own
                rows[language] = rows.get(language, 0) + 1
            for language, own in sums.items():
                seen = np.flatnonzero(own)
                buckets = np.concatenate(([-1], seen))  # bucket -1 counts the rows
                counts = np.concatenate(([rows[language]], own[seen]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(buckets)), pa.array(buckets, pa.int64()), pa.array(counts, pa.int64())],
                    names=["language", "bucket", "n"],
                )

    counts = texts.select("language", "text").mapInArrow(count, "language string, bucket bigint, n bigint")
    found = counts.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, buckets = np.array(found["language"].to_pylist(), dtype=object), found["bucket"].to_numpy()
    numbers = found["n"].to_numpy()
    rows = {name: n for name, b, n in zip(names, buckets, numbers) if b < 0}
    languages = sorted(rows)
    table = np.zeros((BUCKETS, len(languages)))
    for at, language in enumerate(languages):
        own = (names == language) & (buckets >= 0)
        table[buckets[own], at] = numbers[own]
    return TextModel(languages, np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * BUCKETS)))


def page_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``declared`` (of the html tag), ``suffix`` (of the host), ``host`` and ``plain`` text."""
    need(pages, [url_col, html_col])
    html, url = known_text(html_col), known_text(url_col)
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return pages.select(
        *pages.columns,
        F.lower(F.nullif(declared, F.lit(""))).alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
        bare.alias("plain"),
    )


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str | None = "lang",
    suffix_col: str | None = None,
    host_col: str | None = "source",
    model: TextModel | None = None,
    carry: Sequence[str] = (),
    temper: float = 0.3,
    weight: float = 20.0,
    least_probability: float = 0.6,
) -> DataFrame:
    """The language of every row, and whether it is certain enough to accept.

    For each language the posterior adds up the logarithms of
    - the trigram likelihood of the whole text, times ``temper``, as trigrams overlap,
    - the share of the declared language among texts that read like the language,
    - the share of the address suffix among them,
    - the prior of the host: its own counts of languages, smoothed with ``weight`` rows by
      those of its parent domain, which are smoothed likewise by those of the whole table.
    The shares and priors are counted over all rows by grouped aggregation; in them a row counts for
    the language its text alone suggests. Unknown (NULL or absent) evidence says nothing.

    Returns the id, ``language``, ``probability``, ``text_language``, ``accepted`` and the columns
    of ``carry``. A text without letters has no ``text_language`` (NULL), gets the most probable
    language by the other evidence, and is not accepted; otherwise rows are accepted from ``least_probability`` on.
    With no language to choose from, ``language`` is "und". NULL text counts as empty; repeated rows
    are judged each; an empty table gives no rows. Ties go to the first language by name.
    """
    need(docs, [id_col, text_col, *[c for c in (declared_col, suffix_col, host_col) if c], *carry])
    clash = {"language", "probability", "text_language", "accepted"} & {id_col, *carry}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results")
    if model is None:
        if declared_col is None:
            raise ValueError("a model is needed without declared languages")
        model = fit_text_model(docs, declared_col, id_col, text_col)
    languages = model.languages
    scratch = Scratch(docs.sparkSession, "languages")

    def named(column: str | None) -> Column:
        value = F.lower(F.trim(F.col(column))) if column else F.lit(None).cast("string")
        return F.nullif(value, F.lit(""))

    given = docs.select(
        F.col(id_col).alias("__id"),
        *[F.col(c).alias(f"__c{n}") for n, c in enumerate(carry)],
        named(declared_col).alias("__declared"),
        named(suffix_col).alias("__suffix"),
        named(host_col).alias("__host"),
        known_text(text_col).alias("__text"),
    )
    out = T.StructType(
        [f for f in given.schema if f.name != "__text"]
        + [T.StructField("__n", T.LongType()), T.StructField("__text_logs", T.ArrayType(T.DoubleType()))]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per language

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.likelihoods(text) for text in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [
                *batch.columns[:-1],
                pa.array([n for _, n in found], type=pa.int64()),
                pa.array([logs for logs, _ in found], type=pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    best = F.array_position("__text_logs", F.array_max("__text_logs")).cast("int")
    # The last two labels of a host are its domain; other names are their own.
    domain = F.coalesce(F.nullif(F.regexp_extract("__host", r"([^.]+\.[^.]+)$", 1), F.lit("")), F.col("__host"))
    # Texts are read once for the counts and once for the result, so that no text has to be stored.
    rows = given.mapInArrow(read, out).withColumns(
        {"__best": F.when((F.col("__n") > 0) & (F.size("__text_logs") > 0), best), "__domain": domain}
    )
    final = [
        F.col("__id").alias(id_col),
        F.col("language"),
        F.col("probability"),
        F.get(_names(languages), F.col("__best") - 1).alias("text_language"),
        F.coalesce((F.col("probability") >= least_probability) & F.col("__best").isNotNull(), F.lit(False)).alias(
            "accepted"
        ),
        *[F.col(f"__c{n}").alias(c) for n, c in enumerate(carry)],
    ]
    if not languages:
        return rows.select(
            "*", F.lit(NO_LANGUAGE).alias("language"), F.lit(0.0).cast("double").alias("probability")
        ).select(final)

    k = len(languages)
    one = [F.when(F.col("__best") == i + 1, F.col("__rows")).otherwise(0.0) for i in range(k)]
    evidence = ["__host", "__domain", "__declared", "__suffix", "__best"]
    counted = scratch.write(
        rows.where("__best IS NOT NULL").groupBy(*evidence).agg(F.count(F.lit(1)).cast("double").alias("__rows"))
    )
    # A single row: how many texts read like each language.
    total = counted.agg(*[F.coalesce(F.sum(o), F.lit(0.0)) for o in one]).first()
    world = [(n + 1.0) / (sum(total) + k) for n in total]

    def counts(column: str, *more: str) -> DataFrame:
        sums = [F.sum(o).alias(f"n{i}") for i, o in enumerate(one)]
        return counted.where(F.col(column).isNotNull()).groupBy(column, *more).agg(*sums)

    def shares(column: str, name: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's share of all rows."""
        every = sum(total) + 1.0
        here = F.lit(0.0)
        for i in range(k):
            here = here + F.col(f"n{i}")
        logs = [F.log((F.col(f"n{i}") + weight * here / every) / (total[i] + weight)) for i in range(k)]
        return counts(column).select(column, F.array(*logs).alias(name))

    def smoothed(parent: list[Column]) -> Column:
        here = sum((F.col(f"n{i}") for i in range(1, k)), F.col("n0"))
        return F.array(*[(F.col(f"n{i}") + weight * parent[i]) / (here + weight) for i in range(k)])

    domains = counts("__domain").select("__domain", smoothed([F.lit(w) for w in world]).alias("__of_domain"))
    hosts = counts("__host", "__domain").join(domains, "__domain")
    hosts = hosts.select("__host", smoothed([F.col("__of_domain")[i] for i in range(k)]).alias("__prior"))
    joined = rows
    if host_col:
        joined = joined.join(scratch.write(hosts), "__host", "left")
    else:
        joined = joined.withColumn("__prior", F.lit(None).cast("array<double>"))
    for column, name, used in (("__declared", "__by_declared", declared_col), ("__suffix", "__by_suffix", suffix_col)):
        if used:
            joined = joined.join(scratch.write(shares(column, name)), column, "left")
        else:
            joined = joined.withColumn(name, F.lit(None).cast("array<double>"))

    def log_posterior(i: int) -> Column:
        return (
            F.col("__text_logs")[i] * temper
            + F.coalesce(F.log(F.col("__prior")[i]), F.lit(float(np.log(world[i]))))
            + F.coalesce(F.col("__by_declared")[i], F.lit(0.0))
            + F.coalesce(F.col("__by_suffix")[i], F.lit(0.0))
        )

    logs = joined.withColumn("__logs", F.array(*[log_posterior(i) for i in range(k)]))
    logs = logs.withColumn("__top", F.array_max("__logs"))
    odds = sum((F.exp(F.col("__logs")[i] - F.col("__top")) for i in range(1, k)), F.exp(F.col("__logs")[0] - F.col("__top")))
    return logs.select(
        "*",
        F.get(_names(languages), F.array_position("__logs", F.col("__top")).cast("int") - 1).alias("language"),
        (1.0 / odds).alias("probability"),
    ).select(final)


def _names(languages: list[str]) -> Column:
    return F.array(*[F.lit(name) for name in languages]).cast("array<string>")
