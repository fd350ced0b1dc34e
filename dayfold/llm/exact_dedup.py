"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.tables import Scratch, known_text, need


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    first_bytes: int = 64,
    growth: int = 8,
    store_single: bool = True,
) -> DataFrame:
    """Groups of equal texts: ``keep_id``, ``group_size`` and ``kept`` for every row.

    Texts are split by their bytes, the most significant digit first: round one
    splits by length and the first ``first_bytes`` bytes, and every later round
    splits what is still together by the next, ``growth`` times wider, digit. A
    group that is down to one row or has no bytes left is finished, so two texts
    are equal exactly if all their bytes were compared; there is no digest.

    A round counts rows per (group, digit), which map tasks combine, and joins
    the counts back; a hot group is one key of a join that AQE can split, and
    never meets in one task. The counts grow with the table, so they are not broadcast.
    Rounds grow with the logarithm of the longest text.

    Rows that are alone after round one are stored with their carried columns, or without ``store_single``
    found by the first join once more when the result is read, which spares disk where
    the text itself is carried.

    Returns one row per input row: the id, ``keep_id`` (the largest id among equal
    texts), ``group_size``, ``kept`` and the columns of ``carry``. NULL text counts
    as empty. Exactly one row of a group is kept, also where the largest id
    occurs several times in it; NULL ids sort below all others. Columns of
    ``docs`` that are not named are ignored; an empty table gives no rows.
    """
    need(docs, [id_col, text_col, *carry])
    clash = {"keep_id", "group_size", "kept"} & {id_col, *carry}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results")
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    own = [F.col(id_col).alias("__id"), *[F.col(c).alias(f"__c_{c}") for c in carry]]
    kept_cols = [f"__c_{c}" for c in carry]

    data = F.encode(known_text(text_col), "UTF-8")
    rows = docs.select(*own, data.alias("__rest")).withColumns(
        {"__group": F.octet_length("__rest").cast("bigint"), "__digit": F.substring("__rest", 1, first_bytes)}
    )
    together = scratch.write(
        rows.groupBy("__group", "__digit")
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .withColumn("__next", F.monotonically_increasing_id())
    )
    open_ = F.col("__n") > 1
    first = (
        rows.join(together.hint("merge"), ["__group", "__digit"], "left").select(
            "__id",
            *kept_cols,
            F.monotonically_increasing_id().alias("__tag"),
            F.coalesce(open_, F.lit(False)).alias("__open"),
            F.coalesce("__n", F.lit(1)).cast("bigint").alias("__n"),
            F.col("__next").alias("__group"),
            F.when(open_, F.col("__group")).alias("__length"),
            _after(first_bytes, open_).alias("__rest"),
            F.col("__id").alias("__keep"),
            F.lit(True).alias("__kept"),
        )
    )
    if store_single:
        state = scratch.write(first)
        finished = [state.where(~F.col("__open"))]
        scratch.drop(together)
    else:
        state = scratch.write(first.where("__open"))
        finished = [first.where(~F.col("__open"))]
    done, width = first_bytes, first_bytes
    while True:
        rows = state.where("__open")
        if rows.isEmpty():
            break
        width *= growth
        done += width
        rows = rows.withColumn("__digit", F.substring("__rest", 1, width)).drop("__n", "__keep", "__kept", "__open")
        groups = scratch.write(
            rows.groupBy("__group", "__digit")
            .agg(
                F.count(F.lit(1)).alias("__n"),
                F.max(F.struct("__id", "__tag")).alias("__best"),
            )
            .withColumn("__next", F.monotonically_increasing_id())
        )
        open_ = (F.col("__n") > 1) & (F.col("__length") > done)
        following = scratch.write(
            rows.join(groups.hint("merge"), ["__group", "__digit"]).select(
                "__id",
                *kept_cols,
                "__tag",
                open_.alias("__open"),
                "__n",
                F.col("__next").alias("__group"),
                "__length",
                _after(width, open_).alias("__rest"),
                F.col("__best.__id").alias("__keep"),
                (F.col("__tag") == F.col("__best.__tag")).alias("__kept"),
            )
        )
        finished.append(following.where(~F.col("__open")))
        scratch.drop(groups)
        state = following
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select(
        F.col("__id").alias(id_col),
        F.col("__keep").alias("keep_id"),
        F.col("__n").alias("group_size"),
        F.col("__kept").alias("kept"),
        *[F.col(f"__c_{c}").alias(c) for c in carry],
    )


def _after(width: int, open_: Column) -> Column:
    """The bytes behind the digit, for rows that go on."""
    return F.when(open_, F.substring(F.col("__rest"), width + 1, 2**31 - 1))
