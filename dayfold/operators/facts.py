"""Facts at transaction and snapshot grain."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions.columns import day_of, money
from dayfold.functions.hot import DEFAULT, HotGroups, HotSplit
from dayfold.operators.dims import Lookup, denormalize_dim
from dayfold.session import written


def transaction_fact(
    lines: DataFrame,
    header: DataFrame,
    line_key: str,
    header_key: str,
    header_cols: Sequence[str],
    lookups: Sequence[Lookup] = (),
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Line grain with header attributes, dimension attributes and decimal measures.

    Lookups on header columns are joined to the header first: it has fewer rows
    than the lines, and the one large shuffle is then lines against header.
    """
    head = header.select(F.col(header_key).alias("__header"), *header_cols)
    head = denormalize_dim(head, lookups).select(
        "__header", *header_cols, *[name for lookup in lookups for name in lookup.take]
    )
    out = lines.join(head, F.col(line_key) == F.col("__header"), "inner").drop("__header")
    return out.withColumns(measures) if measures else out


def allocate_header_amount(
    lines: DataFrame,
    header: DataFrame,
    key: str,
    amount: str,
    weight: str,
    order_cols: Sequence[str],
    out: str = "allocated",
    split: HotSplit = DEFAULT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lines with their share, headers without lines, lines without a header)``.

    A share is amount x weight / total weight, rounded half away from zero to
    cents in integer arithmetic. The last line by ``order_cols``, and among equals the
    one with the largest hash of all columns, takes what is left, so that lines add up to
    the header exactly. Where the weights add up to zero it takes everything.
    A header key that occurs twice fails, as its lines would count twice.

    Lines and headers meet in one shuffle, and windows over the header then
    need no other; they sort a short key. Headers with very many lines would not fit a window; their
    totals, one row per hot header, are aggregated and broadcast to their lines instead, or joined by a shuffle
    where so many headers count as hot that the totals would not fit.
    """
    cents = F.coalesce((F.col(weight).cast("decimal(16,2)") * 100).cast("decimal(18,0)"), F.lit(0))
    repeated = F.raise_error(F.concat(F.lit("header key occurs twice: "), F.col(key).cast("string")))
    amounts = (
        header.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max((money(amount) * 100).cast("decimal(18,0)")).alias("__amount"), F.count(F.lit(1)).alias("__heads"))
        .withColumn("__amount", F.when(F.col("__heads") > 1, repeated.cast("decimal(18,0)")).otherwise(F.col("__amount")))
        .select(key, "__amount")
    )
    product = F.col("__amount") * F.col("__cents")
    size = F.call_function("div", F.abs(product) * 2 + F.abs("__total"), F.abs("__total") * 2)
    share = F.when(F.col("__total") == 0, F.lit(0).cast("bigint")).otherwise(
        (F.signum(product) * F.signum("__total")).cast("bigint") * size
    )
    given = F.col("__share") + F.when(F.col("__is_last"), F.col("__amount") - F.col("__shares")).otherwise(0)
    result = [*lines.columns, (given / 100).cast("decimal(18,2)").alias(out)]
    groups = HotGroups(lines, [key], split)

    whole = Window.partitionBy(key)
    hashed = F.xxhash64(*lines.columns)
    place = F.struct(*order_cols, hashed.alias("__hash"))
    last_first = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols], hashed.desc())
    calm = (
        groups.rest(lines)
        .join(amounts, key)
        .withColumn("__cents", cents)
        # The ordered window comes first: its sort serves the other two.
        .withColumn("__is_last", F.row_number().over(last_first) == 1)
        .withColumn("__total", F.sum("__cents").over(whole))
        .withColumn("__share", share)
        .withColumn("__shares", F.sum("__share").over(whole))
    )

    # Rows that are equal in every column may still tie; their own number settles that.
    last = F.struct(place.alias("place"), F.monotonically_increasing_id().alias("row"))
    hot = groups.only(lines).withColumns({"__cents": cents, "__place": last})
    if not groups.few:
        # Behind a shuffle rows would not be numbered alike each time.
        hot = written(hot, "hot-lines")
    # One row per hot header, of which there are at most rows / split.min_rows.
    totals = hot.groupBy(key).agg(F.sum("__cents").alias("__total"), F.max("__place").alias("__last"))
    heads = groups.with_totals(amounts, totals, key)
    shared = groups.with_totals(hot, heads, key).withColumn("__share", share)
    sums = shared.groupBy(key).agg(F.sum("__share").alias("__shares"))
    busy = groups.with_totals(shared, sums, key).withColumn("__is_last", F.col("__place") == F.col("__last"))

    without = header.join(lines.select(key).distinct(), key, "left_anti")
    orphans = lines.join(header.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return calm.select(result).unionByName(busy.select(result)), without, orphans.select(lines.columns)


def accumulating_snapshot(
    events: DataFrame, key: str, ts: str, kind: str, milestones: Sequence[str]
) -> DataFrame:
    """One row per key: first time of each milestone and hours between neighbours."""
    first = events.groupBy(key).agg(
        *[F.min(F.when(F.col(kind) == m, F.col(ts))).alias(f"{m}_at") for m in milestones]
    )
    waits = {
        f"hours_{a}_to_{b}": F.timestamp_diff("MICROSECOND", F.col(f"{a}_at"), F.col(f"{b}_at")) / 3.6e9
        for a, b in zip(milestones, milestones[1:])
    }
    return first.withColumns(waits)


def periodic_snapshot(history: DataFrame, start: Any, end: Any, day: str = "dt") -> DataFrame:
    """Each version once per day it is the valid one at the day's end, within ``start``..``end``.

    Days come from the version itself, clipped to the range, so nothing is
    joined and nothing shuffled.
    """
    first = F.greatest(day_of("valid_from"), F.lit(start).cast("date"))
    last = F.least(F.date_sub(day_of("valid_to"), 1), F.lit(end).cast("date"))
    kept = [c for c in history.columns if c not in ("valid_from", "valid_to", "is_current")]
    return history.where(first <= last).select(*kept, F.explode(F.sequence(first, last)).alias(day))
