"""Summaries by day, trailing window, period, grouping set, sketch and quantile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.columns import all_null_safe_equal, day_of, period_start
from dayfold.functions.hot import (
    BEFORE,
    CELL,
    DEFAULT,
    ROW,
    SEED,
    HotSplit,
    cells_along,
    find_hot,
    in_cells,
    in_one_cell,
    seeded,
)

# How a measure is taken from rows, and how partial results of it are merged.
TAKE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}

Measures = Mapping[str, tuple[str, Column | str]]


def take_measures(measures: Measures) -> list[Column]:
    """The aggregates of rows; a text is a column name or SQL expression."""
    return [
        TAKE[how](F.expr(source) if isinstance(source, str) else source).alias(name)
        for name, (how, source) in measures.items()
    ]


def merge_measures(measures: Measures) -> list[Column]:
    return [MERGE[how](name).alias(name) for name, (how, _) in measures.items()]


def daily_summary(
    df: DataFrame, dims: Sequence[str], ts: str, measures: Measures, day: str = "dt"
) -> DataFrame:
    """One row per dims and day; ``measures`` maps a name to ``(how, column)``."""
    return df.groupBy(*dims, day_of(ts).alias(day)).agg(*take_measures(measures))


def trailing_summary(
    daily: DataFrame,
    dims: Sequence[str],
    as_of: Any,
    measures: Measures,
    windows: Sequence[int] = (1, 7, 30),
    day: str = "dt",
) -> DataFrame:
    """One row per dims and window of days that ends on ``as_of``.

    ``measures`` are those of the daily summary. Days outside the longest
    window are filtered out first and so never read from a day-partitioned table.
    """
    end = F.lit(as_of).cast("date")
    inside = daily.where((F.col(day) > F.date_sub(end, max(windows))) & (F.col(day) <= end))
    age = F.date_diff(end, F.col(day))
    fitting = F.array_compact(F.array(*[F.when(age < w, F.lit(w)) for w in windows]))
    return (
        inside.withColumn("window_days", F.explode(fitting))
        .groupBy(*dims, "window_days")
        .agg(*merge_measures(measures))
    )


def to_date_merge(
    prev: DataFrame | None,
    days: DataFrame,
    keys: Sequence[str],
    totals: Sequence[str],
    day: str = "dt",
) -> DataFrame:
    """First day, last day and totals since the beginning.

    ``days`` has one or more days that come after everything in ``prev``; an
    earlier or repeated day fails, as it would be counted twice.
    """
    dt = F.col(day)
    if prev is not None:
        seen = prev.agg(F.max("last_day")).scalar()
        late = F.raise_error(F.concat(F.lit("day already merged: "), dt.cast("string"))).cast("date")
        dt = F.when(dt <= seen, late).otherwise(dt)
    new = days.select(*keys, dt.alias("first_day"), *totals).select(
        *keys, "first_day", F.col("first_day").alias("last_day"), *totals
    )
    both = new if prev is None else prev.unionByName(new)
    types = {c: new.schema[c].dataType for c in totals}
    return both.groupBy(*keys).agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        # Without the cast the precision of a decimal would grow with every day.
        *[F.sum(c).cast(types[c]).alias(c) for c in totals],
    )


def period_to_date(
    daily: DataFrame, dims: Sequence[str], period: str, totals: Sequence[str], day: str = "dt"
) -> DataFrame:
    """Running totals since the period's start; needs one row per dims and day."""
    so_far = (
        Window.partitionBy(*dims, period_start(day, period))
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily.withColumns({f"{c}_{period}_to_date": F.sum(c).over(so_far) for c in totals})


def grouping_summary(
    df: DataFrame,
    dims: Sequence[str],
    mode: str,
    measures: Measures,
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Cube, rollup or chosen grouping sets, with a ``bigint`` ``grouping_id``.

    Rows are first reduced to the finest grain; only those few are then
    multiplied by the grouping sets.
    """
    fine = df.groupBy(*dims).agg(*take_measures(measures))
    if mode == "cube":
        grouped = fine.cube(*dims)
    elif mode == "rollup":
        grouped = fine.rollup(*dims)
    elif mode == "sets" and sets is not None:
        grouped = fine.groupingSets([[F.col(c) for c in s] for s in sets], *dims)
    else:
        raise ValueError("mode must be 'cube', 'rollup' or 'sets' with sets given")
    return grouped.agg(
        F.grouping_id().cast("bigint").alias("grouping_id"), *merge_measures(measures)
    )


def active_ids(
    events: DataFrame,
    id_col: str,
    ts: str,
    start: Any,
    end: Any,
    spans: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    """Exact distinct ids in the ``n`` days ending on each day of ``start``..``end``.

    An active day makes its id count on that day and the ``n - 1`` days after
    it. Days already covered by the id's previous active day are cut off, so an
    id counts at most once a day; the stretches that remain add one where they
    begin and take one away where they end. Those steps are summed per day and
    then run up, which avoids copying every id to ``n`` days.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    dtype = events.schema[ts].dataType
    in_range = (F.col(ts) >= F.date_sub(first, max(spans) - 1).cast(dtype)) & (
        F.col(ts) < F.date_add(last, 1).cast(dtype)
    )
    active = (
        events.where(in_range & F.col(id_col).isNotNull()).select(id_col, day_of(ts).alias("dt")).distinct()
    )
    before = F.lag("dt").over(Window.partitionBy(id_col).orderBy("dt"))

    def step(n: int, at: Column, change: int) -> Column:
        return F.struct(
            F.lit(n).alias("span_days"),
            F.greatest(at, first).alias("dt"),
            F.lit(change).cast("bigint").alias("step"),
        )

    steps = []
    for n in spans:
        begins = F.when(F.col("__before").isNull(), F.col("dt")).otherwise(
            F.greatest(F.col("dt"), F.date_add("__before", n))
        )
        steps += [step(n, begins, 1), step(n, F.date_add("dt", n), -1)]
    changes = active.withColumn("__before", before).select(F.explode(F.array(*steps)).alias("s")).select("s.*")

    # Days without a change still have a row.
    days = events.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in spans])).alias("span_days"),
        F.explode(F.sequence(first, last)).alias("dt"),
        F.lit(0).cast("bigint").alias("step"),
    )
    per_day = (
        changes.where(F.col("dt") <= last).unionByName(days).groupBy("span_days", "dt").agg(F.sum("step").alias("step"))
    )
    # At most one row per day of the range in each partition of this window.
    running = Window.partitionBy("span_days").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select("span_days", "dt", F.sum("step").over(running).alias("active_ids"))


def distinct_sketch(
    events: DataFrame, id_col: str, ts: str, dims: Sequence[str] = (), lg_k: int = 12
) -> DataFrame:
    """One HyperLogLog sketch of ids per dims and day."""
    return events.groupBy(*dims, day_of(ts).alias("dt")).agg(F.hll_sketch_agg(id_col, lg_k).alias("sketch"))


def merge_sketch(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Merge daily sketches to any span, without the events, and estimate."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("approx_ids", F.hll_sketch_estimate("sketch"))


def active_bitmaps(events: DataFrame, id_col: str, ts: str) -> DataFrame:
    """The ids of each day as bitmaps (``dt``, ``bucket``, ``bitmap``), 32,768 ids of a whole-number column in each.

    Stored by day, they answer for any span of days without the events. A bitmap takes 4 KB however few
    ids are in it, so ids should be numbered densely. Rows without an id or a time are left out.
    """
    if not isinstance(events.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"bitmaps need whole numbers, not {events.schema[id_col].dataType.simpleString()}")
    number = F.col(id_col).cast("bigint")
    known = events.where(F.col(id_col).isNotNull() & F.col(ts).isNotNull())
    return known.groupBy(day_of(ts).alias("dt"), F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def merge_bitmaps(bitmaps: DataFrame, start: Any, end: Any, spans: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """As :func:`active_ids`, from stored bitmaps.

    A day's bitmaps are copied to the days they count for and combined in map tasks: what is read and copied are
    bitmaps of the days in question, not events or ids.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")

    def days_for(n: int) -> Column:
        on = lambda later: F.struct(F.lit(n).alias("span_days"), F.date_add("__on", later).alias("dt"))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), on)

    wanted = bitmaps.where((F.col("dt") > F.date_sub(first, max(spans))) & (F.col("dt") <= last))
    copies = (
        wanted.withColumnRenamed("dt", "__on")
        .select("bucket", "bitmap", F.explode(F.concat(*map(days_for, spans))).alias("__for"))
        .select("bucket", "bitmap", "__for.*")
        .where((F.col("dt") >= first) & (F.col("dt") <= last))
    )
    merged = copies.groupBy("span_days", "dt", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    # Days without any id still have a row.
    days = bitmaps.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in spans])).alias("span_days"),
        F.explode(F.sequence(first, last)).alias("dt"),
        F.lit(0).cast("bigint").alias("n"),
    )
    both = merged.select("span_days", "dt", "n").unionByName(days)
    return both.groupBy("span_days", "dt").agg(F.sum("n").alias("active_ids"))


def quantile_sketch(
    events: DataFrame, col: str, ts: str, dims: Sequence[str] = (), k: int = 800
) -> DataFrame:
    """One KLL sketch of ``col`` per dims and day, to be merged to any span.

    A quantile's rank is off by about 2.3 / k of the rows at most, 99 times in a hundred (0.3 % for 800). NULLs and
    NaN are left out; a group with nothing else has no row.
    """
    value = F.col(col).cast("double")
    known = events.where(value.isNotNull() & ~F.isnan(value) & F.col(ts).isNotNull())
    return known.groupBy(*dims, day_of(ts).alias("dt")).agg(F.kll_sketch_agg_double(value, k).alias("sketch"))


def merge_quantiles(
    sketches: DataFrame, by: Sequence[str | Column], quantiles: Mapping[str, float]
) -> DataFrame:
    """Merge daily sketches to any span, without the events: the number of values ``n`` and a column per quantile."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("__sketch"))
    found = [F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q))).alias(name) for name, q in quantiles.items()]
    names = [c for c in merged.columns if c != "__sketch"]
    return merged.select(*names, F.kll_sketch_get_n_double("__sketch").alias("n"), *found)


def quantile_summary(
    df: DataFrame,
    dims: Sequence[str],
    col: str,
    quantiles: Mapping[str, float],
    how: str = "continuous",
    accuracy: int = 10_000,
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Quantiles of ``col`` per dims, one column per entry of ``quantiles``.

    ``how`` is ``"continuous"`` (exact, interpolated, double), ``"discrete"``
    (exact, a value of the column) or ``"approx"``.

    The exact ones count equal values first, then find in the running count of
    each group the values at the wanted positions. Unlike the built-in exact
    percentile, which gathers all distinct values of a group in one task's
    memory, this works for a group of any size.
    """
    if how == "approx":
        return df.groupBy(*dims).agg(
            *[F.percentile_approx(col, q, accuracy).alias(name) for name, q in quantiles.items()]
        )
    if how not in ("continuous", "discrete"):
        raise ValueError(f"unknown kind of quantile: {how!r}")
    # Without dims everything is one group, and a group needs a name.
    keys = [f"__d{i}" for i in range(len(dims))]
    known = df.where(F.col(col).isNotNull()).select(
        *[F.col(d).alias(k) for d, k in zip(dims, keys)], F.col(col).alias("__value")
    )

    def counted(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n"))

    so_far = in_cells(keys).orderBy(SEED, "__value").rowsBetween(Window.unboundedPreceding, 0)

    def running(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__upto", F.sum("__n").over(so_far)).where(F.col(SEED) == ROW)

    hot = find_hot(known, keys, split)
    if hot is None:
        values = counted(known)
        placed = running(seeded(in_one_cell(values, keys)))
    else:
        ranges = hot.in_ranges(counted(hot.only(known)), ["__value"])
        earlier = cells_along(keys).rowsBetween(Window.unboundedPreceding, -1)
        seeds = (
            ranges.groupBy(*keys, CELL)
            .agg(F.sum("__n").alias("__n"))
            .withColumn("__n", F.sum("__n").over(earlier))
            .where("__n IS NOT NULL")
        )
        calm = counted(hot.rest(known))
        values = calm.unionByName(ranges.drop(CELL))
        placed = running(seeded(in_one_cell(calm, keys))).unionByName(running(seeded(ranges, (seeds, BEFORE))))
    # Where to look, worked out once per group: the two neighbours of each
    # quantile's position and how far it lies between them.
    size = F.col("__size")
    wanted = {}
    for i, q in enumerate(quantiles.values()):
        exact_q = F.lit(Decimal(str(q)))
        if how == "discrete":
            wanted[f"__low{i}"] = F.greatest(F.ceil(size * exact_q) - 1, F.lit(0)).cast("bigint")
        else:
            at = (size - 1) * exact_q
            wanted[f"__low{i}"] = F.floor(at).cast("bigint")
            wanted[f"__high{i}"] = F.ceil(at).cast("bigint")
            wanted[f"__part{i}"] = (at - F.floor(at)).cast("double")
    total = F.sum("__n").alias("__size")
    if keys:
        sizes = values.groupBy(*[F.col(k).alias(f"{k}s") for k in keys]).agg(total).withColumns(wanted)
        placed = placed.join(sizes, all_null_safe_equal([(F.col(k), F.col(f"{k}s")) for k in keys]))
        look = {name: F.col(name) for name in wanted}
    else:
        one = values.agg(total).withColumns(wanted).select(F.struct(*wanted)).scalar()
        look = {name: F.col("__look")[name] for name in wanted}
        placed = placed.withColumn("__look", one)

    def value_at(index: Column) -> Column:
        return F.max(
            F.when((F.col("__upto") - F.col("__n") <= index) & (index < F.col("__upto")), F.col("__value"))
        )

    found, result = [], []
    for i, name in enumerate(quantiles):
        low, high, part = (F.col(f"__{c}{i}") for c in ("l", "h", "p"))
        found.append(value_at(look[f"__low{i}"]).alias(f"__l{i}"))
        if how == "discrete":
            result.append(low.alias(name))
            continue
        found.append(value_at(look[f"__high{i}"]).alias(f"__h{i}"))
        found.append(F.max(look[f"__part{i}"]).alias(f"__p{i}"))
        low, high = low.cast("double"), high.cast("double")
        result.append(F.when(low == high, low).otherwise(low + (high - low) * part).alias(name))
    return placed.groupBy(*keys).agg(*found).select(*[F.col(k).alias(d) for d, k in zip(dims, keys)], *result)


def pivot_summary(
    df: DataFrame, rows: Sequence[str], col: str, values: Sequence[Any], measure: tuple[str, Column | str]
) -> DataFrame:
    """One column per value of ``col``; values are listed, so no job looks them up.

    The column is aggregated by (rows, col) first and only then spread. Values
    that are not listed count as NULL there; rows with no others are kept.
    """
    listed = F.when(F.col(col).isin(list(values)), F.col(col)).alias(col)
    fine = df.groupBy(*rows, listed).agg(*take_measures({"__m": measure}))
    return fine.groupBy(*rows).pivot(col, list(values)).agg(*merge_measures({"__m": measure}))


def unpivot_summary(
    df: DataFrame, rows: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Back to one row per (rows, column); cells that are NULL are left out."""
    return df.unpivot(list(rows), list(columns), name, value).where(F.col(value).isNotNull())
