"""Dimensions and their history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.columns import all_null_safe_equal
from dayfold.functions.hot import (
    AFTER,
    BEFORE,
    CELL,
    DEFAULT,
    ROW,
    SEED,
    HotSplit,
    cells_along,
    find_hot,
    in_cells,
    in_lane_zero,
    in_one_cell,
    null_lane,
    seeded,
)
from dayfold.operators.clean import latest_by_key

OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class Lookup:
    """One step of a lookup chain.

    ``on`` maps a column of the base to the lookup's key column, ``take`` maps
    the output name to the lookup's column, ``unknown`` gives the value for a
    missing lookup (otherwise "unknown" for text and NULL for other types); a row that is found keeps
    its values, NULLs included. Unless ``unique`` says that the key is unique, the lookup is
    first reduced to one row per key.
    """

    table: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    unknown: Mapping[str, Any] = field(default_factory=dict)
    unique: bool = False


def denormalize_dim(base: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Flatten a chain of lookups onto ``base``; the row count stays the same.

    No broadcast is forced: Catalyst broadcasts a lookup whose known size is
    below the session's limit, AQE does so at run time, and a larger one is
    joined by shuffle with skewed partitions split.
    """
    out = base
    for step, lookup in enumerate(lookups):
        keys = {f"__k{step}_{i}": key for i, key in enumerate(lookup.on.values())}
        side = lookup.table.select(
            *[F.col(key).alias(name) for name, key in keys.items()],
            *[F.col(source).alias(name) for name, source in lookup.take.items()],
        )
        types = {name: side.schema[name].dataType for name in lookup.take}
        columns = [F.col(c) for c in out.columns]
        condition = F.lit(True)
        if not lookup.unique:
            side = latest_by_key(side.na.drop(subset=list(keys)), list(keys), list(lookup.take))
            side = in_lane_zero(side, "__zero")
            out = out.withColumn("__lane", null_lane(list(lookup.on)))
            condition = F.col("__lane") == F.col("__zero")
        for column, name in zip(lookup.on, keys):
            condition = condition & (F.col(column) == F.col(name))
        # A key is never NULL where a row was found.
        found = F.col(next(iter(keys))).isNotNull()
        taken = [
            F.when(found, F.col(name)).otherwise(_missing(lookup.unknown, name, types[name])).alias(name)
            for name in lookup.take
        ]
        out = out.join(side, condition, "left").select(*columns, *taken)
    return out


def _missing(unknown: Mapping[str, Any], name: str, dtype: T.DataType) -> Column:
    """The value for a missing lookup: as given, else "unknown" for text and NULL for other types."""
    if name in unknown:
        return F.lit(unknown[name])
    return F.lit("unknown") if isinstance(dtype, T.StringType) else F.lit(None).cast(dtype)


def scd1_upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace whole rows by key, NULLs included; other rows stay.

    ``changes`` holds one row per key (see :func:`~dayfold.operators.clean.latest_by_key`).
    """
    changed = changes.select([F.col(k).alias(f"__{k}") for k in keys])
    same_key = all_null_safe_equal([(F.col(k), F.col(f"__{k}")) for k in keys])
    return current.join(changed, same_key, "left_anti").unionByName(changes)


def scd2_build(
    changes: DataFrame,
    keys: Sequence[str],
    ts: str,
    attrs: Sequence[str],
    tiebreak: Sequence[str],
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """History with one version per real change.

    Of the rows with the same key and time the last by ``tiebreak`` counts. A
    row whose attributes equal those before it opens no version. Rows without a
    time cannot be placed in history and are left out.
    """
    columns = [*keys, ts, *attrs]
    state = F.struct(*attrs)
    dtype = changes.schema[ts].dataType

    def placed(part: DataFrame) -> DataFrame:
        known = part.where(F.col(ts).isNotNull())
        return latest_by_key(known, [*keys, ts], tiebreak).select(*columns).withColumn("__state", state)

    def real_changes(df: DataFrame) -> DataFrame:
        before = F.lag("__state").over(in_cells(keys).orderBy(SEED, ts))
        return df.withColumn("__before", before).where(
            (F.col(SEED) != ROW) | F.col("__before").isNull() | ~F.col("__state").eqNullSafe(F.col("__before"))
        )

    def versions(df: DataFrame) -> DataFrame:
        following = F.lead(ts).over(in_cells(keys).orderBy(SEED, ts))
        return real_changes(df).withColumn("__next", following).where(F.col(SEED) == ROW)

    hot = find_hot(changes, keys, split)
    if hot is None:
        found = versions(seeded(in_one_cell(placed(changes), keys)))
    else:
        rows = hot.in_ranges(placed(hot.only(changes)), [ts])
        along = cells_along(keys)
        # What a range must know: the state it starts from ...
        start = (
            rows.groupBy(*keys, CELL)
            .agg(F.max_by("__state", ts).alias("__state"))
            .withColumn("__state", F.lag("__state").over(along))
            .where("__state IS NOT NULL")
        )
        # ... and when the next version opens in a later range.
        end = (
            real_changes(seeded(rows, (start, BEFORE)))
            .where(F.col(SEED) == ROW)
            .groupBy(*keys, CELL)
            .agg(F.min(ts).alias(ts))
            .withColumn(ts, F.lead(ts).over(along))
            .where(F.col(ts).isNotNull())
        )
        calm = versions(seeded(in_one_cell(placed(hot.rest(changes)), keys)))
        busy = versions(seeded(rows, (start, BEFORE), (end, AFTER)))
        found = calm.unionByName(busy)
    return found.select(
        *keys,
        *attrs,
        F.col(ts).alias("valid_from"),
        F.coalesce("__next", F.lit(OPEN_END).cast(dtype)).alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
    )


def scd2_apply(
    history: DataFrame, day_changes: DataFrame, day: Any, keys: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """History after the changes of ``day``, which hold one row per key.

    Only current versions are joined; closed ones pass through. Days come in
    order: a change at or before the start of its current version fails, unless
    it repeats that version.
    """
    dtype = history.schema["valid_from"].dataType
    columns = [*keys, *attrs, "valid_from", "valid_to", "is_current"]
    at = F.lit(day).cast(dtype)
    open_end = F.lit(OPEN_END).cast(dtype)
    current = history.where("is_current").select(
        F.struct(*keys).alias("__key"), F.struct(*attrs).alias("__old"), F.col("valid_from").alias("__since")
    )
    new = day_changes.select(F.struct(*keys).alias("__new_key"), F.struct(*attrs).alias("__new"))
    # A struct of keys compares NULL-safely and keeps this a plain equi-join.
    both = current.join(new, F.col("__key") == F.col("__new_key"), "full_outer")

    def version(key: str, values: str, since: Column, until: Column, is_current: bool) -> Column:
        return F.struct(
            *[F.col(key)[k].alias(k) for k in keys],
            *[F.col(values)[a].alias(a) for a in attrs],
            since.alias("valid_from"),
            until.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
        )

    kept = version("__key", "__old", F.col("__since"), open_end, True)
    opened = version("__new_key", "__new", at, open_end, True)
    in_order = F.when(F.col("__since") < at, F.col("__since")).otherwise(
        F.raise_error(F.concat(F.lit("not after the current version: changes of "), at.cast("string"))).cast(dtype)
    )
    closed = version("__key", "__old", in_order, at, False)
    versions = (
        F.when(F.col("__new_key").isNull() | F.col("__old").eqNullSafe(F.col("__new")), F.array(kept))
        .when(F.col("__key").isNull(), F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    after = both.select(F.explode(versions).alias("__v")).select("__v.*")
    return history.where("NOT is_current").select(*columns).unionByName(after.select(*columns))


def scd2_lookup(
    fact: DataFrame,
    history: DataFrame,
    keys: Mapping[str, str],
    ts: str,
    take: Mapping[str, str],
    unknown: Mapping[str, Any] | None = None,
    bucket: timedelta = timedelta(days=1),
    small: bool | None = None,
) -> DataFrame:
    """Each fact row with the version valid at ``ts``, or the unknown member.

    ``keys`` maps fact columns to history columns, ``take`` output names to
    history columns. Both ways below are joins on the key and a bucket of time, in which a
    fact row meets the versions of its own bucket only, however many its key has.

    A history that Spark expects to broadcast (its estimated size is within the session's limit; ``small`` says so
    by hand) is joined once per *level*: versions about equally long are put in the one or two buckets of 4096 times their
    least length that they lie in, so a bucket has at most 4097 of them. No fact row is shuffled.

    A larger history is joined once, on the key and the day (``bucket``, rounded down to a power of two of
    microseconds, or of days for dates) in which a version begins. To each bucket that has facts comes the
    version that was open before it, found among one row per key and bucket. Fact rows are shuffled once, and AQE
    can split a hot key. No job runs before the result is asked for.

    A version that is found keeps its values, NULLs included. Without one, ``unknown`` gives
    the value, otherwise "unknown" for text and NULL for other types. Rows with a NULL key or time find none.
    """
    unknown = unknown or {}
    names = [f"__k{i}" for i in range(len(keys))]
    fact_keys, version_keys = [], []
    for in_fact, in_history in keys.items():
        types = fact.schema[in_fact].dataType, history.schema[in_history].dataType
        whole = all(isinstance(t, T.IntegralType) for t in types)
        if types[0] != types[1] and not whole:
            raise TypeError(f"{in_fact} and {in_history} differ in type: {types}")
        # One type, so that a key has one hash on both sides.
        fact_keys.append(F.col(in_fact).cast("bigint") if whole else F.col(in_fact))
        version_keys.append(F.col(in_history).cast("bigint") if whole else F.col(in_history))
    times = [fact.schema[ts].dataType, history.schema["valid_from"].dataType]
    days = all(isinstance(t, T.DateType) for t in times)
    rows = fact.withColumns(
        {f"__f{i}": key for i, key in enumerate(fact_keys)} | {"__at": _instant(F.col(ts), times[0], days)}
    )
    versions = (
        history.where("valid_from < valid_to")
        .select(
            *[key.alias(name) for key, name in zip(version_keys, names)],
            F.col("valid_from").alias("__from"),
            F.col("valid_to").alias("__to"),
            _instant(F.col("valid_from"), times[1], days).alias("__first"),
            (_instant(F.col("valid_to"), times[1], days) - 1).alias("__last"),
            F.struct(*[F.col(source).alias(name) for name, source in take.items()]).alias("__version"),
        )
        .na.drop(subset=names)
    )
    if small is None:
        small = _broadcastable(history)
    if small:
        out = _lookup_by_level(rows, versions, names, ts)
    else:
        # For dates the day is the unit, and a bucket has a whole number of them.
        unit = timedelta(days=1) if days else timedelta(microseconds=1)
        out = _lookup_by_bucket(rows, versions, names, ts, max(bucket // unit, 1).bit_length() - 1)
    return out.select(
        *fact.columns,
        *[
            F.when(F.col("__version").isNotNull(), F.col("__version")[name])
            .otherwise(_missing(unknown, name, history.schema[source].dataType))
            .alias(name)
            for name, source in take.items()
        ],
    )


def _instant(col: Column, dtype: T.DataType, days: bool) -> Column:
    """A whole number that never falls as ``col`` rises: days, microseconds, or the number itself."""
    if isinstance(dtype, T.DateType):
        day = F.unix_date(col).cast("bigint")
        return day if days else day * 86_400_000_000
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        # Not by way of a time zone, in which hours may be missing or come twice.
        second = (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
        minutes = F.unix_date(col.cast("date")).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)
        return minutes * 60_000_000 + second
    if isinstance(dtype, T.NumericType):
        return F.floor(col).cast("bigint")
    raise TypeError(f"no time order for {dtype.simpleString()}")


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark expects ``df`` to be within its limit for broadcasts; a look at the plan, not a job."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _same_key(names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, name in enumerate(names):
        condition = condition & (F.col(f"__f{i}") == F.col(name))
    return condition


LEVEL_BITS = 12


def _lookup_by_level(rows: DataFrame, versions: DataFrame, names: Sequence[str], ts: str) -> DataFrame:
    length = F.col("__last") - F.col("__first")
    found = []
    for bits in range(LEVEL_BITS, 63 + LEVEL_BITS, LEVEL_BITS):
        least = 1 << (bits - LEVEL_BITS) if bits > LEVEL_BITS else 0
        of_level = length >= least
        if bits < 63:
            of_level = of_level & (length < 1 << bits)
        shift = min(bits, 63)
        buckets = F.array_distinct(F.array(F.shiftright("__first", shift), F.shiftright("__last", shift)))
        level = versions.where(of_level).select(
            *names, "__from", "__to", F.explode(buckets).alias("__bucket"), F.col("__version").alias(f"__version{bits}")
        )
        valid = (F.col(ts) >= F.col("__from")) & (F.col(ts) < F.col("__to"))
        same_bucket = F.shiftright("__at", shift) == F.col("__bucket")
        rows = rows.join(level, _same_key(names) & same_bucket & valid, "left").drop(*names, "__from", "__to", "__bucket")
        found.append(F.col(f"__version{bits}"))
    return rows.withColumn("__version", F.coalesce(*found))


def _lookup_by_bucket(rows: DataFrame, versions: DataFrame, names: Sequence[str], ts: str, bits: int) -> DataFrame:
    begun = versions.withColumn("__bucket", F.shiftright("__first", bits)).drop("__first", "__last")
    version = F.struct("__from", "__to", "__version")
    latest = begun.groupBy(*names, "__bucket").agg(F.max_by(version, "__from").alias("__latest"))
    asked = rows.select(
        *[F.col(f"__f{i}").alias(name) for i, name in enumerate(names)], F.shiftright("__at", bits).alias("__bucket")
    )
    asked = asked.na.drop().distinct().withColumn("__asked", F.lit(True))
    # One row per key and bucket, whatever the numbers of facts and versions.
    summary = (
        latest.unionByName(asked, allowMissingColumns=True)
        .groupBy(*names, "__bucket")
        .agg(F.max("__asked").alias("__asked"), F.any_value("__latest", F.lit(True)).alias("__latest"))
    )
    earlier = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("__carried", F.last("__latest", ignorenulls=True).over(earlier))
        .where(F.col("__asked") & F.col("__carried").isNotNull())
        .select(*names, "__bucket", "__carried.*")
    )
    valid = (F.col(ts) >= F.col("__from")) & (F.col(ts) < F.col("__to"))
    same_bucket = F.shiftright("__at", bits) == F.col("__bucket")
    return rows.join(begun.unionByName(carried), _same_key(names) & same_bucket & valid, "left")


def calendar_dim(spark: SparkSession, start: Any, end: Any) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("dt")
    )
    dt = F.col("dt")
    iso_day = F.weekday(dt) + 1
    return days.select(
        dt,
        F.year(dt).alias("year"),
        F.quarter(dt).alias("quarter"),
        F.month(dt).alias("month"),
        F.weekofyear(dt).alias("iso_week"),
        iso_day.alias("iso_weekday"),
        (iso_day >= 6).alias("is_weekend"),
        (dt == F.last_day(dt)).alias("is_month_end"),
    )
