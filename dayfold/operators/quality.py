"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.operators.clean import orphan_rows


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, and min and max as text.

    Each column is counted by value on its own, which reads just that column and
    shuffles each of its values once per map task; everything else follows from
    the counts. One aggregate with several exact distinct counts would instead
    copy every row once per column. ``approx`` sketches the distinct counts and
    so needs a single pass that shuffles next to nothing.
    """
    columns = list(columns or df.columns)
    if not approx:
        parts = []
        for c in columns:
            value, n = F.col("__value"), F.col("__n")
            per_value = df.groupBy(F.col(c).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
            zero = F.lit(0).cast("bigint")
            parts.append(
                per_value.agg(
                    F.lit(c).alias("column"),
                    F.coalesce(F.sum(n), zero).alias("rows"),
                    F.coalesce(F.sum(F.when(value.isNull(), n)), zero).alias("nulls"),
                    F.count(value).alias("distinct_values"),
                    F.min(value).cast("string").alias("min_value"),
                    F.max(value).cast("string").alias("max_value"),
                )
            )
        return reduce(DataFrame.unionByName, parts)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"__present{i}"),
            F.approx_count_distinct(c).alias(f"__distinct{i}"),
            F.min(c).cast("string").alias(f"__min{i}"),
            F.max(c).cast("string").alias(f"__max{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("__rows").alias("rows"),
            (F.col("__rows") - F.col(f"__present{i}")).alias("nulls"),
            F.col(f"__distinct{i}").alias("distinct_values"),
            F.col(f"__min{i}").alias("min_value"),
            F.col(f"__max{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*lines)).alias("p")).select("p.*")


@dataclass(frozen=True)
class NotNull:
    column: str

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InRange:
    """NULL fails."""

    column: str
    low: Any
    high: Any

    def fails(self) -> Column:
        return ~F.coalesce(F.col(self.column).between(self.low, self.high), F.lit(False))


@dataclass(frozen=True)
class InSet:
    """NULL fails."""

    column: str
    allowed: Sequence[Any]

    def fails(self) -> Column:
        return ~F.coalesce(F.col(self.column).isin(list(self.allowed)), F.lit(False))


@dataclass(frozen=True)
class Unique:
    """Counts the key values that occur more than once."""

    columns: Sequence[str]


@dataclass(frozen=True)
class References:
    """Counts the rows without a parent; a NULL key has none."""

    column: str
    parent: DataFrame
    parent_column: str


Rule = NotNull | InRange | InSet | Unique | References


def rule_audit(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """One row per rule with its number of failures.

    All rules on single rows share one scan; each key rule adds an aggregation
    that is combined below the shuffle, or an anti-join.
    """
    parts = []
    row_rules = {n: r for n, r in rules.items() if isinstance(r, (NotNull, InRange, InSet))}
    if row_rules:
        counts = df.agg(*[F.count_if(r.fails()).alias(f"__r{i}") for i, r in enumerate(row_rules.values())])
        lines = [
            F.struct(F.lit(n).alias("rule"), F.col(f"__r{i}").alias("failures")) for i, n in enumerate(row_rules)
        ]
        parts.append(counts.select(F.explode(F.array(*lines)).alias("r")).select("r.*"))
    for name, rule in rules.items():
        if isinstance(rule, Unique):
            bad = df.groupBy(*rule.columns).count().where(F.col("count") > 1)
        elif isinstance(rule, References):
            child = df.select(rule.column).groupBy(rule.column).agg(F.count(F.lit(1)).alias("__n"))
            bad = orphan_rows(child, rule.parent, {rule.column: rule.parent_column}, spread_by=[rule.column])
        else:
            continue
        total = F.coalesce(F.sum("__n"), F.lit(0)) if isinstance(rule, References) else F.count(F.lit(1))
        parts.append(bad.agg(F.lit(name).alias("rule"), total.cast("bigint").alias("failures")))
    return reduce(DataFrame.unionByName, parts)


def volume_drift(
    daily: DataFrame,
    dims: Sequence[str],
    value: str,
    n: int,
    tolerance: float,
    day: str = "dt",
) -> DataFrame:
    """Judge each day against the mean of the previous ``n`` rows of the same dims.

    ``is_drift`` is NULL for the first ``n`` days, which are not judged.
    """
    before = Window.partitionBy(*dims).orderBy(day).rowsBetween(-n, -1)
    total, rows = F.sum(value).over(before), F.count(value).over(before)
    # Compared without division: |value * n - total| > tolerance * total.
    off = F.abs(F.col(value) * n - F.col("__total")) > F.lit(Decimal(str(tolerance))) * F.abs("__total")
    return (
        daily.withColumns({"__total": total, "__rows": rows})
        .withColumns(
            {
                "previous_mean": F.when(F.col("__rows") == n, F.col("__total").cast("double") / n),
                "is_drift": F.when(F.col("__rows") == n, off),
            }
        )
        .drop("__total", "__rows")
    )


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys are only in ``a``, only in ``b``, different or the same.

    NULLs equal each other. A key that occurs more than once on a side counts
    as ``repeated``. With no ``keys``, whole rows are compared with
    multiplicity, and none can be different or repeated.

    Both sides are stacked and grouped rather than joined, so that repeated or
    NULL keys are combined below the shuffle and cannot multiply.
    """
    columns = a.columns
    group = list(keys) or columns
    rest = [c for c in columns if c not in group]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("__none"))

    def side(df: DataFrame, left: int) -> DataFrame:
        return df.select(columns).select(
            *group, row.alias("__row"), F.lit(left).alias("__a"), F.lit(1 - left).alias("__b")
        )

    stacked = side(a, 1).unionByName(side(b, 0))
    if not keys:
        counts = stacked.groupBy(*group).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
        zero = F.lit(0).cast("bigint")
        totals = counts.agg(
            F.sum(F.greatest(F.col("__a") - F.col("__b"), zero)).alias("only_left"),
            F.sum(F.greatest(F.col("__b") - F.col("__a"), zero)).alias("only_right"),
            F.sum(F.least("__a", "__b")).alias("same"),
        )
        kinds = ["only_left", "only_right", "same"]
    else:
        # Equal rows are counted first, so that hash aggregates do where extremes of rows need sorts.
        rows = stacked.groupBy(*group, "__row").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
        per_key = rows.groupBy(*group).agg(
            F.sum("__a").alias("__a"), F.sum("__b").alias("__b"), F.count(F.lit(1)).alias("__rows")
        )
        status = (
            F.when((F.col("__a") > 1) | (F.col("__b") > 1), "repeated")
            .when(F.col("__b") == 0, "only_left")
            .when(F.col("__a") == 0, "only_right")
            .when(F.col("__rows") == 1, "same")
            .otherwise("different")
        )
        kinds = ["only_left", "only_right", "different", "same", "repeated"]
        totals = per_key.select(status.alias("__s")).agg(*[F.count_if(F.col("__s") == k).alias(k) for k in kinds])
    lines = [
        F.struct(F.lit(k).alias("status"), F.coalesce(F.col(k), F.lit(0).cast("bigint")).alias("keys")) for k in kinds
    ]
    return totals.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def reconcile_digests(
    a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = 4096, parts: int = 1024
) -> DataFrame:
    """As :func:`reconcile`, for tables that are mostly equal: rows are shuffled only where digests differ.

    Rows are summed up per bucket of the key (of the whole row without ``keys``): their number and two sums of
    hashes, in which order plays no part. Map tasks pass on one digest per bucket. Buckets that differ, at most
    ``buckets``, are read again and divided into ``parts`` each; only rows of parts that differ are compared as
    they are. Equal tables thus shuffle digests alone.

    The keys must be unique on both sides, or the key be left out: in a bucket with equal digests every row counts as
    ``same``, also a key that is repeated alike on both sides. Two 64-bit sums of different rows agree by
    chance once in 10^38 pairs of buckets.
    """
    columns = a.columns
    b = b.select([F.col(c).cast(a.schema[c].dataType).alias(c) for c in columns])
    place = list(keys) or columns
    marks = {
        "__bucket": F.pmod(F.xxhash64(*place), F.lit(buckets)).cast("int"),
        "__part": F.pmod(F.xxhash64(F.lit("part"), *place), F.lit(parts)).cast("int"),
    }

    def digests(df: DataFrame, level: Sequence[str], side: str) -> DataFrame:
        sums = [F.sum(F.xxhash64(F.lit(n), *columns).cast("decimal(38,0)")) for n in (1, 2)]
        rows = F.count(F.lit(1))
        return df.groupBy(*level).agg(F.struct(rows.alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(sums)]).alias(side))

    def compared(left: DataFrame, right: DataFrame, level: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Places that differ, and the number of rows in those that do not."""
        both = digests(left, level, "__a").join(digests(right, level, "__b"), list(level), "full")
        equal = F.col("__a").eqNullSafe(F.col("__b"))
        return both.where(~equal).select(*level), both.where(equal).agg(F.sum("__a.n").alias("keys"))

    a, b = a.withColumns(marks), b.withColumns(marks)
    differ, same = compared(a, b, ["__bucket"])
    # At most ``buckets`` numbers.
    differ = F.broadcast(differ)
    a, b = (df.join(differ, "__bucket", "left_semi") for df in (a, b))
    level = ["__bucket", "__part"]
    differ, same_parts = compared(a, b, level)
    a, b = (df.join(differ, level, "left_semi").select(columns) for df in (a, b))
    more = same.unionByName(same_parts).select(F.lit("same").alias("status"), "keys")
    return reconcile(a, b, keys).unionByName(more).groupBy("status").agg(F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"))
