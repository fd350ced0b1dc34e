"""Clean and conform."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions.hot import in_lane_zero, null_lane


def latest_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_cols``, which must order a key's rows totally.

    Catalyst turns the ``= 1`` filter into a group limit below the shuffle, so
    each map task sends at most one row per key, however hot the key.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__nth")


def conform_types(df: DataFrame, spec: Mapping[str, tuple[str, Any]]) -> DataFrame:
    """Cast columns; a value that does not cast, or is NULL, becomes the default.

    ``spec`` maps a column to ``(type, default)``.
    """
    return df.withColumns(
        {
            name: F.coalesce(F.col(name).try_cast(dtype), F.lit(default).cast(dtype))
            for name, (dtype, default) in spec.items()
        }
    )


def tag_rejects(df: DataFrame, rules: Mapping[str, Column], column: str = "reject_reasons") -> DataFrame:
    """Add the names of the rules a row fails; a rule that is NULL counts as failed."""
    failed = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(column, F.array_compact(F.array(*failed)))


def split_valid(
    df: DataFrame, rules: Mapping[str, Column], column: str = "reject_reasons"
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; the rejected rows carry their reasons.

    Writing both reads the input twice. To read it once, write the result of
    :func:`tag_rejects` partitioned by whether the reasons are empty.
    """
    tagged = tag_rejects(df, rules, column)
    return tagged.where(F.size(column) == 0).drop(column), tagged.where(F.size(column) > 0)


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Child rows without a parent; ``on`` maps child columns to parent columns.

    A row with a NULL key is an orphan. Where such rows are known to be many,
    ``spread_by`` names columns, a row id say, by which they are spread over the
    tasks; otherwise they are left to AQE like any other hot key.
    """
    parents = [f"__p{i}" for i in range(len(on))]
    # One row per key, reduced before it is shuffled.
    known = parent.select([F.col(p).alias(name) for p, name in zip(on.values(), parents)]).na.drop().distinct()
    condition = F.col("__lane") == F.col("__zero")
    for name, key in zip(on, parents):
        condition = condition & (F.col(name) == F.col(key))
    lane = null_lane(list(on), spread_by)
    spread = child.withColumn("__lane", lane)
    return spread.join(in_lane_zero(known, "__zero"), condition, "left_anti").drop("__lane")


def mask_columns(df: DataFrame, spec: Mapping[str, str | tuple[str, int]], salt: str) -> DataFrame:
    """Mask columns by ``"hash"`` (salted SHA-256) or ``("keep_last", n)``.

    ``keep_last`` replaces each character before the last ``n`` by ``*``; a value
    of ``n`` characters or fewer is masked whole, so short values do not leak.
    """
    masked = {}
    for name, how in spec.items():
        text = F.col(name).cast("string")
        if how == "hash":
            masked[name] = F.sha2(F.concat(F.lit(salt), text), 256)
        elif isinstance(how, tuple) and how[0] == "keep_last":
            hidden = F.length(text) - F.lit(how[1])
            masked[name] = F.when(hidden <= 0, F.repeat(F.lit("*"), F.length(text))).otherwise(
                F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.lit(how[1])))
            )
        else:
            raise ValueError(f"unknown masking for {name}: {how!r}")
    return df.withColumns(masked)
