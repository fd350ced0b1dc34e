"""Operators on each key's rows in time order: sessions, next event, as-of match."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

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
    in_one_cell,
    seeded,
)


def sessionize(
    events: DataFrame,
    user: str,
    ts: str,
    gap: timedelta,
    out: str = "session_no",
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Number each user's sessions; a wait *longer than* ``gap`` opens a new one.

    Events without a time belong to no session and get NULL.
    """
    hot = find_hot(events, [user], split)
    if hot is None:
        numbered = _number_sessions(seeded(in_one_cell(events, [user])), user, ts, gap, out)
    else:
        calm = _number_sessions(seeded(in_one_cell(hot.rest(events), [user])), user, ts, gap, out)
        rows = hot.in_ranges(hot.only(events), [ts])
        busy = _number_sessions(seeded(rows, (_sessions_before(rows, user, ts, gap), BEFORE)), user, ts, gap, out)
        numbered = calm.select(*events.columns, out).unionByName(busy.select(*events.columns, out))
    return numbered.select(*events.columns, out)


def _opens(previous: Column, now: Column, gap: timedelta) -> Column:
    return (now.isNotNull() & (previous.isNull() | (now - previous > F.lit(gap)))).cast("bigint")


def _number_sessions(rows: DataFrame, user: str, ts: str, gap: timedelta, out: str) -> DataFrame:
    """A seed has the last time before its cell and, as ``__opened``, the sessions before it."""
    in_order = in_cells([user]).orderBy(SEED, ts)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    step = _opens(F.col("__prev"), F.col(ts), gap)
    if "__opened" in rows.columns:
        step = F.when(F.col(SEED) == ROW, step).otherwise(F.col("__opened"))
    return (
        rows.withColumn("__prev", F.lag(ts).over(in_order))
        .withColumn("__step", step)
        .withColumn("__number", F.sum("__step").over(so_far))
        .where(F.col(SEED) == ROW)
        .withColumn(out, F.when(F.col(ts).isNotNull(), F.col("__number")))
    )


def _sessions_before(rows: DataFrame, user: str, ts: str, gap: timedelta) -> DataFrame:
    """Per range: the last time before it, and the sessions opened until then."""
    inside = rows.select(user, CELL, ts).withColumn("__prev", F.lag(ts).over(in_cells([user]).orderBy(ts)))
    per_cell = inside.groupBy(user, CELL).agg(
        F.sum(F.when(F.col("__prev").isNull(), 0).otherwise(_opens(F.col("__prev"), F.col(ts), gap))).alias("__inner"),
        F.min(ts).alias("__first"),
        F.max(ts).alias("__last"),
    )
    along = cells_along([user])
    linked = per_cell.withColumn("__prev", F.lag("__last").over(along)).withColumn(
        "__opened", F.col("__inner") + _opens(F.col("__prev"), F.col("__first"), gap)
    )
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return linked.select(
        user, CELL, F.col("__prev").alias(ts), F.sum("__opened").over(earlier).alias("__opened")
    ).where("__opened IS NOT NULL")


def next_event(
    events: DataFrame,
    user: str,
    ts: str,
    values: Sequence[str],
    tiebreak: Sequence[str] = (),
    out: str = "next",
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Each event with a struct of the user's next event (its time and ``values``).

    Events of one user at one identical time follow each other by ``tiebreak``; of those equal in that too,
    any may come first.
    """
    order = [ts, *tiebreak]
    hot = find_hot(events, [user], split)
    if hot is None:
        return next_in_cells(in_one_cell(events, [user]), user, order, values, out).select(*events.columns, out)
    calm = next_in_cells(in_one_cell(hot.rest(events), [user]), user, order, values, out)
    busy = next_in_cells(hot.in_ranges(hot.only(events), order), user, order, values, out, is_split=True)
    return calm.select(*events.columns, out).unionByName(busy.select(*events.columns, out))


def next_in_cells(
    rows: DataFrame, user: str, order: Sequence[str], values: Sequence[str], out: str, is_split: bool = False
) -> DataFrame:
    """The next event of each row, of its own cell or, where groups are split, of the first row of the next."""
    here = F.struct(order[0], *values)
    seeds = []
    if is_split:
        first = rows.groupBy(user, CELL).agg(F.min_by(here, F.struct(*order)).alias("__here"))
        following = first.withColumn("__here", F.lead("__here").over(cells_along([user])))
        seeds = [(following.where("__here IS NOT NULL"), AFTER)]
    in_order = in_cells([user]).orderBy(SEED, *order)
    marked = seeded(rows.withColumn("__here", here), *seeds)
    return marked.withColumn(out, F.lead("__here").over(in_order)).where(F.col(SEED) == ROW)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    suffix: str = "_right",
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Each left row with the last right row at or before it, per ``by``.

    Equal times match; of several right rows at one time the last by
    ``tiebreak`` counts. A left row without a match, or with a NULL key or
    time, is kept with NULLs. Right columns that exist on the left get
    ``suffix``.

    Both sides are stacked and sorted, so every row is read once and no pairs
    are formed. Rows of keys with very many are dealt over ranges, each of which starts from
    the last right row before it.
    """
    taken = [c for c in right.columns if c not in by]
    names = {c: c + suffix if c in left.columns else c for c in taken}
    match = F.struct(*[F.col(c).alias(name) for c, name in names.items()])
    order = [f"__t{i}" for i in range(len(tiebreak))]
    has_key = F.lit(True)
    for key in by:
        has_key = has_key & F.col(key).isNotNull()

    lefts = left.select(*by, F.col(ts).alias("__ts"), F.struct(*left.columns).alias("__left"))
    rights = right.where(has_key & F.col(ts).isNotNull()).select(
        *by,
        F.col(ts).alias("__ts"),
        *[F.col(c).alias(name) for c, name in zip(tiebreak, order)],
        match.alias("__match"),
    )
    hot = find_hot(left.select(*by).unionAll(right.select(*by)), by, split)
    if hot is None:
        out = _last_before(in_one_cell(_stacked(lefts, rights), by), by, order)
    else:
        calm = _last_before(in_one_cell(_stacked(hot.rest(lefts), hot.rest(rights)), by), by, order)
        rows = hot.in_ranges(_stacked(hot.only(lefts), hot.only(rights)), ["__ts", "__side", *order])
        # The last right row of a range, carried to those behind it.
        place = F.when(F.col("__side") == 0, F.struct("__ts", *order))
        earlier = cells_along(by).rowsBetween(Window.unboundedPreceding, -1)
        seeds = (
            rows.groupBy(*by, CELL)
            .agg(F.max_by("__match", place).alias("__match"))
            .withColumn("__match", F.last("__match", ignorenulls=True).over(earlier))
            .where("__match IS NOT NULL")
        )
        busy = _last_before(rows, by, order, (seeds, BEFORE))
        out = calm.select(*by, "__ts", "__left", "__found").unionByName(busy.select(*by, "__ts", "__left", "__found"))
    return out.withColumn("__found", F.when(has_key & F.col("__ts").isNotNull(), F.col("__found"))).select(
        "__left.*", *[F.col("__found")[name].alias(name) for name in names.values()]
    )


def _stacked(lefts: DataFrame, rights: DataFrame) -> DataFrame:
    """Right rows are side 0, so that they sort before left rows of the same time."""
    return rights.withColumn("__side", F.lit(0)).unionByName(
        lefts.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )


def _last_before(rows: DataFrame, by: Sequence[str], order: Sequence[str], *seeds: tuple[DataFrame, int]) -> DataFrame:
    in_order = in_cells(by).orderBy(SEED, "__ts", "__side", *order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        seeded(rows, *seeds)
        .withColumn("__found", F.last("__match", ignorenulls=True).over(so_far))
        .where((F.col(SEED) == ROW) & (F.col("__side") == 1))
    )
