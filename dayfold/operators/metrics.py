"""Report metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions.columns import day_of, money, period_index, period_start
from dayfold.functions.hot import DEFAULT, HotSplit, find_hot, in_one_cell
from dayfold.operators.sequence import next_in_cells
from dayfold.operators.summaries import quantile_summary
from dayfold.session import written


def shift_period(start: Column, period: str, by: int) -> Column:
    if period in ("day", "week"):
        return F.date_add(start, by * (7 if period == "week" else 1))
    return F.add_months(start, by * {"month": 1, "quarter": 3, "year": 12}[period])


def _active_periods(events: DataFrame, id_col: str, ts: str, period: str) -> DataFrame:
    """Distinct (id, period): from here on an id has at most one row per period.

    Events without an id or a time count for no one.
    """
    known = F.col(id_col).isNotNull() & F.col(ts).isNotNull()
    return events.where(known).select(id_col, period_start(ts, period).alias("period")).distinct()


def new_ids(events: DataFrame, id_col: str, ts: str, period: str = "day") -> DataFrame:
    """Ids by the period in which they were first seen."""
    first = events.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(ts).alias("__first"))
    return (
        first.where("__first IS NOT NULL")
        .groupBy(period_start("__first", period).alias("period"))
        .agg(F.count(F.lit(1)).alias("new_ids"))
    )


def retention_matrix(events: DataFrame, id_col: str, ts: str, period: str = "month") -> DataFrame:
    """Per cohort and offset: ids still active, and their share of the cohort."""
    first = F.min("period").over(Window.partitionBy(id_col))
    ids = (
        _active_periods(events, id_col, ts, period)
        .withColumn("cohort", first)
        .groupBy("cohort", (period_index("period", period) - period_index("cohort", period)).alias("offset"))
        .agg(F.count(F.lit(1)).alias("active_ids"))
    )
    # Everyone in a cohort is active at offset 0. One row per offset here.
    size = F.max(F.when(F.col("offset") == 0, F.col("active_ids"))).over(Window.partitionBy("cohort"))
    return ids.withColumn("rate", F.col("active_ids") / size)


def lifecycle(events: DataFrame, id_col: str, ts: str, period: str = "month") -> DataFrame:
    """Per period: new, retained, returning and lapsed ids.

    Returning ids skipped at least one period; lapsed ids were active in the
    period before and are not now. The last period is the last in the data.
    """
    active = _active_periods(events, id_col, ts, period)
    final = active.agg(F.max("period")).scalar()
    in_order = Window.partitionBy(id_col).orderBy("period")
    index = period_index("period", period)
    rows = active.withColumns({"__prev": F.lag(index).over(in_order), "__next": F.lead(index).over(in_order)})
    kind = (
        F.when(F.col("__prev").isNull(), "new")
        .when(index - F.col("__prev") == 1, "retained")
        .otherwise("returning")
    )
    following = shift_period(F.col("period"), period, 1)
    gone = F.col("__next").isNull() | (F.col("__next") - index > 1)
    states = F.array_compact(
        F.array(
            F.struct(F.col("period").alias("period"), kind.alias("kind")),
            F.when(gone, F.struct(following.alias("period"), F.lit("lapsed").alias("kind"))),
        )
    )
    return (
        rows.select(F.explode(states).alias("s"))
        .select("s.*")
        .groupBy("period")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_ids") for k in ("new", "retained", "returning", "lapsed")])
        .where(F.col("period") <= final)
    )


def streaks(events: DataFrame, id_col: str, ts: str) -> DataFrame:
    """Runs of consecutive active days per id: first day, last day and length."""
    days = _active_periods(events, id_col, ts, "day")
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy("period"))
    return (
        days.withColumn("__run", F.date_sub("period", nth))
        .groupBy(id_col, "__run")
        .agg(
            F.min("period").alias("start_day"),
            F.max("period").alias("end_day"),
            F.count(F.lit(1)).alias("days"),
        )
        .drop("__run")
    )


def funnel(
    events: DataFrame,
    id_col: str,
    ts: str,
    kind: str,
    steps: Sequence[str],
    within: timedelta,
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Ids that reach each step.

    A run starts at the id's first event of step one; each further step is the
    earliest strictly later event of its kind, at most ``within`` after the start.

    Ids with very many events keep one row of progress each, at most one per ``split.min_rows`` events, which goes to the
    events where they are; these are reduced there and never gathered by id. All others are joined by id.
    """
    used = events.where(F.col(kind).isin(list(steps)) & F.col(id_col).isNotNull()).select(id_col, ts, kind)
    hot = find_hot(used, [id_col], split)
    reached = [f"__at{i}" for i in range(len(steps))]

    def of(part: DataFrame, step: str) -> DataFrame:
        return part.where(F.col(kind) == step).select(F.col(id_col).alias("__id"), F.col(ts).alias("__ts"))

    def first(part: DataFrame) -> DataFrame:
        return of(part, steps[0]).groupBy(F.col("__id").alias(id_col)).agg(F.min("__ts").alias("__at0"))

    def later(i: int) -> Column:
        within_time = F.col("__ts") <= F.col("__at0") + F.lit(within)
        return (F.col(id_col) == F.col("__id")) & (F.col("__ts") > F.col(f"__at{i - 1}")) & within_time

    calm = used if hot is None else hot.rest(used)
    state = first(calm)
    for i, step in enumerate(steps[1:], start=1):
        joined = state.join(of(calm, step), later(i), "left").groupBy(id_col)
        state = joined.agg(*[F.min(c).alias(c) for c in reached[:i]], F.min("__ts").alias(f"__at{i}"))
    counts = state.agg(*[F.count(c).alias(c) for c in reached])
    if hot is not None:
        busy = hot.only(used)
        state = written(first(busy), "funnel-progress")
        for i, step in enumerate(steps[1:], start=1):
            found = of(busy, step).join(F.broadcast(state), later(i)).groupBy("__id").agg(F.min("__ts").alias(f"__at{i}"))
            state = written(state.join(found, F.col(id_col) == F.col("__id"), "left").drop("__id"), "funnel-progress")
        both = counts.unionByName(state.agg(*[F.count(c).alias(c) for c in reached]))
        counts = both.agg(*[F.sum(c).alias(c) for c in reached])
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("kind"), F.col(f"__at{i}").alias("ids"))
            for i, s in enumerate(steps)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def topk_per_group(
    df: DataFrame,
    group: Sequence[str],
    metric: str,
    k: int,
    ties: str = "row",
    tiebreak: Sequence[str] = (),
    out: str = "place",
    lanes: int = 64,
) -> DataFrame:
    """The ``k`` highest per group, with ``row``, ``rank`` or ``dense_rank`` ties.

    For ``row`` each map task keeps at most ``k`` rows per group before the
    shuffle. Spark does that on its own up to its group-limit threshold (100,000 after
    :func:`~dayfold.session.configure`); for a larger ``k`` a first cut is made in ``lanes`` parts per group. The other two
    may keep any number of tied rows, so places are found from the distinct
    metric values, cut likewise, and joined back.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if ties == "row":
        best = [F.col(metric).desc_nulls_last(), *tiebreak]
        if k > limit:
            lane = F.pmod(F.xxhash64(metric, *tiebreak), F.lit(lanes))
            part = Window.partitionBy(*group, "__lane").orderBy(*best)
            df = df.withColumn("__lane", lane).withColumn("__nth", F.row_number().over(part))
            df = df.where(F.col("__nth") <= k).drop("__lane", "__nth")
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*best))
        return df.withColumn(out, place.cast("bigint")).where(F.col(out) <= k)
    if ties not in ("rank", "dense_rank"):
        raise ValueError(f"ties must be row, rank or dense_rank, not {ties!r}")

    keys = [*group, metric]
    names = [f"__l{i}" for i in range(len(keys))]
    levels = df.groupBy(*[F.col(c).alias(n) for c, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n"))
    by_level = Window.partitionBy(*names[:-1]).orderBy(F.col(names[-1]).desc_nulls_last())
    if k > limit:
        lane = F.pmod(F.xxhash64(names[-1]), F.lit(lanes))
        part = Window.partitionBy(*names[:-1], "__lane").orderBy(F.col(names[-1]).desc_nulls_last())
        levels = levels.withColumn("__lane", lane).withColumn("__nth", F.row_number().over(part))
        levels = levels.where(F.col("__nth") <= k).drop("__lane", "__nth")
    # A rank of at most k lies among the first k distinct values.
    top = levels.withColumn("__dense", F.row_number().over(by_level)).where(F.col("__dense") <= k)
    above = F.sum("__n").over(by_level.rowsBetween(Window.unboundedPreceding, -1))
    place = F.col("__dense").cast("bigint") if ties == "dense_rank" else F.coalesce(above, F.lit(0)) + 1
    top = top.withColumn(out, place).where(F.col(out) <= k)
    condition = F.col(keys[0]).eqNullSafe(F.col(names[0]))
    for c, n in zip(keys[1:], names[1:]):
        condition = condition & F.col(c).eqNullSafe(F.col(n))
    return df.join(top, condition).select(*df.columns, out)


def period_growth(
    agg: DataFrame, keys: Sequence[str], period_col: str, period: str, measure: str
) -> DataFrame:
    """Change from the previous period and from the same period last year.

    ``agg`` has one row per keys and period start. Each row is also sent to the
    two periods that compare with it, so a missing period gives NULL and not
    the nearest one. The 29th of February has no day to compare with.
    """
    at, value = F.col(period_col), F.col(measure)
    year_later = F.date_add(at, 364) if period == "week" else F.add_months(at, 12)
    year_back = F.date_sub(year_later, 364) if period == "week" else F.add_months(year_later, -12)

    def sent(to: Column, role: str) -> Column:
        return F.struct(to.alias("__to"), F.lit(role).alias("__role"), value.alias("__value"))

    targets = F.array_compact(
        F.array(
            sent(at, "now"),
            sent(shift_period(at, period, 1), "prev"),
            F.when(year_back == at, sent(year_later, "year")),
        )
    )
    rows = agg.select(*keys, F.explode(targets).alias("__t")).select(*keys, "__t.*")

    def role(name: str) -> Column:
        return F.max(F.when(F.col("__role") == name, F.col("__value")))

    def growth(base: str) -> Column:
        return F.when(F.col(base) != 0, F.col(measure).cast("double") / F.col(base).cast("double") - 1)

    return (
        rows.groupBy(*keys, F.col("__to").alias(period_col))
        .agg(
            F.max((F.col("__role") == "now").cast("int")).alias("__exists"),
            role("now").alias(measure),
            role("prev").alias("previous"),
            role("year").alias("last_year"),
        )
        .where("__exists = 1")
        .drop("__exists")
        .withColumns({"growth": growth("previous"), "growth_on_year": growth("last_year")})
    )


def repeat_rate(lines: DataFrame, group: Sequence[str], id_col: str, order: str, times: int = 2) -> DataFrame:
    """Share of a group's buyers with at least ``times`` distinct orders."""
    buyers = lines.groupBy(*group, id_col).agg(F.count_distinct(order).alias("__orders"))
    return (
        buyers.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("buyers"), F.count_if(F.col("__orders") >= times).alias("repeat_buyers"))
        .withColumn("rate", F.col("repeat_buyers") / F.col("buyers"))
    )


def transitions(
    events: DataFrame,
    id_col: str,
    ts: str,
    kind: str,
    gap: timedelta,
    tiebreak: Sequence[str] = (),
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Counts of (event, next event) inside a session, ``exit`` at its end.

    A session ends where the next event of the id comes more than ``gap`` later.
    Copies of one event follow each other: of ids with very many events they are
    counted before the shuffle, and all but the last lead to their own kind.
    """
    columns = list(dict.fromkeys([id_col, ts, kind, *tiebreak]))
    rows = events.where(F.col(ts).isNotNull()).select(columns)
    def pairs(nexts: DataFrame, copies: Column) -> DataFrame:
        stays = F.col("next")[ts] - F.col(ts) <= F.lit(gap)
        onward = F.struct(
            F.col(kind).alias("from_event"),
            F.when(stays, F.col("next")[kind]).otherwise("exit").alias("to_event"),
            F.lit(1).cast("bigint").alias("n"),
        )
        again = F.struct(F.col(kind).alias("from_event"), F.col(kind).alias("to_event"), (copies - 1).alias("n"))
        return nexts.select(F.explode(F.array_compact(F.array(onward, F.when(copies > 1, again)))).alias("p"))

    order = [ts, *tiebreak]
    hot = find_hot(rows, [id_col], split)
    if hot is None:
        both = pairs(next_in_cells(in_one_cell(rows, [id_col]), id_col, order, [kind], "next"), F.lit(1)).select("p.*")
        return both.groupBy("from_event", "to_event").agg(F.sum("n").alias("n"))
    counted = hot.only(rows).groupBy(columns).agg(F.count(F.lit(1)).alias("__n"))
    calm = next_in_cells(in_one_cell(hot.rest(rows), [id_col]), id_col, order, [kind], "next")
    busy = next_in_cells(hot.in_ranges(counted, order), id_col, order, [kind], "next", is_split=True)
    both = pairs(calm, F.lit(1)).unionByName(pairs(busy, F.col("__n"))).select("p.*")
    return both.groupBy("from_event", "to_event").agg(F.sum("n").alias("n"))


def rfm_segments(
    orders: DataFrame,
    id_col: str,
    ts: str,
    amount: str,
    as_of: Any,
    buckets: int = 5,
    how: str = "discrete",
    split: HotSplit = DEFAULT,
) -> DataFrame:
    """Recency, frequency and money scores from 1 to ``buckets`` (best).

    Scores compare each id with the quantiles of all ids, ``how`` being
    ``"discrete"`` (exact) or ``"approx"``. The cuts are one row each, so no
    global ranking of ids is needed and equal values get equal scores.
    """
    end = F.lit(as_of).cast("date")
    per_id = (
        orders.where(F.col(id_col).isNotNull() & (F.col(ts) < F.date_add(end, 1)))
        .groupBy(id_col)
        .agg(
            F.date_diff(end, day_of(F.max(ts))).cast("bigint").alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum(money(amount)).alias("monetary"),
        )
    )
    measures = ["recency_days", "frequency", "monetary"]
    names = {f"c{i}": i / buckets for i in range(1, buckets)}
    # All three measures in one pass, as three groups of one long column.
    long = per_id.select([F.col(m).cast("decimal(28,2)").alias(m) for m in measures]).unpivot(
        [], measures, "measure", "value"
    )
    cuts = quantile_summary(long, ["measure"], "value", names, how, split=split)
    # Three rows, and so one small map.
    entry = F.struct("measure", F.array(*names))
    table = cuts.agg(F.map_from_entries(F.collect_list(entry))).scalar()

    def above(measure: str) -> Column:
        return F.size(F.filter(F.col("__cuts")[measure], lambda cut: F.col(measure) > cut))

    scored = per_id.withColumn("__cuts", table).withColumns(
        {
            "r_score": F.lit(buckets) - above("recency_days"),
            "f_score": above("frequency") + 1,
            "m_score": above("monetary") + 1,
        }
    )
    return scored.drop("__cuts")


def cohort_value(orders: DataFrame, id_col: str, ts: str, amount: str, period: str = "month") -> DataFrame:
    """Running spend per cohort and offset, in total and per cohort member."""
    known = F.col(id_col).isNotNull() & F.col(ts).isNotNull()
    spend = (
        orders.where(known)
        .groupBy(id_col, period_start(ts, period).alias("period"))
        .agg(F.sum(money(amount)).alias("__spend"))
        .withColumn("cohort", F.min("period").over(Window.partitionBy(id_col)))
        .groupBy("cohort", (period_index("period", period) - period_index("cohort", period)).alias("offset"))
        .agg(F.sum("__spend").alias("spend"), F.count(F.lit(1)).alias("__ids"))
    )
    by_offset = Window.partitionBy("cohort").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    members = F.first("__ids").over(by_offset)
    running = F.sum("spend").over(by_offset)
    return spend.select(
        "cohort",
        "offset",
        members.alias("members"),
        "spend",
        running.alias("running_spend"),
        (running.cast("double") / members).alias("spend_per_member"),
    )


def period_set_compare(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Each id of ``a`` or ``b`` as kept (in both), lost (only ``a``) or gained (only ``b``)."""
    sides = a.select(id_col, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        b.select(id_col, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    both = sides.groupBy(id_col).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
    status = F.when(F.col("__a") + F.col("__b") == 2, "kept").when(F.col("__a") == 1, "lost").otherwise("gained")
    return both.select(id_col, status.alias("status"))

