"""Split groups too large for one task into ordered ranges.

A window over a key puts all rows of that key into one task. Here the few keys
with very many rows are dealt over tasks by range: sorted by key, position and tiebreak, and
cut wherever a task is full, be it amid rows of one instant. A window then runs per (key, range), and
what a range has to know of those before or after it comes in as one extra
*seed* row, built from one summary row per range: a prefix scan in two passes. No row is
dropped and the result does not depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dayfold.session import written

CELL = "__cell"
SEED = "__seed"
BEFORE, ROW, AFTER = 0, 1, 2


@dataclass(frozen=True)
class HotSplit:
    """When a group counts as hot, and how finely it is cut.

    Every group with more than ``min_rows`` rows is hot. Of n rows there are at most
    n / min_rows such groups, each a few bytes, which bounds the list that is broadcast: for 10^12 rows and
    the defaults some 10^6 groups. Their rows are dealt over as many ranges as hold ``rows_per_cell`` each.
    ``enabled=False`` splits nothing and leaves out the pass that looks for hot groups.
    """

    min_rows: int = 1_000_000
    rows_per_cell: int = 1_000_000
    enabled: bool = True


# Groups of so many rows are few in any table. Of smaller ones the list is counted, and joined by a shuffle
# where it is longer than the second figure.
FEW_FROM = 100_000
MOST_BROADCAST = 100_000
# Rows are dealt over at most so many tasks, as the driver gets a sample of the rows for each.
MOST_PARTS = 1000

DEFAULT = HotSplit()
NO_SPLIT = HotSplit(enabled=False)


def group_hash(keys: Sequence[str]) -> Column:
    """A hash keeps the list of hot groups small whatever the key's type.

    Two groups with one hash are merely treated alike.
    """
    return F.xxhash64(*(keys or [F.lit(0)]))


def _large(sizes: DataFrame, split: HotSplit) -> DataFrame:
    return sizes.where(F.col("__n") > split.min_rows) if split.enabled else sizes.where(F.lit(False))


class HotGroups:
    """The hot groups of ``df`` by ``keys``, to be treated apart from the rest."""

    def __init__(self, df: DataFrame, keys: Sequence[str], split: HotSplit = DEFAULT):
        self.group = group_hash(keys)
        self.split = split
        sizes = df.select(self.group.alias("__group")).groupBy("__group").agg(F.count(F.lit(1)).alias("__n"))
        # At most rows / min_rows pairs of longs.
        large = _large(sizes, split)
        self.few = not split.enabled or split.min_rows >= FEW_FROM
        if not self.few:
            large = written(large, "hot-groups")
            self.few = large.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        # By its compressed size Spark might still broadcast a list that is too long for it.
        self.hot = F.broadcast(large) if self.few else large.hint("merge")

    def only(self, df: DataFrame, group: Column | None = None) -> DataFrame:
        """The rows of hot groups; ``group`` is their hash where the keys have other names."""
        marked = df.withColumn("__group", self.group if group is None else group)
        return marked.join(self.hot, "__group", "left_semi").drop("__group")

    def rest(self, df: DataFrame, group: Column | None = None) -> DataFrame:
        marked = df.withColumn("__group", self.group if group is None else group)
        return marked.join(self.hot, "__group", "left_anti").drop("__group")

    def with_totals(self, rows: DataFrame, totals: DataFrame, key: str) -> DataFrame:
        """``rows``, each with the row of ``totals`` of its key; ``totals`` has one row per hot group."""
        if self.few:
            return rows.join(F.broadcast(totals), key)
        laned = rows.where(F.col(key).isNotNull()).withColumn("__lane", F.lit(0))
        return laned.join(in_lane_zero(totals, "__lane").hint("merge"), [key, "__lane"]).drop("__lane")

    def lanes(self, df: DataFrame, name: str) -> DataFrame:
        """All rows, with the number of lanes their group's rows fill; NULL where it is not hot."""
        lanes = F.ceil(F.col("__n") / F.lit(self.split.rows_per_cell)).cast("int").alias(name)
        hot = self.hot.select("__group", lanes)
        return df.withColumn("__group", self.group).join(
            F.broadcast(hot) if self.few else hot, "__group", "left"
        ).drop("__group")


class HotRanges:
    """The rows of the hot groups by ``keys``, found and counted, to be dealt over ranges.

    Without keys all rows are one group.
    """

    def __init__(self, keys: Sequence[str], list_: DataFrame, rows: int, split: HotSplit):
        self.keys = list(keys)
        self.group = group_hash(self.keys)
        # At most rows / min_rows longs.
        self.list = F.broadcast(list_.select("__group"))
        self.split = split
        self.ranges = -(-rows // split.rows_per_cell) + 1

    def only(self, df: DataFrame) -> DataFrame:
        if not self.keys:
            return df
        return df.withColumn("__group", self.group).join(self.list, "__group", "left_semi").drop("__group")

    def rest(self, df: DataFrame) -> DataFrame:
        if not self.keys:
            return df.where("false")
        return df.withColumn("__group", self.group).join(self.list, "__group", "left_anti").drop("__group")

    def in_ranges(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        """``df``, stored, with the number of the range each row is in; they rise along ``order`` in each group.

        Rows are numbered and stored before they are dealt, so that rows equal in all of ``order`` can be dealt
        apart and a task that runs again deals them as before. Where there are more ranges than ``MOST_PARTS``, a task
        gets several: it sorts its rows and begins a range where the last one is full.
        """
        numbered = written(df.withColumn("__row", F.monotonically_increasing_id()), "hot-rows")
        along = [*self.keys, *order, "__row"]
        if self.ranges <= MOST_PARTS:
            dealt = numbered.repartitionByRange(self.ranges, *along).withColumn(CELL, F.spark_partition_id().cast("bigint"))
        else:
            dealt = numbered.repartitionByRange(MOST_PARTS, *along).sortWithinPartitions(*along)
            # The task's number and, in the lower 33 bits, the row's place in it.
            dealt = dealt.withColumn(CELL, F.monotonically_increasing_id())
            place = F.col(CELL).bitwiseAND(F.lit((1 << 33) - 1))
            dealt = dealt.withColumn(CELL, F.col(CELL) - place + F.floor(place / F.lit(self.split.rows_per_cell)))
        return written(dealt.drop("__row"), "hot-ranges")


def find_hot(df: DataFrame, keys: Sequence[str], split: HotSplit = DEFAULT) -> HotRanges | None:
    """The hot groups of ``df`` by ``keys``; None if there are none.

    Runs a narrow pass that counts rows per key, so that where no group is hot, as is usual, the plan that
    follows is the plain window and nothing else.
    """
    if not split.enabled:
        return None
    sizes = df.select(group_hash(keys).alias("__group")).groupBy("__group").agg(F.count(F.lit(1)).alias("__n"))
    found = written(_large(sizes, split), "hot-groups")
    rows = found.agg(F.sum("__n")).first()[0]
    return HotRanges(keys, found, rows, split) if rows else None


def in_cells(keys: Sequence[str]) -> WindowSpec:
    """Window partition for rows: one cell of one group."""
    return Window.partitionBy(*keys, CELL)


def cells_along(keys: Sequence[str]) -> WindowSpec:
    """Window over the per-cell summary of each group, first cell first."""
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CELL)


def seeded(rows: DataFrame, *seeds: tuple[DataFrame, int]) -> DataFrame:
    """``rows`` and the seed rows, told apart by the column ``__seed``."""
    out = rows.withColumn(SEED, F.lit(ROW))
    for seed, place in seeds:
        out = out.unionByName(seed.withColumn(SEED, F.lit(place)), allowMissingColumns=True)
    return out


def in_one_cell(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of groups that are not split."""
    # Without keys all rows are one group, and the cell its only name.
    return rows.withColumn(CELL, F.lit(0).cast("bigint")) if keys else in_lane_zero(rows, CELL)


def null_lane(keys: Sequence[str], spread_by: Sequence[str] = (), lanes: int = 256) -> Column:
    """0 for rows whose keys are all known, more for others, which cannot match.

    Joined with :func:`in_lane_zero`. The others share lane 1, or are spread over
    ``lanes`` by a hash of ``spread_by``.
    """
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    lane = F.pmod(F.xxhash64(*spread_by), F.lit(lanes)).cast("int") + 1 if spread_by else F.lit(1)
    return F.when(unknown, lane).otherwise(0)


def in_lane_zero(df: DataFrame, name: str) -> DataFrame:
    """Add a column that is 0 in a way the optimizer does not fold away.

    As one more join key it makes Spark shuffle ``df`` for the join even if an
    aggregation has already partitioned it by the other keys. AQE splits a skewed
    join only where both inputs come straight from such a shuffle.
    """
    return df.withColumn(name, F.explode(F.array(F.lit(0))))
