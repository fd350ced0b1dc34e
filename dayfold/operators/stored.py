"""Dimensions that are kept in buckets of their key and changed in place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.operators.dims import scd1_upsert, scd2_apply
from dayfold.session import tidy, written
from dayfold.sources.buckets import BucketStore
from dayfold.sources.load import read_days, write_day


def upsert_stored(store: BucketStore, changes: DataFrame) -> list[int]:
    """Replace whole rows of the store by key, as :func:`~dayfold.operators.dims.scd1_upsert`; the buckets rewritten.

    ``changes`` holds one row per key. Other buckets are neither read nor written. The same changes can be applied again.
    """
    with tidy():
        changes = written(changes.select(*store.schema.names), "changes")
        touched = store.touched(changes)
        if touched:
            store.replace(scd1_upsert(store.read(touched), changes, store.keys))
    return touched


def scd2_apply_stored(
    store: BucketStore, closed: str, day_changes: DataFrame, day: date, attrs: Sequence[str]
) -> list[int]:
    """Apply the changes of ``day`` to a stored history; the buckets rewritten.

    ``store`` holds the open version of each key, ``closed`` is the folder of the versions that ended, by day (``dt``).
    Only buckets with a changed key are read and written, and closed versions only of that day. Closed versions are
    written first and keep those of an earlier try, so a day that failed half way, or is applied again,
    gives the same history.
    """
    with tidy():
        changes = written(day_changes.select(*store.keys, *attrs), "day-changes")
        touched = store.touched(changes)
        after = written(scd2_apply(store.read(touched), changes, day, list(store.keys), attrs), "versions")
        ended = after.where("NOT is_current")
        if store.exists(closed):
            ended = written(ended.unionByName(stored_closed(store, closed, day)).distinct(), "ended")
        write_day(ended, closed, day)
        if touched:
            store.replace(after.where("is_current"))
    return touched


def stored_closed(store: BucketStore, closed: str, day: Any = None) -> DataFrame:
    """The versions that ended, all or those of one day."""
    table = read_days(store.spark, closed, store.schema)
    return (table if day is None else table.where(F.col("dt") == F.lit(day))).drop("dt")


def stored_history(store: BucketStore, closed: str) -> DataFrame:
    """All versions, open and ended."""
    return store.read().unionByName(stored_closed(store, closed))
