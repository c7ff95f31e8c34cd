"""Per-key choices and moving values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import col


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key. The ``= 1`` filter becomes a group limit before the shuffle,
    so each task sends at most one row per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def extreme_with_ties(df: DataFrame, keys: Sequence[str], value: str, largest: bool = True) -> DataFrame:
    """All rows that hold the key's largest (or smallest) value.

    A partial aggregate and an equi join, so a hot key is never sorted in one task.
    """
    pick = F.max if largest else F.min
    best = df.groupBy(*keys).agg(pick(value).alias("__best"))
    best = best.select(*[F.col(k).alias(f"__r_{k}") for k in keys], "__best")
    same = F.col(value) == F.col("__best")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return df.join(best, same).drop("__best", *[f"__r_{k}" for k in keys])


def at_latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows at the table's latest time, a scalar subquery that the scan gets as a pushed filter."""
    return df.where(F.col(ts) == df.agg(F.max(ts).alias("newest")).scalar())


def top_dense(df: DataFrame, keys: Sequence[str], value: str, k: int, name: str = "rank") -> DataFrame:
    """Rows within the ``k`` best distinct values per key."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return df.withColumn(name, F.dense_rank().over(w).cast("bigint")).where(F.col(name) <= k)


def moving_mean(value: str, keys: Sequence[str], order: str, rows: int, full_only: bool = False) -> Column:
    """Mean of the last ``rows`` rows of a per-period series (one row per key and period)."""
    return _moving(F.avg, value, keys, order, rows, full_only)


def moving_sum(value: str, keys: Sequence[str], order: str, rows: int, full_only: bool = False) -> Column:
    return _moving(F.sum, value, keys, order, rows, full_only)


def _moving(fn, value: str, keys: Sequence[str], order: str, rows: int, full_only: bool) -> Column:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)
    out = fn(col(value)).over(w)
    return F.when(F.count(col(value)).over(w) == rows, out) if full_only else out


def share_within(df: DataFrame, keys: Sequence[str], count: str, name: str = "share") -> DataFrame:
    """Each row's part of its key's total."""
    return df.withColumn(name, F.col(count) / F.sum(count).over(Window.partitionBy(*keys)))


def last_in_group(value: str, keys: Sequence[str], order: str) -> Column:
    """The key's last value in time order, on every row of an aggregated series."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.last(value).over(w)
