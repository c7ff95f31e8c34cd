"""Polled loads: high watermarks, boundary rows, completeness cuts and merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import latest_per_key

DEFAULT_START = "2024-01-01 00:00:00"


def increment(source: DataFrame, target: DataFrame | None, column: str, default=DEFAULT_START) -> DataFrame:
    """Source rows beyond the target's largest ``column``; beyond ``default`` without a target.

    The bound is a scalar subquery: the scan gets it as a pushed filter and skips row groups below it.
    """
    dtype = source.schema[column].dataType
    if target is None:
        return source.where(F.col(column) > F.lit(default).cast(dtype))
    return source.where(F.col(column) > _highest(target, column, F.lit(default).cast(dtype)))


def _highest(table: DataFrame, column: str, otherwise: Column) -> Column:
    """The largest value of ``column`` as a scalar subquery."""
    return table.agg(F.coalesce(F.max(column), otherwise).alias("mark")).scalar()


def increment_with_boundary(source: DataFrame, target: DataFrame, ts: str, key: str) -> DataFrame:
    """Rows newer than the last time, plus rows of that time whose key is not stored yet.

    Rows without a time are never loaded; all others are, for an empty target.
    """
    start = _lowest(source.schema[ts].dataType)
    marked = source.where(F.col(ts) >= _highest(target, ts, start))
    stored = target.where(F.col(ts) == _highest(target, ts, start)).select(ts, key)
    return marked.join(stored, [ts, key], "left_anti")


def _lowest(dtype: T.DataType) -> Column:
    """A value that no other value of a time-like type is below."""
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}.get(type(dtype))
    if bits:
        return F.lit(-(2**bits)).cast(dtype)
    return F.lit("-Infinity" if isinstance(dtype, T.FractionalType) else "0001-01-01").cast(dtype)


def complete_only(delta: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows up to the smallest of the keys' latest times, so that no key runs ahead."""
    cut = delta.groupBy(key).agg(F.max(ts).alias("__last")).agg(F.min("__last").alias("__cut"))
    return delta.where(F.col(ts) <= cut.scalar())


def once_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest other values, compared in column order."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    least = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("__least"))
    return least.select(*[F.col("__least")[c].alias(c) if c in others else F.col(c) for c in df.columns])


def new_keys(delta: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delta rows, once each (see ``once_per_key``), whose key is not in the base."""
    return once_per_key(delta, keys).join(base.select(*keys), list(keys), "left_anti")


def merge_latest(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Upsert: per key the row with the largest ``order``; the delta wins ties."""
    both = base.withColumn("__side", F.lit(0)).unionByName(delta.withColumn("__side", F.lit(1)))
    return latest_per_key(both, keys, F.col(order).desc(), F.col("__side").desc()).drop("__side")


def reload_open(base: DataFrame, source: DataFrame, key: str, status: str, final: Sequence[str]) -> DataFrame:
    """Source rows to load again: keys that are new or whose stored status is not final."""
    done = base.where(F.col(status).isin(*final)).select(key)
    return source.join(done, key, "left_anti")
