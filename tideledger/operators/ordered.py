"""Ordered work on keys of any size.

A window over one hot key would put that key's rows into one task. The helpers
here either work on rows aggregated to a bounded grain, or split the total order
into range partitions of similar size and carry totals between them.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import col
from ..session import cut_lineage

CHUNK = "__chunk"


def ordered_chunks(df: DataFrame, *order: Column | str, rows_per_chunk: int | None = None) -> DataFrame:
    """Rows range-partitioned by ``order`` with the partition number stored as a column.

    The number is fixed by writing the rows to the shared folder, so a lost executor
    cannot change it. Rows equal on all of ``order`` stay together: end the list with
    a unique column.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows_per_chunk:
        parts = max(parts, -(-df.count() // rows_per_chunk))
    ranged = df.repartitionByRange(parts, *[col(c) for c in order])
    return cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))


def ordered_keys(df: DataFrame, order: Sequence[str], descending: Sequence[str] = (), rows_per_chunk: int | None = None) -> DataFrame:
    """The distinct values of ``order`` with their number of rows (``__n``) in range chunks: only sort keys are written."""
    keys = df.groupBy(*order).agg(F.count(F.lit(1)).alias("__n"))
    return ordered_chunks(keys, *directed(order, descending), rows_per_chunk=rows_per_chunk)


def directed(order: Sequence[str], descending: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]


def with_copy_number(df: DataFrame, order: Sequence[str], keys: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with ``__copy`` (1, 2, ...) among rows equal in ``order``, if ``keys`` counts any; and the columns that tell rows apart."""
    if keys.where("__n > 1").isEmpty():
        return df, list(order)
    again = Window.partitionBy(*order).orderBy(F.lit(1))
    return df.withColumn("__copy", F.row_number().over(again)), [*order, "__copy"]


def with_row_number(df: DataFrame, *order: str, name: str = "row_number", descending: Sequence[str] = ()) -> DataFrame:
    """Exact global numbering by ``order``: numbers are found for the sort keys alone, and join back to the rows.

    Rows equal on all of ``order`` are numbered arbitrarily among themselves.
    """
    keys = ordered_keys(df, order, descending)
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    offsets = keys.groupBy(CHUNK).agg(F.sum("__n").alias("__m"))
    offsets = offsets.select(CHUNK, F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(CHUNK).orderBy(*directed(order, descending)).rowsBetween(Window.unboundedPreceding, -1)
    placed = keys.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(F.broadcast(offsets), CHUNK)
    placed = placed.select(*order, (F.col("__offset") + F.col("__inside")).alias("__before"))
    rows, own = with_copy_number(df, order, keys)
    copy = F.col("__copy") if "__copy" in own else F.lit(1)
    return null_safe_join(rows, placed, order).withColumn(name, F.col("__before") + copy).drop("__before", "__copy")


def numbered(df: DataFrame, ts: str, digest: str, name: str = "row_number", prefix: int = 2) -> DataFrame:
    """Exact numbers from the latest ``ts`` on, rows of one time in the order of ``digest``, a hash as text; no time comes last.

    Rows are dealt out once, by time and the digest's first letters, and numbered where they lie; counts of these groups give the rows
    before. A window holds a group, days, or one day's groups. Rows that are equal in both are numbered arbitrarily among themselves.
    """
    group = F.struct(F.col(ts).alias("ts"), F.substring(digest, 1, prefix).alias("head")).alias("__g")
    newest = [F.col("__g.ts").desc_nulls_last(), F.col("__g.head")]
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("__m")).withColumn("__day", F.date_trunc("day", "__g.ts"))
    days = counts.groupBy("__day").agg(F.sum("__m").alias("__m"))
    earlier = Window.orderBy(F.col("__day").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("__day").alias("__d"), F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__day").orderBy(*newest).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__m").over(inside), F.lit(0)))
    offsets = counts.join(days, F.col("__day").eqNullSafe(F.col("__d"))).select(
        F.col("__g").alias("__own"), (F.col("__offset") + F.col("__before")).alias("__before")
    )
    # one column without nulls, so that the shuffle serves the join, too
    dealt = df.select(group, *df.columns).repartition("__g")
    own = F.row_number().over(Window.partitionBy("__g").orderBy(digest))
    placed = dealt.withColumn(name, own).join(offsets, F.col("__g") == F.col("__own"))
    return placed.select(*df.columns, (F.col("__before") + F.col(name)).alias(name))


def row_id(*columns: Column | str, prefix: str | None = None) -> Column:
    """Deterministic 128-bit surrogate id from business columns: no sort and no shuffle.

    Nulls do not change ``xxhash64``, so null flags are hashed too.
    """
    parts = [col(c) for c in columns]
    parts += [c.isNull() for c in parts]
    digest = F.concat(F.hex(F.xxhash64(*parts)), F.hex(F.xxhash64(F.lit(1), *parts)))
    return digest if prefix is None else F.concat(F.lit(prefix + "_"), digest)


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """SQL ``RANK()`` of each distinct (``keys``, ``value``), also for keys too large for one task.

    One lazy plan for every size: rows are counted per distinct value, values fall into levels that rise with them (16 for
    each doubling), and a window holds one level's distinct values or one key's levels.
    """
    return ranks_of_counts(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), keys, value, name, descending)


def ranks_of_counts(counts: DataFrame, keys: Sequence[str], value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """``value_ranks`` of rows already counted as ``__n``; other columns of ``counts`` stay."""
    own = [c for c in counts.columns if c != "__n"]
    number = F.col(value).cast("double")
    counts = counts.withColumn("__level", F.signum(number) * F.rint(16 * F.log2(1 + F.abs(number))))

    def order(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    earlier = Window.partitionBy(*keys).orderBy(order("__level")).rowsBetween(Window.unboundedPreceding, -1)
    levels = counts.groupBy(*keys, "__level").agg(F.sum("__n").alias("__m"))
    levels = levels.select(*keys, "__level", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*keys, "__level").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    ranks = null_safe_join(counts, levels, [*keys, "__level"])
    return ranks.select(*own, (F.col("__offset") + F.col("__before") + 1).alias(name))


def ranked(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Rows with the ``RANK()`` of a numeric ``value`` within ``keys``: ``value_ranks`` joined back."""
    return null_safe_join(df, value_ranks(df, keys, value, name, descending), [*keys, value])


def ranked_rows(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", descending: bool = True, distinct: bool = False) -> DataFrame:
    """``ranked``, for rows of which a level (16 for each doubling of the value) of one key fits a task: the rows are shuffled once.

    Rows are dealt by key and level and ranked where they lie; a key's levels, counted there, give the rows before a level.
    ``distinct`` first drops copies, which lie together. Many rows of one key with one value are for ``ranked``.
    """
    number = F.col(value).cast("double")
    size = F.least(F.abs(number), F.lit(sys.float_info.max))
    level = F.when(F.isnan(number), 2**15).otherwise(F.signum(number) * F.rint(16 * F.log2(1 + size))).cast("int")
    rest = [c for c in df.columns if c not in keys]
    # one column without nulls, so that the shuffle serves the join, too
    dealt = df.select(F.struct(*keys, level.alias("__level")).alias("__g"), *rest).repartition("__g")
    dealt = dealt.distinct() if distinct else dealt

    def order(c: Column) -> Column:
        return c.desc() if descending else c.asc()

    counts = dealt.groupBy("__g").agg(F.count(F.lit(1)).alias("__m"))
    earlier = Window.partitionBy(*[F.col("__g")[k] for k in keys]).orderBy(order(F.col("__g")["__level"]))
    before = F.coalesce(F.sum("__m").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("__g").alias("__h"), before.alias("__before"))
    placed = dealt.withColumn("__inside", F.rank().over(Window.partitionBy("__g").orderBy(order(F.col(value)))))
    placed = placed.join(offsets, F.col("__g") == F.col("__h"))
    return placed.select(*[F.col("__g")[c].alias(c) if c in keys else F.col(c) for c in df.columns], (F.col("__before") + F.col("__inside")).alias(name))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[F.col(c) for c in right.columns if c not in on]
    )
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(renamed[f"__r_{c}"])
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in on])


def running_total(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str = "running", units: Sequence[str] = ("day",)
) -> DataFrame:
    """One row per (keys, ts) with the running sum; rows of equal time share it.

    Amounts are summed per (keys, ts) and per (keys, unit). A window holds the units
    of a key, or the distinct times inside one unit: at most 86,400 for whole seconds
    and days. For finer times pass ``("day", "second")``.
    """
    raw = df.withColumns({f"__{u}": F.date_trunc(u, F.col(ts)) for u in units})
    levels = [f"__{u}" for u in units]
    out = raw.groupBy(*keys, *levels, ts).agg(F.sum(value).alias(name))
    out = out.withColumn(name, F.sum(name).over(Window.partitionBy(*keys, *levels).orderBy(ts)))
    for depth in range(len(levels), 0, -1):
        outer, unit = levels[: depth - 1], levels[depth - 1]
        before = Window.partitionBy(*keys, *outer).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
        opening = (
            raw.groupBy(*keys, *levels[:depth])
            .agg(F.sum(value).alias("__sum"))
            .select(*keys, *levels[:depth], F.coalesce(F.sum("__sum").over(before), F.lit(0.0)).alias("__open"))
        )
        out = null_safe_join(out, opening, [*keys, *levels[:depth]])
        out = out.withColumn(name, F.col(name) + F.col("__open")).drop("__open")
    return out.drop(*levels)
