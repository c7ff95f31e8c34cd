"""Rows whose key comes again, told from the others without shuffling rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bits of the map of keys that come again.
BITS = 1 << 23


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def split_repeated(df: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame]:
    """Rows whose ``key`` may come again in ``df`` (None if there are none), and rows whose key surely doesn't.

    Only hashes of keys are shuffled; those that come again are marked in a map of fixed size, which every task gets. A row of another key
    may be marked too, where the map is crowded, so what is done with the first rows must be right for those as well. ``df`` is read
    twice: it should be a stored table.
    """
    again = df.groupBy(F.xxhash64(key).alias("__h")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    again = again.select(F.pmod("__h", F.lit(BITS)).alias("__place"))
    bits = F.bit_or(F.expr("shiftleft(1L, int(__place % 64))")).alias("__bits")
    # one row for each word of the map at most
    words = cut_lineage(again.groupBy(F.expr("__place div 64").alias("__word")).agg(bits))
    if words.isEmpty():
        return None, df
    words = F.broadcast(words)
    rows = df.withColumn("__place", _place(key)).withColumn("__word", F.expr("__place div 64")).join(words, "__word", "left")
    rows = rows.withColumn("__again", F.expr("shiftrightunsigned(coalesce(__bits, 0L), int(__place % 64)) & 1L"))
    return tuple(rows.where(F.col("__again") == flag).select(*df.columns) for flag in (1, 0))


def without_copies(df: DataFrame, key: str, made: Callable[[DataFrame], DataFrame], one_each: Callable[[DataFrame], DataFrame], stored: bool) -> DataFrame:
    """``one_each(made(df))``, for a ``one_each`` that leaves rows alone whose ``key`` in ``df`` comes once.

    With ``stored``, for tables that can be read twice, such rows are not shuffled.
    """
    if not stored:
        return one_each(made(df))
    again, once = split_repeated(df, key)
    return made(once) if again is None else made(once).unionByName(one_each(made(again)))
