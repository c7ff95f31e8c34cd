"""Joins against dimensions and prices.

No size is assumed for a dimension: Catalyst broadcasts one that its statistics
(or, at run time, adaptive execution) show to be small, and shuffles it otherwise.
One that is derived from a large table has no small statistics; ``sized`` gives it
its own, so that wide facts are not shuffled before its size is known. Skewed fact keys are split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import col
from ..functions.buckets import epoch_bucket
from ..session import cut_lineage


def sized(dim: DataFrame) -> DataFrame:
    """``dim`` stored in the shared folder: its size is known when a join is planned, so facts stay where they are if it is small."""
    return cut_lineage(dim)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    ignore_case: Sequence[str] = (),
) -> DataFrame:
    """Add ``take`` (dimension column -> new name) where ``on`` (fact -> dimension) is equal.

    Names in ``ignore_case`` (fact side) are compared in lower case.
    """
    keys = {f"__k{i}": pair for i, pair in enumerate(on.items())}

    def side(c: str, fact: str) -> Column:
        return F.lower(F.col(c)) if fact in ignore_case else F.col(c)

    right = dim.select(
        *[side(d, f).alias(k) for k, (f, d) in keys.items()],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    same = reduce(lambda a, b: a & b, [side(f, f) == F.col(k) for k, (f, _) in keys.items()])
    return df.join(right, same, how).drop(*keys)


def lookup_roles(df: DataFrame, dim: DataFrame, key: str, value: str, roles: Mapping[str, str]) -> DataFrame:
    """The same dimension under several roles: fact column -> new column name.

    Of several rows with one key the smallest value is taken, so the result doesn't depend on their order.
    """
    dim = dim.groupBy(key).agg(F.min(value).alias(value))
    for fact, name in roles.items():
        df = lookup(df, dim, {fact: key}, {value: name})
    return df


def price_roles(
    df: DataFrame,
    prices: DataFrame,
    roles: Mapping[str, tuple[str, Column | str]],
    unit: str = "hour",
    symbol: str = "symbol",
    at: str = "date",
    price: str = "price",
) -> DataFrame:
    """Add one price per role: new name -> (symbol column, time to truncate to ``unit``)."""
    for name, (key, ts) in roles.items():
        when = f"__at_{name}"
        df = lookup(df.withColumn(when, F.date_trunc(unit, col(ts))), prices, {key: symbol, when: at}, {price: name})
        df = df.drop(when)
    return df


def price_book_roles(
    df: DataFrame,
    prices: DataFrame,
    ts: Column | str,
    roles: Mapping[str, Column | str],
    unit: str = "hour",
    symbol: str = "symbol",
    at: str = "date",
    price: str = "price",
) -> DataFrame:
    """Add prices of several symbols at one time by one equi join: new name -> symbol.

    The right side has one row for each ``unit``, its book (symbol -> price), so that ``df`` is shuffled once at most, whatever the
    number of roles, and not at all if the books are small (``sized``). Meant for some dozens of symbols, as price groups are; of several prices of one symbol the smallest is taken.
    """
    once = prices.where(F.col(symbol).isNotNull()).groupBy(F.col(at).alias("__at"), F.col(symbol).alias("__s")).agg(F.min(price).alias("__p"))
    books = once.groupBy("__at").agg(F.map_from_entries(F.collect_list(F.struct("__s", "__p"))).alias("__book"))
    df = df.withColumn("__at", F.date_trunc(unit, col(ts))).join(sized(books), "__at", "left")
    return df.withColumns({name: F.try_element_at("__book", col(s)) for name, s in roles.items()}).drop("__at", "__book")


def either_key_lookup(
    df: DataFrame, dim: DataFrame, fact_key: str, dim_keys: Sequence[str], same: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """``fact_key = any of dim_keys`` as one equi join: each key becomes a row first.

    Of several dimension rows for one key the one with the smallest ``take`` values, compared in order, is taken.
    """
    long = dim.select(
        F.explode(F.array_distinct(F.array(*[F.col(k) for k in dim_keys]))).alias("__key"),
        *[F.col(d) for d in same.values()],
        *[F.col(c) for c in take],
    )
    least = long.groupBy("__key", *same.values()).agg(F.min(F.struct(*take)).alias("__least"))
    long = least.select("__key", *same.values(), *[F.col("__least")[c].alias(c) for c in take])
    return lookup(df, long, {fact_key: "__key", **same}, take)


def price_at_or_before(
    facts: DataFrame,
    ticks: DataFrame,
    key: str,
    fact_ts: str,
    tick_ts: str = "ts",
    price: str = "price",
    out: str = "price",
    bucket_seconds: int = 1800,
) -> DataFrame:
    """As-of join: highest price of the latest tick bucket at or before the fact's bucket.

    The ordered step sees one row per (key, bucket), never the facts: a key has
    at most 17,568 half-hour buckets a year however many rows it holds. Facts
    then take the result of the buckets they have through an equi join. Without
    a tick the price is null.
    """
    facts = facts.withColumn("__bucket", epoch_bucket(fact_ts, bucket_seconds))
    quoted = ticks.select(key, epoch_bucket(tick_ts, bucket_seconds).alias("__bucket"), F.col(price).alias("__price"), F.lit(False).alias("__asked"))
    asked = facts.select(key, "__bucket").distinct().withColumns({"__price": F.lit(None).cast("double"), "__asked": F.lit(True)})
    marks = quoted.unionByName(asked).groupBy(key, "__bucket").agg(F.max("__price").alias("__price"), F.max("__asked").alias("__asked"))
    filled = marks.selectExpr(
        key, "__bucket", f"last(__price, true) OVER (PARTITION BY {key} ORDER BY __bucket) AS `{out}`", "__asked"
    )
    return facts.join(sized(filled.where("__asked").drop("__asked")), [key, "__bucket"], "left").drop("__bucket")


def keep_where_in(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """``IN (subquery)`` as a semi join."""
    return df.join(allowed.select(*on), list(on), "left_semi")


def without_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join plus ``IS NULL`` as an anti join."""
    return df.join(other.select(*on), list(on), "left_anti")


def full_on(left: DataFrame, right: DataFrame, on: Sequence[str], zeros: Sequence[str] = ()) -> DataFrame:
    """Full outer join with merged keys; ``zeros`` are columns whose gaps become 0."""
    joined = left.join(right, list(on), "full")
    return joined.fillna(0, subset=list(zeros)) if zeros else joined


def grid(df: DataFrame, **axes: Sequence) -> DataFrame:
    """Every row once per combination of the given value lists, without a cross join."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df
