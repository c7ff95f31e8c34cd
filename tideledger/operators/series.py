"""Prices per time unit and regular grids with forward fill."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Steps of a grid that one row is repeated for at a time.
PIECE = 2048


def mean_price(ticks: DataFrame, unit: str, keys: Sequence[str] = ("symbol",), ts: str = "ts", price: str = "price", out: str = "date") -> DataFrame:
    """Average price per key and time unit."""
    return ticks.groupBy(*keys, F.date_trunc(unit, F.col(ts)).alias(out)).agg(F.avg(price).alias("price"))


def highest_price(ticks: DataFrame, key: str, bucket, price: str = "price") -> DataFrame:
    return ticks.groupBy(key, bucket).agg(F.max(price).alias("price"))


def regular_grid(df: DataFrame, keys: Sequence[str], ts: str, step: str, fill: Sequence[str], only_at_ticks: Sequence[str] = ()) -> DataFrame:
    """One row per ``step`` from a key's first to its last time.

    ``df`` holds one row per (keys, ts). Each row is repeated up to the next one,
    which forward-fills ``fill`` without a window over the dense grid; the columns
    in ``only_at_ticks`` are null on the repeated rows. Nulls inside ``fill`` take
    the previous value first.
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    step_size = F.expr(f"interval {step}")
    for c in fill:
        df = df.withColumn(c, F.last(c, ignorenulls=True).over(w))
    until = F.lead(ts).over(w) - step_size
    last = F.greatest(F.coalesce(until, F.col(ts)), F.col(ts))
    df = df.withColumns({"__tick": F.col(ts), "__last": last})
    # a gap is cut into pieces, then a piece into steps: no array is longer than a piece, or than a gap has pieces
    piece = step_size * F.lit(PIECE)
    rest = [c for c in df.columns if c not in (ts, "__last")]
    pieces = df.select(*rest, "__last", F.explode(F.sequence(F.col(ts), F.col("__last"), piece)).alias("__from"))
    steps = F.sequence(F.col("__from"), F.least(F.col("__last"), F.col("__from") + piece - step_size), step_size)
    dense = pieces.select(*rest, F.explode(steps).alias(ts))
    for c in only_at_ticks:
        dense = dense.withColumn(c, F.when(F.col(ts) == F.col("__tick"), F.col(c)))
    return dense.drop("__tick")


def forward_fill(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str = "filled", units: Sequence[str] = ("day", "hour")) -> DataFrame:
    """``value`` or, where it is null, the key's last value before in time.

    ``units`` go from long to short. A window holds the rows of one shortest unit of a key, or one row per unit inside the
    next longer one, which gets the unit's last value and carries it into the later ones. A key's rows never meet in one task.
    """
    levels = [f"__{u}" for u in units]
    rows = df.withColumns({f"__{u}": F.date_trunc(u, F.col(ts)) for u in units})
    filled = rows.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys, *levels).orderBy(ts)))
    known = F.when(F.col(value).isNotNull(), F.col(ts))
    for depth in range(len(levels), 0, -1):
        unit = levels[depth - 1]
        earlier = Window.partitionBy(*keys, *levels[: depth - 1]).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
        closing = rows.groupBy(*keys, *levels[:depth]).agg(F.max_by(value, known).alias("__close"))
        names = [*keys, *levels[:depth]]
        opening = closing.select(
            *[F.col(c).alias(f"__r{i}") for i, c in enumerate(names)], F.last("__close", ignorenulls=True).over(earlier).alias("__open")
        )
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate(names)])
        filled = filled.join(opening, same).withColumn(name, F.coalesce(name, "__open"))
        filled = filled.drop("__open", *[f"__r{i}" for i in range(len(names))])
    return filled.drop(*levels)


def filled_minute_prices(ticks: DataFrame, keys: Sequence[str] = ("blockchain", "symbol"), ts: str = "minute", price: str = "price") -> DataFrame:
    """Average price per minute with the gaps forward-filled."""
    per_minute = mean_price(ticks, "minute", keys, ts, price, out="minute")
    return regular_grid(per_minute, keys, "minute", "1 minute", ["price"]).select(*keys, "minute", "price")
