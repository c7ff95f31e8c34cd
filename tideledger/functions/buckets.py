"""Range, level and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import col


def usd_range(c) -> Column:
    """Transfer size label. Shared bounds go to the lower class, except 10."""
    c = col(c)
    return (
        F.when(c < 10, "<10$")
        .when(c <= 100, "10-100$")
        .when(c <= 1_000, "100-1000$")
        .when(c <= 10_000, "1000-10000$")
        .when(c > 10_000, ">10000$")
    )


def discount_bucket(c, null_label: str = "4.8.0+") -> Column:
    """Discount in bps to its 0.8-wide class; null goes to the open last class."""
    c = col(c)
    # fixed values: lower bound and label of each discount class
    classes = (
        (4.8, "4.8.0+"),
        (4.0, "4.0 - 4.8"),
        (3.2, "3.2 - 3.99"),
        (2.4, "2.4 - 3.19"),
        (1.6, "1.6 - 2.39"),
        (0.8, "0.8 - 1.59"),
        (0.0, "0 - 0.79"),
    )
    out = F.when(c.isNull(), null_label)
    for bound, label in classes:
        out = out.when(c >= bound, label)
    return out.otherwise("Negative")


def capacity_level(c) -> Column:
    """Utilisation percentage to its right-closed quarter; null outside (-0.1, 100]."""
    c = col(c)
    return (
        F.when((c <= -0.1) | (c > 100), F.lit(None).cast("string"))
        .when(c <= 25, "<25%")
        .when(c <= 50, "25%-50%")
        .when(c <= 75, "50%-75%")
        .when(c <= 100, "75%-100%")
    )


def hour_bucket(ts, hours: int) -> Column:
    """Start of the ``hours``-wide bucket, counted from midnight of the same day."""
    ts = col(ts)
    hour = F.date_trunc("hour", ts)
    if hours == 1:
        return hour
    if hours == 24:
        return F.date_trunc("day", ts)
    return hour - F.make_dt_interval(hours=F.hour(ts) % hours)


def epoch_bucket(ts, seconds: int = 1800) -> Column:
    """Epoch second rounded down to a multiple of ``seconds``."""
    epoch = F.unix_timestamp(col(ts).cast("timestamp"))
    return epoch - epoch % seconds


def sunday_week(ts) -> Column:
    """Date of the Sunday that starts the week of ``ts``."""
    day = col(ts).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def monday_week(ts) -> Column:
    return F.date_trunc("week", col(ts)).cast("date")


def week_parts(ts) -> dict[str, Column]:
    """ISO week number with its first and last day."""
    start = monday_week(ts)
    return {"week": F.weekofyear(col(ts)), "week_start": start, "week_end": F.date_add(start, 6)}


def trailing_days(ts, as_of, days: int) -> Column:
    """Half-open filter on the ``days`` calendar days before ``as_of`` (pushes down)."""
    bound = F.lit(as_of).cast("date")
    return (col(ts) >= F.date_sub(bound, days).cast("timestamp")) & (col(ts) < F.date_add(bound, 1).cast("timestamp"))


def in_range(ts, start, end) -> Column:
    """``start <= ts < end``."""
    return (col(ts) >= F.lit(start).cast("timestamp")) & (col(ts) < F.lit(end).cast("timestamp"))


def in_month(ts, year: int, month: int) -> Column:
    """One calendar month as a half-open range, so file statistics can prune."""
    start = f"{year:04d}-{month:02d}-01"
    end = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return in_range(ts, start, end)
