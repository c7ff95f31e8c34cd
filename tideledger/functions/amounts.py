"""Amount, price and ratio expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DUST = 1e-18


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lossy_double(c) -> Column:
    """Text to double; null where it does not parse or says ``nan``."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def lossy_long(c) -> Column:
    return col(c).try_cast("bigint")


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def scaled(amount, decimals, default: int | None = None) -> Column:
    """Raw integer amount divided by ``10^decimals``.

    ``default`` fills a missing decimals value; without it the result is null.
    """
    places = lossy_long(decimals) if isinstance(decimals, (str, Column)) else F.lit(decimals)
    if default is not None:
        places = F.coalesce(places, F.lit(default))
    return lossy_double(amount) / F.pow(F.lit(10.0), places)


def net_of_fees(amount, *fee_parts) -> Column:
    """``amount * (1 - fee1/1e18 - fee2/1e18 ...)`` for fees given in 1e18 units."""
    keep = F.lit(1.0)
    for part in fee_parts:
        keep = keep - lossy_double(part) / F.lit(1e18)
    return col(amount) * keep


def money_text(c) -> Column:
    """``$1,234.5`` to 1234.5; null where the rest is not a number."""
    return F.regexp_replace(col(c), r"[$,]", "").try_cast("double")


def coerced(c, dtype: str = "bigint", fallback=0) -> Column:
    """Numeric repair on load: bad or missing text becomes ``fallback``."""
    return F.coalesce(col(c).try_cast(dtype), F.lit(fallback).cast(dtype))


def snapped_notional(v) -> Column:
    """The 1k, 10k or 100k level whose 10 % band holds ``v``, else null."""
    v = col(v)
    out = None
    for level in (1_000, 10_000, 100_000):
        inside = F.abs(v - level) <= level // 10
        out = F.when(inside, level) if out is None else out.when(inside, level)
    return out.cast("bigint")


def nearest_power_of_ten(c, half_even: bool = False) -> Column:
    """``10^round(log10(c))``; half-to-even rounding on request."""
    exponent = F.log10(col(c))
    return F.pow(F.lit(10.0), F.bround(exponent) if half_even else F.round(exponent))


def ratio(numerator, denominator) -> Column:
    """Division that is null, not an error, on a zero denominator."""
    return col(numerator) / F.nullif(col(denominator), F.lit(0))


def percent(numerator, denominator, places: int | None = 2) -> Column:
    """``100 * a / b`` as a true percentage, null on zero, rounded half up."""
    value = ratio(col(numerator).cast("double") * 100.0, col(denominator).cast("double"))
    return value if places is None else F.round(value, places)


def clipped(c, low: float = 0.0, high: float = 100.0) -> Column:
    """Force into ``[low, high]``; null stays null."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def anomaly_flag(c) -> Column:
    """1 where a utilisation share is outside ``[0, 1]``."""
    c = col(c)
    return F.when((c > 1) | (c < 0), 1).otherwise(0)


def pct_netted(inflow, outflow) -> Column:
    """``100 - |in - out| / (in + out) * 100``; null when nothing moved."""
    inflow, outflow = col(inflow), col(outflow)
    return 100.0 - F.abs(ratio(inflow - outflow, inflow + outflow)) * 100.0


def compounded(rate, periods: int = 365) -> Column:
    return F.pow(1.0 + col(rate), F.lit(periods)) - 1.0
