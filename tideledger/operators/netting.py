"""In and out sums of a directed transfer list.

Each transfer becomes one row per side, so one scan and one aggregate replace the
two aggregates and full outer join of the textbook form. Map-side partial sums
keep hot nodes cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import pct_netted


def in_out(
    df: DataFrame,
    source: str,
    target: str,
    amount: str,
    time: Column | str | None = None,
    same: Sequence[str] = (),
    node: str = "chain",
    source_extra: dict[str, str] | None = None,
    target_extra: dict[str, str] | None = None,
    inflow_is_source: bool = True,
) -> DataFrame:
    """Inflow and outflow per (date, node, ...).

    By default inflow groups by the source side; ``inflow_is_source=False`` flips it.
    ``same`` columns apply to both sides; ``*_extra`` give a column its side's own
    value (for instance the asset received or sent). Rows without a node are dropped.
    """
    source_extra, target_extra = source_extra or {}, target_extra or {}
    into, out_of = ("inflow", "outflow") if inflow_is_source else ("outflow", "inflow")
    names = list(source_extra)

    def side(where: str, extra: dict[str, str], column: str) -> Column:
        return F.struct(
            F.col(where).alias(node),
            *[F.col(extra[n]).alias(n) for n in names],
            *[
                (F.col(amount) if c == column else F.lit(None).cast("double")).alias(c)
                for c in ("inflow", "outflow")
            ],
        )

    keys = []
    if time is not None:
        df = df.withColumn("date", F.col(time) if isinstance(time, str) else time)
        keys.append("date")
    keys += list(same)
    sides = F.explode(F.array(side(source, source_extra, into), side(target, target_extra, out_of)))
    legs = df.select(*keys, sides.alias("leg")).select(*keys, "leg.*").where(F.col(node).isNotNull())
    return legs.groupBy(*keys, node, *names).agg(
        F.coalesce(F.sum("inflow"), F.lit(0.0)).alias("inflow"),
        F.coalesce(F.sum("outflow"), F.lit(0.0)).alias("outflow"),
    )


def coarser(flows: DataFrame, keys: Sequence[str], date: Column) -> DataFrame:
    """Sum finished in/out rows to a wider time bucket."""
    return (
        flows.withColumn("date", date)
        .groupBy("date", *keys)
        .agg(F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow"))
    )


def with_net(flows: DataFrame) -> DataFrame:
    return flows.withColumn("net_amount", F.col("inflow") - F.col("outflow")).withColumn(
        "pct_netted", pct_netted("inflow", "outflow")
    )
