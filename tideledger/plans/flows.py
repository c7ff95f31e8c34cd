"""Net flow between chains, netting statistics and batching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import pct_netted
from ..functions.buckets import hour_bucket
from ..functions.labels import asset_group, price_group
from ..operators.joins import keep_where_in, price_roles
from ..operators.netting import in_out, with_net

STATS = {"avg": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}


def net_flow(flows: DataFrame, hours: int = 1, source: str = "from", target: str = "to", inflow_is_source: bool = True) -> DataFrame:
    """(date, chain, asset, net_amount) per ``hours``-wide bucket."""
    sums = in_out(flows, source, target, "amount", hour_bucket("date", hours), same=["asset"], inflow_is_source=inflow_is_source)
    return sums.select("date", "chain", "asset", (F.col("inflow") - F.col("outflow")).alias("net_amount"))


def bucketed_flows(
    flows: DataFrame, hours: Sequence[int], by_asset: bool = False, source: str = "from", target: str = "to",
    inflow_is_source: bool = True,
) -> DataFrame:
    """In/out sums for several bucket widths from one pass over the transfers.

    Transfers are summed per hour once; the wider buckets come from those rows.
    """
    keys = ["chain", "asset"] if by_asset else ["chain"]
    hourly = in_out(
        flows, source, target, "amount", hour_bucket("date", 1), same=["asset"] if by_asset else [],
        inflow_is_source=inflow_is_source,
    )
    widths = F.explode(F.array(*[F.lit(h) for h in hours])).alias("hours")
    wide = hourly.select("*", widths)
    start = F.col("date") - F.make_dt_interval(hours=F.hour("date") % F.col("hours"))
    sums = wide.groupBy("hours", *keys, start.alias("bucket")).agg(
        F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow")
    )
    return with_net(sums)


def net_flow_stats(
    flows: DataFrame, hours: Sequence[int] = (1, 3, 6, 9, 12, 24), by_asset: bool = False, by_day: bool = True,
    stats: Sequence[str] = ("avg", "stddev", "min", "max"), source: str = "from", target: str = "to",
) -> DataFrame:
    """Statistics of net amount and netted share, one column set per bucket width."""
    sums = bucketed_flows(flows, hours, by_asset, source, target)
    keys = ([F.date_trunc("day", "bucket").alias("date")] if by_day else []) + ["chain"] + (["asset"] if by_asset else [])
    aggs = [
        STATS[s](c).alias(f"{s}_{name}")
        for c, name in (("net_amount", "net_amount"), ("pct_netted", "percent_netted"))
        for s in stats
    ]
    wide = sums.groupBy(*keys).pivot("hours", list(hours)).agg(*aggs)
    renamed = {}
    for h in hours:
        for name in ("net_amount", "percent_netted"):
            for s in stats:
                renamed[f"{h}_{s}_{name}"] = f"{s}_{name}_{h}hr"
    return wide.withColumnsRenamed(renamed)


def net_flow_grid(
    flows: DataFrame, as_of: str, hours: Sequence[int] = (1, 3, 6, 12, 24), days: Sequence[int] = (7, 15, 30, 60, 90),
    by_asset: bool = False, source: str = "from", target: str = "to", inflow_is_source: bool = False,
) -> DataFrame:
    """Long format: one row per chain, look-back and bucket width."""
    last = F.lit(as_of).cast("date")
    recent = flows.where(F.col("date") >= F.date_sub(last, max(days)).cast("timestamp"))
    sums = bucketed_flows(recent, hours, by_asset, source, target, inflow_is_source)
    looks = sums.select("*", F.explode(F.array(*[F.lit(d) for d in days])).alias("interval_days"))
    inside = looks.where(F.to_date("bucket") >= F.date_sub(last, F.col("interval_days")))
    return inside.groupBy(
        "chain", *(["asset"] if by_asset else []), "interval_days", F.col("hours").alias("time_bucket")
    ).agg(
        F.avg("net_amount").alias("avg_net_amount"),
        F.stddev_samp("net_amount").alias("stddev_net_amount"),
        F.min("net_amount").alias("min_net_amount"),
        F.max("net_amount").alias("max_net_amount"),
        F.avg("pct_netted").alias("avg_percent_netted"),
    )


def _with_volume(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "volume": F.col("inflow") + F.col("outflow"),
            "net_amount": F.col("inflow") - F.col("outflow"),
        }
    )


def multi_bridge_netflow_hourly(flows: DataFrame, prices: DataFrame, source: str = "from", target: str = "to") -> DataFrame:
    """Several protocols (column ``bridge``) in USD; transfers without a price are left out.

    Amounts are summed per hour and edge before the price join.
    """
    hourly = flows.groupBy(
        F.date_trunc("hour", "date").alias("date"), "bridge", "asset", source, target
    ).agg(F.sum("amount").alias("amount"))
    grouped = hourly.withColumn("asset_group", asset_group("asset")).withColumn("__pg", price_group("asset"))
    usd = price_roles(grouped, prices, {"price": ("__pg", "date")}).where(F.col("price").isNotNull())
    usd = usd.withColumn("amount_usd", F.col("amount") * F.col("price"))
    return _with_volume(in_out(usd, source, target, "amount_usd", "date", same=["bridge", "asset", "asset_group"]))


def priced_pair_netflow(
    transfers: DataFrame, prices: DataFrame, chains: Sequence[str] = (), tokens: Sequence[str] = (),
) -> DataFrame:
    """In by source token and chain, out by target token and chain, with the balance ratio.

    ``transfers``: date, source_chain, target_chain, source_token, target_token, target_amount.
    """
    rows = transfers
    if chains:
        rows = rows.where(F.col("source_chain").isin(*chains) & F.col("target_chain").isin(*chains))
    if tokens:
        rows = rows.where(F.col("source_token").isin(*tokens) & F.col("target_token").isin(*tokens))
    rows = price_roles(rows, prices, {"price": ("target_token", "date")})
    rows = rows.withColumn("value_usd", F.col("target_amount") * F.col("price")).where("value_usd > 0")
    sums = in_out(
        rows, "source_chain", "target_chain", "value_usd", F.date_trunc("hour", "date"),
        source_extra={"asset": "source_token"}, target_extra={"asset": "target_token"},
    )
    volume, net = F.col("inflow") + F.col("outflow"), F.col("inflow") - F.col("outflow")
    return sums.where(volume > 0).select(
        "date",
        "chain",
        "asset",
        F.col("inflow").alias("inflow_usd"),
        F.col("outflow").alias("outflow_usd"),
        net.alias("net_amount_usd"),
        F.abs(net).alias("abs_net_amount_usd"),
        volume.alias("total_volume_usd"),
        (1 - F.abs(net) / volume).alias("balance_ratio_usd"),
    )


def netflow_hourly(rows: DataFrame, source: str = "src_chain", target: str = "dst_chain", value: str = "value_usd", asset: str = "token_symbol") -> DataFrame:
    """Positive values only; in by source, out by destination."""
    kept = rows.where(F.col(asset).isNotNull() & (F.col(value) > 0)).withColumnRenamed(asset, "asset")
    sums = in_out(kept, source, target, value, "date", same=["asset"])
    return sums.withColumn("net_amount", F.col("inflow") - F.col("outflow"))


def deposit_withdraw_netflow(
    stats: DataFrame, tracked: DataFrame, group: Sequence[str] = ("chain", "asset"), every: str | None = "year",
    daily_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Deposits in, withdrawals out, netted per day and ``daily_keys``, then averaged.

    ``stats``: date (epoch seconds), chain, symbol, tx_type, usd_value (and bridge).
    ``every`` is year or day; None returns the daily rows. ``tracked.token_name``
    restricts the assets; it is read as a set.
    """
    daily_keys = list(daily_keys or ("chain", "asset", *(["bridge"] if "bridge" in group else [])))
    listed = tracked.select(F.lower("token_name").alias("__token")).distinct()
    rows = (
        stats.where(F.col("symbol").isNotNull() & (F.col("usd_value") > 0))
        .withColumn("asset", F.col("symbol"))
        .withColumn("date", F.date_trunc("day", F.timestamp_seconds("date")))
        .withColumn("__token", F.lower("asset"))
    )
    rows = keep_where_in(rows, listed, ["__token"])

    def part(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("tx_type") == kind, F.col("usd_value"))), F.lit(0.0))

    daily = rows.groupBy("date", *daily_keys).agg(part("deposit").alias("inflow"), part("withdrawal").alias("outflow"))
    daily = daily.where(F.col("inflow") + F.col("outflow") > 0)
    daily = with_net(daily).withColumnRenamed("pct_netted", "percent_netted")
    if every is None:
        return daily
    time = F.year("date").alias("year") if every == "year" else F.to_date("date").alias("date")
    keys = [F.upper("asset").alias("asset") if k == "asset" else F.col(k) for k in group]
    return daily.groupBy(time, *keys).agg(
        F.avg("net_amount").alias("avg_net_amount"), F.avg("percent_netted").alias("avg_percent_netted")
    )


def netting_by_window(hourly: DataFrame, hours: int, group: Sequence[str]) -> DataFrame:
    """Netted share per window, averaged per day; days at or below 0 % are left out."""
    fine = list(dict.fromkeys(["chain", "asset_group", *group]))
    sums = hourly.groupBy(hour_bucket("date", hours).alias("date"), *fine).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("inflow", "outflow", "volume")]
    )
    netted = sums.withColumns(
        {"pct_netted": pct_netted("inflow", "outflow"), "netted": F.abs(F.col("inflow") - F.col("outflow"))}
    )
    return (
        netted.groupBy(F.date_trunc("day", "date").alias("date"), *group)
        .agg(
            F.avg("pct_netted").alias("avg_pct_netted"),
            F.sum("netted").alias("total_netted"),
            F.sum("volume").alias("total_volume"),
        )
        .where("avg_pct_netted > 0")
    )


def with_all_bridges(hourly: DataFrame) -> DataFrame:
    """Per-bridge rows plus their sum under the label ``all``."""
    total = hourly.groupBy("date", "chain", "asset_group", "asset").agg(
        *[F.sum(c).alias(c) for c in ("inflow", "outflow", "volume")]
    )
    return total.withColumn("bridge", F.lit("all")).unionByName(hourly.select(*total.columns, "bridge"))


def netting_variance(by_window: DataFrame) -> DataFrame:
    return by_window.groupBy("bridge").agg(F.var_samp("avg_pct_netted").alias("variance"))


def bridge_difference(by_window: DataFrame, left: str, right: str, metric: str) -> DataFrame:
    """Daily mean of ``metric`` of two bridges and their difference, on days both have."""
    sides = by_window.where(F.col("bridge").isin(left, right)).groupBy("date").agg(
        *[F.avg(F.when(F.col("bridge") == b, F.col(metric))).alias(name) for b, name in ((left, "left_mean"), (right, "right_mean"))]
    )
    both = sides.where(F.col("left_mean").isNotNull() & F.col("right_mean").isNotNull())
    return both.withColumn("diff", F.col("left_mean") - F.col("right_mean"))


def route_flow_summary(transfers: DataFrame, by_token: bool = False, places: int = 2) -> DataFrame:
    """Volume, mean size and count per route, largest first."""
    keys = ["from_chain_name", "to_chain_name"] + (["from_token_symbol"] if by_token else [])
    return (
        transfers.groupBy(*keys)
        .agg(
            F.round(F.sum("from_amount_usd"), places).alias("volume_usd"),
            F.round(F.avg("from_amount_usd"), places).alias("avg_size_usd"),
            F.count(F.lit(1)).alias("transfers"),
        )
        .orderBy(F.col("volume_usd").desc())
    )

