"""Router liquidity, pools, yields and utilisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions.amounts import anomaly_flag, clipped, compounded, lossy_double, ratio, scaled
from ..functions.buckets import capacity_level
from ..functions.labels import asset_group, price_group
from ..operators.joins import full_on, lookup, price_roles
from ..operators.series import mean_price, regular_grid
from ..operators.windows import (
    at_latest,
    extreme_with_ties,
    last_in_group,
    latest_per_key,
    moving_mean,
    moving_sum,
    share_within,
)

ROUTER_FEE = 0.0005
KEYS = ["router", "chain", "asset"]

# fixed values: hours until bridged liquidity is back, by destination chain
SLOW_CHAIN, SLOW_HOURS, OTHER_HOURS = "Ethereum Mainnet", 12, 5


def first_router(routers: str = "routers") -> Column:
    return J.first_item(J.text_array(routers))


def _named(rows: DataFrame, chains: DataFrame, tokens: DataFrame, domain: str, address: str) -> DataFrame:
    """Chain and asset names; an unknown asset keeps its address."""
    rows = lookup(rows, chains.distinct(), {domain: "domainid"}, {"chain": "chain"})
    rows = lookup(rows, tokens.distinct(), {address: "token_address"}, {"token_name": "__asset"}, ignore_case=[address])
    return rows.withColumn("asset", F.coalesce("__asset", address)).drop("__asset")


def routed_amounts(transfers: DataFrame, assets: DataFrame, status: str) -> DataFrame:
    """Transfers with their first router and, for ``status`` rows, the amount in token units."""
    known = assets.select("canonical_id", "domain", "adopted_decimal").distinct()
    rows = lookup(
        transfers, known, {"canonical_id": "canonical_id", "destination_domain": "domain"}, {"adopted_decimal": "__decimal"}
    )
    amount = scaled("destination_transacting_amount", "__decimal", 0)
    return rows.select(
        first_router().alias("router"),
        F.timestamp_seconds("xcall_timestamp").alias("ts"),
        "destination_domain",
        "destination_local_asset",
        F.when(F.col("status") == status, amount).alias("amount"),
    )


def fast_volume(transfers: DataFrame, assets: DataFrame, chains: DataFrame, tokens: DataFrame, unit: str = "hour") -> DataFrame:
    """Volume and fee a router earned, per time unit, chain and asset.

    Sums per raw asset address come before the name joins, which then see few rows.
    """
    rows = routed_amounts(transfers, assets, "CompletedFast").where(F.col("router").isNotNull())
    sums = rows.groupBy(
        F.date_trunc(unit, "ts").alias("date"), "router", "destination_domain", "destination_local_asset"
    ).agg(F.sum("amount").alias("amount"))
    named = _named(sums, chains, tokens, "destination_domain", "destination_local_asset")
    return named.groupBy("date", *KEYS).agg(
        F.sum("amount").alias("router_volume"), (F.sum("amount") * ROUTER_FEE).alias("router_fee")
    )


def ledger_changes(events: DataFrame, chains: DataFrame, tokens: DataFrame, unit: str = "hour") -> DataFrame:
    """Net liquidity added per time unit, router, chain and asset."""
    amount = lossy_double("amount")
    signed = F.when(F.col("event") == "Add", amount).otherwise(-amount)
    sums = events.groupBy(
        F.date_trunc(unit, F.timestamp_seconds("timestamp")).alias("date"), "router", "domain", F.col("asset").alias("address")
    ).agg(F.sum(signed).alias("amount"))
    return _named(sums, chains, tokens, "domain", "address").groupBy("date", *KEYS).agg(F.sum("amount").alias("amount"))


def _running(c: str) -> Column:
    """Running sum per router, chain and asset over rows already summed per time unit."""
    return F.sum(c).over(Window.partitionBy(*KEYS).orderBy("date"))


def _with_groups(rows: DataFrame, names: DataFrame | None) -> DataFrame:
    rows = rows.withColumns({"asset_group": asset_group("asset"), "price_group": price_group("asset")})
    if names is None:
        return rows.withColumn("router_name", F.col("router"))
    rows = lookup(rows, names, {"router": "router"}, {"name": "router_name"}, ignore_case=["router"])
    return rows.withColumn("router_name", F.coalesce("router_name", "router"))


def _in_usd(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.withColumns({f"{c}_usd": F.col("price") * F.col(c) for c in columns})


def router_utilization_hourly(
    events: DataFrame, transfers: DataFrame, assets: DataFrame, chains: DataFrame, tokens: DataFrame, prices: DataFrame,
    names: DataFrame | None = None,
) -> DataFrame:
    """Locked, used and returned liquidity per router, chain, asset and hour, priced.

    Ledger changes, fast volume and its later return are three kinds of rows on one
    time line: one sum per hour replaces two full joins, and every window below it
    sees hours, not transfers.
    """
    none = F.lit(None).cast("double")
    volume = fast_volume(transfers, assets, chains, tokens)
    back = F.when(F.col("chain") == SLOW_CHAIN, SLOW_HOURS).otherwise(OTHER_HOURS)
    parts = [
        volume.select("date", *KEYS, none.alias("dw"), "router_volume", "router_fee", F.lit(0.0).alias("filled")),
        volume.select(
            (F.col("date") + F.make_dt_interval(hours=back)).alias("date"), *KEYS, none.alias("dw"),
            none.alias("router_volume"), none.alias("router_fee"), F.coalesce("router_volume", F.lit(0.0)).alias("filled"),
        ),
        ledger_changes(events, chains, tokens).select(
            "date", *KEYS, F.col("amount").alias("dw"), none.alias("router_volume"), none.alias("router_fee"), none.alias("filled")
        ),
    ]
    line = parts[0].unionByName(parts[1]).unionByName(parts[2])
    line = line.groupBy("date", *KEYS).agg(*[F.sum(c).alias(c) for c in ("dw", "router_volume", "router_fee", "filled")])
    moved = F.col("filled").isNotNull()
    line = line.withColumns(
        {
            "__locked": F.when(moved, F.coalesce("router_volume", F.lit(0.0))),
            "__fee": F.when(moved, F.coalesce("router_fee", F.lit(0.0))),
        }
    )
    line = line.withColumns(
        {
            "initial_locked": _running("dw"),
            "total_fee_earned": _running("__fee"),
            "liquidity_locked": _running("__locked"),
            "liquidity_fill_back": _running("filled"),
        }
    )
    zero = F.lit(0.0)
    total = F.coalesce("initial_locked", zero) - F.coalesce("liquidity_locked", zero) + F.coalesce("liquidity_fill_back", zero)
    line = line.withColumn("total_locked", total).withColumnRenamed("dw", "router_dw")
    at_events = ["router_dw", "initial_locked", "router_volume", "router_fee", "liquidity_locked", "liquidity_fill_back"]
    line = line.select("date", *KEYS, *at_events, "total_locked", "total_fee_earned")
    dense = regular_grid(line, KEYS, "date", "1 hour", ["total_locked", "total_fee_earned"], at_events)
    dense = price_roles(_with_groups(dense, names), prices, {"price": ("price_group", "date")})
    dense = dense.where(F.col("price").isNotNull()).drop("price_group")
    dense = dense.withColumn("total_balance", F.coalesce("total_locked", zero) + F.coalesce("total_fee_earned", zero))
    return _in_usd(dense, [*at_events, "total_locked", "total_fee_earned", "total_balance"])


def router_tvl_daily(
    events: DataFrame, transfers: DataFrame, snapshots: DataFrame, assets: DataFrame, chains: DataFrame, tokens: DataFrame,
    prices: DataFrame, names: DataFrame | None = None,
) -> DataFrame:
    """Locked liquidity and fees per day. A day's last balance snapshot overrides the ledger.

    ``prices``: symbol, date, price per hour; the day's mean is used and days without
    a price stay.
    """
    none = F.lit(None).cast("double")
    volume = fast_volume(transfers, assets, chains, tokens, "day")
    known = assets.select("canonical_id", "domain", "local", "decimal").distinct()
    held = lookup(
        snapshots, known, {"asset_canonical_id": "canonical_id", "asset_domain": "domain"},
        {"local": "__local", "decimal": "__decimal"},
    )
    held = _named(held, chains, tokens, "asset_domain", "__local")
    held = held.select(
        F.col("router_address").alias("router"), "chain", "asset", "snapshot_time",
        F.date_trunc("day", "snapshot_time").alias("date"),
        scaled("locked", "__decimal").alias("snap_locked"), scaled("fees_earned", "__decimal").alias("snap_fees"),
    )
    held = latest_per_key(held, ["date", *KEYS], F.col("snapshot_time").desc(), F.col("snap_locked").desc(), F.col("snap_fees").desc())
    line = (
        ledger_changes(events, chains, tokens, "day")
        .unionByName(volume, allowMissingColumns=True)
        .unionByName(held.drop("snapshot_time"), allowMissingColumns=True)
    )
    line = line.groupBy("date", *KEYS).agg(
        *[F.sum(c).alias(c) for c in ("amount", "router_volume", "router_fee")],
        *[F.max(c).alias(c) for c in ("snap_locked", "snap_fees")],
    )
    line = line.withColumns({"__ledger": _running("amount"), "__fees": _running("router_fee")})
    line = line.select(
        "date", *KEYS, "router_fee", "router_volume", "amount",
        F.coalesce("snap_locked", F.when(F.col("amount").isNotNull(), F.col("__ledger"))).alias("total_locked"),
        F.coalesce("snap_fees", F.when(F.col("router_fee").isNotNull(), F.col("__fees"))).alias("total_fee_earned"),
    )
    flows = ["router_fee", "router_volume", "amount"]
    dense = regular_grid(line, KEYS, "date", "1 day", ["total_locked", "total_fee_earned"], flows)
    daily = mean_price(prices, "day", ts="date", out="date")
    dense = price_roles(_with_groups(dense, names), daily, {"price": ("price_group", "date")}, unit="day")
    zero = F.lit(0.0)
    dense = dense.drop("price_group").withColumn(
        "total_balance", F.coalesce("total_locked", zero) + F.coalesce("total_fee_earned", zero)
    )
    return _in_usd(dense, [*flows, "total_locked", "total_fee_earned", "total_balance"])


def router_utilization_tune(utilization: DataFrame) -> DataFrame:
    """Running sums over the hourly rows, and the balance they imply."""
    w = Window.partitionBy("router", "chain", "asset_group").orderBy("date")
    rows = utilization.withColumns(
        {
            "running_locked_liquidity": F.sum("liquidity_locked").over(w),
            "running_liquidity_fill_back": F.sum("liquidity_fill_back").over(w),
        }
    )
    cal = F.col("initial_locked") - F.col("running_locked_liquidity") + F.col("running_liquidity_fill_back")
    return rows.withColumns({"cal_total_locked": cal, "cal_balance": cal + F.col("total_fee_earned")})


def router_pnl(events: DataFrame, chains: DataFrame, tokens: DataFrame) -> DataFrame:
    """Ledger balance at the end of each day with a change."""
    days = ledger_changes(events, chains, tokens, "day")
    return days.select("date", *KEYS, _running("amount").alias("amount"))


def slow_path_volume_hourly(transfers: DataFrame, assets: DataFrame, chains: DataFrame, tokens: DataFrame, prices: DataFrame) -> DataFrame:
    """Volume of transfers no router paid out, priced; hours without a price are left out."""
    rows = routed_amounts(transfers, assets, "CompletedSlow").where(F.col("router").isNull())
    sums = rows.groupBy(
        F.date_trunc("hour", "ts").alias("date"), "destination_domain", "destination_local_asset"
    ).agg(F.sum("amount").alias("amount"))
    named = _named(sums, chains, tokens, "destination_domain", "destination_local_asset")
    hours = named.groupBy("date", "chain", "asset").agg(F.sum("amount").alias("destination_slow_volume"))
    hours = hours.withColumns({"asset_group": asset_group("asset"), "__pg": price_group("asset")})
    hours = price_roles(hours, prices, {"price": ("__pg", "date")}).where(F.col("price").isNotNull()).drop("__pg")
    return _in_usd(hours, ["destination_slow_volume"])


# --- balances and pools -----------------------------------------------------------------


def latest_asset_prices(prices: DataFrame, keys: Sequence[str] = ("canonical_id",)) -> DataFrame:
    """Price rows at each asset's latest time; rows of equal time are all kept."""
    return extreme_with_ties(prices, list(keys), "timestamp").select(*keys, "price")


def router_balances_usd(balances: DataFrame, assets: DataFrame, prices: DataFrame) -> DataFrame:
    """Balances times the latest price; assets without a price are left out."""
    rows = balances.join(
        assets, (F.col("asset_canonical_id") == F.col("canonical_id")) & (F.col("asset_domain") == F.col("domain"))
    )
    rows = rows.join(latest_asset_prices(prices), "canonical_id")
    return rows.withColumns(
        {f"{c}_usd": F.col("price") * scaled(c, "decimal") for c in ("balance", "fees_earned", "locked", "supplied", "removed")}
    )


def pool_balances_current(pools: DataFrame, tokens: DataFrame, assets: DataFrame, prices: DataFrame, chains: DataFrame) -> DataFrame:
    """Two-token pools: names, amounts and USD value of both sides at the latest price."""
    rows = pools.where(F.col("balances").isNotNull())
    rows = lookup(rows, chains.distinct(), {"domain": "domainid"}, {"chain": "__chain"})
    pair = {n: J.text_array("pooled_tokens")[n - 1] for n in (1, 2)}
    rows = rows.withColumns(
        {
            "chain": F.coalesce("__chain", F.col("domain").cast("string")),
            **{f"token_{n}": pair[n] for n in (1, 2)},
            **{
                f"pool_{n}_amount": scaled(J.text_array("balances")[n - 1], J.text_array("pool_token_decimals")[n - 1])
                for n in (1, 2)
            },
        }
    )
    for n in (1, 2):
        rows = lookup(rows, tokens.distinct(), {f"token_{n}": "token_address"}, {"token_name": f"__name_{n}"})
    rows = lookup(rows, assets, {"token_1": "id", "domain": "domain"}, {"canonical_id": "canonical_id"})
    rows = rows.join(latest_asset_prices(prices), "canonical_id")
    return rows.select(
        F.col("key").alias("pool_id"), "chain", "canonical_id",
        *[F.coalesce(f"__name_{n}", f"token_{n}").alias(f"token_{n}_name") for n in (1, 2)],
        "pool_1_amount", "pool_2_amount",
        *[(F.col("price") * F.col(f"pool_{n}_amount")).alias(f"usd_pool_{n}_amount") for n in (1, 2)],
    )


def router_liquidity_with_pools(balances_usd: DataFrame, pools_usd: DataFrame, tokens: DataFrame, chains: DataFrame) -> DataFrame:
    """Router liquidity per asset and chain beside the pools holding the asset there."""
    rows = lookup(
        balances_usd, tokens.distinct(), {"adopted": "token_address"}, {"token_name": "__name", "is_xerc20": "__flag"}
    )
    rows = lookup(rows, chains.distinct(), {"domain": "domainid"}, {"chain": "__chain"})
    kinds = ("balance", "locked", "removed", "supplied")
    liquidity = rows.groupBy(
        F.coalesce("__name", "adopted").alias("asset"), F.col("__flag").try_cast("boolean").alias("is_xerc20"),
        F.coalesce("__chain", "domain").alias("chain"),
    ).agg(*[F.sum(f"{k}_usd").alias(f"{k}_usd") for k in kinds])
    held = pools_usd.select(
        F.col("token_2_name").alias("asset"), "chain", "token_1_name", "token_2_name", "usd_pool_1_amount", "usd_pool_2_amount"
    )
    return liquidity.join(held, ["asset", "chain"], "left").groupBy(
        "asset", "is_xerc20", "chain", "token_1_name", "token_2_name"
    ).agg(*[F.sum(c).alias(c) for c in (*[f"{k}_usd" for k in kinds], "usd_pool_1_amount", "usd_pool_2_amount")])


def router_volume_trailing(transfers: DataFrame, balances: DataFrame, as_of: str, days: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """Volume of the last ``days`` per router, asset and chain, as origin and as destination.

    ``transfers``: router, asset, origin_chain, destination_chain, xcall_date, status, amount,
    usd_amount. Both sides come from one pass; ``balances`` (router, asset, chain and any
    values) joins in full.
    """
    end = F.lit(as_of).cast("timestamp")
    sides = F.explode(
        F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_chain").alias("chain")) for s in ("origin", "destination")])
    )
    legs = transfers.where(F.col("xcall_date") < end).select("*", sides.alias("leg")).select("*", "leg.side", "leg.chain")
    aggs = []
    for side in ("origin", "destination"):
        here = F.col("side") == side
        for n in days:
            recent = here & (F.col("xcall_date") >= end - F.make_dt_interval(days=F.lit(n)))
            fast = recent & (F.col("status") == "CompletedFast")
            aggs += [
                F.sum(F.when(recent, F.col("usd_amount"))).alias(f"{side}_usd_volume_{n}d"),
                F.sum(F.when(recent, F.col("amount"))).alias(f"{side}_volume_{n}d"),
                F.sum(F.when(fast, F.col("usd_amount"))).alias(f"{side}_fast_volume_{n}d"),
            ]
    origin = F.col("side") == "origin"
    aggs += [
        F.max(F.when(origin, F.col("xcall_date"))).alias("last_txn_date"),
        F.count_if(origin & (F.col("status") == "CompletedSlow")).alias("slow_txns"),
    ]
    volumes = legs.groupBy("router", "asset", "chain").agg(*aggs)
    return full_on(volumes, balances, ["router", "asset", "chain"])


def pool_tvl_vol_daily(pool_events: DataFrame, exchanges: DataFrame, chains: DataFrame) -> DataFrame:
    """Summed balances, fees and volume per day and pool, from events and exchanges."""

    def pair_sum(c: str) -> Column:
        texts = J.text_array(c)
        return lossy_double(texts[0]) + lossy_double(texts[1])

    def rows(df: DataFrame, fee: Column, vol: Column) -> DataFrame:
        return df.select(
            F.date_trunc("day", F.timestamp_seconds("timestamp")).alias("date"), "pool_id", "domain",
            pair_sum("balances").alias("tvl"), fee.alias("fee"), vol.alias("vol"),
        )

    half = (lossy_double("tokens_sold") + lossy_double("tokens_bought")) / 2
    both = rows(pool_events, pair_sum("fees"), F.lit(0.0)).unionByName(rows(exchanges, lossy_double("fee"), half))
    both = both.where(F.col("vol").isNotNull()).groupBy("date", "pool_id", "domain").agg(
        *[F.sum(c).alias(c) for c in ("tvl", "fee", "vol")]
    )
    both = lookup(both, chains.distinct(), {"domain": "domainid"}, {"chain": "__chain"})
    return both.select("date", "pool_id", F.coalesce("__chain", "domain").alias("chain"), "tvl", "fee", "vol")


def pool_apr(daily: DataFrame, pools: DataFrame, chains: DataFrame) -> DataFrame:
    """Yearly rate of each day's fee, simple and compounded, with 7- and 14-row means.

    ``daily``: day, pool_id, domain, total_tvl, total_fee, total_vol (one row per pool and day).
    """
    named = pools.where(F.col("token_1_name") != F.col("token_2_name")).select("pool_id", "token_1_name", "token_2_name").distinct()
    rows = lookup(daily, chains.distinct(), {"domain": "domainid"}, {"chain": "__chain"})
    rows = lookup(rows, named, {"pool_id": "pool_id"}, {"token_1_name": "token_1_name", "token_2_name": "token_2_name"})
    rate = ratio("total_fee", "total_tvl")
    rows = rows.select(
        F.col("day").alias("date"), "pool_id", F.coalesce("__chain", F.col("domain").cast("string")).alias("chain"),
        "token_1_name", "token_2_name", F.col("total_tvl").alias("tvl"), F.col("total_fee").alias("fee"),
        F.col("total_vol").alias("vol"), (rate * 365).alias("apr"), compounded(rate).alias("apy"),
    )
    return rows.withColumns(
        {f"avg_{n}d_{c}": moving_mean(c, ["pool_id", "chain"], "date", n) for n in (7, 14) for c in ("apr", "apy")}
    )


def router_snapshot_latest(snapshots: DataFrame) -> DataFrame:
    """Balance per router at the newest snapshot time."""
    rows = at_latest(snapshots, "snapshot_time").withColumn("balance", F.col("locked") + F.col("fees_earned"))
    return rows.where("balance > 0").groupBy(F.col("router_address").alias("router")).agg(F.sum("balance").alias("balance"))


# --- yields and utilisation ---------------------------------------------------------------

GROUP = ["chain", "asset_group"]


def hourly_to_daily(hourly: DataFrame) -> DataFrame:
    """Daily means of balances and sums of flows per chain, asset and router."""
    keys = ["chain", "asset_group", "asset", "router_name"]
    return hourly.groupBy(F.date_trunc("day", "date").alias("date"), *keys).agg(
        F.avg("total_locked_usd").alias("total_locked_usd"),
        F.coalesce(F.sum("router_fee_usd"), F.lit(0.0)).alias("router_fee_usd"),
        F.coalesce(F.sum("router_volume_usd"), F.lit(0.0)).alias("router_volume_usd"),
        F.avg("total_balance_usd").alias("total_balance_usd"),
        F.coalesce(F.sum("destination_slow_volume_usd"), F.lit(0.0)).alias("destination_slow_volume_usd"),
    )


def with_slow_path(hourly: DataFrame, slow: DataFrame) -> DataFrame:
    """Utilisation rows and slow-path rows in one table, missing columns as null."""
    return hourly.unionByName(slow.withColumn("router_name", F.lit("slow_path")), allowMissingColumns=True)


def router_apr_daily(daily: DataFrame) -> DataFrame:
    """Yearly fee rate in percent per day, chain and asset group, with full 7- and 14-row means."""
    rows = daily.groupBy("date", "asset_group", "chain").agg(
        *[F.sum(c).alias(c) for c in ("total_balance_usd", "router_fee_usd", "router_volume_usd")]
    )
    fee, balance = F.coalesce("router_fee_usd", F.lit(0.0)), F.col("total_balance_usd")
    rows = rows.where(balance > 0).withColumn("apr", F.bround(100 * (fee / balance * 365), 2))
    return rows.withColumns(
        {
            "apr_7d": moving_mean("apr", GROUP, "date", 7, full_only=True),
            "apr_14d": moving_mean("apr", GROUP, "date", 14, full_only=True),
            "utilization": F.col("router_volume_usd") / balance,
        }
    )


def _rolling(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.withColumns(
        {f"rolling_{n}d_required_liquidity": moving_sum("required_liquidity", keys, "date", n, full_only=True) for n in (3, 7)}
    )


def required_liquidity(apr: DataFrame, apr_target: float) -> DataFrame:
    """Liquidity at which the earned fees would have paid ``apr_target`` percent, per day."""
    rows = apr.withColumn("required_liquidity", F.col("router_fee_usd") * 365 / (apr_target / 100))
    return _rolling(rows, GROUP).groupBy("date").agg(
        *[F.avg(c).alias(c) for c in ("apr", "apr_7d", "apr_14d")],
        *[F.sum(c).alias(c) for c in ("required_liquidity", "total_balance_usd", "router_volume_usd")],
        *[F.avg(f"rolling_{n}d_required_liquidity").alias(f"rolling_{n}d_required_liquidity") for n in (3, 7)],
    )


def required_liquidity_with_slow(apr: DataFrame, slow: DataFrame, apr_target: float) -> DataFrame:
    """The same if the slow path's volume had paid the router fee too."""
    fast = apr.groupBy(F.date_trunc("day", "date").alias("date")).agg(
        F.avg("apr").alias("apr"), *[F.sum(c).alias(c) for c in ("router_volume_usd", "router_fee_usd", "total_balance_usd")]
    )
    slow_days = slow.groupBy(F.date_trunc("day", "date").alias("date")).agg(
        F.sum("destination_slow_volume_usd").alias("destination_slow_volume_usd")
    )
    rows = fast.join(slow_days, "date", "left")
    rows = rows.withColumn("volume", F.col("router_volume_usd") + F.col("destination_slow_volume_usd"))
    rows = rows.withColumn("slow_fast_fee", F.col("volume") * ROUTER_FEE)
    rows = rows.withColumn("required_liquidity", F.col("slow_fast_fee") * 365 / (apr_target / 100))
    return _rolling(rows, [])


def _routed(hourly: DataFrame) -> DataFrame:
    """Rows with a chain, group and router; zero volume counts as none."""
    kept = hourly.where((F.col("asset_group") != "") & (F.col("chain") != "") & F.col("router").isNotNull())
    return kept.withColumns(
        {"router_volume_usd": F.nullif("router_volume_usd", F.lit(0.0)), "day": F.date_trunc("day", "date")}
    )


def router_utilization_summary(hourly: DataFrame) -> DataFrame:
    """Daily utilisation in percent, clipped to 0-100: each router, their mean, total and mean total."""
    rows = _routed(hourly)
    volume, locked = F.col("v"), F.col("l")
    by_router = rows.groupBy("day", "router").agg(
        F.coalesce(F.sum("router_volume_usd"), F.lit(0.0)).alias("v"), F.sum("total_locked_usd").alias("l")
    )
    by_router = by_router.select("day", "router", F.when(locked < 0, 1.0).otherwise(ratio(volume, locked)).alias("u"))
    mean = by_router.groupBy("day").agg(F.avg("u").alias("u")).withColumn("router", F.lit("avg"))
    totals = rows.groupBy("day").agg(
        F.sum("router_volume_usd").alias("vs"), F.sum("total_locked_usd").alias("ls"),
        F.avg("router_volume_usd").alias("vm"), F.avg("total_locked_usd").alias("lm"),
    )
    kinds = F.explode(
        F.array(
            F.struct(F.lit("total").alias("router"), ratio("vs", "ls").alias("u")),
            F.struct(F.lit("total_avg").alias("router"), ratio("vm", "lm").alias("u")),
        )
    )
    both = by_router.unionByName(mean).unionByName(totals.select("day", kinds.alias("k")).select("day", "k.*"))
    return both.select("day", "router", clipped(F.col("u") * 100).alias("router_utilization"))


def utilization_levels(hourly: DataFrame, freq: str = "hour") -> DataFrame:
    """Utilisation per chain and asset group and hour (or its daily mean), with anomalies and level."""
    sums = ("router_fee_usd", "router_volume_usd", "total_balance_usd", "total_locked_usd")
    rows = _routed(hourly).groupBy("day", *GROUP, F.hour("date").alias("hour")).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums]
    )
    locked = F.col("total_locked_usd")
    rows = rows.withColumn("utilization", F.when(locked < 0, 1.0).otherwise(ratio("router_volume_usd", locked)))
    rows = rows.withColumns(
        {
            "utilization_percentage": clipped("utilization", 0.0, 1.0) * 100,
            "anomaly_count": anomaly_flag("utilization"),
            "total_count": F.lit(1),
        }
    )
    if freq == "day":
        rows = rows.groupBy("day", *GROUP).agg(
            F.sum("router_fee_usd").alias("router_fee_usd"),
            F.sum("router_volume_usd").alias("router_volume_usd"),
            F.avg("total_balance_usd").alias("total_balance_usd"),
            F.avg("total_locked_usd").alias("total_locked_usd"),
            F.avg("utilization_percentage").alias("utilization_percentage"),
            F.sum("anomaly_count").alias("anomaly_count"),
            F.sum("total_count").alias("total_count"),
        )
    elif freq != "hour":
        raise ValueError(f"freq must be hour or day, not {freq}")
    return rows.withColumns(
        {
            "utilization_anomaly_percentage": F.col("anomaly_count") / F.col("total_count") * 100,
            "utilization_capacity_levels": capacity_level("utilization_percentage"),
        }
    )


def capacity_distribution(levels: DataFrame) -> DataFrame:
    """Share of each level among the rows of a chain and asset group."""
    counts = levels.groupBy(*GROUP, "utilization_capacity_levels").agg(F.count(F.lit(1)).alias("level_count"))
    shares = share_within(counts, GROUP, "level_count")
    return shares.where(F.col("utilization_capacity_levels").isNotNull()).withColumn(
        "level_percentage", F.col("share") * 100
    ).drop("share")


def utilization_heatmap(levels: DataFrame, metric: str = "utilization_percentage") -> DataFrame:
    """Mean per hour of day, day, chain and asset group; missing cells stay out."""
    return levels.groupBy("hour", "day", *GROUP).agg(F.avg(metric).alias(metric)).where(F.col(metric).isNotNull())


def heatmap_matrix(levels: DataFrame, metric: str = "utilization_percentage") -> DataFrame:
    """The cells of the heat map, empty ones too: one row per hour of day, day, chain and asset group, for every day there is."""
    cells = levels.groupBy("hour", F.date_format("day", "yyyy-MM-dd").alias("day"), *GROUP)
    return cells.agg(F.avg(metric).alias(metric))


def fast_slow_daily(levels: DataFrame, slow: DataFrame) -> DataFrame:
    """Fast path sums per day with the slow path's volume."""
    cols = ("router_volume_usd", "router_fee_usd", "total_balance_usd", "total_locked_usd")
    fast = levels.groupBy("day").agg(*[F.sum(c).alias(c) for c in cols])
    days = slow.groupBy(F.date_trunc("day", "date").alias("day")).agg(
        F.sum("destination_slow_volume_usd").alias("destination_slow_volume_usd")
    )
    return fast.join(days, "day", "left")


def with_last_balance(levels: DataFrame, column: str = "total_balance_usd") -> DataFrame:
    """The day's last hourly value beside every hour of a chain and asset group."""
    return levels.withColumn(f"{column}_last", last_in_group(column, ["day", *GROUP], "hour"))


def anomaly_counts(levels: DataFrame) -> DataFrame:
    return levels.groupBy(*GROUP).agg(F.sum("anomaly_count").alias("anomaly_count"))


def utilization_vs_apr(apr: DataFrame) -> DataFrame:
    return apr.groupBy(*GROUP).agg(*[F.avg(c).alias(c) for c in ("utilization", "apr", "apr_7d", "apr_14d")])


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    """``sum(value * weight) / sum(weight)`` per group."""
    return df.groupBy(*keys).agg(ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(name))
