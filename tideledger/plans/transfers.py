"""Message-bridge transfers: enrichment, pricing, slippage, counts, fees and rebates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions.addresses import is_zero
from ..functions.amounts import lossy_double, ratio, scaled
from ..functions.buckets import usd_range, week_parts
from ..functions.labels import asset_group, mapped, price_group
from ..operators.joins import either_key_lookup, lookup, price_at_or_before, price_book_roles, price_roles, sized

# fixed values: domain id -> chain name
DOMAIN_CHAINS = {
    "6648936": "Ethereum",
    "1869640809": "Optimism",
    "6450786": "BNB",
    "6778479": "Gnosis",
    "1886350457": "Polygon",
    "1634886255": "Arbitrum One",
    "1818848877": "Linea",
    "1835365481": "Metis",
    "1650553709": "Base Mainnet",
    "31338": "Local Optimism",
    "31339": "Local Arbitrum One",
}

# fixed values: domain id -> chain name in fee reports
FEE_CHAINS = {
    "6648936": "Ethereum Mainnet",
    "1869640809": "Optimistic Ethereum",
    "6450786": "Binance Smart Chain Mainnet",
    "6778479": "xDAI Chain",
    "1886350457": "Matic Mainnet",
    "1634886255": "Arbitrum One",
    "1818848877": "Linea Mainnet",
    "1835365481": "Metis Andromeda Mainnet",
    "1650553709": "Base Mainnet",
    "1836016741": "Mode Mainnet",
}

# fixed values: chain spelling in deposit lists -> domain id
DEPOSIT_DOMAINS = {
    "bnb": "6450786",
    "base": "1650553709",
    "linea": "1818848877",
    "gnosis": "6778479",
    "polygon": "1886350457",
    "ethereum": "6648936",
    "optimism": "1869640809",
    "metis": "1835365481",
    "mode": "1836016741",
}

# fixed values: domain id -> token gas is paid in (others: WETH)
DOMAIN_GAS_TOKENS = {"1835365481": "METIS", "1886350457": "MATIC", "6450786": "BNB", "6778479": "DAI"}

# fixed values: domains by the rate of their swap fee
LAYER_2_DOMAINS = (
    "1869640809", "1835365481", "1886350457", "1836016741", "2020368761", "6778479", "1634886255", "1818848877", "1650553709",
)
LAYER_1_DOMAINS = ("6450786", "6648936")
LAYER_2_SWAP_RATE, LAYER_1_SWAP_RATE, ROUTER_RATE = 0.0013, 0.0008, 0.0005

# fixed values: tokens with 18 decimals on one domain although 6 elsewhere
WIDE_TOKEN_DOMAIN = "6450786"
WIDE_TOKENS = ("0x8ac76a51cc950d9822d68b83fe1ad97b32cd580d", "0x55d398326f99059ff775485246999027b3197955")

COMPLETED = ("CompletedSlow", "CompletedFast")


def domain_chain(c: str) -> Column:
    return mapped(c, DOMAIN_CHAINS, F.col(c))


def epoch_month(c: str, year: int, month: int) -> Column:
    """One month of an epoch-second column, as a range the file reader can use."""
    start = F.unix_timestamp(F.lit(f"{year:04d}-{month:02d}-01 00:00:00"))
    end = F.unix_timestamp(F.lit(f"{year + month // 12:04d}-{month % 12 + 1:02d}-01 00:00:00"))
    return (F.col(c) >= start) & (F.col(c) < end)


def _with_caller(transfers: DataFrame, contracts: DataFrame) -> DataFrame:
    own = F.lower("xcall_caller") != F.lower("xcall_tx_origin")
    named = lookup(
        transfers, contracts, {"xcall_caller": "xcall_caller"},
        {"contract_name": "contract_name", "contract_author": "contract_author"}, ignore_case=["xcall_caller"],
    )
    return named.withColumns(
        {
            "caller_type": F.when(own, "Contract").otherwise("EOA"),
            "origin_chain": domain_chain("origin_domain"),
            "destination_chain": domain_chain("destination_domain"),
        }
    )


def _with_tokens(transfers: DataFrame, tokens: DataFrame, flags: bool = False) -> DataFrame:
    tokens = tokens.distinct()
    for side in ("origin", "destination"):
        take = {"token_name": f"__{side}_name"} | ({"is_xerc20": f"__{side}_flag"} if flags else {})
        transfers = lookup(transfers, tokens, {f"{side}_transacting_asset": "token_address"}, take)
        transfers = transfers.withColumn(f"{side}_asset", F.coalesce(f"__{side}_name", f"{side}_transacting_asset"))
        if flags:
            transfers = transfers.withColumn(f"is_{side}_asset_xerc20", F.col(f"__{side}_flag").try_cast("boolean"))
            transfers = transfers.drop(f"__{side}_flag")
        transfers = transfers.drop(f"__{side}_name")
    return transfers


def transfers_usd(
    transfers: DataFrame, contracts: DataFrame, tokens: DataFrame, assets: DataFrame, prices: DataFrame,
    month: tuple[int, int] | None = None, per_domain: bool = True,
) -> DataFrame:
    """Transfers with caller, names, token amounts and the half-hour price at or before.

    ``prices``: canonical_id, timestamp (epoch s), price. Decimals come from the
    asset on each side's domain, or from the asset id alone (``per_domain=False``).
    """
    if month:
        transfers = transfers.where(epoch_month("xcall_timestamp", *month))
    rows = _with_tokens(_with_caller(transfers, contracts), tokens)
    if per_domain:
        known = assets.select("canonical_id", "domain", "decimal").distinct()
        for side in ("origin", "destination"):
            rows = lookup(
                rows, known, {"canonical_id": "canonical_id", f"{side}_domain": "domain"}, {"decimal": f"token_{side}_decimal"}
            )
    else:
        known = assets.select("canonical_id", "decimal").distinct()
        rows = lookup(rows, known, {"canonical_id": "canonical_id"}, {"decimal": "token_origin_decimal"})
        rows = rows.withColumn("token_destination_decimal", F.col("token_origin_decimal"))
    rows = rows.withColumns(
        {
            "d_origin_amount": scaled("origin_bridged_amount", "token_origin_decimal", 0),
            "d_destination_amount": scaled("destination_transacting_amount", "token_destination_decimal", 0),
            "xcall_date": F.timestamp_seconds("xcall_timestamp"),
        }
    )
    ticks = prices.select("canonical_id", F.timestamp_seconds("timestamp").alias("ts"), "price")
    rows = price_at_or_before(rows, ticks, "canonical_id", "xcall_date")
    return rows.withColumns(
        {f"usd_{side}_amount": F.col(f"d_{side}_amount") * F.col("price") for side in ("origin", "destination")}
    )


def transfers_usd_hourly(
    transfers: DataFrame, contracts: DataFrame, tokens: DataFrame, assets: DataFrame, hourly: DataFrame,
) -> DataFrame:
    """The same with the hour's price of the destination asset, user group and token flags.

    ``hourly``: symbol, date, average_price; symbols of one price group are averaged.
    """
    rows = _with_tokens(_with_caller(transfers, contracts), tokens, flags=True)
    known = assets.select("canonical_id", "domain", "decimal", "adopted_decimal").distinct()
    for side in ("origin", "destination"):
        rows = lookup(
            rows, known, {"canonical_id": "canonical_id", f"{side}_domain": "domain"},
            {"decimal": f"__{side}_decimal", "adopted_decimal": f"__{side}_adopted"},
        )
    prices = hourly.groupBy(price_group("symbol").alias("symbol"), F.date_trunc("hour", "date").alias("date")).agg(
        F.avg("average_price").alias("price")
    )
    rows = rows.withColumn("xcall_date", F.timestamp_seconds("xcall_timestamp"))
    rows = price_roles(rows, sized(prices), {"price": ("destination_asset", "xcall_date")})
    author = F.col("contract_author")
    bridged_next = F.col("origin_asset").startswith("next") | F.col("destination_asset").startswith("next")
    rows = rows.withColumns(
        {
            "is_aggregator": F.coalesce(author.isin("LiFi", "Socket"), F.lit(False)),
            "user_group": F.when(bridged_next, "nextAsset")
            .when(author == "LiFi", "LiFi")
            .when(author == "Socket", "Socket")
            .otherwise("Bridge - Other"),
            "d_origin_amount": scaled("origin_transacting_amount", "__origin_adopted", 0),
            "d_bridged_amount": scaled("origin_bridged_amount", "__origin_decimal", 0),
            "d_destination_amount": scaled("destination_transacting_amount", "__destination_adopted", 0),
        }
    ).drop("__origin_decimal", "__origin_adopted", "__destination_decimal", "__destination_adopted")
    return rows.withColumns(
        {f"usd_{k}_amount": F.col(f"d_{k}_amount") * F.col("price") for k in ("origin", "bridged", "destination")}
    )


def transfers_slippage(transfers: DataFrame, assets: DataFrame, exchanges: DataFrame | None = None) -> DataFrame:
    """Amounts lost in the swap on either side, and the relayer fee by kind.

    An asset matches by local or adopted address. ``exchanges`` (transaction_hash,
    domain, fee) adds the pool fee of both swaps.
    """
    fees = J.text_map("relayer_fees")
    rows = transfers.withColumns(
        {
            "__gas": lossy_double(F.get(F.map_values(F.map_filter(fees, lambda k, _: is_zero(k))), F.lit(0))),
            "__token": lossy_double(F.get(F.map_values(J.without_zero_address(fees)), F.lit(0))),
        }
    )
    for side in ("origin", "destination"):
        rows = either_key_lookup(
            rows, assets, f"{side}_transacting_asset", ["local", "adopted"], {f"{side}_domain": "domain"},
            {"decimal": f"__{side}_decimal"},
        )
        if exchanges is not None:
            hash_column = "xcall_transaction_hash" if side == "origin" else "execute_transaction_hash"
            name = "source" if side == "origin" else "destination"
            rows = lookup(
                rows, exchanges, {hash_column: "transaction_hash", f"{side}_domain": "domain"},
                {"fee": f"{name}_stableswap_fees"},
            )

    def places(side: str) -> Column:
        wide = F.col(f"{side}_transacting_asset").isin(*WIDE_TOKENS) & (F.col(f"{side}_domain") == WIDE_TOKEN_DOMAIN)
        return F.when(wide, F.lit("18")).otherwise(F.col(f"__{side}_decimal"))

    sent = scaled("origin_transacting_amount", places("origin"))
    token_fee = scaled("__token", places("origin"))
    bridged = scaled("origin_bridged_amount", "__origin_decimal")
    local = scaled("destination_local_amount", "__origin_decimal")
    got = scaled("destination_transacting_amount", places("destination"))
    extra = [] if exchanges is None else ["source_stableswap_fees", "destination_stableswap_fees"]
    return rows.select(
        "transfer_id", "xcall_timestamp", "origin_domain", "destination_domain",
        "origin_transacting_asset", "destination_transacting_asset",
        sent.alias("exact_origin_transacting_amount"),
        F.coalesce(sent - token_fee, sent).alias("exact_origin_transacting_amount_without_relayer_fees"),
        bridged.alias("exact_origin_bridged_amount"),
        local.alias("exact_destination_local_amount"),
        got.alias("exact_destination_transacting_amount"),
        (F.col("__gas") / 1e18).alias("exact_relayer_fee_gas_amount"),
        token_fee.alias("exact_relayer_fee_token_amount"),
        (bridged - sent).alias("source_stableswap_slippage"),
        (got - local).alias("destination_stableswap_slippage"),
        ((bridged - sent) + (got - local)).alias("total_stableswap_slippage"),
        *extra,
    )


# --- counts -------------------------------------------------------------------------


def _day(ts: str = "xcall_date") -> Column:
    return F.date_trunc("day", ts).alias("xcall_date")


def user_counts(transfers: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return transfers.groupBy(_day()).agg(count("xcall_caller").alias("callers"))


def category_counts(transfers: DataFrame, column: str = "xcall_caller", name: str = "callers") -> DataFrame:
    """Distinct users (or transfers) by day, token standard, caller type and status."""
    flags = [F.col(f"is_{side}_asset_xerc20").try_cast("boolean") for side in ("origin", "destination")]
    marked = F.coalesce(flags[0], F.lit(False)) | F.coalesce(flags[1], F.lit(False))
    return transfers.groupBy(_day(), marked.alias("x_erc_20_asset"), "caller_type", "status").agg(
        F.count_distinct(column).alias(name)
    )


def transfer_counts(transfers: DataFrame) -> DataFrame:
    """Transfers, users and volume by day and route; a transfer has one user.

    Counts add up in three steps (transfer, user, route), each with partial sums, so no row is expanded for a second distinct count.
    """
    route = ["xcall_date", "origin_chain", "destination_chain", "origin_asset", "destination_asset"]
    usd = F.sum("usd_bridged_amount").alias("usd_bridged_amount")
    once = transfers.groupBy(_day(), *route[1:], "xcall_caller", "transfer_id").agg(usd)
    users = once.groupBy(*route, "xcall_caller").agg(F.count("transfer_id").alias("transfers"), usd)
    return users.groupBy(*route).agg(F.sum("transfers").alias("transfers"), F.count("xcall_caller").alias("callers"), usd)


def bridge_volume_daily(transfers: DataFrame) -> DataFrame:
    return transfers.groupBy(_day(), "origin_chain", "destination_chain", "origin_asset", "destination_asset").agg(
        F.sum("usd_bridged_amount").alias("usd_bridged_amount")
    )


def amount_cohorts(transfers: DataFrame, amount: str = "usd_amount") -> DataFrame:
    """Count and volume by day and size class, split by the fast and the slow path."""
    fast, slow = F.col("status") == "CompletedFast", F.col("status") == "CompletedSlow"
    value = F.col(amount)
    return transfers.groupBy(F.to_date("xcall_date").alias("date"), usd_range(value).alias("amount_bucket")).agg(
        F.count("transfer_id").alias("transfer_count"),
        F.sum(value).alias("volume"),
        F.sum(F.when(fast, value).otherwise(0.0)).alias("fast_volume"),
        F.sum(F.when(slow, value).otherwise(0.0)).alias("slow_volume"),
        F.count_if(fast).alias("fast_transfer_count"),
        F.count_if(slow).alias("slow_transfer_count"),
    )


# --- fees and rebates -----------------------------------------------------------------

FEES = ("gas", "relay_1", "relay_2", "amm", "router")


def deposit_users(*lists: tuple[DataFrame, str, str, str | None]) -> DataFrame:
    """Deposit lists (table, hash column, user column, chain or None) as hash, user, origin chain.

    A chain, given or in the list's ``origin_chain``, is a spelling or a domain id; it gets the name that fee reports use for
    that domain. Others stay as they are.
    """
    parts = []
    for number, (df, hash_column, user, chain) in enumerate(lists):
        given = (df.withColumn("origin_chain", F.lit(chain)) if chain else df).withColumn(
            "__domain", mapped(F.lower("origin_chain"), DEPOSIT_DOMAINS, F.col("origin_chain"))
        )
        parts.append(
            given.select(
                F.lit(number).alias("__list"), F.col(hash_column).alias("hash"), F.lower(user).alias("user_address"),
                mapped("__domain", FEE_CHAINS, F.col("__domain")).alias("origin_chain"),
            )
        )
    # dealt out as the lookup needs them, so that one shuffle serves both; distinct in each list
    both = reduce(lambda a, b: a.unionByName(b), parts).repartition("hash", "origin_chain")
    return both.distinct().drop("__list")


def transfer_fees(transfers: DataFrame, assets: DataFrame, tokens: DataFrame, prices: DataFrame) -> DataFrame:
    """Gas, two relay fees, swap fee and router fee per completed transfer, in USD.

    A relay fee paid in the sent asset uses its decimals and price, any other one
    the chain's gas token.
    """
    return _valued_fees(_fee_amounts(transfers, assets, tokens), prices)


def _fee_amounts(transfers: DataFrame, assets: DataFrame, tokens: DataFrame) -> DataFrame:
    """What fees are made of, with no column that follows from others: domains, own assets, amounts and times of completed transfers."""
    # lists of assets have sizes, so transfers stay where they are
    known = sized(assets.select("canonical_id", "domain", "adopted_decimal").distinct())
    rows = transfers.where(F.col("status").isin(*COMPLETED))
    for side in ("origin", "destination"):
        rows = lookup(
            rows, known, {"canonical_id": "canonical_id", f"{side}_domain": "domain"}, {"adopted_decimal": f"__{side}_decimal"}
        )
    names = sized(tokens.select(F.lower("token_address").alias("local"), F.col("token_name").alias("asset")).distinct())
    fees = J.text_map("relayer_fees")
    for n in (1, 2):
        key, value = J.nth_fee(fees, n - 1)
        rows = rows.withColumn(f"__key_{n}", key).withColumn(f"__value_{n}", lossy_double(value))
        rows = lookup(rows, names, {f"__key_{n}": "local"}, {"asset": f"__name_{n}"}, ignore_case=[f"__key_{n}"])
    for side in ("origin", "destination"):
        asset = f"{side}_transacting_asset"
        rows = lookup(rows, names, {asset: "local"}, {"asset": f"__{side}_name"}, ignore_case=[asset])
        rows = rows.withColumn(f"{side}_asset", F.coalesce(f"__{side}_name", asset))

    def relay(n: int) -> list[Column]:
        key, value = F.col(f"__key_{n}"), F.col(f"__value_{n}")
        own = (key == F.col("origin_transacting_asset")) & ~is_zero(key)
        amount = F.when(own, scaled(value, "__origin_decimal", 18)).otherwise(value / 1e18)
        return [
            own.alias(f"__own_{n}"), F.when(own, F.col(f"__name_{n}")).alias(f"__asset_{n}"),
            (amount if n == 1 else F.when(key.isNotNull(), amount)).alias(f"relay_{n}_amount"), key.isNotNull().alias(f"__paid_{n}"),
        ]

    return rows.select(
        "transfer_id", "xcall_transaction_hash", F.timestamp_seconds("xcall_timestamp").alias("date"), "origin_domain", "destination_domain",
        "origin_asset", "destination_asset", (lossy_double("xcall_gas_price") * lossy_double("xcall_gas_limit") / 1e18).alias("gas_amount"),
        *relay(1), *relay(2), scaled("origin_transacting_amount", "__origin_decimal", 18).alias("__sent"),
        scaled("destination_transacting_amount", "__destination_decimal", 0).alias("destination_amount"),
    )


def _valued_fees(rows: DataFrame, prices: DataFrame, *kept: str) -> DataFrame:
    """Fees in tokens and in USD from ``_fee_amounts``; ``kept`` are other columns that stay, at the end."""
    gas = mapped("origin_domain", DOMAIN_GAS_TOKENS, F.lit("WETH"))
    domain, sent = F.col("origin_domain"), F.col("__sent")
    swap_rate = F.when(domain.isin(*LAYER_2_DOMAINS), LAYER_2_SWAP_RATE).when(domain.isin(*LAYER_1_DOMAINS), LAYER_1_SWAP_RATE)

    def relay(n: int) -> tuple[Column, Column]:
        asset = F.when(F.col(f"__own_{n}"), F.col(f"__asset_{n}")).otherwise(gas)
        return asset if n == 1 else F.when(F.col(f"__paid_{n}"), asset), F.col(f"relay_{n}_amount")

    amounts = {
        "gas": (gas, F.col("gas_amount")),
        "relay_1": relay(1),
        "relay_2": relay(2),
        "amm": (F.col("origin_asset"), F.coalesce(sent * swap_rate, F.lit(0.0))),
        "router": (F.col("origin_asset"), sent * ROUTER_RATE),
        "destination": (F.col("destination_asset"), F.col("destination_amount")),
    }
    rows = rows.select(
        "transfer_id", "xcall_transaction_hash", "date",
        *[mapped(f"{side}_domain", FEE_CHAINS, F.col(f"{side}_domain")).alias(f"{side}_chain") for side in ("origin", "destination")],
        "destination_asset",
        *[asset.alias(f"{k}_asset") for k, (asset, _) in amounts.items() if k != "destination"],
        *[amount.alias(f"{k}_amount") for k, (_, amount) in amounts.items()],
        *kept,
    )
    rows = price_book_roles(rows, prices, "date", {f"__price_{k}": price_group(f"{k}_asset") for k in amounts})
    rows = rows.withColumns({f"usd_{k}_amount": F.col(f"{k}_amount") * F.col(f"__price_{k}") for k in amounts})
    rows = rows.drop(*[f"__price_{k}" for k in amounts])
    return rows.select(*[c for c in rows.columns if c not in kept], *kept)


def rebates(
    transfers: DataFrame, assets: DataFrame, tokens: DataFrame, prices: DataFrame, deposits: DataFrame, reward_prices: DataFrame
) -> DataFrame:
    """``fee_rebate`` of ``transfer_fees``. Transfers meet their deposits before fees are valued, so that narrow rows are shuffled."""
    rows = _fee_amounts(transfers, assets, tokens)
    rows = rows.withColumn("__chain", mapped("origin_domain", FEE_CHAINS, F.col("origin_domain")))
    rows = lookup(rows, deposits, {"xcall_transaction_hash": "hash", "__chain": "origin_chain"}, {"user_address": "user_address"})
    return _rebated(_valued_fees(rows, prices, "user_address"), reward_prices)


def fee_rebate(fees: DataFrame, deposits: DataFrame, reward_prices: DataFrame) -> DataFrame:
    """Total fee in USD and in the reward token of the hour, with the paying user."""
    rows = lookup(
        fees, deposits, {"xcall_transaction_hash": "hash", "origin_chain": "origin_chain"}, {"user_address": "user_address"}
    )
    return _rebated(rows, reward_prices)


def _rebated(rows: DataFrame, reward_prices: DataFrame) -> DataFrame:
    hour = reward_prices.groupBy(F.date_trunc("hour", "date").alias("__hour")).agg(F.avg("price").alias("price"))
    rows = rows.withColumn("__hour", F.date_trunc("hour", "date")).join(sized(hour), "__hour", "left").drop("__hour")
    total = F.lit(0.0)
    for k in FEES:
        total = total + F.coalesce(F.col(f"usd_{k}_amount"), F.lit(0.0))
    return rows.withColumn("total_fee_usd", total).withColumns(
        {"total_fee_reward": ratio("total_fee_usd", "price"), **week_parts("date")}
    )


def rebate_by_route(rebates: DataFrame) -> DataFrame:
    return rebates.groupBy("origin_chain", "destination_chain").agg(
        F.sum("total_fee_usd").alias("total_fee_usd"),
        F.sum("total_fee_reward").alias("total_fee_reward"),
        F.sum("usd_destination_amount").alias("usd_destination_amount"),
        F.avg("price").alias("price"),
        F.count_distinct("transfer_id").alias("transfer_count"),
    )


def rebate_by_user(rebates: DataFrame) -> DataFrame:
    return (
        rebates.where(F.col("user_address").isNotNull())
        .groupBy("user_address", "destination_asset")
        .agg(
            F.avg("price").alias("reward_usd_price"),
            F.sum("total_fee_reward").alias("total_fee_reward"),
            F.sum("total_fee_usd").alias("total_fee_usd"),
        )
        .where("total_fee_usd > 0")
    )


def missing_deposits(
    transfers: DataFrame, deposits: DataFrame, origin_domain: str, destination_domain: str, asset: str,
) -> DataFrame:
    """Completed transfers of a route at or after the newest deposit on file that are not on file."""
    newest = deposits.agg(F.ceil(F.unix_micros(F.max("timestamp")) / 1_000_000).alias("newest")).scalar()
    rows = transfers.where(
        F.col("status").isin(*COMPLETED)
        & (F.lower("destination_transacting_asset") == asset.lower())
        & (F.col("origin_domain") == origin_domain)
        & (F.col("destination_domain") == destination_domain)
    )
    rows = rows.where(F.col("xcall_timestamp") >= newest)
    rows = rows.select(F.col("xcall_transaction_hash").alias("source_chain_hash"))
    return rows.join(deposits.select(F.col("hash").alias("source_chain_hash")), "source_chain_hash", "left_anti")


def raw_flows(transfers: DataFrame) -> DataFrame:
    """Directed flow rows: date, from, to, asset group, amount, transfer id."""
    return transfers.select(
        F.col("xcall_date").alias("date"),
        F.col("origin_chain").alias("from"),
        F.col("destination_chain").alias("to"),
        asset_group("destination_asset").alias("asset"),
        F.col("d_destination_amount").alias("amount"),
        "transfer_id",
    )

