"""Route quotes: cleaning, ranking, pathway planning and registries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions.amounts import lossy_double, nearest_power_of_ten, snapped_notional
from ..functions.labels import chain_display_name
from ..operators.joins import grid, lookup
from ..operators.ordered import ranked_rows
from ..operators.windows import at_latest, top_dense
from ..session import cut_lineage

PATHWAY = ["from_chain", "to_chain", "from_token", "to_token"]

# fixed value: address used in planned requests
PLANNING_ADDRESS = "0xd8dA6BF26964aF9D7eEd9e03E53415D37aA96045"


def routes_from_steps(steps: DataFrame, source: str, with_fee: bool = True) -> DataFrame:
    """Step rows to one quote per route; the bridges are joined in step order."""
    route = [
        "route_id", "upload_datetime", "route_fromchainid", "route_tochainid", "route_fromtoken_symbol",
        "route_totoken_symbol", "route_fromamountusd", "route_toamountusd", "route_gascostusd", "fee_amountusd", "fee_name",
    ]
    tools = F.array_sort(F.collect_list(F.struct("step_index", "tooldetails_key")))
    per_route = steps.groupBy(*route).agg(tools.alias("tools"))
    out, gas, fee = (lossy_double(c) for c in ("route_toamountusd", "route_gascostusd", "fee_amountusd"))
    return per_route.select(
        F.col("upload_datetime").alias("date"),
        F.lit(source).alias("aggregator"),
        F.array_join(F.col("tools.tooldetails_key"), ",").alias("bridges"),
        F.size("tools").alias("total_user_tx"),
        F.col("route_fromchainid").cast("string").alias("from_chain"),
        F.col("route_tochainid").cast("string").alias("to_chain"),
        F.col("route_fromtoken_symbol").alias("from_token"),
        F.col("route_totoken_symbol").alias("to_token"),
        F.col("fee_name").alias("fee_type"),
        lossy_double("route_fromamountusd").alias("in_value_usd"),
        out.alias("out_value_usd"),
        fee.alias("fee_usd"),
        gas.alias("gas_fee"),
        (out - gas - fee if with_fee else out - gas).alias("final_out_amount"),
    )


def routes_from_quotes(quotes: DataFrame, source: str) -> DataFrame:
    """Quote rows that carry their received value; the bridge list loses its brackets."""
    return quotes.select(
        F.col("upload_datetime").alias("date"),
        F.lit(source).alias("aggregator"),
        J.bracket_list("usedbridgenames").alias("bridges"),
        F.col("totalusertx").cast("int").alias("total_user_tx"),
        F.col("fromchainid").cast("string").alias("from_chain"),
        F.col("tochainid").cast("string").alias("to_chain"),
        F.col("fromasset_symbol").alias("from_token"),
        F.col("toasset_symbol").alias("to_token"),
        F.col("integratorfee_asset_symbol").alias("fee_type"),
        F.col("inputvalueinusd").alias("in_value_usd"),
        F.col("outputvalueinusd").alias("out_value_usd"),
        F.lit(0.0).alias("fee_usd"),
        F.col("totalgasfeesinusd").alias("gas_fee"),
        F.col("receivedvalueinusd").alias("final_out_amount"),
    )


def distinct_quotes(*sources: DataFrame, since: str | None = None) -> DataFrame:
    """Distinct quotes of each source, under one another."""
    return _numbered(sources, since).distinct().drop("__source")


def _numbered(sources: Sequence[DataFrame], since: str | None) -> DataFrame:
    """All quotes, with the number of their source."""
    kept = [df.drop("total_user_tx").withColumn("__source", F.lit(number)) for number, df in enumerate(sources)]
    if since:
        kept = [df.where(F.col("date") >= F.lit(since).cast("timestamp")) for df in kept]
    return reduce(lambda a, b: a.unionByName(b), kept)


def clean_quotes(*sources: DataFrame, since: str | None = None) -> DataFrame:
    """Distinct quotes of each source, ranked by what arrives per time and pathway."""
    rows = _numbered(sources, since)
    return ranked_rows(rows, ["date", *PATHWAY], "final_out_amount", "max_value_rank_by_output", distinct=True).drop("__source")


def rank_bridges(quotes: DataFrame, keep: int = 2) -> DataFrame:
    """The ``keep`` best prices per route and notional.

    Sizes near 1k, 10k or 100k count as those, others as 1k; the output moves by
    the same difference.
    """
    averages = quotes.where("final_out_amount > 0").groupBy("bridges", *PATHWAY, "in_value_usd").agg(
        F.avg("final_out_amount").alias("avg_out")
    )
    level = F.coalesce(snapped_notional("in_value_usd"), F.lit(1000).cast("bigint"))
    named = averages.select(
        chain_display_name("from_chain").alias("from_chain"),
        chain_display_name("to_chain").alias("to_chain"),
        F.col("from_token").alias("token"),
        level.alias("input_amount"),
        F.col("bridges").alias("bridge"),
        (F.col("avg_out") - (F.col("in_value_usd") - level)).alias("out_amount"),
    )
    prices = named.groupBy("from_chain", "to_chain", "token", "input_amount", "bridge").agg(F.avg("out_amount").alias("price"))
    return top_dense(prices, ["from_chain", "to_chain", "token", "input_amount"], "price", keep, "best_bridge_rank")


def best_route_vs_tracked(quotes: DataFrame, tracked: Column) -> DataFrame:
    """Best quotes per time, aggregator and pathway beside the tracked bridge's own quote.

    ``tracked`` is a condition on the quote's bridges.
    """
    group, value, rank = ["date", "aggregator", *PATHWAY], "final_out_amount", "max_value_rank_by_output"
    placed = ranked_rows(quotes, group, value, rank).where((F.col(rank) == 1) | tracked)
    # read for both sides, ranked once
    placed = cut_lineage(placed)
    best = placed.where(F.col(rank) == 1)
    same = ["date", *PATHWAY, "in_value_usd"]
    own = placed.where(tracked).select(*same, *[F.col(c).alias(f"tracked_{c}") for c in ("out_value_usd", "gas_fee", value, rank)])
    return best.join(own, same, "left")


# --- planning -------------------------------------------------------------------


def latest_prices(prices: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Average price per symbol at the table's latest time."""
    newest = at_latest(prices, "date")
    if symbols:
        newest = newest.where(F.col("symbol").isin(*symbols))
    return newest.groupBy("symbol").agg(F.avg("average_price").alias("price"))


def _priced_symbol(symbol: str, synonyms: Sequence[str]) -> Column:
    return F.when(F.col(symbol).isin(*synonyms), "WETH").otherwise(F.col(symbol))


def plan_pathways(
    chains: DataFrame, tokens: DataFrame, prices: DataFrame, amounts: Sequence[int], aggregators: Sequence[str],
    as_weth: Sequence[str] = ("ETH", "ezETH", "nETH"),
) -> DataFrame:
    """Every ordered pair of chains x symbol held on both x amount x aggregator, in raw units.

    ``chains.chain_id``; ``tokens``: chain_id, symbol, address, decimals; ``prices``:
    symbol, price. The grid grows from the tokens both ends hold, so impossible pairs
    are never built.
    """
    known = tokens.join(chains.select("chain_id").distinct(), "chain_id", "left_semi")
    sent = known.select(
        F.col("chain_id").alias("from_chain_id"), "symbol", F.col("address").alias("from_token_address"),
        F.col("decimals").alias("from_decimals"),
    )
    got = known.select(F.col("chain_id").alias("to_chain_id"), "symbol", F.col("address").alias("to_token_address"))
    pairs = sent.join(got, "symbol").where("from_chain_id != to_chain_id")
    rows = grid(pairs, amount=amounts, aggregator=aggregators)
    rows = lookup(
        rows.withColumn("__ps", _priced_symbol("symbol", as_weth)), prices, {"__ps": "symbol"}, {"price": "price"}
    )
    unit = F.pow(F.lit(10.0), F.col("from_decimals"))
    return rows.select(
        "from_chain_id", "to_chain_id", "symbol", "amount",
        F.round(F.col("amount") / F.col("price") * unit, 0).alias("from_amount"),
        "from_token_address", "to_token_address", F.lit(PLANNING_ADDRESS).alias("from_address"), "aggregator",
    )


def supported_pathways(plan: DataFrame, aggregator: str, tokens: DataFrame, pairs: DataFrame | None = None, chains: DataFrame | None = None) -> DataFrame:
    """Planned rows an aggregator can serve: chain pair (or both chains) and both tokens known to it."""
    rows = plan.where(F.col("aggregator") == aggregator)
    if pairs is not None:
        rows = rows.join(pairs.select("from_chain_id", "to_chain_id"), ["from_chain_id", "to_chain_id"], "left_semi")
    for side in ("from", "to"):
        if chains is not None:
            known = chains.select(F.col("chain_id").alias(f"{side}_chain_id"))
            rows = rows.join(known, f"{side}_chain_id", "left_semi")
        held = tokens.select(F.col("chain_id").alias(f"{side}_chain_id"), F.lower("address").alias("__a"))
        rows = rows.withColumn("__a", F.lower(f"{side}_token_address")).join(held, [f"{side}_chain_id", "__a"], "left_semi")
        rows = rows.drop("__a")
    return rows.distinct()


def top_pathways(
    transfers: DataFrame, symbols: Sequence[str], tokens: DataFrame, prices: DataFrame, amounts: Sequence[int],
    aggregators: Sequence[str], as_of: str,
) -> DataFrame:
    """Given chain transfers x symbols x amounts x aggregators with addresses of both sides.

    ``transfers``: origin_chain_id, destination_chain_id; the amount is rounded up
    to a whole token. Missing tokens or prices leave nulls.
    """
    rows = grid(transfers, symbol=symbols, amount=amounts, aggregator=aggregators)
    for side, end in (("from", "origin_chain_id"), ("to", "destination_chain_id")):
        rows = lookup(
            rows, tokens, {"symbol": "symbol", end: "chain_id"},
            {"address": f"{side}_token_address", "decimals": f"{side}_decimals"},
        )
    rows = lookup(rows.withColumn("__ps", _priced_symbol("symbol", ("ETH",))), prices, {"__ps": "symbol"}, {"price": "price"})
    value = F.col("amount") / F.col("price")
    return rows.select(
        F.date_trunc("hour", F.lit(as_of).cast("timestamp")).alias("hour"),
        F.col("origin_chain_id").alias("from_chain_id"), F.col("destination_chain_id").alias("to_chain_id"),
        (F.ceil(value) * F.pow(F.lit(10.0), F.col("from_decimals"))).alias("from_amount"),
        F.col("symbol").alias("asset"), "from_token_address", "from_decimals", "to_token_address", "to_decimals",
        F.lit(PLANNING_ADDRESS).alias("from_address"), "aggregator", "price", value.alias("amount_value"),
    )


def plan_power_amounts(pairs: DataFrame, tokens: DataFrame, symbols: Sequence[str], powers: Sequence[int] = (1, 2, 3, 4, 5, 6)) -> DataFrame:
    """Chain pairs x symbols with amounts worth 10^1 .. 10^6, snapped to powers of ten."""
    listed = tokens.where(F.col("symbol").isin(*symbols))
    sent = listed.select(
        F.col("chain_id").alias("from_chain_id"), "symbol", F.col("address").alias("from_token_address"),
        "decimals", "price_usd",
    )
    got = listed.select(F.col("chain_id").alias("to_chain_id"), "symbol", F.col("address").alias("to_token_address"))
    rows = pairs.join(sent, "from_chain_id").join(got, ["to_chain_id", "symbol"])
    rows = rows.withColumn("__power", F.explode(F.array(*[F.lit(float(p)) for p in powers])))
    raw = F.floor(F.pow(F.lit(10.0), F.col("decimals")) * F.pow(F.lit(10.0), F.col("__power")) / F.col("price_usd"))
    return rows.select(
        "from_chain_id", "from_token_address", "to_chain_id", "to_token_address",
        nearest_power_of_ten(raw, half_even=True).alias("from_amount"),
    ).distinct()


def alternative_pairs(tools: DataFrame, chains: DataFrame, aggregators: Sequence[str]) -> DataFrame:
    """Distinct chain pairs of the tools, named, once per aggregator."""
    rows = tools.select(F.col("from_chain_id").cast("bigint"), F.col("to_chain_id").cast("bigint")).distinct()
    rows = lookup(rows, chains, {"from_chain_id": "chain_id"}, {"name": "from_chain_name"})
    rows = lookup(rows, chains, {"to_chain_id": "chain_id"}, {"name": "to_chain_name"})
    return grid(rows, aggregator=aggregators).distinct()


ENDS = ["from_chain_id", "from_token_address", "to_chain_id", "to_token_address"]


def working_pathways(routes: DataFrame) -> DataFrame:
    """Distinct served pathways with the nearest power of ten of the amount."""
    amount = nearest_power_of_ten(F.nullif(lossy_double("from_amount"), F.lit(0.0)))
    return routes.select(*ENDS, amount.alias("from_amount")).where(F.col("from_amount").isNotNull()).distinct()


def skipped_pathways(configured: DataFrame, working: DataFrame, names: DataFrame) -> DataFrame:
    """Configured pathways without any served route, with both token names."""
    rows = configured.select(*ENDS).distinct().join(working.select(*ENDS), ENDS, "left_anti")
    rows = lookup(rows, names, {"from_token_address": "token_address"}, {"token_name": "from_token_name"})
    return lookup(rows, names, {"to_token_address": "token_address"}, {"token_name": "to_token_name"}).distinct()


def calculated_pathways(routes: DataFrame, configured: DataFrame) -> DataFrame:
    """Every configured pathway with its served amounts, null where there is none.

    Both sides are distinct before they meet, so a pathway gives a row for each of its amounts, not for each pair of its rows.
    """
    amount = nearest_power_of_ten(F.nullif(lossy_double("from_amount"), F.lit(0.0))).alias("nearest_power_of_ten_amount")
    return configured.select(*ENDS).distinct().join(routes.select(*ENDS, amount).distinct(), ENDS, "left").distinct()


# --- registries -------------------------------------------------------------------


def bridge_chain_pairs(bridges: DataFrame) -> DataFrame:
    """One row per chain a bridge supports; ``chains`` is JSON text."""
    return bridges.select("id", F.explode(J.text_array("chains")).alias("name"))


def parse_day_stats(stats: DataFrame, bridges: DataFrame, chains: DataFrame, wallets: bool = False) -> DataFrame:
    """Bridge id, chain and day out of the URL, address out of the key, kind of movement."""
    kind = F.col("key_type")
    rows = stats.select(
        F.col("url").alias("api_url"),
        "date",
        J.extracted("url", r"id=(\d+)").cast("bigint").alias("bridge_id"),
        J.extracted("url", r"/(\d+)/").alias("timestamp"),
        J.extracted("url", r"([^/]+)\?").alias("chain"),
        J.extracted("key", r"([^:]+)").alias("chain_slug"),
        J.extracted("key", r":(.+)").alias("wallet_address" if wallets else "token_address"),
        F.when(kind.endswith("Deposited"), "deposit").when(kind.endswith("Withdrawn"), "withdrawal").alias("tx_type"),
        *(["usd_value", "txs"] if wallets else ["symbol", "decimals", "usd_value"]),
    )
    rows = lookup(rows, bridges, {"bridge_id": "id"}, {"display_name": "name"}, "inner")
    return lookup(rows, chains, {"chain": "name"}, {"chain_id": "chain_id"}, "inner")


def chain_token_registry(assets: DataFrame, registry: DataFrame) -> DataFrame:
    """Assets with the registry's names; one chain is reported under its newer name."""
    named = registry.withColumn("__local", F.lower("asset_key"))
    rows = assets.join(named, (F.col("domain") == F.col("domainid")) & (F.col("local") == F.col("__local")))
    return rows.select(
        F.when(F.col("name") == "xDAI Chain", "Gnosis").otherwise(F.col("name")).alias("chain_name"),
        "domainid", "asset_symbol", F.col("asset_key").alias("asset"),
        F.col("asset_mainnetequivalent").alias("canonical_asset_address"),
        F.lower("local").alias("local"), F.lower("adopted").alias("adopted"),
        F.coalesce(F.col("decimal").cast("bigint"), F.col("asset_decimals").cast("bigint")).alias("asset_decimals"),
    )

