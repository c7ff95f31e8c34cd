"""Bridge transfers: staging per bridge, USD pricing, the union mart and volumes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amounts as A
from ..functions import jsontext as J
from ..functions.labels import (
    BRIDGE_CHAINS,
    BRIDGE_SPELLINGS,
    CHAIN_CODE_IDS,
    CHAIN_CODE_NATIVE,
    CHAIN_NAME_IDS,
    harmonised_chain,
    mapped,
)
from ..operators.joins import lookup, lookup_roles, price_roles, sized
from ..operators.ordered import numbered, row_id
from ..operators.repeats import without_copies
from ..operators.windows import extreme_with_ties, latest_per_key
from ..sources.schemas import CANONICAL_COLUMNS, CANONICAL_TYPES

# fixed values: transfers known to be wrong at the source
ALLBRIDGE_DENIED = (
    "0x0402fa59821efb3c4140b03bc86a5667287390f8ae9a1b661ae092895b922995",
    "0x0405b9ec920036f4be00ebf80170e61079e1cdc5eb18887ee8ef984e62a9ab35",
    "0x040232094e33ddc73941dd012c5a37a8bd73262cb97b5c36d83d4ac289eee0af",
)
HOP_DENIED = ("207960", "110530", "132995", "88441", "126748", "126615")


# --- token metadata -----------------------------------------------------------


def first_addresses(metadata: DataFrame) -> DataFrame:
    """One contract address per (chain, symbol): the first in text order."""
    return extreme_with_ties(metadata, ["blockchain", "symbol"], "contract_address", largest=False)


def chain_tokens(metadata: DataFrame, chains: DataFrame) -> DataFrame:
    """Token metadata keyed by chain id instead of chain name."""
    ids = chains.select("chain_id", F.col("name").alias("blockchain"))
    return metadata.join(ids, "blockchain").select(
        "chain_id", "symbol", "contract_address", F.col("decimals").cast("bigint").alias("decimals")
    )


def _with_symbols(df: DataFrame, tokens: DataFrame, how: str = "left") -> DataFrame:
    for side in ("from", "to"):
        df = lookup(
            df, tokens, {f"{side}_token_address": "contract_address"},
            {"symbol": f"{side}_symbol", "decimals": f"{side}_decimals"}, how,
        )
    return df


def _chain_names(df: DataFrame, chains: DataFrame) -> DataFrame:
    return lookup_roles(
        df, chains, "chain_id", "name", {"from_chain_id": "from_chain_name", "to_chain_id": "to_chain_name"}
    )


# --- staging ------------------------------------------------------------------


def stage_across(v3: DataFrame, v2: DataFrame, metadata: DataFrame) -> DataFrame:
    """Both protocol versions in token units; the relay fee is what arrives short."""
    tokens = sized(first_addresses(metadata).select("symbol", "contract_address", "decimals").distinct())

    def version(df: DataFrame, bridge: str, sent: str, received: Column, gas: Column) -> DataFrame:
        df = _with_symbols(df, tokens)
        return df.select(
            F.lit(bridge).alias("bridge"),
            F.col("id").alias("to_hash"),
            F.col("date").cast("timestamp").alias("date"),
            "from_user",
            A.lossy_long("from_chain_id").alias("from_chain_id"),
            "from_chain_name",
            "from_token_address",
            F.col("from_symbol").alias("from_token_symbol"),
            A.scaled(sent, F.col("from_decimals")).alias("from_amount"),
            "to_user",
            A.lossy_long("to_chain_id").alias("to_chain_id"),
            "to_chain_name",
            "to_token_address",
            F.col("to_symbol").alias("to_token_symbol"),
            received.alias("to_amount"),
            gas.alias("gas_token_symbol"),
        )

    direct = A.scaled("to_amount", F.col("to_decimals"))
    after_fees = A.net_of_fees(
        A.scaled("filled_amount", F.col("to_decimals")), "applied_relayer_fee_pct", "realized_lp_fee_pct"
    )
    both = version(v3, "across_v3", "from_amount", direct, F.col("gas_token_symbol")).unionByName(
        version(v2, "across_v2", "filled_amount", after_fees, A.typed_null("string"))
    )
    fee = F.col("from_amount") - F.col("to_amount")
    return (
        both.where((F.col("from_amount") > A.DUST) & (F.col("to_amount") > A.DUST) & (fee > 0))
        .where(F.col("from_token_symbol").isNotNull() & F.col("to_token_symbol").isNotNull())
        .withColumns(
            {
                "id": row_id("bridge", "to_hash", "date", "from_token_symbol", "from_amount", "to_amount"),
                "from_hash": A.typed_null("string"),
                "gas_amount": A.typed_null("double"),
                "relayer_fee_token_symbol": F.col("from_token_symbol"),
                "relay_fee_amount": fee,
                "relay_fee_usd": A.typed_null("double"),
            }
        )
    )


def stage_allbridge(
    raw: DataFrame, tokens: DataFrame, chains: DataFrame, denied: Sequence[str] = ALLBRIDGE_DENIED, stored: bool = False
) -> DataFrame:
    """Chain codes to ids and native tokens; token addresses match in any case. Equal rows count once, of what is returned.

    A token that is listed twice gives copies of a row: its tokens are made distinct. ``stored``: ``raw`` can be read twice.
    """
    rows = raw.where((A.lossy_double("from_amount") > 0) & (A.lossy_double("to_amount") > 0)).where(~F.col("id").isin(*denied))
    tokens = tokens.select(F.lower("token_address").alias("token_address"), "blockchain", "symbol").distinct()
    return without_copies(rows, "id", lambda df: _allbridge_rows(df, tokens, chains), DataFrame.distinct, stored)


def _allbridge_rows(rows: DataFrame, tokens: DataFrame, chains: DataFrame) -> DataFrame:
    for side in ("from", "to"):
        rows = lookup(
            rows, tokens, {f"{side}_token_address": "token_address", f"{side}_chain_symbol": "blockchain"},
            {"symbol": f"{side}_symbol", "blockchain": f"{side}_code"}, ignore_case=[f"{side}_token_address"],
        )
        rows = rows.withColumn(f"{side}_chain_id", mapped(f"{side}_code", CHAIN_CODE_IDS).cast("bigint"))
        rows = rows.withColumn(f"{side}_native", mapped(f"{side}_code", CHAIN_CODE_NATIVE))
    rows = _chain_names(rows, chains)

    def number(c: str) -> Column:
        return A.lossy_double(c).alias(c)

    from_symbol = F.coalesce("from_symbol", "from_token_address")
    to_symbol = F.coalesce("to_symbol", "to_token_address")
    return rows.select(
        "id",
        F.timestamp_millis(A.lossy_long("timestamp")).alias("date"),
        F.col("send_transaction_hash").alias("from_hash"),
        "from_address",
        "from_chain_id",
        F.coalesce("from_chain_name", "from_chain_symbol").alias("from_chain_name"),
        from_symbol.alias("from_token_symbol"),
        number("from_amount"),
        F.col("receive_transaction_hash").alias("to_hash"),
        "to_address",
        "to_chain_id",
        F.coalesce("to_chain_name", "to_chain_symbol").alias("to_chain_name"),
        to_symbol.alias("to_token_symbol"),
        number("to_amount"),
        F.col("from_native").alias("from_gas_native_token"),
        A.lossy_double("from_gas").alias("from_gas_amount"),
        F.col("to_native").alias("to_gas_native_token"),
        A.lossy_double("to_gas").alias("to_gas_amount"),
        F.col("from_native").alias("from_relayer_fee_native_symbol"),
        A.lossy_double("relayer_fee_in_native").alias("from_relayer_fee_in_native"),
        F.coalesce(from_symbol, to_symbol).alias("relayer_fee_token_symbol"),
        number("relayer_fee_in_tokens"),
    )


def stage_debridge(raw: DataFrame, metadata: DataFrame, chains: DataFrame, stored: bool = False) -> DataFrame:
    """The pre-swap leg, where there is one, is what the user sent. ``stored``: ``raw`` can be read twice."""
    tokens = sized(chain_tokens(first_addresses(metadata), chains).select("chain_id", "symbol", "decimals").distinct())
    done = raw.where("state = 'ClaimedUnlock'")
    semi = without_copies(done, "orderid_stringvalue", _debridge_orders, DataFrame.distinct, stored)
    rows = lookup(
        semi, chains, {"give_chain_id": "chain_id"},
        {"name": "from_chain_name", "fee_token_symbol": "gas_token_symbol", "fee_token_decimal": "gas_decimals"},
    )
    rows = lookup(rows, chains, {"to_chain_id": "chain_id"}, {"name": "to_chain_name"})
    rows = lookup(
        rows, tokens, {"swap_symbol": "symbol", "give_chain_id": "chain_id"}, {"decimals": "swap_decimals"}
    )
    given = A.scaled("give_value", F.col("give_decimals"))
    return rows.select(
        "id",
        "date",
        A.typed_null("string").alias("from_tx_hash"),
        F.coalesce("swap_chain_id", "give_chain_id").alias("from_chain_id"),
        "from_chain_name",
        A.typed_null("string").alias("from_address"),
        "from_token_address",
        F.coalesce("swap_symbol", "interim_symbol").alias("from_token_symbol"),
        F.coalesce(A.scaled("swap_value", F.col("swap_decimals")), given).alias("from_amount"),
        "interim_symbol",
        given.alias("interim_amount"),
        A.typed_null("string").alias("to_tx_hash"),
        "to_chain_id",
        "to_chain_name",
        "to_address",
        A.typed_null("string").alias("to_token_address"),
        "to_token_symbol",
        A.scaled("to_value", F.col("to_decimals")).alias("to_amount"),
        "gas_token_symbol",
        A.scaled("gas_value", F.col("gas_decimals")).alias("gas_amount"),
        F.col("interim_symbol").alias("relayer_fee_token_symbol"),
        A.scaled("fee_value", F.col("give_decimals")).alias("relay_fee_amount"),
    ).where("from_amount > 0 AND to_amount > 0 AND relay_fee_amount > 0")


def _debridge_orders(raw: DataFrame) -> DataFrame:
    give, take, swap = "giveofferwithmetadata_", "takeofferwithmetadata_", "preswapdata_"
    return raw.select(
        F.col("orderid_stringvalue").alias("id"),
        F.timestamp_seconds(A.lossy_long("creationtimestamp")).alias("date"),
        F.col("unlockauthoritydst_stringvalue").alias("to_address"),
        F.col(swap + "tokeninmetadata_symbol").alias("swap_symbol"),
        F.col(give + "metadata_symbol").alias("interim_symbol"),
        F.col(give + "tokenaddress_stringvalue").alias("from_token_address"),
        F.col(take + "metadata_symbol").alias("to_token_symbol"),
        A.lossy_long(swap + "chainid_bigintegervalue").alias("swap_chain_id"),
        A.lossy_double(swap + "inamount_bigintegervalue").alias("swap_value"),
        A.lossy_long(give + "chainid_bigintegervalue").alias("give_chain_id"),
        A.lossy_long(give + "metadata_decimals").alias("give_decimals"),
        A.lossy_long(take + "chainid_bigintegervalue").alias("to_chain_id"),
        A.lossy_long(take + "decimals").alias("to_decimals"),
        A.lossy_double(give + "finalamount_bigintegervalue").alias("give_value"),
        A.lossy_double(take + "amount_bigintegervalue").alias("to_value"),
        A.lossy_double("fixfee_bigintegervalue").alias("gas_value"),
        A.lossy_double("finalpercentfee_bigintegervalue").alias("fee_value"),
    )


def stage_hop(raw: DataFrame, chains: DataFrame, denied: Sequence[str] = HOP_DENIED, stored: bool = False) -> DataFrame:
    """Display texts to numbers; what arrives is the amount less the bonder fee. ``stored``: ``raw`` can be read twice."""
    kept = raw.where(~F.col("id").isin(*denied))
    names = chains.select("chain_id", "name").distinct()
    rows = without_copies(kept, "transferid", lambda df: _hop_rows(df, names), DataFrame.distinct, stored)
    return rows.where("from_amount > 0 AND to_amount > 0 AND to_amount_usd > 0 AND from_amount_usd > 0")


def _hop_rows(named: DataFrame, chains: DataFrame) -> DataFrame:
    named = lookup(named, chains, {"sourcechainid": "chain_id"}, {"name": "from_name"})
    named = lookup(named, chains, {"destinationchainid": "chain_id"}, {"name": "to_name"})
    sent, fee = A.lossy_double("amountdisplay"), A.lossy_double("bonderfeedisplay")
    sent_usd, fee_usd = A.money_text("amountusddisplay"), A.money_text("bonderfeeusddisplay")
    bonded = F.nullif(A.lossy_long("bondtimestamp"), F.lit(0))
    return (
        named.select(
            F.col("transferid").alias("id"),
            F.timestamp_seconds(A.lossy_long("timestamp")).alias("from_timestamp"),
            F.timestamp_seconds(bonded).alias("to_timestamp"),
            F.col("accountaddress").alias("from_address"),
            F.col("recipientaddress").alias("to_address"),
            F.col("transactionhash").alias("from_hash"),
            F.col("sourcechainid").alias("from_chain_id"),
            F.coalesce("from_name", "sourcechainslug").alias("from_chain_name"),
            F.col("token").alias("from_token_symbol"),
            sent.alias("from_amount"),
            sent_usd.alias("from_amount_usd"),
            F.col("bondtransactionhash").alias("to_hash"),
            F.col("destinationchainid").alias("to_chain_id"),
            F.coalesce("to_name", "destinationchainslug").alias("to_chain_name"),
            F.col("token").alias("to_token_symbol"),
            (sent - fee).alias("to_amount"),
            (sent_usd - fee_usd).alias("to_amount_usd"),
            A.typed_null("string").alias("gas_token_symbol"),
            A.typed_null("double").alias("gas_amount"),
            F.col("token").alias("relayer_fee_symbol"),
            fee.alias("relayer_fee"),
            fee_usd.alias("relayer_fee_in_usd"),
        )
    )


def stage_stargate(raw: DataFrame, metadata: DataFrame, chains: DataFrame, default_decimals: int = 18) -> DataFrame:
    """Same token on both sides; a token without metadata has ``default_decimals``."""
    tokens = sized(chain_tokens(metadata, chains).select("chain_id", "symbol", "decimals").distinct())
    rows = raw.withColumns(
        {f"{side}_chain_id": mapped(f"{side}_chain_name", CHAIN_NAME_IDS).cast("bigint") for side in ("from", "to")}
    )
    rows = lookup(
        rows, tokens, {"from_token_symbol": "symbol", "from_chain_id": "chain_id"}, {"decimals": "from_token_decimals"}
    )
    sent, got = A.lossy_double("from_amount"), A.lossy_double("to_amount")
    unit = F.pow(F.lit(10.0), F.coalesce("from_token_decimals", F.lit(default_decimals)))
    return rows.where((sent > 0) & (got > 0) & (sent - got > 0)).select(
        F.lit("stargate_v2").alias("bridge"),
        row_id("from_hash", "from_date", "from_user", "from_token_symbol", "from_amount", "to_chain_name").alias("id"),
        "from_hash",
        A.typed_null("string").alias("to_hash"),
        F.col("from_date").cast("timestamp").alias("from_date"),
        A.typed_null("timestamp").alias("to_date"),
        "from_chain_id",
        "from_chain_name",
        A.typed_null("string").alias("from_token_address"),
        F.col("from_user").alias("from_address"),
        "from_token_symbol",
        "from_token_decimals",
        (sent / unit).alias("from_amount"),
        "to_chain_id",
        "to_chain_name",
        A.typed_null("string").alias("to_token_address"),
        A.typed_null("string").alias("to_address"),
        F.col("from_token_symbol").alias("to_token_symbol"),
        (got / unit).alias("to_amount"),
        A.typed_null("string").alias("gas_token_symbol"),
        A.typed_null("double").alias("gas_amount"),
        A.typed_null("string").alias("relay_symbol"),
        ((sent - got) / unit).alias("relay_amount"),
    )


def stage_symbiosis(raw: DataFrame, chains: DataFrame) -> DataFrame:
    """First hop of the source route and last hop of the target route."""
    kept = raw.where("state = 0 AND type = 0 AND event_type IN (1, 3)").withColumns(
        {"__from": J.route_hops("from_route"), "__to": J.route_hops("to_route")}
    )
    kept = _chain_names(kept.where(F.size("__to") > 0), chains)
    ends = {"from": J.first_item(F.col("__from")), "to": J.last_item(F.col("__to"))}

    def end(side: str) -> list[Column]:
        hop = ends[side]
        return [
            hop["chain_id"].alias(f"{side}_chain_id"),
            *[hop["token"][k].alias(f"{side}_token_{k}") for k in ("symbol", "name", "address")],
            A.scaled(hop["amount"], hop["token"]["decimals"].cast("bigint")).alias(f"{side}_amount"),
        ]

    return (
        kept.select(
            F.col("id").cast("string").alias("id"),
            F.col("created_at").cast("timestamp").alias("from_timestamp"),
            "from_address",
            F.col("from_tx_hash").alias("from_hash"),
            "from_chain_name",
            "from_amount_usd",
            *end("from"),
            "to_address",
            F.col("to_tx_hash").alias("to_hash"),
            F.col("success_at").cast("timestamp").alias("to_timestamp"),
            "to_chain_name",
            "to_amount_usd",
            *end("to"),
        )
        .distinct()
        .where("from_amount > 0 AND to_amount > 0")
        .withColumns(
            {
                "gas_token_symbol": A.typed_null("string"),
                "gas_amount": A.typed_null("double"),
                "gas_amount_usd": A.typed_null("double"),
                "relay_symbol": F.col("from_token_symbol"),
                "relay_amount": A.typed_null("double"),
            }
        )
    )


def stage_synapse(raw: DataFrame, metadata: DataFrame, chains: DataFrame, stored: bool = False) -> DataFrame:
    """Latest row per transfer; both tokens must be known. ``stored``: ``raw`` can be read twice."""
    moved = (A.lossy_double("from_formatted_value") > 0) | (A.lossy_double("to_formatted_value") > 0)
    order = [F.col("from_time").desc(), F.col("to_time").desc(), F.col("from_hash"), F.col("to_hash"), F.col("to_value")]
    latest = without_copies(raw.where(moved), "kappa", lambda df: df, lambda df: latest_per_key(df, ["kappa"], *order), stored)
    tokens = sized(chain_tokens(first_addresses(metadata), chains).distinct())
    for side in ("from", "to"):
        latest = lookup(
            latest, tokens, {f"{side}_token_address": "contract_address", f"{side}_chain_id": "chain_id"},
            {"symbol": f"{side}_meta", "decimals": f"{side}_decimals"}, "inner", ignore_case=[f"{side}_token_address"],
        )
    latest = lookup(
        latest, chains, {"from_chain_id": "chain_id"},
        {"name": "from_chain_name", "fee_token_symbol": "chain_fee_symbol"},
    )
    latest = lookup(latest, chains, {"to_chain_id": "chain_id"}, {"name": "to_chain_name"})

    def side_columns(side: str) -> list[Column]:
        return [
            F.timestamp_seconds(A.lossy_long(f"{side}_time")).alias(f"{side}_timestamp"),
            F.col(f"{side}_hash"),
            F.col(f"{side}_chain_id"),
            F.col(f"{side}_chain_name"),
            F.col(f"{side}_address"),
            F.col(f"{side}_token_address"),
            F.coalesce(f"{side}_meta", f"{side}_token_symbol").alias(f"{side}_token_symbol"),
            A.lossy_double(f"{side}_formatted_value").alias(f"{side}_amount"),
            A.scaled(f"{side}_value", F.col(f"{side}_decimals")).alias(f"cal_{side}_amount"),
        ]

    return latest.select(
        F.col("kappa").alias("id"),
        *side_columns("from"),
        *side_columns("to"),
        F.coalesce("to_decimals", F.lit(18)).alias("to_token_decimals"),
        F.col("chain_fee_symbol").alias("fee_token_symbol"),
        A.typed_null("double").alias("gas_amount"),
        A.typed_null("double").alias("gas_amount_usd"),
        F.coalesce("from_meta", "from_token_symbol").alias("relayer_fee_symbol"),
        A.typed_null("double").alias("relay_amount"),
    ).where("from_amount > 0 AND to_amount > 0")


# --- USD pricing ----------------------------------------------------------------


def priced(df: DataFrame, aliases: DataFrame, prices: DataFrame, roles: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Hourly price per role: role -> (symbol column, time column), as ``<role>_price``."""
    symbols = {symbol: f"__ps_{symbol}" for symbol, _ in roles.values()}
    df = lookup_roles(df, aliases, "token_symbol", "price_symbol", symbols)
    by_name = {f"{role}_price": (symbols[symbol], ts) for role, (symbol, ts) in roles.items()}
    return price_roles(df, prices, by_name).drop(*symbols.values())


def canonical_cells(df: DataFrame, **columns: Column | str | None) -> list[Column]:
    out = []
    for c in CANONICAL_COLUMNS:
        value = columns.get(c, c if c in df.columns else None)
        value = F.lit(None) if value is None else A.col(value)
        out.append(value.cast(CANONICAL_TYPES[c]).alias(c))
    return out


def canonical(df: DataFrame, **columns: Column | str | None) -> DataFrame:
    """The canonical row; a column not given is a typed null of its name if absent."""
    return df.select(*canonical_cells(df, **columns))


@dataclass(frozen=True)
class Legs:
    """How one bridge's staged rows are valued.

    ``columns``: canonical column -> staged column, or null; others keep their name. ``legs``: role -> (token, time, amount), each
    worth its amount at the token's price of the hour. ``reported`` USD columns come before legs. ``spread``: the relay fee is what is
    sent less what arrives, in USD. ``parts``: gas and relay fee have a second leg (``gas_2``, ``relay_2``), and missing ones are 0.
    """

    columns: Mapping[str, Column | str | None]
    legs: Mapping[str, tuple[str, str, str]]
    kept: Column
    reported: Mapping[str, str] = field(default_factory=dict)
    spread: bool = False
    parts: bool = False
    zeros: tuple[str, ...] = ()


USD = ("from_amount_usd", "to_amount_usd", "relay_amount_usd", "gas_amount_usd")
ROLES = ("from", "interim", "to", "relay", "relay_2", "gas", "gas_2")


def usd_kept(at_least: float = 0.1, relay: bool = True) -> Column:
    kept = (F.col("from_amount_usd") > at_least) & (F.col("to_amount_usd") > at_least)
    return kept & (F.col("relay_amount_usd") > 0) if relay else kept


def usd_filter(df: DataFrame, at_least: float = 0.1, relay: bool = True) -> DataFrame:
    return df.where(usd_kept(at_least, relay))


def bridge_legs(max_loss: float = 0.8) -> dict[str, Legs]:
    """The legs of every bridge; symbiosis routes that lose ``max_loss`` or more go."""
    hashes = {"from_tx_hash": "from_hash", "to_tx_hash": "to_hash"}
    addresses = {"from_user_address": "from_address", "to_user_address": "to_address"}
    times = {"from_date": "from_timestamp", "to_date": "to_timestamp"}
    sent, gone = ("from_token_symbol", "date"), {"from_date": "date", "to_date": None}
    got = ("to_token_symbol", "date")
    return {
        "across": Legs(
            {**hashes, "from_date": None, "to_date": "date", "from_user_address": "from_user", "to_user_address": "to_user",
             "relay_symbol": "relayer_fee_token_symbol", "relay_amount": "relay_fee_amount", "gas_symbol": "gas_token_symbol"},
            {"from": (*sent, "from_amount"), "to": (*got, "to_amount"), "relay": (*sent, "relay_fee_amount"),
             "gas": ("gas_token_symbol", "date", "gas_amount")},
            usd_kept(),
        ),
        "allbridge": Legs(
            {**hashes, **addresses, **gone, "bridge": F.lit("all_bridges"), "gas_amount": None,
             "gas_symbol": F.coalesce("from_gas_native_token", "to_gas_native_token"),
             "relay_symbol": F.coalesce("from_relayer_fee_native_symbol", "relayer_fee_token_symbol"),
             "relay_amount": F.coalesce("from_relayer_fee_in_native", F.lit(0.0)) + F.coalesce("relayer_fee_in_tokens", F.lit(0.0))},
            {"from": (*sent, "from_amount"), "to": (*got, "to_amount"),
             "gas": ("from_gas_native_token", "date", "from_gas_amount"), "gas_2": ("to_gas_native_token", "date", "to_gas_amount"),
             "relay": ("from_gas_native_token", "date", "from_relayer_fee_in_native"),
             "relay_2": ("relayer_fee_token_symbol", "date", "relayer_fee_in_tokens")},
            usd_kept(),
            parts=True,
        ),
        "debridge": Legs(
            {**addresses, **gone, "bridge": F.lit("debridge"), "gas_symbol": "gas_token_symbol",
             "relay_symbol": "relayer_fee_token_symbol", "relay_amount": "relay_fee_amount"},
            {"from": (*sent, "from_amount"), "interim": ("interim_symbol", "date", "interim_amount"), "to": (*got, "to_amount"),
             "gas": ("gas_token_symbol", "date", "gas_amount"), "relay": ("interim_symbol", "date", "relay_fee_amount")},
            usd_kept(),
        ),
        "hop": Legs(
            {**hashes, **addresses, **times, "bridge": F.lit("hop"), "relay_symbol": "relayer_fee_symbol", "relay_amount": "relayer_fee",
             "gas_symbol": None, "gas_amount": None},
            {},
            usd_kept(at_least=0),
            {"from_amount_usd": "from_amount_usd", "to_amount_usd": "to_amount_usd", "relay_amount_usd": "relayer_fee_in_usd"},
        ),
        "stargate": Legs(
            {**hashes, **addresses, "relay_amount": F.col("from_amount") - F.col("to_amount"), "gas_symbol": "gas_token_symbol"},
            {"from": ("from_token_symbol", "from_date", "from_amount"), "to": ("from_token_symbol", "from_date", "to_amount")},
            usd_kept(relay=False),
            spread=True,
        ),
        "symbiosis": Legs(
            {**hashes, **addresses, **times, "bridge": F.lit("symbiosis"), "gas_symbol": "gas_token_symbol"},
            {"from": ("from_token_symbol", "from_timestamp", "from_amount"), "to": ("to_token_symbol", "to_timestamp", "to_amount")},
            A.ratio("relay_amount_usd", "from_amount_usd") < max_loss,
            {"from_amount_usd": "from_amount_usd", "to_amount_usd": "to_amount_usd"},
            spread=True,
            zeros=("from_amount", "to_amount"),
        ),
        "synapse": Legs(
            {**hashes, **addresses, **times, "bridge": F.lit("synapse"), "gas_symbol": "fee_token_symbol",
             "relay_symbol": "relayer_fee_symbol"},
            {"from": ("from_token_symbol", "from_timestamp", "cal_from_amount"), "to": ("to_token_symbol", "to_timestamp", "cal_to_amount")},
            usd_kept(),
            spread=True,
        ),
    }


def price_books(aliases: DataFrame, prices: DataFrame) -> DataFrame:
    """Hourly prices by the token's own symbol: one row for each ``hour`` with its ``book`` (token -> price). The highest of several prices."""
    known = aliases.where(F.col("token_symbol").isNotNull()).groupBy("token_symbol").agg(F.min("price_symbol").alias("symbol"))
    once = prices.join(known, "symbol").groupBy(F.col("date").alias("hour"), "token_symbol").agg(F.max("price").alias("price"))
    return once.groupBy("hour").agg(F.map_from_entries(F.collect_list(F.struct("token_symbol", "price"))).alias("book"))


def _valued(label: str, staged: DataFrame, own: Legs, books: DataFrame) -> DataFrame:
    """Canonical rows without own USD values, and the value of each leg."""
    rows = staged.fillna(0.0, subset=list(own.zeros)) if own.zeros else staged
    extra = {
        "label": F.lit(label),
        "interim_symbol": F.col("interim_symbol") if "interim" in own.legs else A.typed_null("string"),
        "interim_amount": F.col("interim_amount") if "interim" in own.legs else A.typed_null("double"),
    }
    given = {**dict.fromkeys(USD), **own.columns, **own.reported}
    hours = {time: f"__hour_{time}" for _, time, _ in own.legs.values()}
    legs = {role: F.struct(F.col(token).alias("token"), F.col(amount).cast("double").alias("amount")) for role, (token, _, amount) in own.legs.items()}
    rows = rows.select(
        *canonical_cells(rows, **given), *[v.alias(c) for c, v in extra.items()],
        *[F.date_trunc("hour", time).alias(name) for time, name in hours.items()], *[leg.alias(f"__leg_{role}") for role, leg in legs.items()],
    )
    for time, name in hours.items():
        roles = [role for role, leg in own.legs.items() if leg[1] == time]
        rows = rows.join(books.withColumnRenamed("hour", name), name, "left")
        worth = {f"v_{role}": F.col(f"__leg_{role}.amount") * F.try_element_at("book", F.col(f"__leg_{role}.token")) for role in roles}
        rows = rows.withColumns(worth).drop("book", name, *[f"__leg_{role}" for role in roles])
    return rows.withColumns({f"v_{role}": A.typed_null("double") for role in ROLES if role not in own.legs})


def clean_all(staged: Mapping[str, DataFrame], aliases: DataFrame, prices: DataFrame, max_loss: float = 0.8) -> DataFrame:
    """Canonical rows of several bridges (``label``, then the canonical columns), priced by one equi join for each time a bridge has.

    All legs of one hour are valued from the hour's book of prices, so rows are not copied and not folded back. Books are stored first:
    small ones are broadcast and the rows stay where they are; with large ones a row is shuffled once for each of its times.
    """
    own = {label: bridge_legs(max_loss)[label] for label in staged}
    books = sized(price_books(aliases, prices))
    folded = reduce(lambda a, b: a.unionByName(b), [_valued(label, df, own[label], books) for label, df in staged.items()])

    def listed(flag: str) -> Column:
        return F.col("label").isin([label for label in own if getattr(own[label], flag)])

    def fee(name: str) -> Column:
        both = F.coalesce(f"v_{name}", F.lit(0.0)) + F.coalesce(f"v_{name}_2", F.lit(0.0))
        return F.when(listed("parts"), both).otherwise(F.col(f"v_{name}"))

    sent = F.coalesce(F.nullif("from_amount_usd", F.lit(0.0)), "v_from", "v_interim")
    got = F.coalesce(F.nullif("to_amount_usd", F.lit(0.0)), "v_to")
    replaced = F.col("interim_symbol").isNotNull() & F.col("v_from").isNull()
    priced = folded.withColumns(
        {
            "from_amount_usd": sent,
            "to_amount_usd": got,
            "relay_amount_usd": F.when(listed("spread"), sent - got).otherwise(F.coalesce("relay_amount_usd", fee("relay"))),
            "gas_amount_usd": fee("gas"),
            "from_token_symbol": F.when(replaced, F.col("interim_symbol")).otherwise(F.col("from_token_symbol")),
            "from_amount": F.when(replaced, F.col("interim_amount")).otherwise(F.col("from_amount")),
        }
    )
    kept = F.coalesce(*[F.when(F.col("label") == label, of.kept) for label, of in own.items()])
    return priced.where(kept).select("label", *CANONICAL_COLUMNS)


def clean_bridge(label: str, staged: DataFrame, aliases: DataFrame, prices: DataFrame, max_loss: float = 0.8) -> DataFrame:
    """Canonical rows of one bridge."""
    return clean_all({label: staged}, aliases, prices, max_loss).drop("label")


def clean_across(staged: DataFrame, aliases: DataFrame, prices: DataFrame) -> DataFrame:
    return clean_bridge("across", staged, aliases, prices)


def clean_allbridge(staged: DataFrame, aliases: DataFrame, prices: DataFrame) -> DataFrame:
    return clean_bridge("allbridge", staged, aliases, prices)


def clean_debridge(staged: DataFrame, aliases: DataFrame, prices: DataFrame) -> DataFrame:
    return clean_bridge("debridge", staged, aliases, prices)


def clean_hop(staged: DataFrame) -> DataFrame:
    """Comes priced, so there is nothing to join."""
    own = bridge_legs()["hop"]
    return canonical(staged, **{**dict.fromkeys(USD), **own.columns, **own.reported}).where(own.kept)


def clean_stargate(staged: DataFrame, aliases: DataFrame, prices: DataFrame) -> DataFrame:
    return clean_bridge("stargate", staged, aliases, prices)


def clean_symbiosis(staged: DataFrame, aliases: DataFrame, prices: DataFrame, max_loss: float = 0.8) -> DataFrame:
    return clean_bridge("symbiosis", staged, aliases, prices, max_loss)


def clean_synapse(staged: DataFrame, aliases: DataFrame, prices: DataFrame) -> DataFrame:
    return clean_bridge("synapse", staged, aliases, prices)


# --- mart -----------------------------------------------------------------------


BUSINESS = ("bridge", "id", "from_date", "from_tx_hash", "to_date", "to_tx_hash", "from_amount", "to_amount")


def all_transfers(cleaned: Mapping[str, DataFrame], exact_numbers: bool = False) -> DataFrame:
    """Union of cleaned bridges (label -> rows) with ids ``<label>_<...>``.

    Ids are hashes of the row's own values by default. ``exact_numbers`` gives
    ``<label>_1, _2, ...`` from the newest transfer, at the price of one shuffle.
    """
    parts = []
    for label, df in cleaned.items():
        if exact_numbers:
            keyed = df.withColumn("__h", row_id(*CANONICAL_COLUMNS))
            keyed = numbered(keyed, "from_date", "__h", name="__n")
            ident = F.concat(F.lit(label + "_"), F.col("__n").cast("string"))
            parts.append(keyed.withColumn("id", ident).select(*CANONICAL_COLUMNS))
        else:
            parts.append(df.withColumn("id", row_id(*BUSINESS, prefix=label)).select(*CANONICAL_COLUMNS))
    return reduce(lambda a, b: a.unionByName(b), parts)


def transfers_mart(staged: Mapping[str, DataFrame], aliases: DataFrame, prices: DataFrame) -> DataFrame:
    """``all_transfers`` of staged bridges (label -> rows), priced together; the ids are the same."""
    ident = F.concat(F.col("label"), F.lit("_"), row_id(*BUSINESS))
    return clean_all(staged, aliases, prices).withColumn("id", ident).select(*CANONICAL_COLUMNS)


# modelling name -> canonical column
MODELLING_NAMES = {
    "bridge": "bridge",
    "id": "id",
    "timestamp_in": "from_date",
    "timestamp_out": "to_date",
    "amount_in": "from_amount",
    "amount_out": "to_amount",
    "gas_fee_symbol": "gas_symbol",
    "gas_fee": "gas_amount",
    "gas_price_usd": "gas_amount_usd",
    "relay_fee_symbol": "relay_symbol",
    "relay_fee": "relay_amount",
    "relay_fee_price_usd": "relay_amount_usd",
    "token_in": "from_token_address",
    "symbol_in": "from_token_symbol",
    "token_out": "to_token_address",
    "symbol_out": "to_token_symbol",
    "price_in_usd": "from_amount_usd",
    "price_out_usd": "to_amount_usd",
    "txn_hash_in": "from_tx_hash",
    "txn_hash_out": "to_tx_hash",
    "token_address_in": "from_token_address",
    "token_address_out": "to_token_address",
    "chain_in": "from_chain_id",
    "chain_name_in": "from_chain_name",
    "chain_out": "to_chain_id",
    "chain_name_out": "to_chain_name",
    "user_address_in": "from_user_address",
    "user_address_out": "to_user_address",
}


def modelling_format(transfers: DataFrame) -> DataFrame:
    return transfers.select(*[F.col(c).alias(name) for name, c in MODELLING_NAMES.items()])


# --- canonical and native rollup bridges ------------------------------------------


def canonical_bridge_flows_hourly(tokens: DataFrame, native: DataFrame) -> DataFrame:
    """The bridge on the sending (``fs_bridge``) or receiving side gives the chain; none means Ethereum."""
    both = tokens.select("date", "fs_bridge", "ts_bridge", "symbol", "usd_token_value").unionByName(
        native.select("date", "fs_bridge", "ts_bridge", "symbol", "usd_token_value")
    )

    def chain(c: str) -> Column:
        return F.when(F.col(c).isNull(), "Ethereum").otherwise(mapped(c, BRIDGE_CHAINS))

    bridge = F.coalesce("fs_bridge", "ts_bridge")
    return both.groupBy(
        "date",
        mapped(bridge, BRIDGE_SPELLINGS, bridge).alias("bridge"),
        chain("fs_bridge").alias("src_chain"),
        chain("ts_bridge").alias("dst_chain"),
        F.col("symbol").alias("token_symbol"),
    ).agg(F.sum("usd_token_value").alias("value_usd"))


def native_bridge_direction(df: DataFrame) -> DataFrame:
    far = F.replace(F.col("bridge"), F.lit(" Bridge"), F.lit(""))
    return df.withColumns(
        {
            "source_chain_name": F.when(F.col("tx_type") == "withdrawal", "Ethereum").otherwise(far),
            "destination_chain_name": F.when(F.col("tx_type") == "deposit", "Ethereum").otherwise(far),
        }
    )


# --- volumes ----------------------------------------------------------------------

VOLUME_KEYS = ("bridge", "date", "currency_symbol", "source_chain_name", "destination_chain_name")


def bridge_volume(
    transfers: DataFrame, bridge: str, freq: str = "day", prices: DataFrame | None = None, price_unit: str = "hour",
    large: float = 10_000,
) -> DataFrame:
    """Volume per (period, token, route) with the ``large``+ slice.

    ``transfers``: transfer_id, date, currency_symbol, source_chain_name,
    destination_chain_name and value_usd, or amount and price_symbol with ``prices``.
    """
    if prices is not None:
        transfers = price_roles(transfers, prices, {"price": ("price_symbol", "date")}, unit=price_unit)
        transfers = transfers.withColumn("value_usd", F.col("amount") * F.col("price"))
    big = F.col("value_usd") >= large
    return (
        transfers.where(F.col("value_usd").isNotNull())
        .groupBy(
            F.lit(bridge).alias("bridge"),
            F.date_trunc(freq, "date").alias("date"),
            "currency_symbol",
            "source_chain_name",
            "destination_chain_name",
        )
        .agg(
            F.count_if(big).alias("tx_count_10k_txs"),
            F.sum(F.when(big, F.col("value_usd"))).alias("volume_10k_txs"),
            F.avg(F.when(big, F.col("value_usd"))).alias("avg_volume_10k_txs"),
            F.avg("value_usd").alias("avg_volume"),
            F.count("transfer_id").alias("total_txs"),
            F.sum("value_usd").alias("total_volume"),
        )
        .where("total_volume > 0")
    )


def all_bridge_volume(*volumes: DataFrame) -> DataFrame:
    """Volumes of several bridges with one spelling per chain."""
    both = reduce(lambda a, b: a.unionByName(b), volumes)
    return both.withColumns({c: harmonised_chain(c) for c in ("source_chain_name", "destination_chain_name")})


def bridge_rank_monthly(volume: DataFrame, since: str | None = None) -> DataFrame:
    rows = volume.where(F.col("destination_chain_name").isNotNull())
    if since:
        rows = rows.where(F.col("date") >= F.lit(since).cast("timestamp"))
    return rows.groupBy(
        F.col("currency_symbol").alias("asset"),
        F.col("source_chain_name").alias("origin_chain"),
        F.col("destination_chain_name").alias("destination_chain"),
    ).agg(
        F.sum("total_volume").alias("volume"),
        F.avg("avg_volume").alias("avg_tx_size"),
        F.sum("total_txs").alias("no_of_txs"),
        F.sum("volume_10k_txs").alias("volume_of_10k_txs"),
        (F.sum("volume_10k_txs") * 100.0 / F.nullif(F.sum("total_volume"), F.lit(0.0))).alias("share_of_10k_transfers"),
    )


def price_vs_volume(volume: DataFrame, ranking: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Quoted loss in bps beside the route's recent volume; routes on both sides only."""
    recent = volume.where(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp"))
    recent = recent.groupBy(
        F.lower("source_chain_name").alias("__s"), F.lower("destination_chain_name").alias("__d"),
        F.lower("currency_symbol").alias("__t"),
        F.col("source_chain_name").alias("v_from"), F.col("destination_chain_name").alias("v_to"),
        F.col("currency_symbol").alias("v_token"),
    ).agg(F.sum("total_volume").alias("volume"))
    quoted = ranking.where(F.col("bridge").isNotNull()).withColumns(
        {"__s": F.lower("from_chain"), "__d": F.lower("to_chain"), "__t": F.lower("token")}
    )
    return recent.where(F.col("volume").isNotNull()).join(quoted, ["__s", "__d", "__t"]).select(
        F.col("v_from").alias("from_chain"),
        F.col("v_to").alias("to_chain"),
        F.col("v_token").alias("token"),
        "input_amount",
        "volume",
        ((1 - F.col("price") / F.col("input_amount")) * 10_000.0).alias("bps"),
        "bridge",
        "price",
        F.col("best_bridge_rank"),
    )

