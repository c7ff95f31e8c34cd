"""Code-to-name mapping, asset grouping and name harmonisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import col

# fixed values: symbols priced as another symbol
PRICE_SYNONYMS = {
    "alUSD": "USDT",
    "instETH": "WETH",
    "ezETH": "WETH",
    "alETH": "WETH",
}

# fixed values: chain code used by one explorer -> EVM chain id (null: not EVM)
CHAIN_CODE_IDS = {"ETH": 1, "POL": 137, "ARB": 42161, "AVA": 43114, "OPT": 10, "BAS": 8453, "BSC": 56}

# fixed values: chain code used by one explorer -> native token
CHAIN_CODE_NATIVE = {
    "ETH": "ETH",
    "POL": "MATIC",
    "ARB": "ETH",
    "AVA": "AVAX",
    "OPT": "ETH",
    "BAS": "ETH",
    "SOL": "SOL",
    "SRB": "SRB",
    "BSC": "BNB",
    "CEL": "CEL",
    "TRX": "TRX",
}

# fixed values: chain name used by one bridge -> EVM chain id
CHAIN_NAME_IDS = {
    "mantle": 5000,
    "bnb": 56,
    "base": 8453,
    "linea": 59144,
    "scroll": 534352,
    "polygon": 137,
    "arbitrum": 42161,
    "ethereum": 1,
    "optimism": 10,
    "avalanche": 43114,
}

# fixed values: EVM chain id -> display name
CHAIN_ID_NAMES = {
    1: "Ethereum",
    10: "Optimism",
    25: "Cronos",
    56: "BNB Chain",
    100: "Gnosis",
    137: "Polygon",
    250: "Fantom",
    288: "Boba",
    324: "zkSync",
    1088: "Metis",
    1101: "Polygon zkEVM",
    1284: "Moonbeam",
    1285: "Moonriver",
    2000: "DogeChain",
    7700: "Canto",
    8217: "Klaytn",
    8453: "Base",
    34443: "Mode",
    42161: "Arbitrum",
    43114: "Avalanche",
    53935: "DFK Chain",
    59144: "Linea",
    81457: "Base",
    1313161554: "Aurora",
    1666600000: "Harmony",
}

# fixed values: spelling variants of a chain name -> one display name
CHAIN_SPELLINGS = {
    "arbitrum": "Arbitrum",
    "Arbitrum One": "Arbitrum",
    "base": "Base",
    "Binance Smart Chain Mainnet": "BNB Chain",
    "ethereum": "Ethereum",
    "linea": "Linea",
    "Optimisum": "Optimism",
    "optimism": "Optimism",
    "Optimism Main": "Optimism",
    "Optimistic Ethereum": "Optimism",
    "polygon": "Polygon",
    "Matic Mainnet": "Polygon",
    "zkEVM": "Polygon zkEVM",
    "zkSync Era": "zkSync",
    "zkSync Lite": "zkSync",
    "zksync": "zkSync",
    "Metis Andromeda": "Metis",
    "Metis Andromeda Mainnet": "Metis",
    "mode": "Mode",
    "blast": "Blast",
    "lisk": "Lisk",
}

# fixed values: rollup bridge label -> chain on its far side
BRIDGE_CHAINS = {
    "Base Bridge": "Base",
    "Metis Bridge": "Metis",
    "metis Bridge": "Metis",
    "mode Bridge": "Mode",
    "Linea Bridge": "Linea",
    "zkEVM Bridge": "Polygon zkEVM",
    "Polygon zkEVM Bridge": "Polygon zkEVM",
    "Mantle Bridge": "Mantle",
    "zkSync Bridge": "zkSync Era",
    "zkSync Era Bridge": "zkSync Era",
    "zkSync Lite Bridge": "zkSync Lite",
    "Polygon Bridge": "Polygon",
    "Arbitrum Bridge": "Arbitrum",
    "StarkNet Bridge": "StarkNet",
    "Optimisum Bridge": "Optimisum",
    "Optimism Main Bridge": "Optimisum",
}

# fixed values: rollup bridge label -> reported label
BRIDGE_SPELLINGS = {
    "Optimism Main Bridge": "Optimisum Bridge",
    "mode Bridge": "Mode Bridge",
    "metis Bridge": "Metis Bridge",
    "zkEVM Bridge": "Polygon zkEVM Bridge",
    "zkSync Bridge": "zkSync Era Bridge",
}


def mapped(c, mapping: Mapping, default: Column | None = None) -> Column:
    """Literal map lookup: no join and no shuffle for tables that fit in code."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return found if default is None else F.coalesce(found, default)


def chain_display_name(chain_id) -> Column:
    """Chain id to display name; an unknown id is kept as text."""
    chain_id = col(chain_id).cast("bigint")
    pairs = [c for k, v in CHAIN_ID_NAMES.items() for c in (F.lit(k).cast("bigint"), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), chain_id), chain_id.cast("string"))


def harmonised_chain(name) -> Column:
    """One spelling per chain; otherwise a trailing `` Mainnet`` is cut off."""
    name = col(name)
    return mapped(name, CHAIN_SPELLINGS, F.regexp_replace(name, " Mainnet$", ""))


def asset_group(symbol) -> Column:
    """Wrapped and bridged variants of a token under one symbol."""
    symbol = col(symbol)
    return F.when(symbol == "ETH", "WETH").otherwise(F.regexp_replace(symbol, "^next", ""))


def price_group(symbol) -> Column:
    """Symbol whose price is used. The ``next`` prefix is cut before synonyms apply."""
    symbol = col(symbol)
    grouped = asset_group(symbol)
    return F.when(symbol.startswith("next"), grouped).otherwise(mapped(symbol, PRICE_SYNONYMS, grouped))


def alphabetic(symbol) -> Column:
    return col(symbol).rlike(r"^\p{L}+$")
