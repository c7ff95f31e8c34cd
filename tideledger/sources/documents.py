"""Nested API documents to flat rows.

All functions take a DataFrame read with a schema from ``schemas`` and use only
``explode`` and field access, so a file set of any size is split by the reader.
Arrays are opened with ``explode_outer`` and a null filter: for ``explode`` the
optimiser adds a size filter below it, which would parse JSON text twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import normalize_columns


def read_documents(spark: SparkSession, path: str, schema: str, stamp: bool = False) -> DataFrame:
    """JSON lines with a fixed schema; ``stamp`` adds the time in the file name."""
    df = spark.read.schema(schema).json(path)
    return with_file_stamp(df) if stamp else df


def parse_documents(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The same from a text column."""
    return df.select(*[c for c in df.columns if c != text], F.from_json(text, schema).alias("__doc")).select(
        *[c for c in df.columns if c != text], "__doc.*"
    )


def with_file_stamp(df: DataFrame, pattern: str = r"(\d{4}-\d{2}-\d{2}[T_ ]\d{2}[:-]\d{2}[:-]\d{2})") -> DataFrame:
    """``upload_datetime`` from the file name, e.g. ``2024-02-13_10-00-00.json``."""
    name = F.regexp_extract(F.input_file_name(), pattern, 1)
    clean = F.regexp_replace(name, r"(\d{4}-\d{2}-\d{2})[T_ ](\d{2})[:-](\d{2})[:-](\d{2})", "$1 $2:$3:$4")
    return df.withColumn("upload_datetime", F.try_to_timestamp(clean, F.lit("yyyy-MM-dd HH:mm:ss")))


def leaves(schema: T.StructType, path: str = "", name: str = "") -> list[Column]:
    """Nested structs as flat columns ``a_b_c``."""
    out = []
    for f in schema:
        here, label = f"{path}`{f.name}`", f"{name}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += leaves(f.dataType, here + ".", label + "_")
        else:
            out.append(F.col(here).alias(label))
    return out


def flatten_structs(df: DataFrame) -> DataFrame:
    return df.select(*leaves(df.schema))


def _prefixed(df: DataFrame, struct: str, prefix: str, skip: Sequence[str] = ()) -> list[Column]:
    inner = df.schema[struct].dataType
    kept = T.StructType([f for f in inner if f.name not in skip])
    return leaves(kept, f"`{struct}`.", prefix)


def flatten_routes(docs: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """One row per route step, with the route's fields, fee and gas cost beside it.

    Costs of all steps of a route form one list; its ``i``-th entry goes to the
    ``i``-th step. Rows with a missing value are dropped, as a loader would.
    """
    keep = [c for c in docs.columns if c not in ("routes", "payload", "unavailableRoutes")]
    routes = docs.select(*keep, F.explode_outer("routes").alias("route")).where(F.col("route").isNotNull())

    def costs(kind: str) -> Column:
        return F.flatten(F.transform("route.steps", lambda s: F.coalesce(s["estimate"][kind], F.array())))

    steps = routes.select(
        *keep, "route", costs("feeCosts").alias("fees"), costs("gasCosts").alias("gases"),
        F.posexplode_outer("route.steps").alias("step_index", "step"),
    ).where(F.col("step").isNotNull()).select(
        *keep, "route", "step_index", "step",
        F.get("fees", F.col("step_index")).alias("fee"), F.get("gases", F.col("step_index")).alias("gas"),
    )
    flat = steps.select(
        *keep,
        "step_index",
        *leaves(T.StructType([f for f in steps.schema["step"].dataType if f.name != "estimate"]), "step."),
        F.col("step.estimate.fromAmount").alias("estimate_fromAmount"),
        F.col("step.estimate.toAmount").alias("estimate_toAmount"),
        *_prefixed(steps, "route", "route_", skip=("steps",)),
        *_prefixed(steps, "fee", "fee_"),
        *_prefixed(steps, "gas", "gas_"),
    )
    flat = normalize_columns(flat)
    return flat.dropna() if drop_incomplete else flat


def flatten_quotes(docs: DataFrame) -> DataFrame:
    """One row per quoted route with the response's own fields repeated."""
    meta = [f"result.{f.name}" for f in docs.schema["result"].dataType if f.name != "routes"]
    keep = [c for c in docs.columns if c not in ("result", "payload")]
    rows = docs.select(*keep, *meta, F.explode_outer("result.routes").alias("__route")).where(F.col("__route").isNotNull())
    fields = [f.name for f in rows.schema["__route"].dataType]
    rows = rows.select(*[c for c in rows.columns if c != "__route"], *[F.col(f"__route.{c}").alias(c) for c in fields])
    return normalize_columns(flatten_structs(rows))


def flatten_steps(docs: DataFrame) -> DataFrame:
    """One row per step of a user transaction, numbered from 0 within it."""
    routes = docs.select(F.explode_outer("result.routes").alias("r"))
    txs = routes.select(F.col("r.routeId").alias("route_id"), F.explode_outer("r.userTxs").alias("u"))
    steps = txs.select(
        "route_id",
        F.col("u.routePath").alias("routePath"),
        F.col("u.userTxIndex").alias("userTxIndex"),
        F.posexplode_outer("u.steps").alias("step_id", "s"),
    ).where(F.col("s").isNotNull())
    return normalize_columns(
        steps.select("route_id", "routePath", "userTxIndex", "step_id", *_prefixed(steps, "s", ""))
    )


def flatten_calls(docs: DataFrame) -> DataFrame:
    """Calls that answered without any route."""
    if "result" in docs.columns:
        empty = docs.where(F.size("result.routes") == 0).withColumn("result", F.col("result").dropFields("routes"))
        return normalize_columns(flatten_structs(empty.withColumn("route_length", F.lit(0))))
    empty = docs.where((F.size("routes") == 0) & (F.size("unavailableRoutes.failed") > 0))
    return normalize_columns(empty.select(F.inline("unavailableRoutes.failed")))


def flatten_payloads(docs: DataFrame) -> DataFrame:
    """The request each answer belongs to."""
    return normalize_columns(docs.where(F.col("payload").isNotNull()).select("payload.*"))


def _day_entries(docs: DataFrame, kinds: Sequence[str]) -> DataFrame:
    sides = F.array(*[F.struct(F.lit(k).alias("key_type"), F.col(f"data.{k}").alias("totals")) for k in kinds])
    rows = docs.select(F.col("data.date").alias("date"), "status_code", "url", F.explode_outer(sides).alias("side"))
    rows = rows.select("date", "status_code", "url", "side.key_type", F.explode_outer("side.totals").alias("key", "total"))
    return rows.where(F.col("key").isNotNull()).select("date", "status_code", "url", "key_type", "key", "total.*")


def flatten_day_stats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token rows, wallet rows) of daily bridge totals."""
    return (
        _day_entries(docs, ("totalTokensDeposited", "totalTokensWithdrawn")),
        _day_entries(docs, ("totalAddressDeposited", "totalAddressWithdrawn")),
    )


def explode_connections(docs: DataFrame) -> DataFrame:
    """Every from-token with every to-token of a connection."""
    keep = [c for c in docs.columns if c not in ("fromTokens", "toTokens")]
    rows = docs.select(*keep, F.explode_outer("fromTokens").alias("f"), "toTokens")
    rows = rows.select(*keep, "f", F.explode_outer("toTokens").alias("t"))
    return rows.select(*keep, *_prefixed(rows, "f", "from_"), *_prefixed(rows, "t", "to_"))


def flatten_chain_assets(docs: DataFrame) -> DataFrame:
    keep = [c for c in docs.columns if c != "assetId"]
    rows = docs.select(*keep, F.explode_outer("assetId").alias("asset_key", "asset"))
    return normalize_columns(rows.select(*keep, "asset_key", *_prefixed(rows, "asset", "asset_")))


def flatten_token_contracts(docs: DataFrame) -> DataFrame:
    tokens = docs.select(F.explode_outer("data").alias("token_id", "t"))
    rows = tokens.select("token_id", "t.name", "t.symbol", F.explode_outer("t.contract_address").alias("c"))
    return rows.select(
        "token_id",
        F.col("name").alias("token_name"),
        F.col("symbol").alias("token_symbol"),
        F.col("c.contract_address").alias("contract_address"),
        F.col("c.platform.name").alias("platform_name"),
        F.col("c.platform.coin.id").alias("platform_coin_id"),
        F.col("c.platform.coin.name").alias("platform_coin_name"),
        F.col("c.platform.coin.symbol").alias("platform_coin_symbol"),
    ).where(F.col("contract_address").isNotNull())


def normalize_multi_hop(df: DataFrame) -> DataFrame:
    """Dates with or without fractional seconds, the first token, nested values as JSON text."""

    def when(c: str) -> Column:
        parsed = F.coalesce(
            F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
            F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
            F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")),
        )
        return F.date_trunc("second", parsed)

    first = F.get("tokens", F.lit(0))
    out = df.withColumns({c: when(c) for c in ("created_at", "mined_at", "success_at")})
    out = out.withColumns({f"token_{k}": first[k] for k in ("symbol", "name", "address", "decimals")})
    nested = ("amounts", "tokens", "from_route", "to_route", "transit_token")
    return out.withColumns({c: F.to_json(c) for c in nested})


def flatten_chain_registry(docs: DataFrame) -> DataFrame:
    def joined(c) -> Column:
        return F.array_join(c, ", ")

    return docs.select(
        "id",
        "name",
        "chain",
        F.col("chainId"),
        joined(F.coalesce(F.col("rpc"), F.array())).alias("rpc"),
        F.col("icon.publicURL").alias("icon"),
        F.col("nativeCurrency.decimals").alias("nativeCurrency_decimals"),
        F.col("nativeCurrency.name").alias("nativeCurrency_name"),
        F.col("nativeCurrency.symbol").alias("nativeCurrency_symbol"),
        F.when(F.size("explorers") > 0, joined(F.col("explorers.url"))).alias("explorers"),
        "status",
        joined(F.coalesce(F.col("faucets"), F.array())).alias("faucets"),
    )


def flatten_records(docs: DataFrame, keep: Sequence[str] | None = None, text: bool = True) -> DataFrame:
    """Leaf fields in snake case, distinct rows, as text."""
    flat = normalize_columns(flatten_structs(docs), snake=True, text=text)
    return (flat.select(*keep) if keep else flat).distinct()


def stablecoin_snapshot(df: DataFrame) -> DataFrame:
    """Priced coins without the per-chain map; the chain list stays."""
    return normalize_columns(df.where(F.col("price").isNotNull()).drop("chainCirculating"))
