"""Table scans, seed files and literal tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# dimension files; columns as published with them
SEED_SCHEMAS = {
    "chains": "chain_id bigint, name string, fee_token_symbol string, fee_token_decimal bigint",
    "token_aliases": "token_symbol string, price_symbol string",
    "tokens": "asset_name string, symbol string, decimals bigint, domain_id bigint, address string",
    "market_makers": "origin_initiator string, market_maker_name string",
}


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_except(spark: SparkSession, path: str, *excluded: str) -> DataFrame:
    """All columns but ``excluded``; the scan does not read those."""
    return spark.read.parquet(path).drop(*excluded)


def seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SEED_SCHEMAS[name]).csv(path, header=True)


def literal(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table written in code, as a local relation the optimiser knows the size of."""
    struct = T.StructType.fromDDL(schema)

    def cell(value, dtype) -> str:
        if value is None:
            return f"CAST(NULL AS {dtype.simpleString()})"
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"CAST('{text}' AS {dtype.simpleString()})"

    lines = ", ".join("(" + ", ".join(cell(v, f.dataType) for v, f in zip(r, struct)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(f'`{f.name}`' for f in struct)})")


def snake_case(name: str) -> str:
    return re.sub(r"([A-Z])", r"_\1", name).lower().lstrip("_").replace(".", "_")


def normalize_columns(df: DataFrame, snake: bool = False, text: bool = False) -> DataFrame:
    """Lower-case names with ``_`` for ``.``; arrays and booleans become text.

    ``snake`` also splits camel case; ``text`` casts every column to text.
    """
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif text or isinstance(f.dataType, T.BooleanType):
            c = c.cast("string")
        out.append(c.alias(snake_case(f.name) if snake else f.name.lower().replace(".", "_")))
    return df.select(*out)


def columns_with_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c.startswith(prefixes)])


def filter_by(df: DataFrame, values: dict[str, Sequence] | None = None, time: str | None = None, start=None, end=None) -> DataFrame:
    """Value lists per column and a half-open time range; empty lists do not filter."""
    for c, allowed in (values or {}).items():
        if allowed:
            df = df.where(F.col(c).isin(*allowed))
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(time) < F.lit(end).cast("timestamp"))
    return df
