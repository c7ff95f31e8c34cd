"""Domain-shaped views over the driver tables.

Each view is one SQL text used by Spark and by the checking engine. ``@name``
stands for a table or another view; the dialect object covers the few functions
the two engines spell differently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}


class SparkDialect:
    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"timestampadd(HOUR, CAST({n} AS INT), {ts})"

    @staticmethod
    def epoch(ts: str) -> str:
        return f"unix_timestamp({ts})"

    @staticmethod
    def joined(text: str, order: str) -> str:
        return f"listagg({text}, ',') WITHIN GROUP (ORDER BY {order})"

    @staticmethod
    def moment(seconds: str) -> str:
        return f"timestamp_seconds({seconds})"

    @staticmethod
    def array(*values: str) -> str:
        return f"array({', '.join(values)})"

    @staticmethod
    def gathered(value: str, order: str) -> str:
        return f"transform(sort_array(collect_list(struct({order} AS o, {value} AS v))), x -> x.v)"

    @staticmethod
    def each(*values: str) -> str:
        return "explode(array(" + ", ".join(f"'{v}'" for v in values) + "))"


class DuckDialect:
    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"({ts} + to_hours(CAST({n} AS INTEGER)))"

    @staticmethod
    def epoch(ts: str) -> str:
        return f"(epoch_us({ts}) // 1000000)"

    @staticmethod
    def joined(text: str, order: str) -> str:
        return f"string_agg({text}, ',' ORDER BY {order})"

    @staticmethod
    def moment(seconds: str) -> str:
        return f"make_timestamp({seconds} * 1000000)"

    @staticmethod
    def array(*values: str) -> str:
        return f"[{', '.join(values)}]"

    @staticmethod
    def gathered(value: str, order: str) -> str:
        return f"list({value} ORDER BY {order})"

    @staticmethod
    def each(*values: str) -> str:
        return "unnest([" + ", ".join(f"'{v}'" for v in values) + "])"


VIEWS: dict[str, Callable[[type], str]] = {}


def fixture(fn: Callable[[type], str]) -> Callable[[type], str]:
    VIEWS[fn.__name__] = fn
    return fn


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"@(\w+)", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A driver table or a view over them, as a DataFrame; ``known`` ones are taken as they are, and new ones added."""
    known = {} if known is None else known
    if name in known:
        return known[name]
    if name not in VIEWS:
        known[name] = table(spark, sf_dir, name)
        return known[name]
    sql = VIEWS[name](SparkDialect)
    parts = {r: view(spark, sf_dir, r, known) for r in references(sql)}
    escaped = sql.replace("{", "{{").replace("}", "}}")
    known[name] = spark.sql(re.sub(r"@(\w+)", r"{\1}", escaped), **parts)
    return known[name]


def stored(spark: SparkSession, sf_dir: str, names: list[str], known: dict[str, DataFrame]) -> None:
    """Views that a query reads several times, joined once and written to the shared folder; ``known`` gets the written ones."""
    for name in names:
        if name == "fx_moves":
            known[name] = _stored_moves(spark, sf_dir, known)
        else:
            known[name] = cut_lineage(view(spark, sf_dir, name, known))


def _stored_moves(spark: SparkSession, sf_dir: str, known: dict[str, DataFrame]) -> DataFrame:
    """``fx_moves`` over its joined tables, of which the columns that it reads are written and nothing that follows from them.

    Orders meet customers and line items meet suppliers and parts before the two meet, so line items are shuffled for parts and
    orders alone.
    """
    columns = VIEWS["fx_moves"](SparkDialect).partition("FROM")[0]
    items, orders, customers, suppliers, parts = (view(spark, sf_dir, n, known) for n in ("lineitem", "orders", "customer", "supplier", "part"))
    sold = items.join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"]).join(parts, items["l_partkey"] == parts["p_partkey"])
    made = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    rows = sold.join(made, items["l_orderkey"] == orders["o_orderkey"])
    read = dict.fromkeys(re.findall(r"\b[lopsc]_\w+", columns))
    return spark.sql(columns + "FROM {moves}", moves=cut_lineage(rows.select(*read)))


def duck(body: str) -> str:
    """``body`` with its views put in front as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for r in references(VIEWS[name](DuckDialect)):
                visit(r)
            order.append(name)

    for r in references(body):
        visit(r)
    ctes = [f"{n} AS MATERIALIZED ({VIEWS[n](DuckDialect)})" for n in order]
    text = re.sub(r"@(\w+)", r"\1", ",\n".join(ctes) + "\x00" + body)
    heads, body = text.split("\x00")
    if not heads:
        return body
    start = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", body)
    if start:
        word = "WITH RECURSIVE " if start.group(1) else "WITH "
        return f"{word}{heads},\n{body[start.end():]}"
    return f"WITH {heads}\n{body}"


def discount_label(value: str) -> str:
    """Class of a discount in basis points: steps of 0.8, the last one open and for unknown ones too."""
    # fixed values: the classes' names
    names = ["Negative", "0 - 0.79", "0.8 - 1.59", "1.6 - 2.39", "2.4 - 3.19", "3.2 - 3.99", "4.0 - 4.8", "4.8.0+"]
    limits = "[0.0, 0.8, 1.6, 2.4, 3.2, 4.0, 4.8]"
    return f"{names}[CASE WHEN {value} IS NULL THEN {len(names)} ELSE 1 + len(list_filter({limits}, lambda x: x <= {value})) END]"


# --- dimensions -------------------------------------------------------------


@fixture
def fx_chains(d):
    return """
    SELECT CAST(n_nationkey AS BIGINT) AS chain_id, lower(n_name) AS name,
           'Brand#' || CAST(1 + n_regionkey AS STRING) AS fee_token_symbol, CAST(6 AS BIGINT) AS fee_token_decimal
    FROM @nation"""


@fixture
def fx_aliases(d):
    return """
    SELECT DISTINCT p_brand AS token_symbol, 'S' || CAST(CAST(substr(p_brand, 7) AS INT) % 5 AS STRING) AS price_symbol
    FROM @part"""


@fixture
def fx_token_metadata(d):
    # several addresses per chain and symbol; decimals follow the address
    return """
    SELECT DISTINCT 'nation_' || CAST(p_partkey % 25 AS STRING) AS blockchain, p_brand AS symbol,
           '0x' || md5(p_brand || '-' || CAST(p_partkey % 3 AS STRING)) AS contract_address,
           CASE WHEN CAST(substr(p_brand, 7) AS INT) % 2 = 0 THEN '6' ELSE '8' END AS decimals
    FROM @part"""


@fixture
def fx_prices_hourly(d):
    return f"""
    SELECT 'S' || CAST(o_custkey % 5 AS STRING) AS symbol, {d.hours('o_orderdate', '(o_orderkey % 2) * 12')} AS date,
           1 + o_totalprice / 100000 AS average_price
    FROM @orders"""


# --- transfers --------------------------------------------------------------


@fixture
def fx_moves(d):
    return f"""
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
             || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) AS move_id,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
           CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS out_cents,
           p_brand, p_partkey % 3 AS address_no, o_custkey, o_orderdate, o_orderstatus,
           {d.hours('o_orderdate', '(l_linenumber % 2) * 12')} AS ts,
           CAST(c_nationkey AS BIGINT) AS from_id, CAST(s_nationkey AS BIGINT) AS to_id
    FROM @lineitem JOIN @orders ON l_orderkey = o_orderkey JOIN @customer ON o_custkey = c_custkey
    JOIN @supplier ON l_suppkey = s_suppkey JOIN @part ON l_partkey = p_partkey"""


@fixture
def fx_transfers(d):
    return """
    SELECT l_returnflag AS bridge, move_id AS id, ts AS date, ts AS from_date, from_id AS from_chain_id, to_id AS to_chain_id,
           'chain_' || CAST(from_id AS STRING) AS from_chain_name, 'chain_' || CAST(to_id AS STRING) AS to_chain_name,
           CAST(o_custkey AS STRING) AS from_user_address, p_brand AS from_token_symbol, p_brand AS to_token_symbol,
           l_extendedprice AS from_amount_usd, l_extendedprice * (1 - l_discount) AS to_amount_usd,
           l_extendedprice * l_discount AS relay_amount_usd, l_extendedprice * l_tax AS gas_amount_usd
    FROM @fx_moves"""


# --- event-based facts --------------------------------------------------------


@fixture
def fx_ticks(d):
    return """
    SELECT 'S' || CAST(user_id % 5 AS STRING) AS symbol, 'chain_' || CAST(user_id % 2 AS STRING) AS blockchain,
           ts, value AS price
    FROM @events WHERE event_type = 'view'"""


@fixture
def fx_facts(d):
    return """
    SELECT event_id, 'S' || CAST(user_id % 5 AS STRING) AS symbol, user_id, event_type, ts, value AS amount
    FROM @events WHERE event_type <> 'view'"""


@fixture
def fx_ledger(d):
    return """
    SELECT event_id, 'r' || CAST(user_id % 13 AS STRING) AS router, 'S' || CAST(user_id % 5 AS STRING) AS asset,
           CASE WHEN user_id % 3 = 0 THEN 'Ethereum Mainnet' ELSE 'chain_' || CAST(user_id % 3 AS STRING) END AS chain, ts,
           CASE WHEN event_type IN ('signup', 'purchase') THEN 'Add' ELSE 'Remove' END AS event, value AS amount
    FROM @events"""


@fixture
def fx_flows(d):
    return """
    SELECT event_id AS transfer_id, ts AS date, 'c' || CAST(user_id % 7 AS STRING) AS source,
           'c' || CAST((user_id + event_id) % 7 AS STRING) AS target, event_type AS asset, value AS amount
    FROM @events"""
