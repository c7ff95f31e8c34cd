"""Reader, document, sink, incremental and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.amounts import coerced
from ..session import new_path
from ..sources import documents as D
from ..sources import incremental as I
from ..sources import schemas as SC
from ..sources import sinks as K
from ..sources import tables as T
from ..streaming import files as SF
from ..streaming import flows as SL
from .fixtures import TABLES, fixture
from .flows import BATCH_SQL, bucket_sql, sides_sql
from .registry import query

# --- scans --------------------------------------------------------------------------------


@query("S1_scan_columns", "SELECT l_orderkey, l_extendedprice FROM lineitem", "l_extendedprice")
def _(t):
    return T.scan(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


@query("S2_scan_except", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def _(t):
    return T.scan_except(t.spark, f"{t.sf_dir}/customer.parquet", "c_acctbal")


@query("S3_seed_csv", "SELECT chain_id, name, fee_token_symbol, fee_token_decimal FROM @fx_chains")
def _(t):
    path = new_path(t.spark, "seed")
    t.fx_chains.write.csv(path, header=True)
    return T.seed(t.spark, path, "chains")


@query("S4_literal_table", "SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'filled'), ('O', 'open'), ('P', CAST(NULL AS VARCHAR))) v(code, label) ON o_orderstatus = code")
def _(t):
    names = T.literal(t.spark, [("F", "filled"), ("O", "open"), ("P", None)], "code string, label string")
    return t.orders.join(F.broadcast(names), F.col("o_orderstatus") == F.col("code")).select("o_orderkey", "label")


# --- JSON documents -------------------------------------------------------------------------


def text(e: str) -> str:
    return f"""'"' || {e} || '"'"""


def num(e: str) -> str:
    return f"CAST({e} AS STRING)"


def obj(**fields: str) -> str:
    return "'{' || " + " || ',' || ".join(f"""'"{k}":' || {v}""" for k, v in fields.items()) + " || '}'"


def token(key: str) -> str:
    return obj(address=text(f"'0x' || CAST({key} AS STRING)"), chainId=num(key), symbol=text(f"'S' || CAST({key} AS STRING)"), decimals="'6'", name=text("'n'"), priceUSD=text("'1'"))


# Each line item is one document, so documents stay small however the data is spread.
LINE_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(cents AS STRING)"


@fixture
def fx_document_lines(d):
    return f"""
    SELECT {LINE_ID} AS line_id, * FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM @lineitem) x"""


def listed(cell, last: str) -> str:
    """JSON list of ``cell(0) .. cell(n)`` where ``last`` (0, 1 or 2) is a SQL expression."""
    return (
        f"'[' || {cell(0)} || CASE WHEN {last} > 0 THEN ',' || {cell(1)} ELSE '' END || CASE WHEN {last} > 1 THEN ',' || {cell(2)} ELSE '' END || ']'"
    )


@fixture
def fx_route_documents(d):
    def cost(k: int) -> str:
        return obj(name=text(f"'fee{k}'"), amount=text(num(f"cents + {k}")), amountUSD=text("'0.5'"), token=token("l_suppkey"))

    def step(k: int) -> str:
        fees = f"CASE WHEN (l_linenumber + {k}) % 2 = 0 THEN '[' || {cost(k)} || ']' ELSE '[]' END"
        return obj(
            id=text(f"line_id || '/{k}'"), type=text("'cross'"), tool=text(f"'t{k}'"),
            toolDetails=obj(key=text("'k' || CAST(l_suppkey % 4 AS STRING)"), name=text("'n'")),
            estimate=obj(fromAmount=text(num("cents")), toAmount=text(num("cents - 1")), feeCosts=fees, gasCosts=f"'[' || {cost(k)} || ']'"),
        )

    route = obj(
        id=text("line_id"), fromChainId=num("l_partkey % 5"), toChainId=num("l_orderkey % 5"), fromAmountUSD=text(num("cents")),
        toAmountUSD=text(num("cents - 1")), gasCostUSD=text("'0.1'"), fromAmount=text("'100'"), toAmount=text("'99'"), tags="""'["FASTEST"]'""",
        fromToken=token("l_partkey % 5"), toToken=token("l_orderkey % 5"), steps=listed(step, "l_linenumber % 3"),
    )
    request = obj(fromChainId=num("l_partkey % 5"), toChainId=num("l_orderkey % 5"), fromAmount=text("line_id"), fromTokenAddress=text("'a'"), toTokenAddress=text("'b'"))
    failed = obj(overallPath=text("line_id"), subpaths=text("'s'"))
    doc = obj(
        payload=request, routes=f"CASE WHEN l_linenumber = 7 THEN '[]' ELSE '[' || {route} || ']' END",
        unavailableRoutes=obj(failed=f"CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN '[' || {failed} || ']' ELSE '[]' END"),
    )
    return f"SELECT {doc} AS doc FROM @fx_document_lines"


def route_documents(t):
    return D.parse_documents(t.fx_route_documents, "doc", SC.ROUTE_DOCUMENTS)


@query(
    "S5_flatten_routes",
    """WITH steps AS (SELECT l.*, CAST(unnest([0, 1, 2]) AS BIGINT) AS k FROM @fx_document_lines l WHERE l_linenumber <> 7),
       kept AS (SELECT * FROM steps WHERE k <= l_linenumber % 3),
       fees AS (SELECT line_id, k AS fee_no, row_number() OVER (PARTITION BY line_id ORDER BY k) - 1 AS pos FROM kept WHERE (l_linenumber + k) % 2 = 0)
       SELECT s.line_id AS route_id, s.k AS step_index, s.line_id || '/' || s.k AS id, 't' || s.k AS tool, 'k' || l_suppkey % 4 AS tooldetails_key, CAST(cents AS VARCHAR) AS estimate_fromamount,
              l_partkey % 5 AS route_fromchainid, 'S' || l_partkey % 5 AS route_fromtoken_symbol, 'fee' || fee_no AS fee_name, CAST(cents + fee_no AS VARCHAR) AS fee_amount,
              'fee' || s.k AS gas_name, 'S' || l_suppkey AS gas_token_symbol, '["FASTEST"]' AS route_tags
       FROM kept s JOIN fees f ON s.line_id = f.line_id AND s.k = f.pos""",
)
def _(t):
    return D.flatten_routes(route_documents(t)).select(
        "route_id", "step_index", "id", "tool", "tooldetails_key", "estimate_fromamount", "route_fromchainid", "route_fromtoken_symbol", "fee_name", "fee_amount",
        "gas_name", "gas_token_symbol", "route_tags",
    )


@fixture
def fx_quote_documents(d):
    def step(k: int) -> str:
        return obj(type=text(f"'bridge{k}'"), fromAmount=text(num("cents")), toAmount=text(num("cents - 1")), protocol=obj(name=text("'p' || CAST(l_suppkey % 3 AS STRING)")))

    def user(k: int) -> str:
        return obj(userTxType=text("'fund'"), routePath=text(f"'path{k}'"), userTxIndex=f"'{k}'", steps=listed(step, "l_suppkey % 3"))

    def route(k: int) -> str:
        return obj(
            routeId=text(f"line_id || '/{k}'"), fromAmount=text(num("cents")), toAmount=text(num("cents - 1")), usedBridgeNames="""'["b' || CAST(l_suppkey % 4 AS STRING) || '"]'""",
            totalUserTx="'1'", totalGasFeesInUsd="'0.25'", inputValueInUsd=num("cents"), outputValueInUsd=num("cents - 2"), receivedValueInUsd=num(f"cents - {k}"),
            isOnlySwapRoute=f"'{'true' if k == 0 else 'false'}'", userTxs=listed(user, "l_partkey % 2"),
        )

    asset = obj(symbol=text("'S' || CAST(l_partkey % 5 AS STRING)"), address=text("'0x'"))
    request = obj(fromChainId=num("l_partkey % 5"), toChainId=num("l_orderkey % 5"), fromAmount=text("'100'"), fromTokenAddress=text("'a'"), toTokenAddress=text("'b'"))
    routes = f"CASE WHEN l_linenumber = 7 THEN '[]' ELSE {listed(route, 'l_linenumber % 2')} END"
    result = obj(fromChainId=num("l_partkey % 5"), toChainId=num("l_orderkey % 5"), fromAsset=asset, toAsset=asset, routes=routes)
    return f"SELECT {obj(payload=request, result=result)} AS doc FROM @fx_document_lines"


def quote_documents(t):
    return D.parse_documents(t.fx_quote_documents, "doc", SC.QUOTE_DOCUMENTS)


_ROUTES = "(SELECT l.*, CAST(unnest([0, 1]) AS BIGINT) AS r FROM @fx_document_lines l WHERE l_linenumber <> 7)"


@query(
    "S6_flatten_quotes",
    f"""SELECT line_id || '/' || r AS routeid, l_partkey % 5 AS fromchainid, l_orderkey % 5 AS tochainid, 'S' || l_partkey % 5 AS fromasset_symbol, '["b' || l_suppkey % 4 || '"]' AS usedbridgenames,
               CAST(cents AS DOUBLE) AS inputvalueinusd, CAST(cents - r AS DOUBLE) AS receivedvalueinusd, CASE WHEN r = 0 THEN 'true' ELSE 'false' END AS isonlyswaproute
        FROM {_ROUTES} x WHERE r <= l_linenumber % 2""",
    "inputvalueinusd receivedvalueinusd",
)
def _(t):
    return D.flatten_quotes(quote_documents(t)).select(
        "routeid", "fromchainid", "tochainid", "fromasset_symbol", "usedbridgenames", "inputvalueinusd", "receivedvalueinusd", "isonlyswaproute"
    )


@query(
    "S7_flatten_steps",
    f"""SELECT line_id || '/' || r AS route_id, 'path' || u AS routepath, u AS usertxindex, s AS step_id, 'bridge' || s AS type, CAST(cents AS VARCHAR) AS fromamount,
               CAST(cents - 1 AS VARCHAR) AS toamount, 'p' || l_suppkey % 3 AS protocol_name
        FROM {_ROUTES} x CROSS JOIN (SELECT CAST(unnest([0, 1]) AS BIGINT) AS u) a CROSS JOIN (SELECT CAST(unnest([0, 1, 2]) AS BIGINT) AS s) b
        WHERE r <= l_linenumber % 2 AND u <= l_partkey % 2 AND s <= l_suppkey % 3""",
)
def _(t):
    return D.flatten_steps(quote_documents(t))


@query("S8_failed_calls", "SELECT line_id AS overallpath, 's' AS subpaths FROM @fx_document_lines WHERE l_linenumber = 7 AND l_orderkey % 2 = 0")
def _(t):
    return D.flatten_calls(route_documents(t))


@query(
    "S8_empty_quote_calls",
    "SELECT l_partkey % 5 AS result_fromchainid, l_orderkey % 5 AS result_tochainid, CAST(0 AS BIGINT) AS route_length FROM @fx_document_lines WHERE l_linenumber = 7",
)
def _(t):
    return D.flatten_calls(quote_documents(t)).select("result_fromchainid", "result_tochainid", "route_length")


@query("S8_payloads", "SELECT l_partkey % 5 AS fromchainid, l_orderkey % 5 AS tochainid, line_id AS fromamount, 'a' AS fromtokenaddress, 'b' AS totokenaddress FROM @fx_document_lines")
def _(t):
    return D.flatten_payloads(route_documents(t))


@fixture
def fx_day_totals(d):
    return f"""
    SELECT {d.epoch("date_trunc('day', ts)")} AS day, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
    FROM @events GROUP BY 1, 2"""


@fixture
def fx_day_documents(d):
    entry = obj(usdValue=num("cents"), amount=text(num("n")), symbol=text("'S' || CAST(user_id % 5 AS STRING)"), decimals="'6'")
    wallet = obj(usdValue=num("cents"), txs=num("n"))

    def entries(value: str, keep: str) -> str:
        cell = f"""'"eth:0x' || CAST(user_id AS STRING) || '":' || {value}"""
        return f"'{{' || coalesce({d.joined(f'CASE WHEN {keep} THEN {cell} END', 'user_id')}, '') || '}}'"

    data = obj(
        date=num("day"), totalTokensDeposited=entries(entry, "user_id % 2 = 0"), totalTokensWithdrawn=entries(entry, "user_id % 2 = 1"),
        totalAddressDeposited=entries(wallet, "user_id % 3 = 0"), totalAddressWithdrawn=entries(wallet, "user_id % 3 > 0"),
    )
    # at most 50 users per document
    return f"SELECT day AS doc_id, {obj(status_code="'200'", url=text("'https://x/' || CAST(day AS STRING) || '/Base?id=1'"), data=data)} AS doc FROM @fx_day_totals GROUP BY day, floor(user_id / 50)"


def day_documents(t):
    return D.flatten_day_stats(D.parse_documents(t.fx_day_documents.select("doc"), "doc", SC.DAY_STATS_DOCUMENTS))


@query(
    "S9_day_stats_tokens",
    """SELECT day AS date, CAST(200 AS BIGINT) AS status_code, 'https://x/' || day || '/Base?id=1' AS url, CASE WHEN user_id % 2 = 0 THEN 'totalTokensDeposited' ELSE 'totalTokensWithdrawn' END AS key_type,
              'eth:0x' || user_id AS key, CAST(cents AS DOUBLE) AS "usdValue", CAST(n AS VARCHAR) AS amount, 'S' || user_id % 5 AS symbol, CAST(6 AS BIGINT) AS decimals FROM @fx_day_totals""",
    '"usdValue"',
)
def _(t):
    return day_documents(t)[0]


@query(
    "S9_day_stats_wallets",
    """SELECT day AS date, CAST(200 AS BIGINT) AS status_code, 'https://x/' || day || '/Base?id=1' AS url, CASE WHEN user_id % 3 = 0 THEN 'totalAddressDeposited' ELSE 'totalAddressWithdrawn' END AS key_type,
              'eth:0x' || user_id AS key, CAST(cents AS DOUBLE) AS "usdValue", n AS txs FROM @fx_day_totals""",
    '"usdValue"',
)
def _(t):
    return day_documents(t)[1]


@fixture
def fx_connection_documents(d):
    def side(letter: str, n: int) -> str:
        return obj(address=text(f"'{letter}{n}' || CAST(c_custkey AS STRING)"), symbol=text(f"'S{n}'"), decimals="'6'")

    doc = obj(
        fromChainId=num("c_nationkey"), toChainId=num("c_custkey"), fromTokens=f"'[' || {side('f', 1)} || ',' || {side('f', 2)} || ']'",
        toTokens=f"CASE WHEN c_custkey % 4 = 0 THEN '[]' ELSE '[' || {side('t', 1)} || ',' || {side('t', 3)} || ']' END",
    )
    return f"SELECT c_custkey AS doc_id, {doc} AS doc FROM @customer"


@query(
    "S10_connections",
    """SELECT CAST(c_nationkey AS BIGINT) AS "fromChainId", c_custkey AS "toChainId", 'f' || f || c_custkey AS from_address, 'S' || f AS from_symbol, CAST(6 AS BIGINT) AS from_decimals,
              CASE WHEN c_custkey % 4 <> 0 THEN 't' || g || c_custkey END AS to_address, CASE WHEN c_custkey % 4 <> 0 THEN 'S' || g END AS to_symbol,
              CASE WHEN c_custkey % 4 <> 0 THEN CAST(6 AS BIGINT) END AS to_decimals
       FROM customer CROSS JOIN (SELECT unnest([1, 2]) AS f) a CROSS JOIN (SELECT unnest([1, 3]) AS g) b WHERE c_custkey % 4 <> 0 OR g = 1""",
)
def _(t):
    return D.explode_connections(D.parse_documents(t.fx_connection_documents.select("doc"), "doc", SC.CONNECTION_DOCUMENTS))


@fixture
def fx_asset_documents(d):
    asset = obj(symbol=text("p_brand"), mainnetEquivalent=text("'0x' || CAST(p_partkey AS STRING)"), decimals=num("p_size"))
    cell = f"""'"0xk' || CAST(p_partkey AS STRING) || '":' || {asset}"""
    doc = obj(chainId=num("chain"), name=text("'chain ' || CAST(chain AS STRING)"), domainId=text(num("chain * 10")), confirmations="'1'", assetId="'{' || assets || '}'")
    # at most 40 assets per document
    return f"SELECT chain AS doc_id, {doc} AS doc FROM (SELECT p_partkey % 25 AS chain, {d.joined(cell, 'p_partkey')} AS assets FROM @part GROUP BY 1, floor(p_partkey / 1000)) x"


@query(
    "S11_chain_assets",
    """SELECT p_partkey % 25 AS chainid, 'chain ' || p_partkey % 25 AS name, CAST(p_partkey % 25 * 10 AS VARCHAR) AS domainid, CAST(1 AS BIGINT) AS confirmations, '0xk' || p_partkey AS asset_key,
              p_brand AS asset_symbol, '0x' || p_partkey AS asset_mainnetequivalent, CAST(p_size AS BIGINT) AS asset_decimals FROM part""",
)
def _(t):
    return D.flatten_chain_assets(D.parse_documents(t.fx_asset_documents.select("doc"), "doc", SC.CHAIN_ASSETS_DOCUMENTS))


@fixture
def fx_contract_documents(d):
    platform = obj(name=text("'net' || CAST(p_size % 5 AS STRING)"), coin=obj(id=text(num("p_size")), name=text("'coin'"), symbol=text("'C'")))
    contract = obj(contract_address=text("'0x' || CAST(p_partkey AS STRING)"), platform=platform)
    cell = f"""'"' || brand_no || '":' || {obj(name=text("'token ' || brand_no"), symbol=text("'T' || brand_no"), contract_address="'[' || contracts || ']'")}"""
    return f"""
    SELECT part_no AS doc_id, {obj(data=f"'{{' || {d.joined(cell, 'brand_no')} || '}}'")} AS doc
    FROM (SELECT CAST(p_partkey % 40 AS STRING) AS brand_no, floor(p_partkey / 400) AS part_no, {d.joined(contract, 'p_partkey')} AS contracts FROM @part GROUP BY 1, 2) x GROUP BY part_no"""


@query(
    "S12_token_contracts",
    """SELECT CAST(p_partkey % 40 AS VARCHAR) AS token_id, 'token ' || p_partkey % 40 AS token_name, 'T' || p_partkey % 40 AS token_symbol, '0x' || p_partkey AS contract_address,
              'net' || p_size % 5 AS platform_name, CAST(p_size AS VARCHAR) AS platform_coin_id, 'coin' AS platform_coin_name, 'C' AS platform_coin_symbol FROM part""",
)
def _(t):
    return D.flatten_token_contracts(D.parse_documents(t.fx_contract_documents.select("doc"), "doc", SC.TOKEN_REGISTRY_DOCUMENTS))


@fixture
def fx_hop_documents(d):
    tok = obj(symbol=text("'S' || CAST(o_custkey % 5 AS STRING)"), name=text("'n'"), address=text("'a'"), decimals="'6'")
    day = "substr(CAST(o_orderdate AS STRING), 1, 10)"
    doc = obj(
        id=num("o_orderkey"), from_chain_id=num("o_custkey % 5"), state="'0'", type="'0'", event_type=num("o_orderkey % 4"), created_at=text(f"{day} || 'T01:02:03.456Z'"),
        mined_at=text(f"{day} || 'T01:02:03Z'"), success_at=f"CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE {text(f'''{day} || 'T01:02:04.123456Z' ''')} END",
        amounts="""'["1","2"]'""", tokens=f"CASE WHEN o_orderkey % 5 = 0 THEN '[]' ELSE '[' || {tok} || ']' END", from_amount_usd=num("o_custkey"), retry_active="'false'",
    )
    return f"SELECT o_orderkey AS doc_id, {doc} AS doc FROM @orders"


@query(
    "S13_normalize_records",
    """SELECT o_orderkey AS id, o_orderdate + INTERVAL 3723 SECOND AS created_at, o_orderdate + INTERVAL 3723 SECOND AS mined_at,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 3724 SECOND END AS success_at, CASE WHEN o_orderkey % 5 <> 0 THEN 'S' || o_custkey % 5 END AS token_symbol, '["1","2"]' AS amounts
       FROM orders""",
)
def _(t):
    rows = D.normalize_multi_hop(D.parse_documents(t.fx_hop_documents.select("doc"), "doc", SC.MULTI_HOP_TRANSACTIONS))
    return rows.select("id", "created_at", "mined_at", "success_at", "token_symbol", "amounts")


@fixture
def fx_chain_documents(d):
    doc = obj(
        id=text(num("s_suppkey")), name=text("s_name"), chain=text("'C'"), chainId=num("s_nationkey"), rpc="""'["http://a' || CAST(s_suppkey AS STRING) || '","http://b"]'""",
        icon="CASE WHEN s_suppkey % 2 = 0 THEN 'null' ELSE '{\"publicURL\":\"u\"}' END", nativeCurrency=obj(decimals="'18'", name=text("'Ether'"), symbol=text("'ETH'")),
        explorers="CASE WHEN s_suppkey % 3 = 0 THEN '[]' ELSE '[{\"url\":\"e1\"},{\"url\":\"e2\"}]' END", status=text("'active'"), faucets="'[]'",
    )
    return f"SELECT s_suppkey AS doc_id, {doc} AS doc FROM @supplier"


@query(
    "S14_chain_registry",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'C' AS chain, CAST(s_nationkey AS BIGINT) AS "chainId", 'http://a' || s_suppkey || ', http://b' AS rpc,
              CASE WHEN s_suppkey % 2 = 1 THEN 'u' END AS icon, CAST(18 AS BIGINT) AS "nativeCurrency_decimals", 'Ether' AS "nativeCurrency_name", 'ETH' AS "nativeCurrency_symbol",
              CASE WHEN s_suppkey % 3 <> 0 THEN 'e1, e2' END AS explorers, 'active' AS status, '' AS faucets FROM supplier""",
)
def _(t):
    return D.flatten_chain_registry(D.parse_documents(t.fx_chain_documents.select("doc"), "doc", SC.CHAIN_REGISTRY_DOCUMENTS))


@query("S15_normalize_columns", """SELECT c_custkey AS cust_key, CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS is_rich, '["' || c_mktsegment || '","x"]' AS tag_list FROM customer""")
def _(t):
    rows = t.customer.select(F.col("c_custkey").alias("custKey"), (F.col("c_acctbal") > 0).alias("isRich"), F.array("c_mktsegment", F.lit("x")).alias("tagList"))
    return T.normalize_columns(rows, snake=True)


@query("S16_coerced_numbers", "SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS BIGINT), 0) AS n, CAST(0 AS BIGINT) AS volatile FROM orders")
def _(t):
    raw = F.when(F.col("o_orderkey") % 4 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    return t.orders.select("o_orderkey", coerced(raw).alias("n"), F.lit(0).cast("bigint").alias("volatile"))


@query("S17_append_replace", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t):
    path = new_path(t.spark, "sink")
    K.replace(t.customer.select("c_custkey", "c_name"), path)
    K.append(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), path)
    return t.spark.read.parquet(path)


@query("S18_rewrite_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem")
def _(t):
    path = new_path(t.spark, "raw")
    K.replace(t.lineitem.select("l_suppkey", "l_returnflag", "l_linenumber", "l_tax"), path)
    return K.rewrite_distinct(t.spark, path, ["l_suppkey", "l_returnflag", "l_linenumber"]).read()


@query("S19_load_stamp", "SELECT c_custkey, TIMESTAMP '2024-02-13 10:00:00' AS uploaded_at FROM customer")
def _(t):
    return K.stamped(t.customer.select("c_custkey"), at="2024-02-13 10:00:00")


@query("S19_file_stamp", "SELECT c_custkey, TIMESTAMP '2024-02-13 10:00:00' AS upload_datetime FROM customer")
def _(t):
    path = new_path(t.spark, "pull") + "/2024-02-13_10-00-00.json"
    t.customer.select("c_custkey").write.json(path)
    return D.read_documents(t.spark, path, "c_custkey bigint", stamp=True)


@query("S20_partitioned_mart", "SELECT id, from_amount_usd, bridge FROM @fx_transfers", "from_amount_usd")
def _(t):
    path = new_path(t.spark, "mart")
    K.write_mart(K.with_month(t.fx_transfers.select("id", "bridge", "date", "from_amount_usd"), "date"), path, ["bridge"])
    return t.spark.read.parquet(path).select("id", "from_amount_usd", "bridge")


@query(
    "S24_flatten_records",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS status_code, '["' || o_orderpriority || '"]' AS tag_list FROM orders""",
)
def _(t):
    record = F.struct(
        F.struct(F.col("o_custkey").alias("Id")).alias("user"), F.struct(F.col("o_orderstatus").alias("code")).alias("status"), F.array("o_orderpriority").alias("tagList"), "o_orderkey"
    )
    rows = t.orders.select(F.to_json(record).alias("doc"))
    docs = D.parse_documents(rows, "doc", "user struct<Id:bigint>, status struct<code:string>, tagList array<string>, o_orderkey bigint")
    return D.flatten_records(docs, ["user__id", "status_code", "tag_list"]).withColumnRenamed("user__id", "user_id")


@query("S25_stablecoins", """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, s_acctbal AS price, '["c' || s_nationkey || '"]' AS chains FROM supplier WHERE s_suppkey % 4 <> 0""", "price")
def _(t):
    price = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_acctbal"))
    rows = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), price.alias("price"), F.array(F.concat(F.lit("c"), "s_nationkey")).alias("chains"),
        F.create_map(F.lit("c"), F.lit("1")).alias("chainCirculating"),
    )
    return D.stablecoin_snapshot(rows)


@query(
    "S26_typed_records",
    """SELECT line_id AS id, cents AS timestamp, 'S' || l_suppkey AS from_chain_symbol, CAST(cents AS VARCHAR) AS from_amount FROM @fx_document_lines""",
)
def _(t):
    record = F.struct(
        F.col("line_id").alias("id"), F.col("cents").alias("timestamp"),
        F.concat(F.lit("S"), "l_suppkey").alias("fromChainSymbol"), F.col("cents").cast("string").alias("fromAmount"),
    )
    rows = D.parse_documents(t.fx_document_lines.select(F.to_json(record).alias("doc")), "doc", SC.BRIDGE_TRANSFERS)
    return T.normalize_columns(rows, snake=True).select("id", "timestamp", "from_chain_symbol", "from_amount")


# --- incremental loads ------------------------------------------------------------------------------

CUT = "2024-01-15 12:00:00"


@query("I1_increment", f"SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{CUT}')")
def _(t):
    return I.increment(t.events, t.events.where(F.col("ts") <= CUT), "ts").select("event_id", "ts")


@query("I1_first_load", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def _(t):
    return I.increment(t.events, None, "ts", "2024-01-20 00:00:00").select("event_id")


@query(
    "I2_boundary_rows",
    """WITH h AS (SELECT event_id, date_trunc('hour', ts) AS ts FROM events), s AS (SELECT * FROM h WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' AND event_id % 2 = 0)
       SELECT event_id, ts FROM h WHERE ts > (SELECT max(ts) FROM s) OR (ts = (SELECT max(ts) FROM s) AND event_id NOT IN (SELECT event_id FROM s))""",
)
def _(t):
    rows = t.events.select("event_id", F.date_trunc("hour", "ts").alias("ts"))
    stored = rows.where((F.col("ts") <= CUT) & (F.col("event_id") % 2 == 0))
    return I.increment_with_boundary(rows, stored, "ts", "event_id").select("event_id", "ts")


@query("I6_merge_latest", "SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version FROM orders")
def _(t):
    base = t.orders.where("o_orderkey % 5 <> 0 OR o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", F.lit(1).alias("version"))
    delta = t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus", F.lit(2).alias("version"))
    return I.merge_latest(base, delta, ["o_orderkey"], "version")


@query("I6_reload_open", "SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 2 = 0 AND o_orderstatus IN ('F'))")
def _(t):
    return I.reload_open(t.orders.where("o_orderkey % 2 = 0"), t.orders, "o_orderkey", "o_orderstatus", ["F"]).select("o_orderkey")


@query("I9_complete_only", "SELECT event_id, ts FROM events WHERE ts <= (SELECT min(m) FROM (SELECT max(ts) AS m FROM events GROUP BY event_type) x)")
def _(t):
    return I.complete_only(t.events, "event_type", "ts").select("event_id", "ts")


@query("I5_new_keys", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)")
def _(t):
    base = t.supplier.where("s_nationkey < 12").select(F.col("s_suppkey").alias("l_suppkey"))
    return I.new_keys(t.lineitem.select("l_suppkey"), base, ["l_suppkey"])


# --- streams -----------------------------------------------------------------------------------------


def event_stream(t):
    return SF.watch_files(t.spark, t.sf_dir, TABLES["events"], fmt="parquet", pattern="events.parquet")


def finished(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@query("I4_new_files", "SELECT event_id, event_type, value FROM events", "value")
def _(t):
    path = new_path(t.spark, "loaded")
    finished(SF.load_new_files(event_stream(t).select("event_id", "event_type", "value"), path, path + "-state"))
    return t.spark.read.parquet(path)


@query("I5_append_once", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    path = new_path(t.spark, "once")
    finished(SF.append_once(event_stream(t).select("user_id", "event_type"), path, path + "-state", ["user_id", "event_type"]))
    return t.spark.read.parquet(path).select("user_id", "event_type")


@query("I5_stream_dedup", "SELECT count(DISTINCT (user_id, event_type)) AS n FROM events")
def _(t):
    path = new_path(t.spark, "dedup")
    rows = SF.deduplicated(event_stream(t).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "60 days")
    finished(SF.load_new_files(rows, path, path + "-state"))
    return t.spark.read.parquet(path).agg(F.count("*").alias("n"))


@query(
    "I7_stream_net_flow",
    f"""SELECT bucket AS date, chain, asset, inflow, outflow, inflow - outflow AS net_amount FROM ({sides_sql(bucket_sql(6))}) x
        WHERE bucket + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "inflow outflow net_amount",
)
def _(t):
    flows = event_stream(t).select(
        F.col("ts").alias("date"), F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("source"),
        F.concat(F.lit("c"), ((F.col("user_id") + F.col("event_id")) % 7).cast("string")).alias("target"), F.col("event_type").alias("asset"), F.col("value").alias("amount"),
    )
    path = new_path(t.spark, "flows")
    finished(SF.load_new_files(SL.windowed_net_flow(flows, "source", "target", "amount", "date", 6, "1 hour"), path, path + "-state"))
    return t.spark.read.parquet(path)


@query("I8_stream_batches", BATCH_SQL + "SELECT f.transfer_id, f.chain, f.asset, w.batch_id FROM f JOIN walk w USING (chain, asset, rn)")
def _(t):
    flows = event_stream(t).select(
        F.col("event_id").alias("transfer_id"), F.col("ts").alias("date"), F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("chain"), F.col("event_type").alias("asset")
    )
    path = new_path(t.spark, "batches")
    finished(SF.load_new_files(SL.batch_stream(flows, ["chain", "asset"], "date", "transfer_id", 20, 3), path, path + "-state"))
    return t.spark.read.parquet(path).select("transfer_id", "chain", "asset", "batch_id")
