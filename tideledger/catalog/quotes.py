"""Route quote, planning and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import CHAIN_ID_NAMES
from ..plans import bridges as B
from ..plans import quotes as Q
from ..sources.tables import literal
from .bridges import all_volume_sql, volume_input, hourly
from .fixtures import fixture
from .registry import query

CODES = "CASE {c} % 5 WHEN 0 THEN '1' WHEN 1 THEN '10' WHEN 2 THEN '137' WHEN 3 THEN '42161' ELSE '9999' END"


@fixture
def fx_route_steps(d):
    return f"""
    SELECT CAST(l_orderkey AS STRING) AS route_id, o_orderdate AS upload_datetime, l_linenumber AS step_index,
           'tool' || CAST(l_suppkey % 4 AS STRING) AS tooldetails_key, {CODES.format(c='o_custkey')} AS route_fromchainid,
           {CODES.format(c='l_orderkey')} AS route_tochainid, 'S' || CAST(o_custkey % 2 AS STRING) AS route_fromtoken_symbol,
           'S' || CAST(o_custkey % 2 AS STRING) AS route_totoken_symbol,
           CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING) AS route_fromamountusd,
           CAST(CAST(round(o_totalprice * 0.99) AS BIGINT) AS STRING) AS route_toamountusd, '2.5' AS route_gascostusd,
           CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE '0.5' END AS fee_amountusd, 'fee' AS fee_name
    FROM @lineitem JOIN @orders ON l_orderkey = o_orderkey"""


@fixture
def fx_quote_rows(d):
    return f"""
    SELECT l_shipdate AS upload_datetime,
           CASE WHEN l_linenumber = 4 THEN 'tool1' ELSE '[''tool' || CAST(l_suppkey % 4 AS STRING) || ''', ''tool' || CAST(l_partkey % 3 AS STRING) || ''']' END AS usedbridgenames,
           l_linenumber AS totalusertx, {CODES.format(c='l_suppkey')} AS fromchainid, {CODES.format(c='l_partkey')} AS tochainid,
           'S' || CAST(l_partkey % 2 AS STRING) AS fromasset_symbol, 'S' || CAST(l_partkey % 2 AS STRING) AS toasset_symbol,
           'S0' AS integratorfee_asset_symbol, l_extendedprice AS inputvalueinusd, l_extendedprice * (1 - l_discount) AS outputvalueinusd,
           l_quantity / 10 AS totalgasfeesinusd, l_extendedprice * (1 - l_discount) - l_quantity / 10 AS receivedvalueinusd
    FROM @lineitem"""


STEPS_SQL = """
    SELECT upload_datetime AS date, 'routes' AS aggregator, string_agg(tooldetails_key, ',' ORDER BY step_index, tooldetails_key) AS bridges,
           count(*) AS total_user_tx, route_fromchainid AS from_chain, route_tochainid AS to_chain, route_fromtoken_symbol AS from_token,
           route_totoken_symbol AS to_token, fee_name AS fee_type, CAST(route_fromamountusd AS DOUBLE) AS in_value_usd,
           CAST(route_toamountusd AS DOUBLE) AS out_value_usd, CAST(fee_amountusd AS DOUBLE) AS fee_usd, CAST(route_gascostusd AS DOUBLE) AS gas_fee,
           CAST(route_toamountusd AS DOUBLE) - CAST(route_gascostusd AS DOUBLE) - CAST(fee_amountusd AS DOUBLE) AS final_out_amount
    FROM @fx_route_steps GROUP BY route_id, upload_datetime, route_fromchainid, route_tochainid, route_fromtoken_symbol, route_totoken_symbol,
         route_fromamountusd, route_toamountusd, route_gascostusd, fee_amountusd, fee_name"""

QUOTES_SQL = r"""
    SELECT upload_datetime AS date, 'quotes' AS aggregator,
           coalesce(replace(nullif(regexp_extract(usedbridgenames, '\[(.*?)\]', 1), ''), '''', ''), usedbridgenames) AS bridges,
           totalusertx AS total_user_tx, fromchainid AS from_chain, tochainid AS to_chain, fromasset_symbol AS from_token,
           toasset_symbol AS to_token, integratorfee_asset_symbol AS fee_type, inputvalueinusd AS in_value_usd, outputvalueinusd AS out_value_usd,
           0.0::DOUBLE AS fee_usd, totalgasfeesinusd AS gas_fee, receivedvalueinusd AS final_out_amount
    FROM @fx_quote_rows"""

CLEAN_SQL = f"""
    SELECT *, rank() OVER (PARTITION BY date, from_chain, to_chain, from_token, to_token ORDER BY final_out_amount DESC NULLS LAST) AS max_value_rank_by_output
    FROM (SELECT DISTINCT * EXCLUDE (total_user_tx) FROM ({STEPS_SQL}) a UNION ALL SELECT DISTINCT * EXCLUDE (total_user_tx) FROM ({QUOTES_SQL}) b) u"""

QUOTE_DOUBLES = "in_value_usd out_value_usd fee_usd gas_fee final_out_amount"


def both(t):
    return Q.routes_from_steps(t.fx_route_steps, "routes"), Q.routes_from_quotes(t.fx_quote_rows, "quotes")


@query("D17_clean_quotes", CLEAN_SQL, QUOTE_DOUBLES)
def _(t):
    return Q.clean_quotes(*both(t))


@query(
    "D17_clean_quotes_since",
    CLEAN_SQL.replace("FROM @fx_route_steps GROUP", "FROM @fx_route_steps WHERE upload_datetime >= TIMESTAMP '1999-01-01' GROUP").replace(
        "FROM @fx_quote_rows", "FROM @fx_quote_rows WHERE upload_datetime >= TIMESTAMP '1999-01-01'"),
    QUOTE_DOUBLES,
)
def _(t):
    return Q.clean_quotes(*both(t), since="1999-01-01")


_NAMES = " ".join(f"WHEN {{c}} = '{k}' THEN '{v}'" for k, v in CHAIN_ID_NAMES.items())
# the power of ten that the size is within a tenth of, from 1k to 100k; 1k for others
_POWER = "10 ** round(log10(greatest(v, 1)))"
_LEVEL = f"if({_POWER} BETWEEN 1000 AND 100000 AND abs(v / ({_POWER}) - 1) <= 0.1, {_POWER}, 1000)"
RANK_SQL = f"""
    SELECT from_chain, to_chain, token, CAST(input_amount AS BIGINT) AS input_amount, bridge, price, best_bridge_rank FROM (
      SELECT *, dense_rank() OVER (PARTITION BY from_chain, to_chain, token, input_amount ORDER BY price DESC) AS best_bridge_rank FROM (
        SELECT CASE {_NAMES.format(c='from_chain')} ELSE from_chain END AS from_chain, CASE {_NAMES.format(c='to_chain')} ELSE to_chain END AS to_chain,
               from_token AS token, {_LEVEL} AS input_amount, bridges AS bridge, avg(o - (v - {_LEVEL})) AS price
        FROM (SELECT bridges, from_chain, to_chain, from_token, to_token, in_value_usd AS v, avg(final_out_amount) AS o
              FROM ({CLEAN_SQL}) c WHERE final_out_amount > 0 GROUP BY ALL) a GROUP BY ALL) p) r
    WHERE best_bridge_rank <= 2"""


@query("D18_rank_bridges", RANK_SQL, "price")
def _(t):
    return Q.rank_bridges(Q.distinct_quotes(*both(t)))


@query(
    "D19_best_route_vs_tracked",
    f"""WITH r AS MATERIALIZED (SELECT *, rank() OVER (PARTITION BY date, aggregator, from_chain, to_chain, from_token, to_token
                       ORDER BY final_out_amount DESC NULLS LAST) AS max_value_rank_by_output
                   FROM (SELECT * FROM ({STEPS_SQL}) a UNION ALL SELECT * FROM ({QUOTES_SQL}) b) u)
    SELECT b.*, c.out_value_usd AS tracked_out_value_usd, c.gas_fee AS tracked_gas_fee, c.final_out_amount AS tracked_final_out_amount,
           c.max_value_rank_by_output AS tracked_max_value_rank_by_output
    FROM r b LEFT JOIN (SELECT * FROM r WHERE bridges LIKE '%tool1%' OR bridges LIKE '%tool3%') c
      ON b.date = c.date AND b.from_chain = c.from_chain AND b.to_chain = c.to_chain AND b.from_token = c.from_token
      AND b.to_token = c.to_token AND b.in_value_usd = c.in_value_usd
    WHERE b.max_value_rank_by_output = 1""",
    QUOTE_DOUBLES + " tracked_out_value_usd tracked_gas_fee tracked_final_out_amount",
)
def _(t):
    a, b = both(t)
    return Q.best_route_vs_tracked(a.unionByName(b), F.col("bridges").rlike("tool1|tool3"))


@query(
    "D16_price_vs_volume",
    f"""WITH v AS (SELECT source_chain_name AS f, destination_chain_name AS g, currency_symbol AS s, sum(total_volume) AS volume
                   FROM ({all_volume_sql('day')}) x WHERE date >= TIMESTAMP '1994-01-02' GROUP BY ALL),
    q AS (SELECT 'CHAIN_' || from_chain AS from_chain, 'chain_' || to_chain AS to_chain, 'brand#' || substr(token, 2) AS token, input_amount, price, bridge,
                 best_bridge_rank FROM ({RANK_SQL.replace('CASE ' + _NAMES.format(c='from_chain') + ' ELSE from_chain END', 'from_chain').replace('CASE ' + _NAMES.format(c='to_chain') + ' ELSE to_chain END', 'to_chain')}) z)
    SELECT v.f AS from_chain, v.g AS to_chain, v.s AS token, input_amount, volume, 10000 * (1 - price / input_amount) AS bps, bridge, price, best_bridge_rank
    FROM v JOIN q ON lower(v.f) = lower(q.from_chain) AND lower(v.g) = lower(q.to_chain) AND lower(v.s) = lower(q.token)""",
    "volume bps price", places=3,
)
def _(t):
    prices = hourly(t)
    volume = B.all_bridge_volume(*[B.bridge_volume(volume_input(t, b), b, "day", prices) for b in ("A", "N", "R")])
    back = {v: k for k, v in CHAIN_ID_NAMES.items() if k in (1, 10, 137, 42161)}
    ids = literal(t.spark, [(k, str(v)) for k, v in back.items()], "chain string, code string")
    r = Q.rank_bridges(Q.distinct_quotes(*both(t)))
    for side, prefix in (("from", "CHAIN_"), ("to", "chain_")):
        named = ids.select(F.col("chain").alias(f"{side}_chain"), F.col("code").alias("__code"))
        r = r.join(F.broadcast(named), f"{side}_chain", "left")
        r = r.withColumn(f"{side}_chain", F.concat(F.lit(prefix), F.coalesce("__code", f"{side}_chain"))).drop("__code")
    r = r.withColumn("token", F.concat(F.lit("brand#"), F.substring("token", 2, 9)))
    return B.price_vs_volume(volume, r, as_of="2003-12-31", days=3650)


# --- planning ------------------------------------------------------------------------


@fixture
def fx_chain_tokens(d):
    # tokens S0..S4 on the chains that have a supplier selling the brand's parts
    return """
    SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS chain_id, 'S' || CAST(l_partkey % 5 AS STRING) AS symbol,
           '0xA' || CAST(s_nationkey AS STRING) || 'B' || CAST(l_partkey % 5 AS STRING) AS address,
           CASE WHEN l_partkey % 2 = 0 AND l_partkey % 5 = 0 THEN CAST(6 AS BIGINT) ELSE CAST(6 AS BIGINT) END AS decimals
    FROM @lineitem JOIN @supplier ON l_suppkey = s_suppkey"""


@fixture
def fx_latest_prices(d):
    return """
    SELECT symbol, avg(average_price) AS price FROM @fx_prices_hourly
    WHERE date = (SELECT max(date) FROM @fx_prices_hourly) GROUP BY symbol"""


@query(
    "D65_latest_prices",
    "SELECT symbol, avg(average_price) AS price FROM @fx_prices_hourly WHERE date = (SELECT max(date) FROM @fx_prices_hourly) GROUP BY 1", "price",
)
def _(t):
    return Q.latest_prices(t.fx_prices_hourly)


AMOUNTS, AGGREGATORS = (1000, 10000, 100000), ("routes", "quotes")


PLAN_SQL = f"""
    SELECT f.chain_id AS from_chain_id, g.chain_id AS to_chain_id, f.symbol, CAST(amount AS BIGINT) AS amount, round(amount / p.price * pow(10, f.decimals), 0) AS from_amount,
           f.address AS from_token_address, g.address AS to_token_address, '{Q.PLANNING_ADDRESS}' AS from_address, aggregator
    FROM @fx_chain_tokens f JOIN @fx_chain_tokens g ON f.symbol = g.symbol AND f.chain_id <> g.chain_id
    CROSS JOIN (SELECT CAST(unnest([1000, 10000, 100000]) AS INTEGER) AS amount) a CROSS JOIN (SELECT unnest(['routes', 'quotes']) AS aggregator) b
    LEFT JOIN @fx_latest_prices p ON f.symbol = p.symbol"""


def plan(t):
    return Q.plan_pathways(t.fx_chains, t.fx_chain_tokens, Q.latest_prices(t.fx_prices_hourly), AMOUNTS, AGGREGATORS)


@query("D20_plan_pathways", PLAN_SQL, "from_amount")
def _(t):
    return plan(t)


@query(
    "D20_supported_pathways",
    f"""SELECT DISTINCT * FROM ({PLAN_SQL}) p WHERE aggregator = 'quotes' AND from_chain_id IN (SELECT s_nationkey FROM supplier)
          AND to_chain_id IN (SELECT c_nationkey FROM customer) AND to_chain_id < 20
          AND EXISTS (SELECT 1 FROM @fx_chain_tokens k WHERE k.chain_id = from_chain_id AND k.address = from_token_address AND k.chain_id < 20)
          AND from_chain_id < 20""",
    "from_amount",
)
def _(t):
    known = t.fx_chain_tokens.where("chain_id < 20").withColumn("address", F.upper("address"))
    return Q.supported_pathways(plan(t), "quotes", known, chains=t.fx_chains)


@query(
    "D20_top_pathways",
    f"""SELECT TIMESTAMP '2024-02-13 10:00:00' AS hour, h.origin_chain_id AS from_chain_id, h.destination_chain_id AS to_chain_id,
               ceil(amount / p.price) * pow(10, f.decimals) AS from_amount, s.symbol AS asset, f.address AS from_token_address, f.decimals AS from_decimals,
               g.address AS to_token_address, g.decimals AS to_decimals, '{Q.PLANNING_ADDRESS}' AS from_address, aggregator, p.price, amount / p.price AS amount_value
        FROM (SELECT DISTINCT from_id AS origin_chain_id, to_id AS destination_chain_id FROM @fx_moves) h
        CROSS JOIN (SELECT unnest(['S0', 'S1', 'S2', 'S3', 'S4']) AS symbol) s CROSS JOIN (SELECT CAST(unnest([1000, 10000, 100000]) AS INTEGER) AS amount) a
        CROSS JOIN (SELECT unnest(['routes', 'quotes']) AS aggregator) b
        LEFT JOIN @fx_chain_tokens f ON s.symbol = f.symbol AND h.origin_chain_id = f.chain_id
        LEFT JOIN @fx_chain_tokens g ON s.symbol = g.symbol AND h.destination_chain_id = g.chain_id
        LEFT JOIN @fx_latest_prices p ON s.symbol = p.symbol""",
    "from_amount price amount_value",
)
def _(t):
    pairs = t.fx_moves.select(F.col("from_id").alias("origin_chain_id"), F.col("to_id").alias("destination_chain_id")).distinct()
    return Q.top_pathways(
        pairs, ["S0", "S1", "S2", "S3", "S4"], t.fx_chain_tokens, Q.latest_prices(t.fx_prices_hourly), AMOUNTS, AGGREGATORS, "2024-02-13 10:20:30"
    )


@query(
    "D20_plan_power_amounts",
    """SELECT DISTINCT from_chain_id, from_token_address, to_chain_id, to_token_address, pow(10, round_even(log10(raw), 0)) AS from_amount FROM (
         SELECT h.from_id AS from_chain_id, f.address AS from_token_address, h.to_id AS to_chain_id, g.address AS to_token_address,
                floor(pow(10, f.decimals) * pow(10, CAST(pw AS DOUBLE)) / p.price) AS raw
         FROM (SELECT DISTINCT from_id, to_id FROM @fx_moves) h JOIN @fx_chain_tokens f ON h.from_id = f.chain_id
         JOIN @fx_chain_tokens g ON h.to_id = g.chain_id AND f.symbol = g.symbol JOIN @fx_latest_prices p ON f.symbol = p.symbol
         CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6]) AS pw) x) y""",
    "from_amount", places=0,
)
def _(t):
    pairs = t.fx_moves.select(F.col("from_id").alias("from_chain_id"), F.col("to_id").alias("to_chain_id")).distinct()
    tokens = t.fx_chain_tokens.join(Q.latest_prices(t.fx_prices_hourly).withColumnRenamed("price", "price_usd"), "symbol")
    return Q.plan_power_amounts(pairs, tokens, ["S0", "S1", "S2", "S3", "S4"])


@query(
    "D20_alternative_pairs",
    """SELECT DISTINCT CAST(h.from_id AS BIGINT) AS from_chain_id, f.name AS from_chain_name, CAST(h.to_id AS BIGINT) AS to_chain_id, g.name AS to_chain_name, aggregator
       FROM @fx_moves h LEFT JOIN @fx_chains f ON h.from_id = f.chain_id LEFT JOIN @fx_chains g ON h.to_id = g.chain_id
       CROSS JOIN (SELECT unnest(['routes', 'quotes']) AS aggregator) b""",
)
def _(t):
    tools = t.fx_moves.select(F.col("from_id").alias("from_chain_id"), F.col("to_id").alias("to_chain_id"))
    return Q.alternative_pairs(tools, t.fx_chains, AGGREGATORS)


@fixture
def fx_served(d):
    return """
    SELECT from_id AS from_chain_id, '0x' || p_brand AS from_token_address, to_id AS to_chain_id, '0x' || l_returnflag AS to_token_address,
           CASE WHEN l_linenumber = 6 THEN 'none' ELSE CAST(cents AS STRING) END AS from_amount
    FROM @fx_moves WHERE l_linestatus = 'F' AND l_linenumber < 4 OR l_linenumber = 6"""


@fixture
def fx_configured(d):
    return """
    SELECT from_id AS from_chain_id, '0x' || p_brand AS from_token_address, to_id AS to_chain_id, '0x' || l_returnflag AS to_token_address FROM @fx_moves"""


WORKING_SQL = """
    SELECT DISTINCT from_chain_id, from_token_address, to_chain_id, to_token_address, pow(10, round(log10(TRY_CAST(from_amount AS DOUBLE)))) AS from_amount
    FROM @fx_served WHERE TRY_CAST(from_amount AS DOUBLE) IS NOT NULL"""


@query("D21_working_pathways", WORKING_SQL, "from_amount", places=0)
def _(t):
    return Q.working_pathways(t.fx_served)


@query(
    "D21_skipped_pathways",
    f"""SELECT DISTINCT c.*, fn.name AS from_token_name, tn.name AS to_token_name FROM @fx_configured c
        LEFT JOIN (SELECT DISTINCT '0x' || p_brand AS a, lower(p_brand) AS name FROM part) fn ON c.from_token_address = fn.a
        LEFT JOIN (SELECT DISTINCT '0x' || p_brand AS a, lower(p_brand) AS name FROM part) tn ON c.to_token_address = tn.a
        WHERE NOT EXISTS (SELECT 1 FROM ({WORKING_SQL}) w WHERE w.from_chain_id = c.from_chain_id AND w.to_chain_id = c.to_chain_id
                          AND w.from_token_address = c.from_token_address AND w.to_token_address = c.to_token_address)""",
)
def _(t):
    names = t.part.select(F.concat(F.lit("0x"), "p_brand").alias("token_address"), F.lower("p_brand").alias("token_name")).distinct()
    return Q.skipped_pathways(t.fx_configured, Q.working_pathways(t.fx_served), names)


@query(
    "D21_calculated_pathways",
    """SELECT DISTINCT c.*, pow(10, round(log10(TRY_CAST(s.from_amount AS DOUBLE)))) AS nearest_power_of_ten_amount
       FROM @fx_configured c LEFT JOIN @fx_served s USING (from_chain_id, from_token_address, to_chain_id, to_token_address)""",
    "nearest_power_of_ten_amount", places=0,
)
def _(t):
    return Q.calculated_pathways(t.fx_served, t.fx_configured)


# --- registries -------------------------------------------------------------------------


@fixture
def fx_bridge_registry(d):
    return """
    SELECT s_suppkey AS id, s_name AS display_name,
           '["chain_' || CAST(s_nationkey AS STRING) || '","chain_' || CAST(s_suppkey % 11 AS STRING) || '"]' AS chains
    FROM @supplier"""


@query(
    "D22_bridge_chain_pairs",
    """SELECT id, unnest(from_json(chains, '["VARCHAR"]')) AS name FROM @fx_bridge_registry""",
)
def _(t):
    return Q.bridge_chain_pairs(t.fx_bridge_registry)


@fixture
def fx_history(d):
    return """
    SELECT 'https://x/stats/' || CAST(l_orderkey AS STRING) || '/chain_' || CAST(from_id AS STRING) || '?id=' || CAST(l_suppkey AS STRING) AS url,
           l_orderkey AS date, CASE WHEN l_linenumber = 1 THEN 'nocolon' ELSE 'slug:0x' || CAST(l_partkey AS STRING) END AS key,
           CASE WHEN l_linenumber % 3 = 0 THEN 'totalTokensDeposited' WHEN l_linenumber % 3 = 1 THEN 'totalTokensWithdrawn' ELSE 'totalOther' END AS token_type,
           CASE WHEN l_linenumber % 2 = 0 THEN 'totalAddressDeposited' ELSE 'totalAddressWithdrawn' END AS wallet_type,
           p_brand AS symbol, l_linenumber AS decimals, l_extendedprice AS usd_value, l_partkey AS txs
    FROM @fx_moves"""


def history_sql(kind: str, address: str, rest: str) -> str:
    return rf"""
    SELECT b.display_name AS name, url AS api_url, date, CAST(regexp_extract(url, 'id=(\d+)', 1) AS BIGINT) AS bridge_id,
           nullif(regexp_extract(url, '/(\d+)/', 1), '') AS timestamp, nullif(regexp_extract(url, '([^/]+)\?', 1), '') AS chain,
           nullif(regexp_extract(key, '([^:]+)', 1), '') AS chain_slug, nullif(regexp_extract(key, ':(.+)', 1), '') AS {address},
           CASE WHEN {kind} LIKE '%Deposited' THEN 'deposit' WHEN {kind} LIKE '%Withdrawn' THEN 'withdrawal' END AS tx_type, {rest}, c.chain_id
    FROM @fx_history h JOIN @fx_bridge_registry b ON CAST(regexp_extract(url, 'id=(\d+)', 1) AS BIGINT) = b.id
    JOIN (SELECT 'chain_' || n_nationkey AS name, CAST(n_nationkey AS BIGINT) AS chain_id FROM nation WHERE n_nationkey < 20) c
      ON regexp_extract(url, '([^/]+)\?', 1) = c.name"""


def history_chains(t):
    return t.nation.where("n_nationkey < 20").select(
        F.concat(F.lit("chain_"), F.col("n_nationkey")).alias("name"), F.col("n_nationkey").cast("bigint").alias("chain_id")
    )


@query("D23_parse_day_stats_tokens", history_sql("token_type", "token_address", "symbol, CAST(decimals AS BIGINT) AS decimals, usd_value"), "usd_value")
def _(t):
    return Q.parse_day_stats(t.fx_history.withColumnRenamed("token_type", "key_type"), t.fx_bridge_registry, history_chains(t))


@query("D23_parse_day_stats_wallets", history_sql("wallet_type", "wallet_address", "usd_value, txs"), "usd_value")
def _(t):
    stats = t.fx_history.withColumnRenamed("wallet_type", "key_type")
    return Q.parse_day_stats(stats, t.fx_bridge_registry, history_chains(t), wallets=True)


@fixture
def fx_assets(d):
    return """
    SELECT CAST(p_partkey % 25 AS STRING) AS domain, '0x' || md5(p_brand) AS canonical_id, 'l' || md5(CAST(p_partkey AS STRING)) AS local,
           'A' || md5(p_name) AS adopted, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '18' END AS decimal, '6' AS adopted_decimal
    FROM @part"""


@fixture
def fx_registry(d):
    return """
    SELECT CASE WHEN p_partkey % 25 = 1 THEN 'xDAI Chain' ELSE 'chain_' || CAST(p_partkey % 25 AS STRING) END AS name,
           CAST(p_partkey % 25 AS STRING) AS domainid, p_brand AS asset_symbol, 'L' || upper(md5(CAST(p_partkey AS STRING))) AS asset_key,
           md5(p_brand) AS asset_mainnetequivalent, CAST(p_size AS STRING) AS asset_decimals
    FROM @part WHERE p_size < 40"""


@query(
    "D24_chain_token_registry",
    """SELECT CASE WHEN n.name = 'xDAI Chain' THEN 'Gnosis' ELSE n.name END AS chain_name, n.domainid, n.asset_symbol, n.asset_key AS asset,
              n.asset_mainnetequivalent AS canonical_asset_address, lower(a.local) AS local, lower(a.adopted) AS adopted,
              coalesce(CAST(a.decimal AS BIGINT), CAST(n.asset_decimals AS BIGINT)) AS asset_decimals
       FROM @fx_assets a JOIN @fx_registry n ON a.domain = n.domainid AND a.local = lower(n.asset_key)""",
)
def _(t):
    return Q.chain_token_registry(t.fx_assets, t.fx_registry)
