"""Message-bridge transfer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import transfers as T
from .fixtures import fixture
from .registry import query

DOMAIN = "CASE {c} % 4 WHEN 0 THEN '6648936' WHEN 1 THEN '6450786' WHEN 2 THEN '1634886255' ELSE '1835365481' END"
ZERO = "0x0000000000000000000000000000000000000000"


@fixture
def fx_public_transfers(d):
    address = "'0x' || md5('S' || CAST({c} % 5 AS STRING))"
    own = f"{address.format(c='l_partkey')}"
    return f"""
    SELECT move_id AS transfer_id, 'S' || CAST(l_partkey % 5 AS STRING) AS canonical_id, '0xC' || CAST(o_custkey % 50 AS STRING) AS xcall_caller,
           CASE WHEN l_linenumber % 2 = 0 THEN '0xc' || CAST(o_custkey % 50 AS STRING) ELSE '0xd' || CAST(o_custkey AS STRING) END AS xcall_tx_origin,
           {d.epoch('ts')} + (l_suppkey * 7) % 3600 AS xcall_timestamp, {DOMAIN.format(c='from_id')} AS origin_domain,
           {DOMAIN.format(c='to_id')} AS destination_domain, {own} AS origin_transacting_asset,
           CASE WHEN l_suppkey % 2 = 0 THEN 'a' || md5('S' || CAST(l_partkey % 5 AS STRING)) ELSE {own} END AS destination_transacting_asset,
           CAST(cents AS STRING) || '0000' AS origin_transacting_amount, CAST(out_cents AS STRING) || '0000' AS origin_bridged_amount,
           CAST(out_cents - 3 AS STRING) || '0000' AS destination_local_amount, CAST(out_cents - 5 AS STRING) || '0000' AS destination_transacting_amount,
           CASE l_returnflag WHEN 'A' THEN 'CompletedFast' WHEN 'N' THEN 'CompletedSlow' ELSE 'XCalled' END AS status,
           CASE l_returnflag WHEN 'A' THEN '["r' || CAST(l_suppkey % 9 AS STRING) || '"]' ELSE '[]' END AS routers,
           CASE l_linenumber % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN '{{"{ZERO}":"' || CAST(cents AS STRING) || '000000000"}}'
                WHEN 2 THEN '{{"{ZERO}":"' || CAST(cents AS STRING) || '000000000","' || {own} || '":"2500000"}}'
                ELSE '{{"' || {own} || '":"1500000"}}' END AS relayer_fees,
           'h' || move_id AS xcall_transaction_hash, 'e' || move_id AS execute_transaction_hash, '30000000000' AS xcall_gas_price,
           CAST(200000 + l_partkey AS STRING) AS xcall_gas_limit, l_extendedprice AS usd_amount
    FROM @fx_moves"""


@fixture
def fx_domain_assets(d):
    return f"""
    SELECT DISTINCT 'S' || CAST(p_partkey % 5 AS STRING) AS canonical_id, {DOMAIN.format(c='p_partkey')} AS domain,
           '0x' || md5('S' || CAST(p_partkey % 5 AS STRING)) AS local, 'a' || md5('S' || CAST(p_partkey % 5 AS STRING)) AS adopted,
           CASE WHEN p_partkey % 4 = 1 THEN '7' ELSE '6' END AS decimal, CASE WHEN p_partkey % 5 = 0 THEN '5' ELSE '6' END AS adopted_decimal
    FROM @part"""


@fixture
def fx_asset_prices(d):
    return f"""
    SELECT 'S' || CAST(o_custkey % 5 AS STRING) AS canonical_id, {d.epoch('o_orderdate')} + o_orderkey % 86400 AS timestamp,
           1 + o_totalprice / 100000 AS price
    FROM @orders"""


@fixture
def fx_contracts(d):
    return """
    SELECT DISTINCT '0xc' || CAST(c_custkey % 50 AS STRING) AS xcall_caller, 'name' || CAST(c_custkey % 50 AS STRING) AS contract_name,
           CASE c_custkey % 50 % 3 WHEN 0 THEN 'LiFi' WHEN 1 THEN 'Socket' ELSE 'Other' END AS contract_author
    FROM @customer WHERE c_custkey % 50 < 30"""


@fixture
def fx_known_tokens(d):
    return """
    SELECT DISTINCT '0x' || md5('S' || CAST(p_partkey % 5 AS STRING)) AS token_address,
           CASE WHEN p_partkey % 5 = 3 THEN 'nextS3' ELSE 'S' || CAST(p_partkey % 5 AS STRING) END AS token_name,
           CASE WHEN p_partkey % 5 = 1 THEN 'true' ELSE 'false' END AS is_xerc20
    FROM @part WHERE p_partkey % 5 <> 4"""


_CHAIN = "CASE {c} WHEN '6648936' THEN 'Ethereum' WHEN '6450786' THEN 'BNB' WHEN '1634886255' THEN 'Arbitrum One' WHEN '1835365481' THEN 'Metis' END"

ENRICHED = f"""
    SELECT t.*, c.contract_name, c.contract_author, CASE WHEN lower(t.xcall_caller) <> lower(t.xcall_tx_origin) THEN 'Contract' ELSE 'EOA' END AS caller_type,
           {_CHAIN.format(c='t.origin_domain')} AS origin_chain, {_CHAIN.format(c='t.destination_domain')} AS destination_chain,
           coalesce(ot.token_name, t.origin_transacting_asset) AS origin_asset, coalesce(dt.token_name, t.destination_transacting_asset) AS destination_asset,
           CAST(ot.is_xerc20 AS BOOLEAN) AS is_origin_asset_xerc20, CAST(dt.is_xerc20 AS BOOLEAN) AS is_destination_asset_xerc20,
           make_timestamp(t.xcall_timestamp * 1000000) AS xcall_date
    FROM @fx_public_transfers t LEFT JOIN @fx_contracts c ON lower(t.xcall_caller) = lower(c.xcall_caller)
    LEFT JOIN @fx_known_tokens ot ON t.origin_transacting_asset = ot.token_address
    LEFT JOIN @fx_known_tokens dt ON t.destination_transacting_asset = dt.token_address"""


def asof_sql(where: str = "TRUE", per_domain: bool = True) -> str:
    if per_domain:
        decimals = """LEFT JOIN @fx_domain_assets oa ON e.canonical_id = oa.canonical_id AND e.origin_domain = oa.domain
        LEFT JOIN @fx_domain_assets da ON e.canonical_id = da.canonical_id AND e.destination_domain = da.domain"""
    else:
        ids = "(SELECT DISTINCT canonical_id, decimal FROM @fx_domain_assets)"
        decimals = f"LEFT JOIN {ids} oa ON e.canonical_id = oa.canonical_id LEFT JOIN {ids} da ON e.canonical_id = da.canonical_id AND oa.decimal = da.decimal"
    return f"""
    WITH e AS (SELECT * EXCLUDE (is_origin_asset_xerc20, is_destination_asset_xerc20) FROM ({ENRICHED}) x WHERE {where}),
    tick AS (SELECT canonical_id, timestamp - timestamp % 1800 AS b, max(price) AS price FROM @fx_asset_prices GROUP BY ALL),
    w AS (SELECT e.*, oa.decimal AS token_origin_decimal, da.decimal AS token_destination_decimal,
                 CAST(origin_bridged_amount AS DOUBLE) / pow(10, coalesce(CAST(oa.decimal AS BIGINT), 0)) AS d_origin_amount,
                 CAST(destination_transacting_amount AS DOUBLE) / pow(10, coalesce(CAST(da.decimal AS BIGINT), 0)) AS d_destination_amount,
                 xcall_timestamp - xcall_timestamp % 1800 AS b FROM e {decimals})
    SELECT w.* EXCLUDE (b), k.price, d_origin_amount * k.price AS usd_origin_amount, d_destination_amount * k.price AS usd_destination_amount
    FROM w ASOF LEFT JOIN tick k ON w.canonical_id = k.canonical_id AND w.b >= k.b"""


USD_DOUBLES = "usd_amount d_origin_amount d_destination_amount price usd_origin_amount usd_destination_amount"


def tables(t):
    return t.fx_public_transfers, t.fx_contracts, t.fx_known_tokens, t.fx_domain_assets


@query("D35_transfers_usd_asof", asof_sql(), USD_DOUBLES)
def _(t):
    return T.transfers_usd(*tables(t), t.fx_asset_prices)


@query(
    "D35_transfers_usd_month",
    asof_sql("xcall_date >= TIMESTAMP '1997-12-01' AND xcall_date < TIMESTAMP '1998-01-01'", per_domain=False), USD_DOUBLES,
)
def _(t):
    return T.transfers_usd(*tables(t), t.fx_asset_prices, month=(1997, 12), per_domain=False)


HOURLY_SQL = f"""
    WITH e AS ({ENRICHED}),
    p AS (SELECT CASE WHEN symbol = 'ETH' THEN 'WETH' ELSE regexp_replace(symbol, '^next', '') END AS symbol, date_trunc('hour', date) AS date,
                 avg(average_price) AS price FROM @fx_prices_hourly GROUP BY ALL),
    w AS (SELECT e.*, p.price, coalesce(contract_author IN ('LiFi', 'Socket'), false) AS is_aggregator,
                 CASE WHEN origin_asset LIKE 'next%' OR destination_asset LIKE 'next%' THEN 'nextAsset' WHEN contract_author = 'LiFi' THEN 'LiFi'
                      WHEN contract_author = 'Socket' THEN 'Socket' ELSE 'Bridge - Other' END AS user_group,
                 CAST(origin_transacting_amount AS DOUBLE) / pow(10, coalesce(CAST(oa.adopted_decimal AS BIGINT), 0)) AS d_origin_amount,
                 CAST(origin_bridged_amount AS DOUBLE) / pow(10, coalesce(CAST(oa.decimal AS BIGINT), 0)) AS d_bridged_amount,
                 CAST(destination_transacting_amount AS DOUBLE) / pow(10, coalesce(CAST(da.adopted_decimal AS BIGINT), 0)) AS d_destination_amount
          FROM e LEFT JOIN @fx_domain_assets oa ON e.canonical_id = oa.canonical_id AND e.origin_domain = oa.domain
          LEFT JOIN @fx_domain_assets da ON e.canonical_id = da.canonical_id AND e.destination_domain = da.domain
          LEFT JOIN p ON e.destination_asset = p.symbol AND date_trunc('hour', e.xcall_date) = p.date)
    SELECT *, d_origin_amount * price AS usd_origin_amount, d_bridged_amount * price AS usd_bridged_amount, d_destination_amount * price AS usd_destination_amount FROM w"""


def enriched_hourly(t):
    return T.transfers_usd_hourly(*tables(t), t.fx_prices_hourly)


@query(
    "D36_transfers_usd_hourly", HOURLY_SQL,
    "usd_amount price d_origin_amount d_bridged_amount d_destination_amount usd_origin_amount usd_bridged_amount usd_destination_amount",
)
def _(t):
    return enriched_hourly(t)


SLIPPAGE_SQL = f"""
    WITH long AS (SELECT DISTINCT domain, unnest([local, adopted]) AS address, decimal FROM @fx_domain_assets),
    w AS (SELECT t.*, CAST(json_extract_string(relayer_fees, '$."{ZERO}"') AS DOUBLE) / 1e18 AS gas_fee,
                 CAST(nullif(regexp_extract(regexp_replace(relayer_fees, '"{ZERO}":"[^"]*",?', ''), ':"(\\d+)"', 1), '') AS DOUBLE)
                   / pow(10, CAST(oa.decimal AS BIGINT)) AS token_fee,
                 CAST(origin_transacting_amount AS DOUBLE) / pow(10, CAST(oa.decimal AS BIGINT)) AS sent,
                 CAST(origin_bridged_amount AS DOUBLE) / pow(10, CAST(oa.decimal AS BIGINT)) AS bridged,
                 CAST(destination_local_amount AS DOUBLE) / pow(10, CAST(oa.decimal AS BIGINT)) AS loc,
                 CAST(destination_transacting_amount AS DOUBLE) / pow(10, CAST(da.decimal AS BIGINT)) AS got
          FROM @fx_public_transfers t LEFT JOIN long oa ON t.origin_domain = oa.domain AND t.origin_transacting_asset = oa.address
          LEFT JOIN long da ON t.destination_domain = da.domain AND t.destination_transacting_asset = da.address)
    SELECT transfer_id, xcall_timestamp, origin_domain, destination_domain, origin_transacting_asset, destination_transacting_asset,
           sent AS exact_origin_transacting_amount, CASE WHEN token_fee IS NULL THEN sent ELSE sent - token_fee END AS exact_origin_transacting_amount_without_relayer_fees,
           bridged AS exact_origin_bridged_amount, loc AS exact_destination_local_amount, got AS exact_destination_transacting_amount,
           gas_fee AS exact_relayer_fee_gas_amount, token_fee AS exact_relayer_fee_token_amount, bridged - sent AS source_stableswap_slippage,
           got - loc AS destination_stableswap_slippage, (bridged - sent) + (got - loc) AS total_stableswap_slippage FROM w"""


@query(
    "D37_transfers_slippage", SLIPPAGE_SQL,
    "exact_origin_transacting_amount exact_origin_transacting_amount_without_relayer_fees exact_origin_bridged_amount exact_destination_local_amount "
    "exact_destination_transacting_amount exact_relayer_fee_gas_amount exact_relayer_fee_token_amount source_stableswap_slippage "
    "destination_stableswap_slippage total_stableswap_slippage",
    places=5,
)
def _(t):
    return T.transfers_slippage(t.fx_public_transfers, t.fx_domain_assets)


DAY = "date_trunc('day', xcall_date) AS xcall_date"


@query("D38_user_counts", f"SELECT {DAY}, count(DISTINCT xcall_caller) AS callers FROM ({HOURLY_SQL}) h GROUP BY 1")
def _(t):
    return T.user_counts(enriched_hourly(t))


_FLAG = "coalesce(is_origin_asset_xerc20, false) OR coalesce(is_destination_asset_xerc20, false) AS x_erc_20_asset"


@query(
    "D38_category_counts_users",
    f"SELECT {DAY}, {_FLAG}, caller_type, status, count(DISTINCT xcall_caller) AS callers FROM ({HOURLY_SQL}) h GROUP BY ALL",
)
def _(t):
    return T.category_counts(enriched_hourly(t))


@query(
    "D38_category_counts_transfers",
    f"SELECT {DAY}, {_FLAG}, caller_type, status, count(DISTINCT transfer_id) AS transfers FROM ({HOURLY_SQL}) h GROUP BY ALL",
)
def _(t):
    return T.category_counts(enriched_hourly(t), "transfer_id", "transfers")


_ROUTE = "origin_chain, destination_chain, origin_asset, destination_asset"


@query(
    "D38_transfer_counts",
    f"""SELECT {DAY}, {_ROUTE}, count(DISTINCT transfer_id) AS transfers, count(DISTINCT xcall_caller) AS callers,
               sum(usd_bridged_amount) AS usd_bridged_amount FROM ({HOURLY_SQL}) h GROUP BY ALL""",
    "usd_bridged_amount",
)
def _(t):
    return T.transfer_counts(enriched_hourly(t))


@query(
    "D38_bridge_volume_daily", f"SELECT {DAY}, {_ROUTE}, sum(usd_bridged_amount) AS usd_bridged_amount FROM ({HOURLY_SQL}) h GROUP BY ALL",
    "usd_bridged_amount",
)
def _(t):
    return T.bridge_volume_daily(enriched_hourly(t))


@query(
    "D38_amount_cohorts",
    """SELECT CAST(make_timestamp(xcall_timestamp * 1000000) AS DATE) AS date,
              CASE WHEN usd_amount < 10 THEN '<10$' WHEN usd_amount <= 100 THEN '10-100$' WHEN usd_amount <= 1000 THEN '100-1000$'
                   WHEN usd_amount <= 10000 THEN '1000-10000$' WHEN usd_amount > 10000 THEN '>10000$' END AS amount_bucket,
              count(transfer_id) AS transfer_count, sum(usd_amount) AS volume, sum(CASE WHEN status = 'CompletedFast' THEN usd_amount ELSE 0 END) AS fast_volume,
              sum(CASE WHEN status = 'CompletedSlow' THEN usd_amount ELSE 0 END) AS slow_volume,
              count(CASE WHEN status = 'CompletedFast' THEN 1 END) AS fast_transfer_count, count(CASE WHEN status = 'CompletedSlow' THEN 1 END) AS slow_transfer_count
       FROM @fx_public_transfers GROUP BY ALL""",
    "volume fast_volume slow_volume", dates="date",
)
def _(t):
    return T.amount_cohorts(t.fx_public_transfers.withColumn("xcall_date", F.timestamp_seconds("xcall_timestamp")))


# --- fees ------------------------------------------------------------------------------


@fixture
def fx_fee_prices(d):
    # symbols S0..S4 plus the gas tokens
    return """
    SELECT symbol, date, avg(average_price) AS price FROM (
      SELECT symbol, date, average_price FROM @fx_prices_hourly
      UNION ALL SELECT CASE symbol WHEN 'S0' THEN 'WETH' WHEN 'S1' THEN 'BNB' ELSE 'METIS' END, date, average_price * 100 FROM @fx_prices_hourly
      WHERE symbol IN ('S0', 'S1', 'S2')) x GROUP BY symbol, date"""


@fixture
def fx_deposits(d):
    return """
    SELECT 'h' || move_id AS hash, '0xU' || CAST(o_custkey AS STRING) AS from_address, ts AS timestamp FROM @fx_moves
    WHERE l_linenumber < 6 AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""


@fixture
def fx_deposit_list(d):
    # every transfer once, its chain spelled in one of several ways
    return """
    SELECT xcall_transaction_hash AS hash, xcall_caller AS user_address,
           CASE origin_domain WHEN '6648936' THEN 'ethereum' WHEN '6450786' THEN CASE WHEN xcall_timestamp % 2 = 0 THEN 'bnb' ELSE 'BNB' END
                WHEN '1835365481' THEN '1835365481' ELSE 'Arbitrum One' END AS origin_chain
    FROM @fx_public_transfers WHERE origin_domain <> '6450786' OR xcall_timestamp % 3 > 0"""


@fixture
def fx_deposit_rest(d):
    return """
    SELECT xcall_transaction_hash AS hash, upper(xcall_caller) AS from_address FROM @fx_public_transfers
    WHERE origin_domain = '6450786' AND xcall_timestamp % 3 = 0"""


# domain, name in fee reports
_FEE_CHAINS = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in T.FEE_CHAINS.items()) + ") fee_chains(domain, label)"
_GAS = "CASE origin_domain WHEN '1835365481' THEN 'METIS' WHEN '6450786' THEN 'BNB' ELSE 'WETH' END"
_GROUP = "CASE WHEN {c} = 'ETH' THEN 'WETH' ELSE regexp_replace({c}, '^next', '') END"
FEES_SQL = f"""
    WITH names AS (SELECT DISTINCT lower(token_address) AS local, token_name AS asset FROM @fx_known_tokens),
    keyed AS (SELECT t.*, json_keys(relayer_fees) AS ks FROM @fx_public_transfers t WHERE status IN ('CompletedSlow', 'CompletedFast')),
    f AS (SELECT t.*, ks[1] AS k1, ks[2] AS k2, CAST(json_extract_string(relayer_fees, '$."' || ks[1] || '"') AS DOUBLE) AS v1,
                 CAST(json_extract_string(relayer_fees, '$."' || ks[2] || '"') AS DOUBLE) AS v2, {_GAS} AS gas_asset,
                 coalesce(n.asset, t.origin_transacting_asset) AS origin_asset, coalesce(m.asset, t.destination_transacting_asset) AS destination_asset,
                 coalesce(CAST(oa.adopted_decimal AS BIGINT), 18) AS od, coalesce(CAST(da.adopted_decimal AS BIGINT), 0) AS dd
          FROM keyed t LEFT JOIN names n ON lower(t.origin_transacting_asset) = n.local LEFT JOIN names m ON lower(t.destination_transacting_asset) = m.local
          LEFT JOIN @fx_domain_assets oa ON t.canonical_id = oa.canonical_id AND t.origin_domain = oa.domain
          LEFT JOIN @fx_domain_assets da ON t.canonical_id = da.canonical_id AND t.destination_domain = da.domain),
    g AS (SELECT f.*, CASE WHEN k1 = origin_transacting_asset THEN n1.asset ELSE gas_asset END AS relay_1_asset,
                 CASE WHEN k1 = origin_transacting_asset THEN v1 / pow(10, od) ELSE v1 / 1e18 END AS relay_1_amount,
                 CASE WHEN k2 IS NULL THEN NULL WHEN k2 = origin_transacting_asset THEN n2.asset ELSE gas_asset END AS relay_2_asset,
                 CASE WHEN k2 IS NULL THEN NULL WHEN k2 = origin_transacting_asset THEN v2 / pow(10, od) ELSE v2 / 1e18 END AS relay_2_amount,
                 CAST(xcall_gas_price AS DOUBLE) * CAST(xcall_gas_limit AS DOUBLE) / 1e18 AS gas_amount, origin_asset AS amm_asset, origin_asset AS router_asset,
                 CAST(origin_transacting_amount AS DOUBLE) / pow(10, od) * CASE WHEN origin_domain IN ('6450786', '6648936') THEN 0.0008::DOUBLE ELSE 0.0013::DOUBLE END AS amm_amount,
                 CAST(origin_transacting_amount AS DOUBLE) / pow(10, od) * 0.0005::DOUBLE AS router_amount,
                 CAST(destination_transacting_amount AS DOUBLE) / pow(10, dd) AS destination_amount, make_timestamp(xcall_timestamp * 1000000) AS date,
                 coalesce(fo.label, origin_domain) AS origin_chain, coalesce(fd.label, destination_domain) AS destination_chain
          FROM f LEFT JOIN {_FEE_CHAINS.replace("fee_chains(", "fo(")} ON fo.domain = origin_domain
          LEFT JOIN {_FEE_CHAINS.replace("fee_chains(", "fd(")} ON fd.domain = destination_domain LEFT JOIN names n1 ON lower(k1) = n1.local LEFT JOIN names n2 ON lower(k2) = n2.local)
    SELECT transfer_id, xcall_transaction_hash, g.date, origin_chain, destination_chain, destination_asset, gas_asset, relay_1_asset, relay_2_asset, amm_asset,
           router_asset, gas_amount, relay_1_amount, relay_2_amount, amm_amount, router_amount, destination_amount,
           {', '.join(f'{k}_amount * p_{k}.price AS usd_{k}_amount' for k in (*T.FEES, 'destination'))}
    FROM g {' '.join(f"LEFT JOIN @fx_fee_prices p_{k} ON {_GROUP.format(c=k + '_asset')} = p_{k}.symbol AND date_trunc('hour', g.date) = p_{k}.date" for k in (*T.FEES, 'destination'))}"""

FEE_DOUBLES = " ".join(f"{p}{k}_amount" for p in ("", "usd_") for k in (*T.FEES, "destination"))


def fees(t):
    return T.transfer_fees(t.fx_public_transfers, t.fx_domain_assets, t.fx_known_tokens, t.fx_fee_prices)


@query("D39_transfer_fees", FEES_SQL, FEE_DOUBLES, places=6)
def _(t):
    return fees(t)


REBATE_SQL = f"""
    SELECT *, total_fee_usd / nullif(price, 0) AS total_fee_reward, extract(week FROM date) AS week,
           CAST(date_trunc('week', date) AS DATE) AS week_start, CAST(CAST(date_trunc('week', date) AS DATE) + 6 AS DATE) AS week_end FROM (
      SELECT f.*, d.user_address, r.price, {' + '.join(f'coalesce(usd_{k}_amount, 0)' for k in T.FEES)} AS total_fee_usd
      FROM ({FEES_SQL}) f
      JOIN (SELECT DISTINCT xcall_transaction_hash AS hash, lower(xcall_caller) AS user_address FROM @fx_public_transfers) d ON f.xcall_transaction_hash = d.hash
      LEFT JOIN (SELECT date_trunc('hour', date) AS h, avg(price) AS price FROM @fx_fee_prices WHERE symbol = 'S3' GROUP BY 1) r
        ON date_trunc('hour', f.date) = r.h) x"""


def rebates(t):
    # transfers and both deposit lists come from one join of the tables
    t.store("fx_moves")
    users = T.deposit_users((t.fx_deposit_list, "hash", "user_address", None), (t.fx_deposit_rest, "hash", "from_address", "bnb"))
    prices = t.fx_fee_prices
    return T.rebates(t.fx_public_transfers, t.fx_domain_assets, t.fx_known_tokens, prices, users, prices.where("symbol = 'S3'"))


@query("D39_fee_rebate", REBATE_SQL, FEE_DOUBLES + " price total_fee_usd total_fee_reward", dates="week_start week_end")
def _(t):
    return rebates(t)


@query(
    "D39_rebate_by_route",
    f"""SELECT origin_chain, destination_chain, sum(total_fee_usd) AS total_fee_usd, sum(total_fee_reward) AS total_fee_reward,
               sum(usd_destination_amount) AS usd_destination_amount, avg(price) AS price, count(DISTINCT transfer_id) AS transfer_count
        FROM ({REBATE_SQL}) r GROUP BY ALL""",
    "total_fee_usd total_fee_reward usd_destination_amount price", places=2,
)
def _(t):
    return T.rebate_by_route(rebates(t))


@query(
    "D39_rebate_by_user",
    f"""SELECT user_address, destination_asset, avg(price) AS reward_usd_price, sum(total_fee_reward) AS total_fee_reward, sum(total_fee_usd) AS total_fee_usd
        FROM ({REBATE_SQL}) r WHERE user_address IS NOT NULL GROUP BY ALL HAVING sum(total_fee_usd) > 0""",
    "reward_usd_price total_fee_reward total_fee_usd", places=3,
)
def _(t):
    return T.rebate_by_user(rebates(t))


@query(
    "D40_missing_deposits",
    """SELECT xcall_transaction_hash AS source_chain_hash FROM @fx_public_transfers t
       WHERE status IN ('CompletedSlow', 'CompletedFast') AND lower(destination_transacting_asset) = 'a' || md5('S1')
         AND destination_domain = '1634886255' AND origin_domain = '1835365481'
         AND make_timestamp(xcall_timestamp * 1000000) >= (SELECT max(timestamp) FROM @fx_deposits)
         AND xcall_transaction_hash NOT IN (SELECT hash FROM @fx_deposits)""",
)
def _(t):
    asset = "a67f6274e0ac0bd892f9b1ec09a2253fc"
    return T.missing_deposits(t.fx_public_transfers, t.fx_deposits, "1835365481", "1634886255", asset)


@query(
    "D25_raw_flows",
    f"""SELECT xcall_date AS date, origin_chain AS "from", destination_chain AS "to",
               CASE WHEN destination_asset = 'ETH' THEN 'WETH' ELSE regexp_replace(destination_asset, '^next', '') END AS asset,
               d_destination_amount AS amount, transfer_id FROM ({HOURLY_SQL}) h""",
    "amount",
)
def _(t):
    return T.raw_flows(enriched_hourly(t))
