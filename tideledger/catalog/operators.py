"""Queries for the single operators: projections, joins, aggregates, windows, sorting, sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import addresses as AD
from ..functions import amounts as A
from ..functions import buckets as K
from ..functions import jsontext as J
from ..functions import labels as L
from ..operators import joins as JN
from ..operators import ordered as O
from ..operators import quality as Q
from ..operators import series as SR
from ..operators import windows as W
from ..plans import bridges as B
from ..sources import tables as T
from .fixtures import discount_label, fixture
from .registry import query

# --- projections, filters, predicates ------------------------------------------------------


@query(
    "P1_rename_cast",
    """SELECT 'lines' AS bridge, CAST(l_orderkey AS VARCHAR) AS id, l_shipdate AS from_date, CAST(l_suppkey AS BIGINT) AS from_chain_id, l_extendedprice AS from_amount_usd,
              CAST(NULL AS DOUBLE) AS gas_amount, CAST(NULL AS VARCHAR) AS to_tx_hash FROM lineitem""",
    "from_amount_usd gas_amount",
)
def _(t):
    rows = t.lineitem.withColumnRenamed("l_orderkey", "id")
    out = B.canonical(rows, bridge=F.lit("lines"), from_date="l_shipdate", from_chain_id="l_suppkey", from_amount_usd="l_extendedprice")
    return out.select("bridge", "id", "from_date", "from_chain_id", "from_amount_usd", "gas_amount", "to_tx_hash")


@query("P2_typed_null", "SELECT o_orderkey, CAST(NULL AS DOUBLE) AS gas, CAST(NULL AS VARCHAR) AS hash FROM orders", "gas")
def _(t):
    return t.orders.select("o_orderkey", A.typed_null("double").alias("gas"), A.typed_null("string").alias("hash"))


@fixture
def fx_texts(d):
    return """
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) END AS amount,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '6' END AS decimals, '$1,' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || '.25' AS money,
           CAST(o_orderkey % 30 * 10000000000000000 AS STRING) AS fee, o_totalprice AS price, o_orderdate AS ts, o_custkey AS user_id
    FROM @orders"""


@query(
    "P3_decimal_scaling",
    "SELECT id, TRY_CAST(amount AS DOUBLE) / pow(10, coalesce(CAST(decimals AS BIGINT), 2)) AS a, TRY_CAST(amount AS DOUBLE) / pow(10, CAST(decimals AS BIGINT)) AS b FROM @fx_texts", "a b",
)
def _(t):
    return t.fx_texts.select("id", A.scaled("amount", "decimals", 2).alias("a"), A.scaled("amount", "decimals").alias("b"))


@query("P4_net_of_fees", "SELECT id, price * (1 - CAST(fee AS DOUBLE) / 1e18 - CAST(fee AS DOUBLE) / 1e18) AS net FROM @fx_texts", "net")
def _(t):
    return t.fx_texts.select("id", A.net_of_fees("price", "fee", "fee").alias("net"))


@query("P5_lossy_cast", "SELECT id, TRY_CAST(amount AS DOUBLE) AS d, TRY_CAST(amount AS BIGINT) AS n FROM @fx_texts", "d")
def _(t):
    return t.fx_texts.select("id", A.lossy_double("amount").alias("d"), A.lossy_long("amount").alias("n"))


@fixture
def fx_spellings(d):
    return """
    SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_partkey % 8 WHEN 0 THEN 'ethereum' WHEN 1 THEN 'Optimisum' WHEN 2 THEN 'Celo Mainnet' WHEN 3 THEN 'Matic Mainnet'
           WHEN 4 THEN 'zkSync Lite' WHEN 5 THEN 'Arbitrum One' WHEN 6 THEN 'Base' ELSE 'Other' END AS name,
           CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 8453 WHEN 2 THEN 81457 WHEN 3 THEN 137 ELSE 424242 END AS chain_id,
           CASE l_partkey % 7 WHEN 0 THEN 'ETH' WHEN 1 THEN 'NEXT' WHEN 2 THEN 'nextUSDC' WHEN 3 THEN 'alUSD' WHEN 4 THEN 'ezETH' WHEN 5 THEN 'nextalETH' ELSE 'W1NK' END AS symbol
    FROM @lineitem"""


@query(
    "P6_code_mapping",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE name WHEN 'ethereum' THEN 'Ethereum' WHEN 'Optimisum' THEN 'Optimism' WHEN 'Celo Mainnet' THEN 'Celo' WHEN 'Matic Mainnet' THEN 'Polygon'
              WHEN 'zkSync Lite' THEN 'zkSync' WHEN 'Arbitrum One' THEN 'Arbitrum' ELSE name END AS harmonised,
              CASE chain_id WHEN 1 THEN 'Ethereum' WHEN 8453 THEN 'Base' WHEN 81457 THEN 'Base' WHEN 137 THEN 'Polygon' ELSE CAST(chain_id AS VARCHAR) END AS display FROM @fx_spellings""",
)
def _(t):
    return t.fx_spellings.select(
        "l_orderkey", "l_linenumber", "l_suppkey", L.harmonised_chain("name").alias("harmonised"), L.chain_display_name("chain_id").alias("display")
    )


@query(
    "P7_address_mapping",
    """SELECT m.move_id, coalesce(k.symbol, '0X' || upper(md5(p_brand || '-' || CAST(address_no AS VARCHAR)))) AS asset FROM @fx_moves m
       LEFT JOIN (SELECT DISTINCT symbol, contract_address FROM @fx_token_metadata WHERE decimals = '6') k ON lower('0x' || md5(p_brand || '-' || CAST(address_no AS VARCHAR))) = lower(k.contract_address)""",
)
def _(t):
    raw = F.concat(F.lit("0X"), F.upper(F.md5(F.concat_ws("-", "p_brand", F.col("address_no").cast("string")))))
    names = t.fx_token_metadata.where("decimals = '6'").select("symbol", "contract_address").distinct()
    rows = JN.lookup(
        t.fx_moves.select("move_id", raw.alias("address")), names, {"address": "contract_address"}, {"symbol": "symbol"}, ignore_case=["address"]
    )
    return rows.select("move_id", F.coalesce("symbol", "address").alias("asset"))


@query(
    "P8_asset_grouping",
    """WITH spelled(symbol, ag) AS (VALUES ('ETH', 'WETH'), ('NEXT', 'NEXT')),
       priced(symbol, pg) AS (FROM spelled UNION ALL VALUES ('alUSD', 'USDT'), ('instETH', 'WETH'), ('ezETH', 'WETH'), ('alETH', 'WETH'))
       SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(ag, regexp_replace(symbol, '^next', '')) AS ag, coalesce(pg, regexp_replace(symbol, '^next', '')) AS pg
       FROM @fx_spellings LEFT JOIN spelled USING (symbol) LEFT JOIN priced USING (symbol)""",
)
def _(t):
    return t.fx_spellings.select(
        "l_orderkey", "l_linenumber", "l_suppkey", L.asset_group("symbol").alias("ag"), L.price_group("symbol").alias("pg")
    )


@query(
    "P9_range_bucket",
    """SELECT event_id, ['<10$', '10-100$', '100-1000$', '1000-10000$', '>10000$']
              [1 + (value >= 10)::INT + (value > 100)::INT + (value > 1000)::INT + (value > 10000)::INT] AS bucket FROM events""",
)
def _(t):
    return t.events.select("event_id", K.usd_range("value").alias("bucket"))


@query(
    "P10_discount_bucket",
    f"SELECT event_id, {discount_label('d')} AS bucket FROM (SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN value / 10 - 1 END AS d FROM events) x",
)
def _(t):
    d = F.when(F.col("event_id") % 17 != 0, F.col("value") / 10 - 1)
    return t.events.select("event_id", K.discount_bucket(d).alias("bucket"))


@query(
    "P11_notional_snapping",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN abs(v - 1000) <= 100 THEN 1000 WHEN abs(v - 10000) <= 1000 THEN 10000 WHEN abs(v - 100000) <= 10000 THEN 100000 END AS level
       FROM (SELECT *, l_extendedprice AS v FROM lineitem) x""",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", A.snapped_notional("l_extendedprice").alias("level"))


@query("P12_nearest_power_of_ten", "SELECT o_orderkey, pow(10, round(log10(o_totalprice))) AS p, pow(10, round_even(log10(o_totalprice), 0)) AS q FROM orders WHERE o_totalprice > 0", "p q", places=0)
def _(t):
    return t.orders.where("o_totalprice > 0").select(
        "o_orderkey", A.nearest_power_of_ten("o_totalprice").alias("p"), A.nearest_power_of_ten("o_totalprice", half_even=True).alias("q")
    )


@query("P13_amount_filters", "SELECT id, from_amount_usd, relay_amount_usd FROM @fx_transfers WHERE from_amount_usd > 0.1 AND to_amount_usd > 0.1 AND relay_amount_usd > 0", "from_amount_usd relay_amount_usd")
def _(t):
    return B.usd_filter(t.fx_transfers).select("id", "from_amount_usd", "relay_amount_usd")


@query("P14_deny_list", "SELECT o_orderkey FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN ('1', '7', '207960')")
def _(t):
    return t.orders.where(~F.col("o_orderkey").cast("string").isin("1", "7", "207960")).select("o_orderkey")


@query("P15_status_filter", "SELECT id, hub_status FROM @fx_raw_intents WHERE status = 'SETTLED_AND_COMPLETED' AND hub_status <> 'DISPATCHED_UNSUPPORTED'")
def _(t):
    return t.fx_raw_intents.where("status = 'SETTLED_AND_COMPLETED' AND hub_status != 'DISPATCHED_UNSUPPORTED'").select("id", "hub_status")


@query("P16_in_subquery", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def _(t):
    allowed = t.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return JN.keep_where_in(t.orders, allowed, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("P17_month_filter", "SELECT o_orderkey FROM orders WHERE extract(year FROM o_orderdate) = 1997 AND extract(month FROM o_orderdate) = 12")
def _(t):
    return t.orders.where(K.in_month("o_orderdate", 1997, 12)).select("o_orderkey")


@query("P17_trailing_days", "SELECT event_id FROM events WHERE ts >= DATE '2024-01-20' - 7 AND ts < DATE '2024-01-21'")
def _(t):
    return t.events.where(K.trailing_days("ts", "2024-01-20", 7)).select("event_id")


@query("P18_usd_fallback", "SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_totalprice END, 0), o_custkey * 2.0) AS usd FROM orders", "usd")
def _(t):
    reported = F.when(F.col("o_orderkey") % 3 == 0, 0.0).otherwise(F.col("o_totalprice"))
    return t.orders.select("o_orderkey", F.coalesce(F.nullif(reported, F.lit(0.0)), F.col("o_custkey") * 2.0).alias("usd"))


@query("P19_user_filters", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-10'")
def _(t):
    return T.filter_by(t.events, {"event_type": ["click", "view"], "user_id": []}, "ts", "2024-01-05", "2024-01-10").select("event_id", "event_type")


@query("P20_clipping", "SELECT event_id, greatest(0, least(100, value * 3 - 20)) AS c FROM events", "c")
def _(t):
    return t.events.select("event_id", A.clipped(F.col("value") * 3 - 20).alias("c"))


@query("P21_anomaly_flag", "SELECT event_id, CAST(CASE WHEN value / 50 - 0.1 > 1 OR value / 50 - 0.1 < 0 THEN 1 ELSE 0 END AS BIGINT) AS flag FROM events")
def _(t):
    return t.events.select("event_id", A.anomaly_flag(F.col("value") / 50 - 0.1).alias("flag"))


@query("P22_capacity_level", "SELECT event_id, CASE WHEN value <= -0.1 OR value > 100 THEN NULL WHEN value <= 25 THEN '<25%' WHEN value <= 50 THEN '25%-50%' WHEN value <= 75 THEN '50%-75%' ELSE '75%-100%' END AS level FROM events")
def _(t):
    return t.events.select("event_id", K.capacity_level("value").alias("level"))


@query("P23_alphabetic_symbols", "SELECT l_orderkey, l_linenumber, l_suppkey, symbol FROM @fx_spellings WHERE regexp_full_match(symbol, '[A-Za-z]+')")
def _(t):
    return t.fx_spellings.where(L.alphabetic("symbol")).dropna().select("l_orderkey", "l_linenumber", "l_suppkey", "symbol")


@query("P24_filtered_read", "SELECT date, router, total_balance_usd FROM @fx_hourly_utilization WHERE asset_group IN ('S0', 'S7')", "total_balance_usd")
def _(t):
    return T.filter_by(t.fx_hourly_utilization, {"asset_group": ["S0", "S7"]}).select("date", "router", "total_balance_usd")


# --- scalar functions ------------------------------------------------------------------------------


@query("F_money_text", "SELECT id, CAST(replace(replace(money, '$', ''), ',', '') AS DOUBLE) AS usd FROM @fx_texts", "usd")
def _(t):
    return t.fx_texts.select("id", A.money_text("money").alias("usd"))


@query(
    "F_address_forms",
    """SELECT id, lower('0x' || regexp_replace(substr(a, 3), '^0{24}', '')) AS unpadded, lower('0x' || right(a, 40)) AS last20, '0x' || lpad(right(a, 40), 64, '0') AS padded
       FROM (SELECT o_orderkey AS id, '0x000000000000000000000000' || substr(md5(CAST(o_custkey AS VARCHAR)) || md5('x'), 1, 40) AS a FROM orders) x""",
)
def _(t):
    a = F.concat(F.lit("0x" + "0" * 24), F.substring(F.concat(F.md5(F.col("o_custkey").cast("string")), F.md5(F.lit("x"))), 1, 40))
    rows = t.orders.select(F.col("o_orderkey").alias("id"), a.alias("a"))
    return rows.select("id", AD.unpadded("a").alias("unpadded"), AD.last_20_bytes("a").alias("last20"), AD.padded(AD.last_20_bytes("a")).alias("padded"))


@query(
    "F_time_buckets",
    """SELECT event_id, date_trunc('day', ts) + to_hours(CAST(floor(extract(hour FROM ts) / 9) AS INTEGER) * 9) AS nine, epoch_us(ts) // 1000000 - (epoch_us(ts) // 1000000) % 1800 AS half_hour,
              CAST(ts AS DATE) - CAST(extract(dow FROM ts) AS INTEGER) AS sunday, CAST(date_trunc('week', ts) AS DATE) AS week_start, CAST(CAST(date_trunc('week', ts) AS DATE) + 6 AS DATE) AS week_end,
              extract(week FROM ts) AS week FROM events""",
    dates="sunday week_start week_end",
)
def _(t):
    parts = K.week_parts("ts")
    return t.events.select(
        "event_id", K.hour_bucket("ts", 9).alias("nine"), K.epoch_bucket("ts").alias("half_hour"), K.sunday_week("ts").alias("sunday"),
        *[c.alias(n) for n, c in parts.items()],
    )


@query(
    "F_json_text",
    r"""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, nullif(regexp_extract(props, '"k": (\d+)', 1), '') AS by_regex FROM events""",
)
def _(t):
    return t.events.select(
        "event_id", J.text_map("props")["k"].cast("bigint").alias("k"), J.extracted("props", r'"k": (\d+)').alias("by_regex")
    )


@query("F_compounding", "SELECT o_orderkey, pow(1 + o_totalprice / 1e9, 365) - 1 AS apy FROM orders", "apy", places=8)
def _(t):
    return t.orders.select("o_orderkey", A.compounded(F.col("o_totalprice") / 1e9).alias("apy"))


@query("F2_prefix_columns", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem", "l_quantity l_extendedprice l_discount l_tax")
def _(t):
    kinds = {f.name for f in t.lineitem.schema if f.dataType.simpleString() not in ("string", "timestamp")}
    return T.columns_with_prefix(t.lineitem.select(*[c for c in t.lineitem.columns if c in kinds]), "l_")


# --- joins -----------------------------------------------------------------------------------------------


@query("J1_left_dimension", "SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def _(t):
    return JN.lookup(t.orders, t.customer.where("c_acctbal > 0"), {"o_custkey": "c_custkey"}, {"c_name": "c_name"}).select("o_orderkey", "c_name")


@query("J2_inner_dimension", "SELECT o_orderkey, c_name FROM orders JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def _(t):
    return JN.lookup(t.orders, t.customer.where("c_acctbal > 0"), {"o_custkey": "c_custkey"}, {"c_name": "c_name"}, "inner").select("o_orderkey", "c_name")


@query("J3_dimension_roles", "SELECT move_id, f.name AS from_name, g.name AS to_name FROM @fx_moves LEFT JOIN @fx_chains f ON from_id = f.chain_id LEFT JOIN @fx_chains g ON to_id = g.chain_id")
def _(t):
    return JN.lookup_roles(t.fx_moves, t.fx_chains, "chain_id", "name", {"from_id": "from_name", "to_id": "to_name"}).select("move_id", "from_name", "to_name")


@query("J4_ignore_case", "SELECT p_partkey, b.n FROM part JOIN (SELECT upper(p_brand) AS k, count(*) AS n FROM part GROUP BY 1) b ON lower(p_brand) = lower(b.k)")
def _(t):
    dim = t.part.groupBy(F.upper("p_brand").alias("k")).agg(F.count("*").alias("n"))
    return JN.lookup(t.part, dim, {"p_brand": "k"}, {"n": "n"}, "inner", ignore_case=["p_brand"]).select("p_partkey", "n")


_FACT_PRICE = """SELECT event_id, f.symbol, amount, p.price, amount * p.price AS usd FROM @fx_facts f
    LEFT JOIN (SELECT symbol, date_trunc('{u}', ts) AS d, avg(price) AS price FROM @fx_ticks GROUP BY 1, 2) p ON f.symbol = p.symbol AND date_trunc('{u}', f.ts) = p.d"""


def _priced_facts(t, unit):
    prices = SR.mean_price(t.fx_ticks, unit)
    rows = JN.price_roles(t.fx_facts, prices, {"price": ("symbol", "ts")}, unit)
    return rows.select("event_id", "symbol", "amount", "price", (F.col("amount") * F.col("price")).alias("usd"))


@query("J5_hour_price", _FACT_PRICE.format(u="hour"), "amount price usd")
def _(t):
    return _priced_facts(t, "hour")


@query("J6_minute_price", _FACT_PRICE.format(u="minute"), "amount price usd")
def _(t):
    return _priced_facts(t, "minute")


@query(
    "J7_asof_price",
    """WITH k AS (SELECT symbol, epoch_us(ts) // 1000000 // 1800 AS b, max(price) AS price FROM @fx_ticks GROUP BY 1, 2)
       SELECT f.event_id, f.symbol, f.amount, k.price FROM (SELECT *, epoch_us(ts) // 1000000 // 1800 AS b FROM @fx_facts) f ASOF LEFT JOIN k ON f.symbol = k.symbol AND f.b >= k.b""",
    "amount price",
)
def _(t):
    return JN.price_at_or_before(t.fx_facts, t.fx_ticks, "symbol", "ts").select("event_id", "symbol", "amount", "price")


@query(
    "J8_full_join",
    """SELECT coalesce(a.k, b.k) AS k, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM (SELECT c_custkey AS k, sum(c_acctbal) AS x FROM customer GROUP BY 1) a
       FULL JOIN (SELECT o_custkey * 2 AS k, sum(o_totalprice) AS y FROM orders GROUP BY 1) b ON a.k = b.k""",
    "x y",
)
def _(t):
    a = t.customer.groupBy(F.col("c_custkey").alias("k")).agg(F.sum("c_acctbal").alias("x"))
    b = t.orders.groupBy((F.col("o_custkey") * 2).alias("k")).agg(F.sum("o_totalprice").alias("y"))
    return JN.full_on(a, b, ["k"], ["x", "y"])


@query("J10_anti_join", "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) o ON c_custkey = o_custkey WHERE o_custkey IS NULL")
def _(t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return JN.without_match(t.customer, big, ["c_custkey"]).select("c_custkey")


@query("J11_latest_with_ties", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) x WHERE o_orderdate = m")
def _(t):
    return W.extreme_with_ties(t.orders, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_orderdate")


@query(
    "J12_grid",
    """SELECT a.*, s.symbol, CAST(n.amount AS BIGINT) AS amount FROM (SELECT DISTINCT from_id, to_id FROM @fx_moves) a CROSS JOIN (SELECT unnest(['ETH', 'USDC']) AS symbol) s
       CROSS JOIN (SELECT unnest([1000, 10000]) AS amount) n WHERE a.from_id <> a.to_id""",
)
def _(t):
    pairs = t.fx_moves.select("from_id", "to_id").distinct().where("from_id != to_id")
    return JN.grid(pairs, symbol=["ETH", "USDC"], amount=[1000, 10000])


@query(
    "J13_parameter_rows",
    """SELECT source, days, count(*) AS n, sum(amount) AS amount FROM @fx_flows CROSS JOIN (SELECT CAST(unnest([7, 15, 30]) AS BIGINT) AS days) p
       WHERE CAST(date AS DATE) >= DATE '2024-01-31' - CAST(days AS INTEGER) GROUP BY 1, 2""",
    "amount",
)
def _(t):
    # rows are summed per day before they are repeated for each look-back
    daily = t.fx_flows.groupBy("source", F.to_date("date").alias("day")).agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    looks = daily.select("*", F.explode(F.array(*[F.lit(x).cast("bigint") for x in (7, 15, 30)])).alias("days"))
    kept = looks.where(F.col("day") >= F.date_sub(F.lit("2024-01-31").cast("date"), F.col("days").cast("int")))
    return kept.groupBy("source", "days").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))


@query(
    "J14_either_key",
    """SELECT transfer_id, min(a.decimal) AS decimal FROM @fx_public_transfers t LEFT JOIN @fx_domain_assets a ON t.destination_domain = a.domain
         AND (t.destination_transacting_asset = a.local OR t.destination_transacting_asset = a.adopted) GROUP BY 1""",
)
def _(t):
    return JN.either_key_lookup(
        t.fx_public_transfers, t.fx_domain_assets, "destination_transacting_asset", ["local", "adopted"], {"destination_domain": "domain"}, {"decimal": "decimal"}
    ).select("transfer_id", "decimal")


@query(
    "J15_case_key",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p.n FROM @fx_spellings s LEFT JOIN (SELECT symbol, count(*) AS n FROM @fx_spellings GROUP BY 1) p
       ON (CASE WHEN s.symbol IN ('ETH', 'ezETH') THEN 'NEXT' ELSE s.symbol END) = p.symbol""",
)
def _(t):
    sizes = t.fx_spellings.groupBy("symbol").agg(F.count("*").alias("n"))
    keyed = t.fx_spellings.withColumn("__k", F.when(F.col("symbol").isin("ETH", "ezETH"), "NEXT").otherwise(F.col("symbol")))
    return JN.lookup(keyed, sizes, {"__k": "symbol"}, {"n": "n"}).select("l_orderkey", "l_linenumber", "l_suppkey", "n")


@query(
    "J16_role_self_join",
    "SELECT a.user_id, a.n AS views, b.n AS clicks FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) a JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) b ON a.user_id = b.user_id",
)
def _(t):
    def side(kind, name):
        return t.events.where(F.col("event_type") == kind).groupBy("user_id").agg(F.count("*").alias(name))

    return side("view", "views").join(side("click", "clicks"), "user_id")


# one column per kind that is named, and one for every other
KINDS = ("click", "error", "purchase", "signup", "view")


@query(
    "J18_bucket_columns",
    "SELECT user_id, " + ", ".join(f"sum(value) FILTER (event_type = '{e}') AS {e}" for e in KINDS)
    + f", sum(value) FILTER (event_type IS NULL OR event_type NOT IN {KINDS}) AS other FROM events GROUP BY 1",
    " ".join(KINDS) + " other",
)
def _(t):
    kind = F.when(F.col("event_type").isin(*KINDS), F.col("event_type")).otherwise("other")
    return t.events.withColumn("kind", kind).groupBy("user_id").pivot("kind", [*KINDS, "other"]).agg(F.sum("value"))


# --- aggregates -------------------------------------------------------------------------------------------


@query(
    "A1_group_by",
    "SELECT bridge, from_chain_id, sum(from_amount_usd) AS s, avg(from_amount_usd) AS a, count(*) AS n, min(from_amount_usd) AS lo, max(from_amount_usd) AS hi FROM @fx_transfers GROUP BY 1, 2", "s a lo hi",
)
def _(t):
    v = "from_amount_usd"
    return t.fx_transfers.groupBy("bridge", "from_chain_id").agg(
        F.sum(v).alias("s"), F.avg(v).alias("a"), F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")
    )


@query("A2_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("A3_count_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))


@query(
    "A4_conditional",
    "SELECT l_linestatus, count(CASE WHEN l_extendedprice >= 10000 THEN 1 END) AS n, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS s, avg(CASE WHEN l_tax > 0.04 THEN l_quantity END) AS a FROM lineitem GROUP BY 1", "s a",
)
def _(t):
    return t.lineitem.groupBy("l_linestatus").agg(
        F.count_if(F.col("l_extendedprice") >= 10000).alias("n"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0.0)).alias("s"),
        F.avg(F.when(F.col("l_tax") > 0.04, F.col("l_quantity"))).alias("a"),
    )


@query("A5_percentage", "SELECT o_custkey, round(100.0::DOUBLE * count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / nullif(count(CASE WHEN o_orderstatus <> 'P' THEN 1 END), 0), 2) AS pct FROM orders GROUP BY 1", "pct", places=1)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        A.percent(F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") != "P")).alias("pct")
    )


@query("A6_A7_spread", "SELECT l_suppkey, stddev_samp(l_extendedprice) AS sd, var_samp(l_quantity) AS v, min(l_tax) AS lo, max(l_tax) AS hi FROM lineitem GROUP BY 1", "sd v lo hi")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.stddev_samp("l_extendedprice").alias("sd"), F.var_samp("l_quantity").alias("v"), F.min("l_tax").alias("lo"), F.max("l_tax").alias("hi")
    )


@query("A8_having", "SELECT l_suppkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1 HAVING sum(l_discount) > 25", "s")
def _(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("s"), F.sum("l_discount").alias("d"))
    return sums.where("d > 25").select("l_suppkey", "s")


@query(
    "A9_two_levels",
    "SELECT date_trunc('day', b) AS day, avg(s) AS mean_bucket FROM (SELECT date_trunc('day', ts) + to_hours(CAST(floor(extract(hour FROM ts) / 6) AS INTEGER) * 6) AS b, sum(value) AS s FROM events GROUP BY 1) x GROUP BY 1", "mean_bucket",
)
def _(t):
    buckets = t.events.groupBy(K.hour_bucket("ts", 6).alias("b")).agg(F.sum("value").alias("s"))
    return buckets.groupBy(F.date_trunc("day", "b").alias("day")).agg(F.avg("s").alias("mean_bucket"))


@query("A10_array_text", "SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS flags, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag")))
    rows = t.lineitem.groupBy("l_orderkey").agg(items.alias("i"))
    return rows.select("l_orderkey", F.array_join(F.col("i.l_returnflag"), ",").alias("flags"), F.size("i").cast("bigint").alias("n"))


@query("A12_price_per_bucket", "SELECT symbol, epoch_us(ts) // 1000000 // 1800 * 1800 AS bucket, max(price) AS price FROM @fx_ticks GROUP BY 1, 2", "price")
def _(t):
    return SR.highest_price(t.fx_ticks, "symbol", K.epoch_bucket("ts").alias("bucket"))


@query("A13_rollup", "SELECT coalesce(l_returnflag, 'all') AS bridge, sum(l_extendedprice) AS s FROM lineitem GROUP BY ROLLUP (l_returnflag)", "s")
def _(t):
    return t.lineitem.rollup("l_returnflag").agg(F.sum("l_extendedprice").alias("s")).select(F.coalesce("l_returnflag", F.lit("all")).alias("bridge"), "s")


@query(
    "A14_melt",
    "SELECT event_type, 'max_value' AS metric, max(value) AS v FROM events GROUP BY 1 UNION ALL SELECT event_type, 'min_value', min(value) FROM events GROUP BY 1", "v",
)
def _(t):
    wide = t.events.groupBy("event_type").agg(F.max("value").alias("max_value"), F.min("value").alias("min_value"))
    return wide.unpivot("event_type", ["max_value", "min_value"], "metric", "v")


@query("A15_share", "SELECT l_returnflag, l_linestatus, n, n / sum(n) OVER (PARTITION BY l_returnflag) AS share FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) x", "share")
def _(t):
    return W.share_within(t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")), ["l_returnflag"], "n")


@query("A16_capped_sum", "SELECT o_custkey, sum(CASE WHEN o_orderkey % 2 = 0 THEN least(o_totalprice, 50000) ELSE 0 END) AS s FROM orders GROUP BY 1", "s")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderkey") % 2 == 0, F.least(F.col("o_totalprice"), F.lit(50000.0))).otherwise(0.0)).alias("s")
    )


# --- windows -------------------------------------------------------------------------------------------------


@query("W1_latest_row", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1", "o_totalprice")
def _(t):
    return W.latest_per_key(t.orders, ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "o_totalprice")


@query("W2_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders")
def _(t):
    return O.with_row_number(t.orders, "o_orderdate", "o_orderkey", name="n", descending=["o_orderdate"]).select("o_orderkey", "n")


@query("W2_hash_id", "SELECT count(*) AS n, count(DISTINCT id) AS ids FROM @fx_transfers")
def _(t):
    ids = t.fx_transfers.select(O.row_id("id", "date", prefix="x").alias("id"))
    return ids.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query("W3_first_address", "SELECT blockchain, symbol, contract_address, decimals FROM (SELECT *, rank() OVER (PARTITION BY blockchain, symbol ORDER BY contract_address) AS r FROM @fx_token_metadata) x WHERE r = 1")
def _(t):
    return B.first_addresses(t.fx_token_metadata)


_RANKED = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS r FROM lineitem"


@query("W4_rank", _RANKED)
def _(t):
    return O.ranked(t.lineitem, ["l_returnflag"], "l_extendedprice", "r").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r")


@query(
    "W4_rank_hot_groups",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank() OVER (PARTITION BY l_suppkey % 20 = 0 ORDER BY l_extendedprice DESC) AS r FROM lineitem",
)
def _(t):
    # nine rows in ten have one key
    keyed = t.lineitem.withColumn("rare", F.col("l_suppkey") % 20 == 0)
    return O.ranked(keyed, ["rare"], "l_extendedprice", "r").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r")


@query("W5_top_dense", "SELECT * FROM (SELECT l_suppkey, l_returnflag, avg_price, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY avg_price DESC) AS r FROM (SELECT l_suppkey, l_returnflag, round(avg(l_extendedprice), -2) AS avg_price FROM lineitem GROUP BY 1, 2) a) b WHERE r <= 2", "avg_price", places=0)
def _(t):
    means = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.round(F.avg("l_extendedprice"), -2).alias("avg_price"))
    return W.top_dense(means, ["l_suppkey"], "avg_price", 2, "r")


@query(
    "W6_running_sum",
    """SELECT DISTINCT router, asset, chain, ts, sum(CASE WHEN event = 'Add' THEN amount ELSE -amount END) OVER (PARTITION BY router, asset, chain ORDER BY ts) AS running FROM @fx_ledger""",
    "running",
)
def _(t):
    signed = t.fx_ledger.withColumn("v", F.when(F.col("event") == "Add", F.col("amount")).otherwise(-F.col("amount")))
    return O.running_total(signed, ["router", "asset", "chain"], "ts", "v", units=("day", "second"))


@query("W7_forward_fill", "SELECT event_id, user_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts) AS filled FROM (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v FROM events) x", "filled")
def _(t):
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    return SR.forward_fill(rows, ["user_id"], "ts", "v").select("event_id", "user_id", "filled")


@query("W9_moving_mean", "SELECT day, event_type, avg(v) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m FROM (SELECT date_trunc('day', ts) AS day, event_type, sum(value) AS v FROM events GROUP BY 1, 2) x", "m")
def _(t):
    days = t.events.groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.sum("value").alias("v"))
    return days.select("day", "event_type", W.moving_mean("v", ["event_type"], "day", 7).alias("m"))


@query(
    "W10_full_rolling",
    """SELECT day, event_type, CASE WHEN count(v) OVER w = 7 THEN avg(v) OVER w END AS m, CASE WHEN count(v) OVER w = 7 THEN sum(v) OVER w END AS s
       FROM (SELECT date_trunc('day', ts) AS day, event_type, sum(value) AS v FROM events GROUP BY 1, 2) x WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "m s",
)
def _(t):
    days = t.events.groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.sum("value").alias("v"))
    return days.select(
        "day", "event_type", W.moving_mean("v", ["event_type"], "day", 7, full_only=True).alias("m"), W.moving_sum("v", ["event_type"], "day", 7, full_only=True).alias("s")
    )


# --- series ------------------------------------------------------------------------------------------------------


@query("D12_hourly_prices", "SELECT symbol, date_trunc('hour', ts) AS date, avg(price) AS price FROM @fx_ticks GROUP BY 1, 2", "price")
def _(t):
    return SR.mean_price(t.fx_ticks, "hour")


@query(
    "D12_minute_prices_filled",
    """WITH r AS (SELECT blockchain, symbol, date_trunc('minute', ts) AS minute, avg(price) AS price FROM @fx_ticks GROUP BY 1, 2, 3),
       g AS (SELECT blockchain, symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS minute FROM (SELECT blockchain, symbol, min(minute) AS lo, max(minute) AS hi FROM r GROUP BY 1, 2) b)
       SELECT g.blockchain, g.symbol, g.minute, last_value(r.price IGNORE NULLS) OVER (PARTITION BY g.blockchain, g.symbol ORDER BY g.minute) AS price
       FROM g LEFT JOIN r USING (blockchain, symbol, minute)""",
    "price",
)
def _(t):
    return SR.filled_minute_prices(t.fx_ticks, ts="ts")


# --- sorting and sets -----------------------------------------------------------------------------------------------


@query("O1_sorted", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey", "o_totalprice")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("O2_best_with_ties", "SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS r FROM lineitem) x WHERE r = 1", "l_quantity")
def _(t):
    return W.extreme_with_ties(t.lineitem, ["l_suppkey"], "l_quantity").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("O4_latest_slice", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _(t):
    return W.at_latest(t.orders, "o_orderdate").select("o_orderkey", "o_orderdate")


@query("U1_union_all", "SELECT o_custkey AS k, 'orders' AS src FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer")
def _(t):
    a = t.orders.select(F.col("o_custkey").alias("k"), F.lit("orders").alias("src"))
    return a.unionByName(t.customer.select(F.lit("customer").alias("src"), F.col("c_custkey").alias("k")))


@query("U2_distinct_then_union", "SELECT DISTINCT l_suppkey AS k, l_returnflag AS f FROM lineitem UNION ALL SELECT DISTINCT s_suppkey, 'A' FROM supplier")
def _(t):
    a = t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("f")).distinct()
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.lit("A").alias("f")).distinct())


@query("U3_union_distinct", "SELECT from_id AS chain_id FROM @fx_moves UNION SELECT to_id FROM @fx_moves")
def _(t):
    moves = t.fx_moves
    return moves.select(F.col("from_id").alias("chain_id")).union(moves.select("to_id")).distinct()


@query("U4_union_missing_columns", "SELECT c_custkey AS k, c_acctbal AS v, CAST(NULL AS VARCHAR) AS s FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier", "v")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("s")), allowMissingColumns=True)


# --- quality -------------------------------------------------------------------------------------------------------------


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        number = kind not in ("string", "timestamp")
        stats = (
            f"avg({c}) AS avg, quantile_cont({c}, 0.5) AS median, stddev_pop({c}) AS std_dev_population, stddev_samp({c}) AS std_dev_sample"
            if number
            else "NULL::DOUBLE AS avg, NULL::DOUBLE AS median, NULL::DOUBLE AS std_dev_population, NULL::DOUBLE AS std_dev_sample"
        )
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, count({c}) / count(*) AS not_null_proportion, "
            f"count(DISTINCT {c}) / count(*) AS distinct_proportion, count(DISTINCT {c}) AS distinct_count, count(DISTINCT {c}) = count(*) AS is_unique, "
            f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, {stats} FROM {table}"
        )
    return " UNION ALL ".join(parts)


PROFILED = {
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
        "l_shipdate": "timestamp",
    },
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double",
    },
}
PROFILE_DOUBLES = "not_null_proportion distinct_proportion avg median std_dev_population std_dev_sample"


def _register_profile(table: str) -> None:
    @query(f"S21_profile_{table}", _profile_sql(table, PROFILED[table]), PROFILE_DOUBLES)
    def _(t):
        return Q.profile(getattr(t, table), table)


for _table in ("orders", "lineitem"):
    _register_profile(_table)


@query("S21_profile_tables", " UNION ALL ".join(_profile_sql(table, columns) for table, columns in PROFILED.items()), PROFILE_DOUBLES)
def _(t):
    return reduce(DataFrame.unionByName, [Q.profile(getattr(t, table), table) for table in PROFILED])


@query(
    "S22_expectations",
    """SELECT 'not_null(o_custkey)' AS rule, count(*) AS violations FROM orders WHERE o_custkey IS NULL
       UNION ALL SELECT 'at_least(o_totalprice)', count(*) FROM orders WHERE o_totalprice < 20000
       UNION ALL SELECT 'unique(o_orderkey)', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) a
       UNION ALL SELECT 'unique(o_custkey,o_orderstatus)', count(*) FROM (SELECT o_custkey, o_orderstatus FROM orders GROUP BY 1, 2 HAVING count(*) > 1) b
       UNION ALL SELECT 'exists(o_missing)', 1 UNION ALL SELECT 'type(o_orderkey)', 0 UNION ALL SELECT 'type(o_custkey)', 1""",
)
def _(t):
    return Q.expect(
        t.orders,
        [
            Q.Rule("not_null", ("o_custkey",)), Q.Rule("at_least", ("o_totalprice",), 20000.0), Q.Rule("unique", ("o_orderkey",)),
            Q.Rule("unique", ("o_custkey", "o_orderstatus")), Q.Rule("exists", ("o_missing",)), Q.Rule("type", ("o_orderkey",), "bigint"),
            Q.Rule("type", ("o_custkey",), "string"),
        ],
    )


@query(
    "S23_source_coverage",
    """SELECT 'events' AS source, min(ts) AS first_tx, max(ts) AS last_tx, count(*) AS tx_count FROM events
       UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate), count(*) FROM orders UNION ALL SELECT 'lines', min(l_shipdate), max(l_shipdate), count(*) FROM lineitem""",
)
def _(t):
    return Q.source_coverage({"events": (t.events, "ts"), "orders": (t.orders, "o_orderdate"), "lines": (t.lineitem, "l_shipdate")})


@query("D67_unmatched_chains", "SELECT move_id FROM @fx_moves WHERE from_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) OR to_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def _(t):
    known = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").cast("bigint").alias("chain_id"))
    return Q.unmatched_chains(t.fx_moves, known, "from_id", "to_id").select("move_id")
