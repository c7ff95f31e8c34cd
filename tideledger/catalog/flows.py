"""Net flow, netting and batching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.batching import aggregate_batches, batch_transfers
from ..plans import flows as L
from .bridges import PRICES, hourly
from .fixtures import fixture
from .registry import query

AS_OF = "2024-01-31"


def sides_sql(bucket: str, amount: str = "amount", by: str = "asset", table: str = "@fx_flows", flip: bool = False) -> str:
    a, b = ("target", "source") if flip else ("source", "target")
    keys = f"{by}," if by else ""
    on = f"AND i.{by} = o.{by}" if by else ""
    merged = f"coalesce(i.{by}, o.{by}) AS {by}," if by else ""
    return f"""
    SELECT coalesce(i.bucket, o.bucket) AS bucket, coalesce(i.chain, o.chain) AS chain, {merged}
           coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
    FROM (SELECT {bucket} AS bucket, {a} AS chain, {keys} sum({amount}) AS inflow FROM {table} GROUP BY ALL) i
    FULL JOIN (SELECT {bucket} AS bucket, {b} AS chain, {keys} sum({amount}) AS outflow FROM {table} GROUP BY ALL) o
      ON i.bucket = o.bucket AND i.chain = o.chain {on}"""


def bucket_sql(h: int, ts: str = "date") -> str:
    return f"date_trunc('day', {ts}) + to_hours(CAST(floor(extract(hour FROM {ts}) / {h}) AS INTEGER) * {h})"


PCT = "100 - abs((inflow - outflow) / nullif(inflow + outflow, 0)) * 100"


def _register_net_flow(h: int) -> None:
    @query(
        f"D25_net_flow_{h}h",
        f"SELECT bucket AS date, chain, asset, inflow - outflow AS net_amount FROM ({sides_sql(bucket_sql(h))}) x",
        "net_amount",
    )
    def _(t):
        return L.net_flow(t.fx_flows, h, "source", "target")


for _h in (1, 3, 6, 12, 24):
    _register_net_flow(_h)

HOURS = (1, 3, 6, 9, 12, 24)
STATS = ("avg", "stddev", "min", "max")


def stats_sql(keys: str, by: str, hours=HOURS, stats=STATS) -> str:
    heads = {"avg": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}
    parts = []
    for h in hours:
        cells = ", ".join(
            f"{heads[s]}({expr}) AS {s}_{name}_{h}hr"
            for expr, name in (("inflow - outflow", "net_amount"), (PCT, "percent_netted"))
            for s in stats
        )
        parts.append(f"h{h} AS (SELECT {keys}, {cells} FROM ({sides_sql(bucket_sql(h), by=by)}) x GROUP BY ALL)")
    names = [k.split(" AS ")[-1].strip() for k in keys.split(", ") if not k.startswith("date_trunc('day'")]
    if "AS date" in keys:
        names = ["date"] + [n for n in names if n != "date"]
    using = ", ".join(names)
    joins = " ".join(f"LEFT JOIN h{h} USING ({using})" for h in hours[1:])
    return f"WITH {', '.join(parts)} SELECT * FROM h{hours[0]} {joins}"


def stat_columns(hours=HOURS, stats=STATS) -> str:
    return " ".join(f"{s}_{n}_{h}hr" for h in hours for s in stats for n in ("net_amount", "percent_netted"))


@query("D26_net_flow_stats_by_day", stats_sql("date_trunc('day', bucket) AS date, chain", ""), stat_columns(), places=3)
def _(t):
    return L.net_flow_stats(t.fx_flows, source="source", target="target")


@query(
    "D26_net_flow_stats_by_day_asset",
    stats_sql("date_trunc('day', bucket) AS date, chain, asset", "asset"), stat_columns(), places=3,
)
def _(t):
    return L.net_flow_stats(t.fx_flows, by_asset=True, source="source", target="target")


@query(
    "D26_net_flow_stats_total",
    stats_sql("chain", "", (1, 3, 6, 12, 24), ("avg",)), stat_columns((1, 3, 6, 12, 24), ("avg",)), places=3,
)
def _(t):
    return L.net_flow_stats(t.fx_flows, (1, 3, 6, 12, 24), by_day=False, stats=("avg",), source="source", target="target")


def grid_sql(by: str, flip: bool = True) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {h} AS time_bucket, * FROM ({sides_sql(bucket_sql(h), by=by, flip=flip)}) x{h}" for h in (1, 3, 6, 12, 24)
    )
    keys = "chain, asset" if by else "chain"
    return f"""
    SELECT {keys}, CAST(interval_days AS BIGINT) AS interval_days, CAST(time_bucket AS BIGINT) AS time_bucket,
           avg(inflow - outflow) AS avg_net_amount, stddev_samp(inflow - outflow) AS stddev_net_amount,
           min(inflow - outflow) AS min_net_amount, max(inflow - outflow) AS max_net_amount, avg({PCT}) AS avg_percent_netted
    FROM ({parts}) f CROSS JOIN (SELECT unnest([7, 15, 30, 60, 90]) AS interval_days) d
    WHERE CAST(bucket AS DATE) >= DATE '{AS_OF}' - interval_days GROUP BY ALL"""


GRID_DOUBLES = "avg_net_amount stddev_net_amount min_net_amount max_net_amount avg_percent_netted"


@query("D27_net_flow_grid", grid_sql(""), GRID_DOUBLES, places=3)
def _(t):
    return L.net_flow_grid(t.fx_flows, AS_OF, source="source", target="target")


@query("D27_net_flow_grid_by_asset", grid_sql("asset"), GRID_DOUBLES, places=3)
def _(t):
    return L.net_flow_grid(t.fx_flows, AS_OF, by_asset=True, source="source", target="target")


# --- priced flows over the transfer tables -------------------------------------------


@fixture
def fx_bridge_flows(d):
    # tokens 'next<symbol>', 'ETH' and plain ones fall into price groups S0..S4 and WETH
    return """
    SELECT l_returnflag AS bridge, ts AS date, 'c' || CAST(from_id AS STRING) AS source, 'c' || CAST(to_id AS STRING) AS target,
           CASE WHEN l_suppkey % 7 = 0 THEN 'ETH' WHEN l_suppkey % 2 = 0 THEN 'nextS' || CAST(l_suppkey % 5 AS STRING)
                ELSE 'S' || CAST(l_suppkey % 5 AS STRING) END AS asset, l_extendedprice AS amount
    FROM @fx_moves"""


@query(
    "D28_multi_bridge_netflow_hourly",
    f"""WITH {PRICES},
    h AS (SELECT date_trunc('hour', date) AS bucket, bridge, asset, CASE WHEN asset = 'ETH' THEN 'WETH' ELSE regexp_replace(asset, '^next', '') END AS asset_group,
                 source, target, sum(amount) AS amount FROM @fx_bridge_flows GROUP BY ALL),
    u AS (SELECT h.*, amount * price AS usd FROM h JOIN prices p ON h.asset_group = p.symbol AND h.bucket = p.date),
    i AS (SELECT bucket, bridge, asset, asset_group, source AS chain, sum(usd) AS inflow FROM u GROUP BY ALL),
    o AS (SELECT bucket, bridge, asset, asset_group, target AS chain, sum(usd) AS outflow FROM u GROUP BY ALL)
    SELECT bucket AS date, bridge, asset, asset_group, chain, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow,
           coalesce(inflow, 0) + coalesce(outflow, 0) AS volume, coalesce(inflow, 0) - coalesce(outflow, 0) AS net_amount
    FROM i FULL JOIN o USING (bucket, bridge, asset, asset_group, chain)""",
    "inflow outflow volume net_amount",
)
def _(t):
    return L.multi_bridge_netflow_hourly(t.fx_bridge_flows, hourly(t), "source", "target")


@fixture
def fx_pair_transfers(d):
    return """
    SELECT ts AS date, 'c' || CAST(from_id % 8 AS STRING) AS source_chain, 'c' || CAST(to_id % 8 AS STRING) AS target_chain,
           'S' || CAST(l_partkey % 5 AS STRING) AS source_token, 'S' || CAST(l_suppkey % 5 AS STRING) AS target_token,
           l_extendedprice * (1 - l_discount) AS target_amount
    FROM @fx_moves"""


CHAINS, TOKENS = ("c0", "c1", "c2", "c3", "c4"), ("S0", "S1", "S2", "S3")


@query(
    "D29_debridge_netflow_hourly",
    f"""WITH {PRICES},
    u AS (SELECT date_trunc('hour', t.date) AS bucket, source_chain, target_chain, source_token, target_token, target_amount * price AS v
          FROM @fx_pair_transfers t JOIN prices p ON target_token = p.symbol AND date_trunc('hour', t.date) = p.date
          WHERE source_chain IN {CHAINS} AND target_chain IN {CHAINS} AND source_token IN {TOKENS} AND target_token IN {TOKENS}),
    i AS (SELECT bucket, source_chain AS chain, source_token AS asset, sum(v) AS a FROM u WHERE v > 0 GROUP BY ALL),
    o AS (SELECT bucket, target_chain AS chain, target_token AS asset, sum(v) AS b FROM u WHERE v > 0 GROUP BY ALL),
    j AS (SELECT bucket, chain, asset, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM i FULL JOIN o USING (bucket, chain, asset))
    SELECT bucket AS date, chain, asset, a AS inflow_usd, b AS outflow_usd, a - b AS net_amount_usd, abs(a - b) AS abs_net_amount_usd,
           a + b AS total_volume_usd, 1 - abs(a - b) / (a + b) AS balance_ratio_usd FROM j WHERE a + b > 0""",
    "inflow_usd outflow_usd net_amount_usd abs_net_amount_usd total_volume_usd balance_ratio_usd",
)
def _(t):
    return L.priced_pair_netflow(t.fx_pair_transfers, hourly(t), CHAINS, TOKENS)


@query(
    "D30_across_netflow_hourly",
    """WITH r AS (SELECT date, coalesce(fs_bridge, 'none') AS s, coalesce(ts_bridge, 'none') AS d, symbol, usd_token_value AS v
                  FROM @raw_rollup_flows WHERE symbol IS NOT NULL AND usd_token_value > 0),
    i AS (SELECT date, s AS chain, symbol AS asset, sum(v) AS a FROM r GROUP BY ALL),
    o AS (SELECT date, d AS chain, symbol AS asset, sum(v) AS b FROM r GROUP BY ALL)
    SELECT date, chain, asset, coalesce(a, 0) AS inflow, coalesce(b, 0) AS outflow, coalesce(a, 0) - coalesce(b, 0) AS net_amount
    FROM i FULL JOIN o USING (date, chain, asset)""",
    "inflow outflow net_amount",
)
def _(t):
    rows = t.raw_rollup_flows.withColumns(
        {"src_chain": F.coalesce("fs_bridge", F.lit("none")), "dst_chain": F.coalesce("ts_bridge", F.lit("none"))}
    )
    return L.netflow_hourly(rows, value="usd_token_value", asset="symbol")


# --- deposits and withdrawals ----------------------------------------------------------


@fixture
def fx_day_stats(d):
    return f"""
    SELECT {d.epoch('o_orderdate')} AS date, 'c' || CAST(from_id % 6 AS STRING) AS chain, lower(p_brand) AS symbol, l_returnflag AS bridge,
           CASE WHEN l_linenumber % 2 = 0 THEN 'deposit' ELSE 'withdrawal' END AS tx_type, l_extendedprice AS usd_value
    FROM @fx_moves"""


@fixture
def fx_tracked(d):
    return "SELECT DISTINCT p_brand AS token_name FROM @part WHERE p_brand NOT IN ('Brand#3', 'Brand#7')"


def deposit_sql(time: str, keys: str, bridge: bool = False) -> str:
    extra = ", bridge" if bridge else ""
    return f"""
    WITH d AS (SELECT date_trunc('day', make_timestamp(date * 1000000)) AS day, chain, symbol AS asset{extra},
                      coalesce(sum(CASE WHEN tx_type = 'deposit' THEN usd_value END), 0) AS a,
                      coalesce(sum(CASE WHEN tx_type = 'withdrawal' THEN usd_value END), 0) AS b
               FROM @fx_day_stats WHERE symbol IS NOT NULL AND usd_value > 0
                 AND lower(symbol) IN (SELECT lower(token_name) FROM @fx_tracked) GROUP BY ALL)
    SELECT {time}, {keys}, avg(a - b) AS avg_net_amount, avg(100 - abs((a - b) / nullif(a + b, 0)) * 100) AS avg_percent_netted
    FROM d GROUP BY ALL"""


YEAR = "CAST(extract(year FROM day) AS BIGINT) AS year"
AVERAGES = "avg_net_amount avg_percent_netted"
ASSET = "upper(asset) AS asset"


@query("D31_deposit_withdraw_by_asset_chain", deposit_sql(YEAR, f"chain, {ASSET}"), AVERAGES)
def _(t):
    return L.deposit_withdraw_netflow(t.fx_day_stats, t.fx_tracked)


@query("D31_deposit_withdraw_by_asset_chain_bridge", deposit_sql(YEAR, f"chain, {ASSET}, bridge", True), AVERAGES)
def _(t):
    return L.deposit_withdraw_netflow(t.fx_day_stats, t.fx_tracked, ("chain", "asset", "bridge"))


@query("D31_deposit_withdraw_by_chain_bridge", deposit_sql(YEAR, "chain, bridge", True), AVERAGES)
def _(t):
    return L.deposit_withdraw_netflow(t.fx_day_stats, t.fx_tracked, ("chain", "bridge"))


@query("D31_deposit_withdraw_by_chain_day", deposit_sql("CAST(day AS DATE) AS date", "chain"), AVERAGES, dates="date")
def _(t):
    return L.deposit_withdraw_netflow(t.fx_day_stats, t.fx_tracked, ("chain",), every="day")


@query(
    "D31_deposit_withdraw_daily",
    """SELECT day AS date, chain, asset, a AS inflow, b AS outflow, a - b AS net_amount, 100 - abs((a - b) / nullif(a + b, 0)) * 100 AS percent_netted
       FROM (SELECT date_trunc('day', make_timestamp(date * 1000000)) AS day, chain, symbol AS asset,
                      coalesce(sum(CASE WHEN tx_type = 'deposit' THEN usd_value END), 0) AS a,
                      coalesce(sum(CASE WHEN tx_type = 'withdrawal' THEN usd_value END), 0) AS b
             FROM @fx_day_stats WHERE usd_value > 0 AND lower(symbol) IN (SELECT lower(token_name) FROM @fx_tracked) GROUP BY ALL) x""",
    "inflow outflow net_amount percent_netted",
)
def _(t):
    return L.deposit_withdraw_netflow(t.fx_day_stats, t.fx_tracked, every=None)


# --- netting windows ---------------------------------------------------------------------


@fixture
def fx_netting_hourly(d):
    return """
    SELECT date_trunc('hour', ts) AS date, 'c' || CAST(user_id % 4 AS STRING) AS chain, event_type AS asset_group,
           event_type || CAST(event_id % 2 AS STRING) AS asset, CASE WHEN user_id % 3 = 0 THEN 'b0' ELSE 'b1' END AS bridge,
           sum(CASE WHEN event_id % 3 = 0 THEN value ELSE 0.0 END) AS inflow,
           sum(CASE WHEN event_id % 3 <> 0 THEN value ELSE 0.0 END) AS outflow, sum(value) AS volume
    FROM @events GROUP BY 1, 2, 3, 4, 5"""


def window_sql(h: int, table: str, group: str) -> str:
    return f"""
    SELECT date_trunc('day', bucket) AS date, {group}, avg(100 - abs((i - o) / nullif(i + o, 0)) * 100) AS avg_pct_netted,
           sum(abs(i - o)) AS total_netted, sum(v) AS total_volume
    FROM (SELECT {bucket_sql(h)} AS bucket, chain, asset_group, bridge, sum(inflow) AS i, sum(outflow) AS o, sum(volume) AS v
          FROM {table} GROUP BY ALL) x
    GROUP BY ALL HAVING avg(100 - abs((i - o) / nullif(i + o, 0)) * 100) > 0"""


ALL_BRIDGES = """(SELECT date, chain, asset_group, asset, 'all' AS bridge, sum(inflow) AS inflow, sum(outflow) AS outflow, sum(volume) AS volume
    FROM @fx_netting_hourly GROUP BY ALL
    UNION ALL SELECT date, chain, asset_group, asset, bridge, inflow, outflow, volume FROM @fx_netting_hourly) y"""
WINDOW_DOUBLES = "avg_pct_netted total_netted total_volume"


@query("D32_netting_by_window_3h", window_sql(3, "@fx_netting_hourly", "chain, bridge"), WINDOW_DOUBLES)
def _(t):
    return L.netting_by_window(t.fx_netting_hourly, 3, ["chain", "bridge"])


@query("D32_netting_by_window_1d", window_sql(24, "@fx_netting_hourly", "bridge"), WINDOW_DOUBLES)
def _(t):
    return L.netting_by_window(t.fx_netting_hourly, 24, ["bridge"])


@query("D33_all_bridges_rollup", window_sql(6, ALL_BRIDGES, "bridge"), WINDOW_DOUBLES)
def _(t):
    return L.netting_by_window(L.with_all_bridges(t.fx_netting_hourly), 6, ["bridge"])


@query(
    "D33_netting_variance",
    f"SELECT bridge, var_samp(avg_pct_netted) AS variance FROM ({window_sql(3, ALL_BRIDGES, 'bridge')}) w GROUP BY 1", "variance",
)
def _(t):
    return L.netting_variance(L.netting_by_window(L.with_all_bridges(t.fx_netting_hourly), 3, ["bridge"]))


@query(
    "D33_bridge_difference",
    f"""SELECT date, l AS left_mean, r AS right_mean, l - r AS diff FROM (
          SELECT date, avg(CASE WHEN bridge = 'b0' THEN avg_pct_netted END) AS l, avg(CASE WHEN bridge = 'b1' THEN avg_pct_netted END) AS r
          FROM ({window_sql(3, '@fx_netting_hourly', 'bridge')}) w GROUP BY 1) x WHERE l IS NOT NULL AND r IS NOT NULL""",
    "left_mean right_mean diff",
)
def _(t):
    return L.bridge_difference(L.netting_by_window(t.fx_netting_hourly, 3, ["bridge"]), "b0", "b1", "avg_pct_netted")


# --- batching ------------------------------------------------------------------------------

BATCH_SQL = """
WITH RECURSIVE f AS (SELECT source AS chain, asset, date, transfer_id, amount,
                            row_number() OVER (PARTITION BY source, asset ORDER BY date, transfer_id) AS rn FROM @fx_flows),
walk AS (
  SELECT chain, asset, rn, date AS start, 1 AS held, CAST(1 AS BIGINT) AS batch_id FROM f WHERE rn = 1
  UNION ALL
  SELECT f.chain, f.asset, f.rn,
         CASE WHEN w.held < 20 AND f.date - w.start <= INTERVAL 3 HOUR THEN w.start ELSE f.date END,
         CASE WHEN w.held < 20 AND f.date - w.start <= INTERVAL 3 HOUR THEN w.held + 1 ELSE 1 END,
         CASE WHEN w.held < 20 AND f.date - w.start <= INTERVAL 3 HOUR THEN w.batch_id ELSE w.batch_id + 1 END
  FROM walk w JOIN f ON f.chain = w.chain AND f.asset = w.asset AND f.rn = w.rn + 1)
"""


def batches(t):
    flows = t.fx_flows.withColumnRenamed("source", "chain").drop("target")
    return batch_transfers(flows, ["chain", "asset"], "date", "transfer_id", batch_size=20, window_hours=3)


@query("D34_batch_transfers", BATCH_SQL + "SELECT f.transfer_id, f.chain, f.asset, f.date, f.amount, w.batch_id FROM f JOIN walk w USING (chain, asset, rn)", "amount")
def _(t):
    return batches(t)


@query(
    "D34_aggregate_batches",
    BATCH_SQL
    + f"""SELECT w.batch_id, chain, asset, min(date) AS first_tx_date, max(date) AS last_tx_date, sum(amount) AS amount, count(*) AS tx_count
          FROM f JOIN walk w USING (chain, asset, rn) GROUP BY ALL HAVING min(date) < DATE '{AS_OF}'""",
    "amount",
)
def _(t):
    return aggregate_batches(batches(t), ["chain", "asset"], "date", ["amount"], as_of=AS_OF)


@query(
    "D41_route_flow_summary",
    """SELECT from_chain_name, to_chain_name, from_token_symbol, sum(from_amount_usd) AS volume_usd, avg(from_amount_usd) AS avg_size_usd,
              count(*) AS transfers FROM @fx_transfers GROUP BY ALL""",
    "volume_usd avg_size_usd",
)
def _(t):
    return L.route_flow_summary(t.fx_transfers, by_token=True, places=8)
