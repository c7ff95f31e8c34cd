from datetime import datetime

from pyspark.sql import functions as F

from tideledger.catalog import load_all
from tideledger.catalog.registry import Tables
from tideledger.plans import bridges as B
from tideledger.plans import flows as L
from tideledger.plans import routers as R
from tideledger.plans import settlement as S

SMALL = "/root/testdata/sf0.001"


def tables(spark):
    load_all()
    return Tables(spark, SMALL)


def test_net_flow_sums_to_zero(spark):
    rows = L.net_flow(tables(spark).fx_flows, 6, "source", "target")
    sums = rows.groupBy("date", "asset").agg(F.sum("net_amount").alias("s")).collect()
    assert sums and all(abs(r.s) < 1e-6 for r in sums)


def test_union_mart_counts_add_up(spark):
    from tideledger.catalog import bridges as CB

    t = tables(spark)
    parts = {b: CB.cleaned(t, b) for b in ("hop", "stargate", "synapse")}
    union = B.all_transfers(parts)
    assert union.count() == sum(p.count() for p in parts.values()) > 0
    assert union.select("id").distinct().count() == union.count()


def test_first_address_per_symbol(spark):
    rows = [("eth", "USDC", "0x2", "6"), ("eth", "USDC", "0x1", "6"), ("base", "USDC", "0x3", "18")]
    got = B.first_addresses(spark.createDataFrame(rows, "blockchain string, symbol string, contract_address string, decimals string"))
    assert sorted(r.contract_address for r in got.collect()) == ["0x1", "0x3"]


def test_stargate_default_decimals(spark):
    raw = spark.createDataFrame(
        [("h", "2024-01-01 00:00:00", "u", "base", "1", "linea", "ZZZ", "2000000000000000000", "1000000000000000000")],
        "from_hash string, from_date string, from_user string, from_chain_name string, to_chain_id string, to_chain_name string, from_token_symbol string, from_amount string, to_amount string",
    )
    meta = spark.createDataFrame([("base", "USDC", "0x1", "6")], "blockchain string, symbol string, contract_address string, decimals string")
    chains = spark.createDataFrame([(8453, "base")], "chain_id bigint, name string")
    row = B.stage_stargate(raw, meta, chains).first()
    assert (row.from_amount, row.to_amount, row.relay_amount, row.from_chain_id) == (2.0, 1.0, 1.0, 8453)


def test_router_ledger_returns_liquidity_after_the_lag(spark):
    epoch = 1704067200  # 2024-01-01 00:00 UTC
    events = spark.createDataFrame([("r", "0xA", "1", epoch, "Add", "100"), ("r", "0xA", "1", epoch, "Remove", "10")], "router string, asset string, domain string, timestamp bigint, event string, amount string")
    transfers = spark.createDataFrame([("k", epoch + 3600, '["r"]', "CompletedFast", "1", "0xa", "4000")], "canonical_id string, xcall_timestamp bigint, routers string, status string, destination_domain string, destination_local_asset string, destination_transacting_amount string")
    assets = spark.createDataFrame([("k", "1", "2")], "canonical_id string, domain string, adopted_decimal string")
    chains = spark.createDataFrame([("1", "Base")], "domainid string, chain string")
    tokens = spark.createDataFrame([("0xa", "ETH")], "token_address string, token_name string")
    prices = spark.range(24).select(F.lit("WETH").alias("symbol"), (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("date"), F.lit(2.0).alias("price"))
    got = R.router_utilization_hourly(events, transfers, assets, chains, tokens, prices).orderBy("date").collect()
    assert [r.total_locked for r in got] == [90.0] + [50.0] * 5 + [90.0]
    assert got[1].router_fee_usd == 40 * 0.0005 * 2 and got[2].router_volume is None and got[6].total_balance == 90.0 + 0.02


def test_netted_intents_have_no_invoice(spark):
    t = tables(spark)
    from tideledger.catalog import settlement as CS

    intents, invoices = CS.cleaned(t)
    netted = S.netting_daily(intents, invoices).agg(F.sum("netting_total_intents")).first()[0]
    joined = S.intents_with_invoices(intents, invoices).where("invoice_intent_id IS NULL").count()
    assert netted == joined > 0


def test_retention_starts_at_one(spark):
    rows = [("a", 1704067200), ("b", 1704067200), ("a", 1704067200 + 8 * 86400)]
    got = S.wallet_retention(spark.createDataFrame(rows, "initiator string, timestamp bigint")).orderBy("week").collect()
    assert [(r.users, r.weeks_since_cohort, r.retention_rate) for r in got] == [(2, 0, 1.0), (1, 1, 0.5)]
