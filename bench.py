"""Headline queries timed on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tideledger.catalog import load_all
from tideledger.catalog.fixtures import TABLES
from tideledger.session import build_session

HEADLINE = (
    "D1_stage_across",
    "D7_stage_synapse",
    "D8_clean_across",
    "D8_clean_allbridge",
    "D9_all_transfers",
    "D12_minute_prices_filled",
    "D13_bridge_volume_daily",
    "D14_all_bridge_volume_daily",
    "D17_clean_quotes",
    "D18_rank_bridges",
    "D19_best_route_vs_tracked",
    "D25_net_flow_1h",
    "D26_net_flow_stats_by_day_asset",
    "D27_net_flow_grid",
    "D28_multi_bridge_netflow_hourly",
    "D31_deposit_withdraw_by_asset_chain",
    "D34_batch_transfers",
    "D35_transfers_usd_asof",
    "D36_transfers_usd_hourly",
    "D37_transfers_slippage",
    "D38_transfer_counts",
    "D39_fee_rebate",
    "D42_router_utilization_hourly",
    "D43_router_tvl_daily",
    "D53_intents_with_invoices",
    "D54_settlement_daily",
    "D56_settlement_rates_daily",
    "D58_cohort_ndr_gdr",
    "D59_wallet_retention",
    "D61_intent_profit",
    "J7_asof_price",
    "W6_running_sum",
    "W4_rank_hot_groups",
    "S5_flatten_routes",
    "S21_profile_lineitem",
)


def in_several_files(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables in a scratch folder, the large ones in several files.

    The test files have one row group each, which one task would read, whatever the number of cores.
    """
    scratch = tempfile.mkdtemp(prefix="bench-tables-")
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in ("lineitem", "orders", "events"):
            df = df.repartition(files, df.columns[0])
        df.write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def main(names: tuple[str, ...]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    sf_dir = in_several_files(spark, sf_dir, int(cpus))
    queries, _ = load_all()
    # one small query first, so that JVM start-up is not counted
    queries["A1_group_by"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(tuple(sys.argv[1:]) or HEADLINE)
