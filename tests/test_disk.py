"""Queries that join the tables once and leave wide rows where they are: same rows, less disk."""

from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tideledger.catalog import load_all
from tideledger.catalog.fixtures import TABLES
from tideledger.catalog.registry import Tables
from tideledger.operators import ordered as O
from tideledger.operators import repeats as R
from tideledger.plans import bridges as B
from tideledger.session import SHUFFLES_GO, cut_lineage

T0 = datetime(1997, 3, 1)
ROWS = {
    "region": [(0, "R")],
    "nation": [(n, f"NATION_{n}", 0) for n in range(4)],
    "customer": [(1, "c", 0, 1.0, "m"), (2, "d", 1, 1.0, "m"), (2, "e", 1, 1.0, "m"), (None, "f", 1, 1.0, "m"), (3, "g", None, 1.0, "m")],
    "supplier": [(1, "s", 0, 1.0), (2, "t", 2, 1.0), (2, "t", 2, 1.0), (None, "u", 1, 1.0), (3, "v", 1, 1.0)],
    "part": [(1, "p", "Brand#1", "t", 1, 1.0), (2, "q", "Brand#2", "t", 1, 1.0), (2, "q", "Brand#2", "t", 1, 1.0), (3, "r", None, "t", 1, 1.0)],
    "orders": [(o, 1 + o % 4, "F", 1000.0 * o, T0 + timedelta(days=o % 3), "x") for o in range(1, 9)] + [(4, 1, "O", 5.0, None, "x"), (None, 1, "F", 1.0, T0, "x")],
    "lineitem": [
        (o, p, s, line, 2.0, 900.0 * line + (o or 0), 0.05, 0.02, flag, "F", T0)
        for o in (1, 2, 3, 4, 5, 5, None) for p, s, line, flag in ((1, 1, 1, "A"), (2, 2, 2, "N"), (3, 1, 3, "R"), (2, 1, 4, "A"), (2, None, 5, "N"), (1, 2, 6, "R"), (1, 2, 6, "N"), (1, 3, 7, "A"), (1, 3, 4, "A"))
    ],
    "events": [],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, TABLES[name]).write.parquet(f"{path}/{name}.parquet")
    return path


def listed(df):
    return sorted(map(str, df.collect()))


def test_stored_moves_are_the_view(spark, folder):
    view, stored = Tables(spark, folder), Tables(spark, folder)
    stored.store("fx_moves")
    assert stored.fx_moves.schema == view.fx_moves.schema or stored.fx_moves.dtypes == view.fx_moves.dtypes
    assert listed(stored.fx_moves) == listed(view.fx_moves) and view.fx_moves.count() > 50
    written = pq.read_schema(stored.fx_moves.inputFiles()[0].removeprefix("file:")).names
    assert "l_orderkey" in written and "move_id" not in written and "cents" not in written


def test_cut_tables_free_their_shuffles(spark):
    before = spark.conf.get(SHUFFLES_GO)
    table = cut_lineage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert spark.conf.get(SHUFFLES_GO) == before and ".zstd." in table.inputFiles()[0] and table.count() == 7


def test_rows_whose_key_comes_again(spark):
    df = spark.createDataFrame([(n, "once") for n in range(50)] + [(7, "other"), (None, "x"), (None, "y"), (60, "z"), (60, "z")], "k int, v string")
    again, once = R.split_repeated(df, "k")
    assert {row.k for row in again.collect()} == {7, 60, None} and once.count() == 49
    assert R.split_repeated(df.where("k < 5"), "k")[0] is None
    got = R.without_copies(df, "k", lambda rows: rows.withColumn("w", F.upper("v")), lambda rows: rows.distinct(), True)
    assert listed(got) == listed(df.withColumn("w", F.upper("v")).distinct())


@pytest.mark.parametrize("bridge", ["allbridge", "debridge", "hop", "synapse"])
def test_stored_bridges_keep_the_same_rows(spark, folder, bridge):
    """Ids of one row, of equal rows and of different rows: the same rows stay; only rows of ids that come again are shuffled."""
    from tideledger.catalog import bridges as C

    view, stored = Tables(spark, folder), Tables(spark, folder)
    stored.store("fx_moves")
    expected, got = C.STAGED[bridge](view), C.STAGED[bridge](stored, stored=True)
    assert got.columns == expected.columns and listed(got) == listed(expected) and got.count() > 0
    single = cut_lineage(stored.fx_moves.where("move_id IS NOT NULL").dropDuplicates(["l_orderkey", "l_linenumber"]))

    def steps(flag):
        tables = Tables(spark, folder)
        tables.known["fx_moves"] = single
        plan = C.STAGED[bridge](tables, stored=flag)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Aggregate [") + plan.count("Window [")

    assert steps(True) == steps(False) - 1


def test_numbers_by_time_and_hash(spark):
    rows = [(T0 + timedelta(hours=n % 30, seconds=n % 2), f"{n * 7919 % 4096:X}", n) for n in range(900)] + [(None, "0", 1), (None, "A", 2), (T0, "B", 3), (T0, "", 4)]
    df = spark.createDataFrame(rows, "ts timestamp, h string, n int")
    want = df.selectExpr("ts", "h", "n", "cast(row_number() OVER (ORDER BY ts DESC NULLS LAST, h, n) as bigint) AS number")
    got = O.numbered(df, "ts", "h", "number")
    assert got.columns == want.columns
    assert {(r.ts, r.h, r.number) for r in got.collect()} == {(r.ts, r.h, r.number) for r in want.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert O.numbered(df.limit(0), "ts", "h", "number").count() == 0


def test_exact_numbers_of_bridges(spark):
    rows = [("b", T0 + timedelta(minutes=n % 5), f"t{n}") for n in range(40)] + [("b", None, "t")]
    df = B.canonical(spark.createDataFrame(rows, "bridge string, from_date timestamp, from_tx_hash string"))
    got = B.all_transfers({"x": df}, exact_numbers=True).collect()
    assert sorted(int(r.id.split("_")[1]) for r in got) == list(range(1, 42))
    by_number = [r.from_date for r in sorted(got, key=lambda r: int(r.id.split("_")[1]))]
    assert by_number[-1] is None and by_number[:-1] == sorted(by_number[:-1], reverse=True)


def test_mart_of_odd_tables(spark, folder):
    """The mart over tables with null and repeated keys has the rows that its bridges have one by one."""
    from tideledger.catalog import bridges as C

    run = load_all()[0]["D9_all_transfers"]
    got = {r.label: r["count"] for r in run(spark, folder).groupBy("label").count().collect()}
    one_by_one = {b: C.cleaned(Tables(spark, folder), b).count() for b in C.MART}
    assert got == {b: n for b, n in one_by_one.items() if n}


def test_transfers_meet_deposits_before_fees_are_valued(spark):
    """The rebates are those of the valued fees; lists of assets are stored, so only the deposits' join shuffles transfers."""
    from tideledger.plans import transfers as T

    domains = ("6648936", "6450786", "999")
    rows = [
        (f"t{n}", "S1", 1_000_000 + 600 * n, domains[n % 3], domains[(n + 1) % 3], ("0xA", "0xb", None)[n % 3], "0xB", "1000000", "900000",
         ("CompletedFast", "CompletedSlow", "XCalled")[n % 3 if n % 2 else 0], ('{}', '{"0xA":"5000","0x0000000000000000000000000000000000000000":"70"}', '{"0xb":"9"}', None)[n % 4],
         f"h{n % 20}" if n % 7 else None, "30", "2000" if n % 5 else None)
        for n in range(60)
    ]
    names = (
        "transfer_id string, canonical_id string, xcall_timestamp long, origin_domain string, destination_domain string, origin_transacting_asset string, "
        "destination_transacting_asset string, origin_transacting_amount string, destination_transacting_amount string, status string, relayer_fees string, "
        "xcall_transaction_hash string, xcall_gas_price string, xcall_gas_limit string"
    )
    transfers = spark.createDataFrame(rows, names)
    assets = spark.createDataFrame([("S1", d, "6") for d in domains[:2]] * 2, "canonical_id string, domain string, adopted_decimal string")
    tokens = spark.createDataFrame([("0xa", "ETH"), ("0xb", "nextS3"), ("0xb", "nextS3")], "token_address string, token_name string")
    hour = datetime(1970, 1, 12, 13)
    prices = spark.createDataFrame([(s, hour + timedelta(hours=h), 2.0 + h) for s in ("WETH", "BNB", "S3") for h in range(4)], "symbol string, date timestamp, price double")
    deposits = spark.createDataFrame(
        [(f"h{n}", f"u{n}", T.FEE_CHAINS.get(d, d)) for n in range(15) for d in domains] + [("h1", "v", T.FEE_CHAINS["6450786"]), (None, "w", "999")],
        "hash string, user_address string, origin_chain string",
    )
    given = (transfers, assets, tokens, prices)
    got = T.rebates(*given, deposits, prices.where("symbol = 'S3'"))
    want = T.fee_rebate(T.transfer_fees(*given), deposits, prices.where("symbol = 'S3'"))
    assert got.dtypes == want.dtypes and listed(got) == listed(want) and got.where("user_address = 'v'").count() > 0
    assert got.where("total_fee_usd > 0 AND price IS NOT NULL").count() > 5
    steps = T.transfer_fees(*given)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in steps and "Exchange hashpartitioning" not in steps
