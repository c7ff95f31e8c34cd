"""Joins and ranks that leave wide rows where they are: right results, and the plans that say so."""

import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tideledger.operators import joins as JN
from tideledger.operators import ordered as O
from tideledger.plans import bridges as B
from tideledger.plans import quotes as Q
from tideledger.plans import transfers as T

T0 = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_books_are_broadcast(spark):
    """A price table of unknown size is stored first, so facts are not shuffled to meet it."""
    facts = spark.createDataFrame([(1, T0 + timedelta(minutes=5), "A"), (2, T0, "B"), (3, T0, None), (4, None, "A")], "id long, at timestamp, s string")
    prices = spark.createDataFrame([("A", T0, 2.0), ("A", T0, 3.0), ("B", T0, 5.0), (None, T0, 7.0)], "symbol string, date timestamp, price double")
    got = JN.price_book_roles(facts, prices, "at", {"p": "s"})
    assert {r.id: r.p for r in got.collect()} == {1: 2.0, 2: 5.0, 3: None, 4: None}
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


def test_last_prices_are_broadcast(spark):
    facts = spark.createDataFrame([(1, "A", T0 + timedelta(minutes=40)), (2, "A", T0 - timedelta(hours=1)), (3, None, T0)], "id long, k string, at timestamp")
    ticks = spark.createDataFrame([("A", T0, 2.0), ("A", T0 + timedelta(minutes=1), 4.0), ("B", T0, 9.0)], "k string, ts timestamp, price double")
    got = JN.price_at_or_before(facts, ticks, "k", "at")
    assert {r.id: r.price for r in got.collect()} == {1: 4.0, 2: None, 3: None}
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


def test_bridges_are_valued_without_copies_of_rows(spark):
    staged = spark.createDataFrame(
        [("stargate_v2", "i", "h", T0 + timedelta(minutes=7), token, 10.0, 8.0) for token in ("X", "X", "Y", None)],
        "bridge string, id string, from_hash string, from_date timestamp, from_token_symbol string, from_amount double, to_amount double",
    ).withColumns({c: F.lit(None).cast("string") for c in ("to_hash", "from_address", "to_address", "to_token_symbol", "gas_token_symbol", "relay_symbol")})
    aliases = spark.createDataFrame([("X", "S"), ("Y", "other")], "token_symbol string, price_symbol string")
    prices = spark.createDataFrame([("S", T0, 2.0)], "symbol string, date timestamp, price double")
    got = B.clean_stargate(staged, aliases, prices)
    assert [(r.from_token_symbol, r.from_amount_usd, r.to_amount_usd, r.relay_amount_usd) for r in got.collect()] == [("X", 20.0, 16.0, 4.0)] * 2
    assert "Generate" not in plan(got) and "SortMergeJoin" not in plan(got)


def test_ranks_with_one_shuffle_of_the_rows(spark):
    values = [None, None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.0, 1.0, 1.02, 100.0, 100.5, -3.0, -3.1, 1e300]
    rows = [(k, v, i) for k in ("a", None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v double, i int").union(spark.createDataFrame([("b", 1.0, 0)] * 3, "k string, v double, i int"))
    for down, ends in ((True, "DESC NULLS LAST"), (False, "ASC NULLS FIRST")):
        want = df.selectExpr("k", "v", "i", f"cast(rank() OVER (PARTITION BY k ORDER BY v {ends}) as bigint) AS r")
        got = O.ranked_rows(df, ["k"], "v", "r", descending=down)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
    assert O.ranked_rows(df, ["k"], "v", "r", distinct=True).where("k = 'b'").count() == 1


def test_quotes_are_distinct_in_each_source(spark):
    row = (T0, "x", "b", 1, "1", "2", "S", "S", "f", 1.0, 2.0, 0.0, 0.0, 2.0)
    schema = (
        "date timestamp, aggregator string, bridges string, total_user_tx int, from_chain string, to_chain string, from_token string, to_token string, "
        "fee_type string, in_value_usd double, out_value_usd double, fee_usd double, gas_fee double, final_out_amount double"
    )
    df = spark.createDataFrame([row, row], schema)
    assert [r.max_value_rank_by_output for r in Q.clean_quotes(df, df).collect()] == [1, 1]
    assert Q.distinct_quotes(df, df).count() == 2
    # rows are dealt once, before they are made distinct: no join on each value
    assert plan(Q.clean_quotes(df, df)).count("final_out_amount") > 0 and "<=>" not in plan(Q.clean_quotes(df, df))
    best = Q.best_route_vs_tracked(df, F.col("bridges") == "b")
    assert [r.tracked_max_value_rank_by_output for r in best.collect()] == [1] * 4


def test_pathways_meet_once(spark):
    """Copies of a configured and a served pathway do not meet in pairs."""
    ends = "from_chain_id int, from_token_address string, to_chain_id int, to_token_address string"
    served = spark.createDataFrame([(1, "a", 2, "b", "990"), (1, "a", 2, "b", "1010"), (1, "a", 2, "b", "none")] * 3, ends + ", from_amount string")
    configured = spark.createDataFrame([(1, "a", 2, "b"), (1, "a", 3, "b")] * 3, ends)
    got = Q.calculated_pathways(served, configured)
    assert sorted((r.to_chain_id, r.nearest_power_of_ten_amount or 0) for r in got.collect()) == [(2, 0), (2, 1000.0), (3, 0)]
    below = logical(got).split("Join", 1)[1]
    assert below.count("Aggregate") == 2


def test_deposit_lists_are_dealt_once(spark):
    one = spark.createDataFrame([("h1", "U", "bnb"), ("h1", "U", "bnb"), (None, "V", "x")], "hash string, who string, origin_chain string")
    two = spark.createDataFrame([("h1", "u")], "hash string, who string")
    got = T.deposit_users((one, "hash", "who", None), (two, "hash", "who", "bnb"))
    bnb = T.FEE_CHAINS["6450786"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("h1", "u", bnb), ("h1", "u", bnb), (None, "v", "x")]))
    assert plan(got.select("*")).count("Exchange") == 1
