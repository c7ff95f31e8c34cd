import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideledger.operators import joins as JN
from tideledger.operators import netting as N
from tideledger.operators import ordered as O
from tideledger.operators import quality as Q
from tideledger.operators import series as SR
from tideledger.operators import windows as W
from tideledger.operators.batching import aggregate_batches, batch_transfers

T0 = datetime(2024, 1, 1)


def at(**kw):
    return T0 + timedelta(**kw)


def test_in_out_keeps_one_sided_nodes_and_drops_null_ones(spark):
    rows = [("a", "b", 5.0), ("a", None, 2.0), (None, "c", 1.0)]
    got = {r.chain: (r.inflow, r.outflow) for r in N.in_out(spark.createDataFrame(rows, "s string, t string, v double"), "s", "t", "v").collect()}
    assert got == {"a": (7.0, 0.0), "b": (0.0, 5.0), "c": (0.0, 1.0)}


def test_in_out_direction_flag(spark):
    df = spark.createDataFrame([("a", "b", 5.0)], "s string, t string, v double")
    got = {r.chain: (r.inflow, r.outflow) for r in N.in_out(df, "s", "t", "v", inflow_is_source=False).collect()}
    assert got == {"a": (0.0, 5.0), "b": (5.0, 0.0)}


def test_netted_share_without_movement_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 1.0)], "inflow double, outflow double")
    assert [r.pct_netted for r in N.with_net(df).collect()] == [None, 50.0]


def test_asof_before_first_tick_and_in_missing_buckets(spark):
    ticks = spark.createDataFrame([("x", at(hours=1), 10.0), ("x", at(hours=1, minutes=10), 12.0), ("x", at(hours=3), 7.0)], "k string, ts timestamp, price double")
    facts = spark.createDataFrame([(1, "x", at(minutes=5)), (2, "x", at(hours=1, minutes=1)), (3, "x", at(hours=2, minutes=59)), (4, "x", at(hours=9)), (5, "y", at(hours=9)), (6, None, at(hours=9))], "id int, k string, at timestamp")
    got = {r.id: r.price for r in JN.price_at_or_before(facts, ticks, "k", "at").collect()}
    assert got == {1: None, 2: 12.0, 3: 12.0, 4: 7.0, 5: None, 6: None}


def test_lookup_ignores_case_and_keeps_null_keys(spark):
    facts = spark.createDataFrame([(1, "0xAB"), (2, None), (3, "0xff")], "id int, a string")
    dim = spark.createDataFrame([("0xab", "T")], "address string, symbol string")
    got = {r.id: r.s for r in JN.lookup(facts, dim, {"a": "address"}, {"symbol": "s"}, ignore_case=["a"]).collect()}
    assert got == {1: "T", 2: None, 3: None}


def test_either_key_lookup_does_not_repeat_rows(spark):
    facts = spark.createDataFrame([(1, "l", "d"), (2, "p", "d"), (3, "z", "d")], "id int, asset string, domain string")
    dim = spark.createDataFrame([("d", "l", "l", "6"), ("d", "m", "p", "8")], "domain string, local string, adopted string, decimal string")
    rows = JN.either_key_lookup(facts, dim, "asset", ["local", "adopted"], {"domain": "domain"}, {"decimal": "decimal"}).collect()
    assert {r.id: r.decimal for r in rows} == {1: "6", 2: "8", 3: None} and len(rows) == 3


def test_running_total_shares_ties_and_crosses_days(spark):
    rows = [("k", at(hours=1), 5.0), ("k", at(hours=1), -2.0), ("k", at(days=1, seconds=1), 4.0), ("k", at(days=40), 1.0), (None, at(hours=1), 9.0), (None, at(days=2), 1.0)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, v double")
    for units in (("day",), ("day", "second")):
        got = [(r.key, r.running) for r in O.running_total(df, ["key"], "ts", "v", units=units).orderBy("key", "ts").collect()]
        assert got == [(None, 9.0), (None, 10.0), ("k", 3.0), ("k", 7.0), ("k", 8.0)]


def test_rank_of_hot_groups_equals_plain_rank(spark):
    random.seed(3)
    rows = [(i, random.choice(["hot", "hot", "hot", "b", None]), random.choice([None, *range(20)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    got = O.ranked(df, ["g"], "v", "r")
    assert {x.id: x.r for x in got.collect()} == {x.id: x.r for x in want.collect()}


def test_dimension_rows_with_one_key_in_any_order(spark):
    facts = spark.createDataFrame([(1, "a")], "k int, name string")
    for rows in ([(1, "b"), (1, "a")], [(1, "a"), (1, "b")]):
        dim = spark.createDataFrame(rows, "key int, value string")
        assert JN.lookup_roles(facts, dim, "key", "value", {"k": "found"}).first().found == "a"
        wide = dim.select("key", F.col("key").alias("other"), "value")
        assert JN.either_key_lookup(facts, wide, "k", ["key", "other"], {}, {"value": "found"}).first().found == "a"


def test_row_numbers_are_exact(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    got = O.with_row_number(df, "x", name="n").collect()
    assert sorted((r.x, r.n) for r in got) == [(i, i + 1) for i in range(5000)]


def test_row_id_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(O.row_id("x", "y").alias("i")).distinct().count() == 2


def test_latest_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 2, "r"), (None, 5, "s")], "k string, t int, v string")
    assert sorted(r.v for r in W.extreme_with_ties(df, ["k"], "t").collect()) == ["q", "r", "s"]
    assert sorted(r.v for r in W.latest_per_key(df, ["k"], F.col("t").desc(), F.col("v")).collect()) == ["q", "s"]


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    plan = W.latest_per_key(df, ["k"], F.col("t").desc())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_full_rolling_needs_all_rows(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 5)], "k string, d int, v double")
    got = [r.m for r in df.select("d", W.moving_mean("v", ["k"], "d", 3, full_only=True).alias("m")).orderBy("d").collect()]
    assert got == [None, None, 2.0, 3.0]


def test_grid_fills_gaps_forward_only(spark):
    rows = [("a", at(), 1.0, 5.0), ("a", at(hours=3), None, 6.0), ("b", at(hours=1), 2.0, None)]
    grid = SR.regular_grid(spark.createDataFrame(rows, "k string, t timestamp, p double, q double"), ["k"], "t", "1 hour", ["p"], ["q"])
    got = [(r.k, r.t.hour, r.p, r.q) for r in grid.orderBy("k", "t").collect()]
    assert got == [("a", 0, 1.0, 5.0), ("a", 1, 1.0, None), ("a", 2, 1.0, None), ("a", 3, 1.0, 6.0), ("b", 1, 2.0, None)]


def test_grid_fills_gaps_of_years(spark):
    """Every minute of three years between two ticks, in pieces."""
    rows = [("a", T0, 1.0), ("a", T0 + timedelta(days=1096, minutes=7), 2.0), ("a", T0 + timedelta(days=1096, minutes=8), 3.0)]
    grid = SR.regular_grid(spark.createDataFrame(rows, "k string, t timestamp, p double"), ["k"], "t", "1 minute", ["p"])
    got = grid.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("t").alias("d"), F.min("t").alias("a"), F.max("t").alias("z")).collect()
    minutes = 1096 * 1440 + 7
    assert {r.p: (r.n, r.d) for r in got} == {1.0: (minutes, minutes), 2.0: (1, 1), 3.0: (1, 1)}
    assert {(r.a, r.z) for r in got if r.p == 1.0} == {(T0, rows[1][1] - timedelta(minutes=1))}


def test_row_numbers_and_batches_of_equal_rows(spark):
    """Rows equal in all sort keys, some of them null, get numbers of their own."""
    rows = [(None, 1), (None, 1), (2, 5), (2, 5), (2, 5), (1, 9)]
    df = spark.createDataFrame(rows, "x int, y int")
    got = O.with_row_number(df, "x", "y", name="n", descending=["x"]).collect()
    assert sorted(r.n for r in got) == [1, 2, 3, 4, 5, 6]
    assert {r.n for r in got if r.x == 2} == {1, 2, 3} and {r.n for r in got if r.x is None} == {5, 6}
    same = spark.createDataFrame([("k", T0, 1)] * 5 + [("k", T0 + timedelta(hours=9), 1)] * 2, "k string, t timestamp, id int")
    batched = batch_transfers(same, ["k"], "t", "id", 2, 1, rows_per_chunk=2).collect()
    assert sorted(r.batch_id for r in batched) == [1, 1, 2, 2, 3, 4, 4]
    assert {r.batch_id for r in batched if r.t > T0} == {4}


def walk(rows, size, hours):
    """Plain greedy batching, row by row."""
    out, start, held, batch = {}, None, 0, 0
    for ts, ident in sorted(rows):
        if start is None or held >= size or ts - start > timedelta(hours=hours):
            start, held, batch = ts, 0, batch + 1
        held += 1
        out[ident] = batch
    return out


def test_batches_equal_the_row_by_row_walk_over_many_chunks(spark):
    random.seed(5)
    rows, ident = [], 0
    for key, n in (("hot", 1500), ("warm", 120), ("one", 1), (None, 200)):
        t = T0
        for _ in range(n):
            t += timedelta(seconds=random.choice([0, 0, 1, 30, 600, 4000]))
            rows.append((ident, key, t, 1.0))
            ident += 1
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v double")
    for size, hours in ((7, 1), (1, 5), (50, 0.5), (10_000, 2)):
        got = batch_transfers(df, ["k"], "t", "id", size, hours, rows_per_chunk=90).collect()
        want = {}
        for key in ("hot", "warm", "one", None):
            want |= walk([(t, i) for i, k, t, _ in rows if k == key], size, hours)
        assert {r.id: r.batch_id for r in got} == want


def test_batch_exactly_at_size_and_window_end(spark):
    rows = [(i, "k", at(hours=i), 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v double")
    assert {r.id: r.batch_id for r in batch_transfers(df, ["k"], "t", "id", 2, 10).collect()} == {0: 1, 1: 1, 2: 2, 3: 2}
    batched = batch_transfers(df, ["k"], "t", "id", 10, 2)
    assert {r.id: r.batch_id for r in batched.collect()} == {0: 1, 1: 1, 2: 1, 3: 2}
    assert [r.tx_count for r in aggregate_batches(batched, ["k"], "t", ["v"], as_of="2024-01-02").orderBy("batch_id").collect()] == [3, 1]
    assert aggregate_batches(batched, ["k"], "t", ["v"], as_of="2024-01-01").count() == 0


def test_profile_medians_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (10, None), (11, "b")], "n int, s string")
    got = {r.column_name: r for r in Q.profile(df, "t").collect()}
    assert got["n"].median == 6.0 and got["n"].is_unique and got["n"].not_null_proportion == 1.0
    assert got["s"].distinct_count == 2 and got["s"].not_null_proportion == 0.75 and got["s"].median is None


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (None, 2.0)], "k int, v double")
    rules = [Q.Rule("not_null", ("k",)), Q.Rule("unique", ("k",)), Q.Rule("at_least", ("v",), 0), Q.Rule("exists", ("zz",)), Q.Rule("type", ("v",), "double")]
    assert {r.rule: r.violations for r in Q.expect(df, rules).collect()} == {"not_null(k)": 1, "unique(k)": 1, "at_least(v)": 1, "exists(zz)": 1, "type(v)": 0}


def test_intermediate_tables_are_deleted(spark):
    import os

    from tideledger.session import cut_lineage, intermediate_tables

    with intermediate_tables(spark) as folder:
        assert cut_lineage(spark.range(5)).count() == 5
        plain = folder.removeprefix("file://").removeprefix("file:")
        assert os.path.isdir(plain)
    assert not os.path.exists(plain)
