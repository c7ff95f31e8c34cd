import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideledger.session import new_path
from tideledger.sources import documents as D
from tideledger.sources import incremental as I
from tideledger.sources import schemas as SC
from tideledger.sources import sinks as K
from tideledger.sources import tables as T


def test_literal_table_quotes_and_nulls(spark):
    got = T.literal(spark, [("it's", 1), (None, 2), ("a\\b", None)], "s string, n bigint").collect()
    assert [tuple(r) for r in got] == [("it's", 1), (None, 2), ("a\\b", None)]


def test_column_names():
    assert T.snake_case("fromChainId") == "from_chain_id" and T.snake_case("a.bC") == "a_b_c"


def cost(name):
    token = {"address": "a", "chainId": 1, "symbol": "S", "decimals": 6, "name": "n", "priceUSD": "1"}
    return {"name": name, "amount": "1", "amountUSD": "1", "token": token}


def route(steps):
    token = cost("x")["token"]
    return {
        "id": "r", "fromChainId": 1, "toChainId": 2, "fromAmountUSD": "1", "toAmountUSD": "1", "gasCostUSD": "0", "fromAmount": "1", "toAmount": "1",
        "tags": ["T"], "fromToken": token, "toToken": token, "steps": steps,
    }


def step(ident, fees):
    estimate = {"fromAmount": "1", "toAmount": "1", "feeCosts": fees, "gasCosts": [cost("g" + ident)]}
    return {"id": ident, "type": "t", "tool": "tool", "toolDetails": {"key": "k", "name": "n"}, "estimate": estimate}


def test_routes_without_fees_and_empty_documents(spark):
    docs = [
        {"routes": [route([step("0", []), step("1", [cost("late")])]), route([step("2", [])])]},
        {"routes": [], "unavailableRoutes": {"failed": [{"overallPath": "p", "subpaths": "s"}]}},
        {"routes": None},
        {},
    ]
    df = D.parse_documents(spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string"), "doc", SC.ROUTE_DOCUMENTS)
    got = D.flatten_routes(df).select("id", "step_index", "fee_name").collect()
    assert [tuple(r) for r in got] == [("0", 0, "late")]
    assert D.flatten_routes(df, drop_incomplete=False).count() == 3
    assert [r.overallpath for r in D.flatten_calls(df).collect()] == ["p"]


def test_dates_with_and_without_fraction(spark):
    docs = [{"id": 1, "created_at": "2024-01-02T03:04:05.678Z", "mined_at": "2024-01-02T03:04:05Z", "tokens": [], "from_route": None}, {"id": 2, "created_at": "bad"}]
    df = D.parse_documents(spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string"), "doc", SC.MULTI_HOP_TRANSACTIONS)
    got = D.normalize_multi_hop(df).orderBy("id").collect()
    assert got[0].created_at == got[0].mined_at == datetime(2024, 1, 2, 3, 4, 5)
    assert got[0].token_symbol is None and got[1].created_at is None and got[0].tokens == "[]"


def test_json_files_with_a_time_in_the_name(spark):
    path = new_path(spark, "docs") + "/2024-02-13T10:11:12.json"
    spark.createDataFrame([(1,)], "a int").write.json(path)
    assert D.read_documents(spark, path, "a int", stamp=True).first().upload_datetime == datetime(2024, 2, 13, 10, 11, 12)


def test_duplicate_load_is_rewritten_once(spark):
    path = new_path(spark, "dups")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    K.append(df, path)
    K.append(df, path)
    clean = K.rewrite_distinct(spark, path)
    assert clean.read().count() == 2 and spark.read.parquet(path).count() == 4
    assert [version for version, _ in clean.versions()] == [1]


def test_readers_see_whole_tables(spark):
    """Before, during and after a rewrite, and after one that fails."""
    path = new_path(spark, "swapped")
    K.append(spark.range(10).selectExpr("id % 5 AS k"), path)
    table = K.VersionedTable(spark, path)
    before = table.read()
    broken = table.read().selectExpr("if(k = 3, raise_error('broken'), k) AS k")
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    assert table.current() == (0, path) and table.read().count() == 10
    K.rewrite_distinct(spark, path)
    assert before.count() == 10 and table.read().count() == 5
    held = table.read()
    assert table.replace(table.read().where("k > 0")) == 2
    assert held.count() == 5 and table.read().count() == 4
    with pytest.raises(RuntimeError):
        table.replace(held, expected=1)
    assert table.read().count() == 4 and [version for version, _ in table.versions()] == [1, 2]


def test_increment_starts_at_the_default_for_an_empty_target(spark):
    src = spark.createDataFrame([(1,), (5,), (9,)], "k int")
    empty = src.where("k < 0")
    assert sorted(r.k for r in I.increment(src, empty, "k", 4).collect()) == [5, 9]
    assert sorted(r.k for r in I.increment(src, src.where("k < 6"), "k").collect()) == [9]


def test_boundary_rows_of_the_last_time(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "t int, h string")
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "t int, h string")
    assert sorted(r.h for r in I.increment_with_boundary(src, stored, "t", "h").collect()) == ["c", "d"]
    assert I.increment_with_boundary(src, stored.where("t > 9"), "t", "h").count() == 4


def test_merge_prefers_later_rows_and_the_delta_on_ties(spark):
    base = spark.createDataFrame([(1, 5, "base"), (2, 5, "base"), (3, 9, "base")], "k int, v int, s string")
    delta = spark.createDataFrame([(1, 6, "delta"), (2, 5, "delta"), (3, 1, "delta"), (4, 1, "delta")], "k int, v int, s string")
    assert {r.k: r.s for r in I.merge_latest(base, delta, ["k"], "v").collect()} == {1: "delta", 2: "delta", 3: "base", 4: "delta"}


def test_no_symbol_runs_ahead(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), ("b", 3)], "s string, t int")
    assert sorted((r.s, r.t) for r in I.complete_only(df, "s", "t").collect()) == [("a", 1), ("b", 2), ("b", 3)]


def test_mart_splits_a_hot_partition_over_tasks(spark):
    path = new_path(spark, "mart")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    K.write_mart(spark.range(20000).select("id", F.lit("hot").alias("bridge")), path, ["bridge"])
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(path).count() == 20000 and len(spark.read.parquet(path).inputFiles()) > 1
