import time
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideledger.operators.batching import batch_transfers
from tideledger.plans.flows import net_flow
from tideledger.session import new_path
from tideledger.streaming import files as SF
from tideledger.streaming import flows as SL

T0 = datetime(2024, 1, 1)
SCHEMA = "id bigint, date timestamp, source string, target string, asset string, amount double"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def rows(start, n):
    return [(i, T0 + timedelta(minutes=20 * i), f"c{i % 3}", f"c{(i + 1) % 3}", "A", float(i)) for i in range(start, start + n)]


def run(spark, stream, path):
    query = SF.load_new_files(stream, path, path + "-state")
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.parquet(path)


def test_windowed_flow_equals_batch_and_drops_late_rows(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    stream = lambda: SL.windowed_net_flow(SF.watch_files(spark, folder, SCHEMA, "parquet"), "source", "target", "amount", "date", 6, "1 hour")
    land(spark, folder, rows(0, 200))
    run(spark, stream(), out)
    land(spark, folder, [(999, T0, "c0", "c1", "A", 1e6)])
    got = run(spark, stream(), out)
    batch = net_flow(spark.createDataFrame(rows(0, 200), SCHEMA), 6, "source", "target")
    last = T0 + timedelta(minutes=20 * 199) - timedelta(hours=1)
    want = {(r.date, r.chain): round(r.net_amount, 6) for r in batch.collect() if r.date + timedelta(hours=6) <= last}
    assert {(r.date, r.chain): round(r.net_amount, 6) for r in got.collect()} == want and want


def test_the_same_rows_are_appended_once(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    for _ in range(2):
        land(spark, folder, rows(0, 5))
        query = SF.append_once(SF.watch_files(spark, folder, SCHEMA, "parquet"), out, out + "-state", ["id"])
        query.awaitTermination()
        assert query.exception() is None
    assert sorted(r.id for r in spark.read.parquet(out).select("id").collect()) == [0, 1, 2, 3, 4]


def test_batches_go_on_over_triggers(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    for part in (rows(0, 23), rows(23, 30)):
        land(spark, folder, part)
        stream = SL.batch_stream(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["source", "asset"], "date", "id", 4, 5)
        got = run(spark, stream, out)
    want = batch_transfers(spark.createDataFrame(rows(0, 53), SCHEMA), ["source", "asset"], "date", "id", 4, 5)
    assert {r.id: r.batch_id for r in got.collect()} == {r.id: r.batch_id for r in want.collect()}


def test_batches_in_a_session_with_other_settings(spark):
    """A stream keeps its state in RocksDB where the session names another store; the session's own setting comes back."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, other = spark.conf.get(provider), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    spark.conf.set(provider, other)
    try:
        land(spark, folder, rows(0, 23))
        got = run(spark, SL.batch_stream(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["source", "asset"], "date", "id", 4, 5), out)
        assert spark.conf.get(provider) == other
    finally:
        spark.conf.set(provider, before)
    want = batch_transfers(spark.createDataFrame(rows(0, 23), SCHEMA), ["source", "asset"], "date", "id", 4, 5)
    assert {r.id: r.batch_id for r in got.collect()} == {r.id: r.batch_id for r in want.collect()}


def test_rows_without_a_time_have_no_batch(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    land(spark, folder, rows(0, 3) + [(9, None, "c0", "c1", "A", 1.0), (10, None, "c9", "c1", None, 1.0)])
    got = run(spark, SL.batch_stream(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["source", "asset"], "date", "id", 4, 5), out)
    assert {r.id: r.batch_id for r in got.collect()} == {0: 1, 1: 1, 2: 1, 9: None, 10: None}


def test_late_rows_have_no_batch(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    for part in (rows(40, 13), rows(0, 3)):
        land(spark, folder, part)
        stream = SL.batch_stream(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["source", "asset"], "date", "id", 4, 5)
        got = run(spark, stream, out)
    numbers = {r.id: r.batch_id for r in got.collect()}
    assert {key for key, number in numbers.items() if number is None} == {0, 1, 2} and len(numbers) == 16


def test_dedup_within_the_delay(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    land(spark, folder, rows(0, 5) + rows(0, 5))
    got = run(spark, SF.deduplicated(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["id"], "date", "1 day"), out)
    assert got.select(F.count("*")).first()[0] == 5


def test_idle_keys_expire(spark):
    """After the idle time a key's state is gone: a new batch begins, and no number comes twice."""
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    land(spark, folder, rows(0, 3))
    stream = SL.batch_stream(SF.watch_files(spark, folder, SCHEMA, "parquet"), ["asset"], "date", "id", 100, 500, 0.0005)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state")
    query = writer.trigger(processingTime="1 second").start()

    def numbers(n):
        for _ in range(60):
            assert query.exception() is None
            found = {r.id: r.batch_id for r in spark.read.schema("id bigint, batch_id bigint").parquet(out).collect()} if query.lastProgress else {}
            if len(found) == n:
                return found
            time.sleep(1)
        raise TimeoutError

    try:
        first = numbers(3)
        time.sleep(4)
        land(spark, folder, rows(3, 3))
        both = numbers(6)
    finally:
        query.stop()
    assert len(set(first.values())) == 1 == len({both[i] for i in (3, 4, 5)})
    assert both[0] < both[3]


@given(st.lists(st.integers(0, 60), min_size=0, max_size=40), st.integers(1, 6), st.integers(1, 20), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_numbers_after_an_open_batch(gaps, size, span, cut):
    """Walking in two parts gives what a row-by-row walk gives."""
    times = np.cumsum(gaps) if gaps else np.zeros(0, np.int64)
    start, held, number, plain = None, 0, 0, []
    for t in times.tolist():
        if start is None or held >= size or t - start > span:
            start, held, number = t, 0, number + 1
        held += 1
        plain.append(number)
    first, state = SL.numbered(times[:cut], size, span, None, 0, 0)
    second, state = SL.numbered(times[cut:], size, span, *state)
    assert [*first.tolist(), *second.tolist()] == plain
    if len(times):
        assert state == (start, held, number)


def test_append_once_counts_keys_of_a_base_and_of_earlier_triggers(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    base = spark.createDataFrame([(2,), (3,)], "id bigint")
    for part in (rows(0, 4) + rows(1, 3) * 50, rows(2, 5) + [(None, T0, "c", "c", "A", 0.0)] * 3):
        land(spark, folder, part)
        query = SF.append_once(SF.watch_files(spark, folder, SCHEMA, "parquet"), out, out + "-state", ["id"], base)
        query.awaitTermination()
        assert query.exception() is None
    ids = [r.id for r in spark.read.parquet(out).collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == [0, 1, 4, 5, 6, None]
