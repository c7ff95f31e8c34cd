"""Net flow per tumbling window and greedy batches over a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.batching import first_start, next_start


def windowed_net_flow(stream: DataFrame, source: str, target: str, amount: str, ts: str, hours: int, delay: str, asset: str = "asset") -> DataFrame:
    """Inflow, outflow and net per (window, chain, asset).

    Each transfer becomes a row per side, so the stream needs one aggregate and no
    stream-stream join. Rows later than ``delay`` behind the newest are dropped.
    """
    legs = stream.withWatermark(ts, delay).select(
        ts,
        asset,
        F.explode(
            F.array(
                F.struct(F.col(source).alias("chain"), F.col(amount).alias("i"), F.lit(0.0).alias("o")),
                F.struct(F.col(target).alias("chain"), F.lit(0.0).alias("i"), F.col(amount).alias("o")),
            )
        ).alias("leg"),
    )
    sums = legs.groupBy(F.window(ts, f"{hours} hours"), F.col("leg.chain").alias("chain"), asset).agg(
        F.sum("leg.i").alias("inflow"), F.sum("leg.o").alias("outflow")
    )
    return sums.select(
        F.col("window.start").alias("date"), "chain", asset, "inflow", "outflow",
        (F.col("inflow") - F.col("outflow")).alias("net_amount"),
    )


class _OpenBatch(StatefulProcessor):
    """The open batch of a key: first time, rows, number; and the latest time seen."""

    def __init__(self, ts: str, tie_breaker: str, size: int, span: int, idle_ms: int | None) -> None:
        self.ts, self.tie_breaker, self.size, self.span, self.idle_ms = ts, tie_breaker, size, span, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open", "start bigint, rows bigint, number bigint, latest bigint", self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values([self.ts, self.tie_breaker], kind="stable", ignore_index=True)
        timeless = pdf[self.ts].isna()
        if timeless.any():
            yield pdf[timeless].assign(batch_id=pd.array([None] * int(timeless.sum()), dtype="Int64"))
            pdf = pdf[~timeless].reset_index(drop=True)
            if pdf.empty:
                return
        times = pdf[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        if self.state.exists():
            start, held, number, latest = self.state.get()
        else:
            # after a key has expired its numbers must not come again: they go on from the time
            start, held, number, latest = None, 0, 0 if self.idle_ms is None else int(times[0]), int(times[0])
        late = int(np.searchsorted(times, latest))
        ids = np.zeros(len(times), np.int64)
        ids[late:], (start, held, number) = numbered(times[late:], self.size, self.span, start, held, number)
        self.state.update((start, held, number, max(latest, int(times[-1]))))
        yield pdf.assign(batch_id=pd.arrays.IntegerArray(ids, np.arange(len(ids)) < late))

    def close(self) -> None:
        pass


def numbered(times: np.ndarray, size: int, span: int, start: int | None, held: int, number: int) -> tuple[np.ndarray, tuple]:
    """Batch numbers of one key's ordered times after an open batch, and the batch that is open then. One step for each batch."""
    begun = np.zeros(len(times), np.int64)
    place = first_start(times[:size], len(times), size, span, start, held) if len(times) else 0
    if place >= len(times):
        return begun + number, (start, held + len(times), number)
    following = next_start(times, size, span)
    while place < len(times):
        begun[place], last = 1, place
        place = following[place]
    ids = np.cumsum(begun) + number
    return ids, (int(times[last]), len(times) - last, int(ids[-1]))


def batch_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, tie_breaker: str, batch_size: int, window_hours: float, idle_hours: float | None = None,
) -> DataFrame:
    """Transfers with ``batch_id``, numbered in arrival order per key.

    The state is the open batch (first time, rows and number) and the latest time seen, in RocksDB. Rows are ordered by time inside a
    trigger; batches are found by jumps, one step for each batch. A row older than the rows of earlier triggers belongs to a batch that
    is closed: it passes with a null ``batch_id``, as does a row without a time. A task holds a trigger's rows of one key, which the source's ``max_files`` bounds.

    With ``idle_hours`` the state of a key without rows for as long (by the clock) expires. When the key comes back a new batch
    begins, and its numbers, which then go on from the first row's time in microseconds, stay unique. Spark runs such a query's
    triggers without new rows, too, so it takes a processing-time trigger; ``availableNow`` would not end.
    """
    span = int(window_hours * 3600 * 1_000_000)
    idle_ms = None if idle_hours is None else int(idle_hours * 3_600_000)
    out = StructType([*stream.schema.fields, StructField("batch_id", LongType())])
    return stream.groupBy(*keys).transformWithStateInPandas(
        _OpenBatch(ts, tie_breaker, batch_size, span, idle_ms), out, "Append", "None" if idle_ms is None else "ProcessingTime"
    )
