"""Greedy batches of transfers per key.

Walking a key's transfers in time order, a batch closes when it holds
``batch_size`` rows or when a row lies more than ``window_hours`` after its first
row. The walk is sequential, but what one stretch of rows does to the open batch
can be summarised by ``batch_size`` cases: the first new batch inside the stretch
must start at one of its first ``batch_size`` rows. Stretches are summarised in
parallel, the summaries are chained per key, and rows are numbered in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import CHUNK, null_safe_join, ordered_keys, with_copy_number


def next_start(times: np.ndarray, size: int, span: int) -> np.ndarray:
    by_time = np.searchsorted(times, times + span, side="right")
    return np.minimum(np.arange(len(times)) + size, by_time)


def summarise_stretch(times: np.ndarray, size: int, span: int) -> dict[str, np.ndarray]:
    """For each possible first start: start time and rows of the batch left open, and batches begun."""
    n = len(times)
    # starts are followed in steps that double; the end is a start that leads to itself
    nxt = np.append(next_start(times, size, span), n)
    last, begun = np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
    while (nxt < n).any():
        last = np.where(nxt < n, last[nxt], last)
        begun, nxt = begun + begun[nxt], nxt[nxt]
    first = min(size, n)
    opened = last[:first]
    return {"head": times[:first], "open_start": times[opened], "open_rows": n - opened, "begun": begun[:first]}


def first_start(head: np.ndarray, length: int, size: int, span: int, start: int | None, rows: int) -> int:
    """Position of the first row the open batch cannot take."""
    if start is None:
        return 0
    fits = int(np.searchsorted(head, start + span, side="right"))
    return min(size - rows, fits, length)


def batch_transfers(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie_breaker: str,
    batch_size: int,
    window_hours: float,
    rows_per_chunk: int = 500_000,
) -> DataFrame:
    """Add ``batch_id`` (1, 2, ... per key)."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    size, span = batch_size, int(window_hours * 3600 * 1_000_000)
    timed = df.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    order = [*keys, "__us", tie_breaker]
    # keys, time and tie breaker go through the range step; the rows take their numbers by a join
    chunks = ordered_keys(timed, order, rows_per_chunk=rows_per_chunk)
    timed, own = with_copy_number(timed, order, chunks)
    if "__copy" in own:
        chunks = chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    chunks = chunks.drop("__n")
    fields = {f.name: f.dataType for f in chunks.schema}
    key_ddl = ", ".join(f"`{k}` {fields[k].simpleString()}" for k in keys)

    # a chunk border lies inside one key at most, so there are fewer such keys than chunks
    spanning = chunks.groupBy(*keys).agg(F.min(CHUNK).alias("__lo"), F.max(CHUNK).alias("__hi")).where("__lo < __hi")
    renamed = spanning.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    stretches = chunks.select(*keys, CHUNK, "__us").join(F.broadcast(renamed), same, "left_semi")

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(pdf["__us"].to_numpy())
        parts = summarise_stretch(times, size, span)
        row = {k: pdf[k].iloc[0] for k in [*keys, CHUNK]}
        return pd.DataFrame([{**row, "length": len(times), **{k: v.tolist() for k, v in parts.items()}}])

    stretch_ddl = "length bigint, head array<bigint>, open_start array<bigint>, open_rows array<bigint>, begun array<bigint>"
    summaries = stretches.groupBy(*keys, CHUNK).applyInPandas(summarise, f"{key_ddl}, {CHUNK} int, {stretch_ddl}")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK, ignore_index=True)
        start, rows, done, out = None, 0, 0, []
        for s in pdf.itertuples(index=False):
            out.append((start, rows, done))
            p = first_start(np.asarray(s.head), s.length, size, span, start, rows)
            if p < s.length:
                start, rows, done = int(s.open_start[p]), int(s.open_rows[p]), done + int(s.begun[p])
            else:
                rows += s.length
        entry = pdf[[*keys, CHUNK]].copy()
        entry["entry_start"] = pd.array([o[0] for o in out], dtype="Int64")
        entry["entry_rows"] = [o[1] for o in out]
        entry["entry_done"] = [o[2] for o in out]
        return entry

    # one summary row per stretch of the key
    entries = summaries.groupBy(*keys).applyInPandas(
        chain, f"{key_ddl}, {CHUNK} int, entry_start bigint, entry_rows bigint, entry_done bigint"
    )
    held = entries.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], F.col(CHUNK).alias("__r_chunk"), "entry_start", "entry_rows", "entry_done"
    )
    wide = chunks.join(F.broadcast(held), same & (F.col(CHUNK) == F.col("__r_chunk")), "left")
    wide = wide.drop("__r_chunk", *[f"__r_{k}" for k in keys])
    out_ddl = ", ".join(f"`{c}` {fields[c].simpleString()}" for c in own)

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["__code"] = pdf.groupby(list(keys), dropna=False, sort=False).ngroup()
        pdf = pdf.sort_values(["__code", "__us", tie_breaker], kind="stable", ignore_index=True)
        times, codes = pdf["__us"].to_numpy(), pdf["__code"].to_numpy()
        starts, rows, done = (pdf[f"entry_{c}"] for c in ("start", "rows", "done"))
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(pdf)]
        ids = np.zeros(len(pdf), dtype=np.int64)
        for lo, hi in zip(edges, edges[1:]):
            carried = not pd.isna(starts[lo])
            p = first_start(
                times[lo : min(lo + size, hi)], hi - lo, size, span,
                int(starts[lo]) if carried else None, int(rows[lo]) if carried else 0,
            )
            nxt = next_start(times[lo:hi], size, span).tolist()
            while p < hi - lo:
                ids[lo + p] = 1
                p = nxt[p]
            ids[lo:hi] = np.cumsum(ids[lo:hi]) + (int(done[lo]) if carried else 0)
        pdf["batch_id"] = ids
        return pdf[[*own, "batch_id"]]

    numbers = wide.groupBy(CHUNK).applyInPandas(number, f"{out_ddl}, batch_id bigint")
    return null_safe_join(timed, numbers, own).drop("__us", "__copy")


def aggregate_batches(batched: DataFrame, keys: Sequence[str], ts: str, sums: Sequence[str], as_of=None) -> DataFrame:
    """First and last time, sums and row count per batch; batches begun on ``as_of`` or later are left out."""
    out = batched.groupBy("batch_id", *keys).agg(
        F.min(ts).alias("first_tx_date"),
        F.max(ts).alias("last_tx_date"),
        *[F.sum(c).alias(c) for c in sums],
        F.count(F.lit(1)).alias("tx_count"),
    )
    if as_of is not None:
        out = out.where(F.col("first_tx_date") < F.lit(as_of).cast("date").cast("timestamp"))
    return out
