"""Token ids as Parquet list columns with delta encoding, bounded row groups and page indexes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideledger.llm.common import loaded, sent_spec, texts

#: Writer version 2 stores integers as deltas where a dictionary doesn't pay. Row groups are small enough to be read by one
#: task each, pages small enough that a page index (min and max of ``doc_id``) leads to few documents.
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}
END = 0


def list_array(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(part) for part in parts)], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _encode(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = loaded(spec.value), TaskContext.get().partitionId(), 0
        end = np.array([END], np.uint32)
        for batch in batches:
            ids = [np.concatenate([encoder.ids(text.as_py()), end]) for text in batch.column("text")]
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(starts),
                    pa.array(sizes),
                    list_array(ids),
                ],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )

    return run


SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def write_token_ids(docs: DataFrame, tokenizer: str, path: str) -> str:
    """Writes the ids of every text, each closed by id 0, to Parquet files at ``path`` in ascending ``doc_id``; returns it.

    ``docs`` has ``doc_id`` and ``text`` (any others are ignored); a null or empty text has the end id alone; null ids come
    first; rows that repeat an id lie next to each other, ordered by text hash; no rows write files without rows.
    File n holds the n-th range of ids, ``part`` is its number, ``start_in_part`` the ids in that file before a document.
    """
    spec = sent_spec(docs.sparkSession, tokenizer)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(_encode(spec), SCHEMA).write.options(**FORMAT).parquet(path)
    return path


def read_token_ids(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The files at ``path`` with ``start``, the ids of all documents before; only the named columns are read.

    Starts come from one small row per file: the totals of ``part`` and ``n_tokens``, which no token page is read for.
    """
    found = spark.read.schema(SCHEMA).parquet(path)
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    opening = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("opening"))
    # as many rows as files
    placed = found.join(F.broadcast(opening), "part").withColumn("start", F.col("opening") + F.col("start_in_part"))
    return placed.select(*(columns or ["doc_id", "start", "n_tokens", "ids"]))


def id_bytes(values: pa.ListArray) -> Iterator[memoryview]:
    """The ids of each list as little-endian unsigned 32-bit integers."""
    flat = values.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
    ends = values.offsets.to_numpy()
    for first, last in zip(ends[:-1], ends[1:], strict=True):
        yield memoryview(flat[first:last]).cast("B") if last > first else memoryview(b"")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = pa.array([zlib.crc32(ids) for ids in id_bytes(batch.column("ids"))], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), sums],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of each document's ids, read from the files."""
    return read_token_ids(spark, path).mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
