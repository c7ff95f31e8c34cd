"""Best-fit packing of token pieces into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import loaded, sent_spec, texts, written
from tideledger.llm.token_output import END, list_array

# pieces that one task packs together; a block leaves one or two sequences partly filled
BLOCK = 16_384


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the first takes what full ones leave."""
    first = total % capacity or min(total, capacity)
    return [first] + [capacity] * ((total - first) // capacity)


def _cut(spec, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = loaded(spec.value), np.array([END], np.uint32)
        for batch in batches:
            rows, parts = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.concatenate([encoder.ids(text.as_py()), end]).astype("<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc, piece, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        parts.append(part)
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, list_array(parts)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every row of ``docs`` (``doc_id``, ``text``, any others), each text closed by id 0.

    A null or empty text is one piece of length 1. Only longer documents are cut; all their pieces but the first are full.
    """
    spec = sent_spec(docs.sparkSession, path)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return texts(docs).mapInArrow(_cut(spec, capacity, with_ids), schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every length, given in descending order.

    ``open_bins[g]`` counts open bins with ``g`` tokens left. Putting ``s`` tokens into a gap ``g`` turns one bin of gap ``g``
    into one of gap ``g - s``; the gap with the least sum of squared counts afterwards is taken, the smallest one in a tie.
    A new bin is opened where no open one has room.
    """
    open_bins = np.zeros(capacity + 1, np.int64)
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, last = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for row, size in enumerate(lengths.tolist()):
        counts = open_bins[size:]
        after = open_bins[: capacity + 1 - size]
        change = 2 * (after - counts)
        change[0] = -2 * counts[0]
        change[counts == 0] = np.iinfo(np.int64).max
        left = int(np.argmin(change))
        if counts[left]:
            number = held[size + left].pop()
            open_bins[size + left] -= 1
        else:
            number, left, last = last, capacity - size, last + 1
        bins[row], offsets[row] = number, capacity - size - left
        if left:
            open_bins[left] += 1
            held[left].append(number)
    return bins, offsets


def _pack(capacity: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        number = block.column("block")[0].as_py()
        bins, offsets = place(block.column("length").to_numpy(), capacity)
        packed = block.drop_columns(["block"])
        packed = packed.append_column("sequence_id", pa.array(bins + (number << 32)))
        return packed.append_column("offset", pa.array(offsets))

    return run


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length`` and others) with ``sequence_id`` and ``offset``.

    Offsets have no gap and no sequence is longer than ``capacity``. Pieces are dealt by hash into blocks of about ``BLOCK``
    rows, each packed by one task, longest first; no sequence spans two blocks. Text isn't shuffled, only the piece rows are.
    Rows that repeat are packed like others; a null ``doc_id`` is kept; no rows give no rows.
    """
    pieces = written(pieces, "pieces")
    size = pieces.count()
    blocks = max(1, round(size / BLOCK))
    numbered = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(blocks)))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return numbered.groupBy("block").applyInArrow(_pack(capacity), schema)


def packed_documents(docs: DataFrame, path: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its place: see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, path, capacity, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its tokens, from pieces packed ``with_ids``; a sequence is at most ``capacity`` tokens long."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
