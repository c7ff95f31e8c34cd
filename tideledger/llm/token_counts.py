"""Token counts without a shuffle of pre-tokens: a sent table of frequent pieces, worker caches for the rest."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import loaded, sent_spec, texts

# entries of the sent table, of one task's sketch and of a worker's cache; they bound memory and change no count
FREQUENT = 1 << 16
SKETCH = 1 << 17
TOLD = 1 << 13
CACHED = 1 << 18
# longer pieces are encoded each time
PIECE = 64
# a blank inside or at the end of a run of white space: cutting there could change the tokens
_INSIDE = re.compile(r"\s (?!\S)")


def pieces(text: str, special: list[str]) -> list[str] | None:
    """``text`` cut before every blank, or None where a cut could fall inside a pre-token.

    A byte-level pre-token holds a blank only as its first character or within a run of white space.
    """
    if "\0" in text or _INSIDE.search(text) or any(token in text for token in special):
        return None
    return text.replace(" ", "\0 ").split("\0")


def _sketch(spec):
    """Frequent pieces of one task's texts; when the sketch is full, the rarer half goes (lossy counting)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = loaded(spec.value).special
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(pieces(text.as_py(), special) or ())
                if len(seen) > SKETCH:
                    seen = Counter(dict(seen.most_common(SKETCH // 2)))
        told = [(piece, n) for piece, n in seen.most_common(TOLD) if len(piece) <= PIECE]
        yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in told], "n": pa.array([n for _, n in told], pa.int64())})

    return run


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the corpus's most frequent pieces: at most ``FREQUENT`` entries of ``PIECE`` characters."""
    spec = sent_spec(docs.sparkSession, path)
    told = texts(docs).select("text").mapInArrow(_sketch(spec), "piece string, n long")
    top = told.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)
    names = [row.piece for row in top.collect()]
    coded = loaded(spec.value).library.encode_batch(names, add_special_tokens=False)
    return {name: len(code.ids) for name, code in zip(names, coded, strict=True)}


class _Lengths(dict):
    """Piece to token count: the sent table, then this worker's cache, then the tokenizer."""

    def __init__(self, library, frequent: dict[str, int]):
        super().__init__(frequent)
        self.library, self.frequent, self.room = library, frequent, len(frequent) + CACHED

    def __missing__(self, piece: str) -> int:
        n = len(self.library.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= PIECE:
            self[piece] = n
        return n

    def trim(self) -> None:
        if len(self) > self.room:
            self.clear()
            self.update(self.frequent)


_KNOWN: dict[str, _Lengths] = {}


def _count(spec, frequent, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(spec.value)
        # a worker runs many tasks of one call and keeps its cache
        if name not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[name] = _Lengths(encoder.library, frequent.value)
        known = _KNOWN[name]
        for batch in batches:
            counts = []
            for text in batch.column("text"):
                text = text.as_py()
                cut = pieces(text, encoder.special) if encoder.quick else None
                if cut is None:
                    counts.append(len(encoder.library.encode(text, add_special_tokens=False).ids))
                else:
                    counts.append(sum(map(known.__getitem__, cut)))
                    known.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id``, UTF-8 bytes, tokens and ``n_tokens > limit`` for every row of ``docs`` (``doc_id``, ``text``, any others).

    Counts are those of the tokenizers library for the file at ``path`` without added tokens; a special string inside a text
    counts as that library does by default. Files that aren't byte-level BPE are counted text by text.
    Null and empty texts have 0 bytes and 0 tokens; repeated rows stay; null ids stay; no rows give no rows.

    Two narrow passes over the texts and no shuffle of pieces: the first finds frequent pieces by bounded sketches, of which
    each task sends a few thousand; the second looks pieces up in the sent table and the worker's cache.
    """
    spark = docs.sparkSession
    spec = sent_spec(spark, path)
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path) if loaded(spec.value).quick else {})
    counted = texts(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = counted.mapInArrow(_count(spec, frequent, uuid.uuid4().hex), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
