"""Quality classifier: gated-attention multiple-instance learning over the passages of a document."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import kept_by, texts

#: labelled documents that training uses at most: those with the smallest hashes of ``doc_id``
TRAINING = 6_000
#: bytes of a passage, about: a text is cut into the nearest number of even passages
PASSAGE = 1_000
LETTERS = PAIRS = 64
MARKS = 1_024
FEATURES = LETTERS + PAIRS + 8
HIDDEN = 24
ROUNDS = 250
# passages that are turned into features at a time
AT_A_TIME = 1_000
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids whose labels are never learnt; a null id is not held out, for it has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _shares(keys: np.ndarray, rows: int, width: int) -> np.ndarray:
    return np.bincount(keys, minlength=rows * width).reshape(rows, width).astype(np.float32)


def _features(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of passages that lie one after another in ``flat``: what characters, pairs and runs they are made of."""
    rows = len(sizes)
    owner = np.repeat(np.arange(rows), sizes)
    total = np.maximum(sizes, 1).astype(np.float32)[:, None]
    wide = np.concatenate([flat, np.zeros(3, np.uint8)]).astype(np.uint32)
    # letters fold into one slot whatever their case; other bytes keep a slot of their own as far as it goes
    letters = _shares(owner * LETTERS + (wide[:-3] & 63), rows, LETTERS) / total
    pair = (wide[:-3] | wide[1:-2] << 8) * np.uint32(0x9E3779B1) >> 26
    pairs = _shares(owner * PAIRS + pair, rows, PAIRS) / total
    four = (wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24) * np.uint32(0x85EBCA6B) >> 22
    seen = np.zeros(rows * MARKS, bool)
    seen[owner * MARKS + four] = True
    new = seen.reshape(rows, MARKS).sum(1)[:, None] / (MARKS * -np.expm1(-total / MARKS))
    kinds = np.zeros(256, np.int64)
    kinds[[9, 10, 11, 12, 13, 32]] = 1
    kinds[65:91], kinds[97:123], kinds[48:58] = 2, 3, 4
    kinds[128:] = 5
    kind = _shares(owner * 6 + kinds[flat], rows, 6) / total
    return np.hstack([np.sqrt(letters), np.sqrt(pairs), new.astype(np.float32), np.sqrt(kind), np.log1p(total) / 8])


def passages(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``docs``, and the row of each document's first one; an empty text is one empty passage."""
    lengths = np.array([len(doc) for doc in docs], np.int64)
    counts = np.maximum(1, (lengths + PASSAGE // 2) // PASSAGE)
    first = np.cumsum(counts) - counts
    place = np.arange(counts.sum()) - np.repeat(first, counts)
    length, count = np.repeat(lengths, counts), np.repeat(counts, counts)
    sizes = (place + 1) * length // count - place * length // count
    flat = np.frombuffer(b"".join(docs), np.uint8)
    starts = np.cumsum(sizes) - sizes
    parts = []
    for low in range(0, len(sizes), AT_A_TIME):
        own = slice(low, low + AT_A_TIME)
        begin = int(starts[low])
        parts.append(_features(flat[begin : begin + int(sizes[own].sum())], starts[own] - begin, sizes[own]))
    return np.concatenate(parts), first


class Attention:
    """One hidden layer per passage, gated attention over a document's passages, one score per document."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        shapes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, HIDDEN), "u": (HIDDEN, HIDDEN), "a": (HIDDEN,), "c": (HIDDEN,), "d": ()}
        self.p = {k: (rng.normal(0, 1 / math.sqrt(s[0]), s) if s else np.zeros(())) for k, s in shapes.items()}
        self.p["b"][:] = 0
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.constant: float | None = None

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, counts = self.p, np.diff([*first, len(x)])
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        weight = e / np.repeat(np.add.reduceat(e, first), counts)
        z = np.add.reduceat(h * weight[:, None], first)
        return {"h": h, "t": t, "s": s, "weight": weight, "z": z, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["d"]))), "counts": counts}

    def _gradient(self, x: np.ndarray, first: np.ndarray, label: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, first)
        dy = (f["y"] - label) * share
        dz = np.repeat(dy[:, None] * p["c"], f["counts"], axis=0)
        dweight = (dz * f["h"]).sum(1)
        de = f["weight"] * (dweight - np.repeat(np.add.reduceat(dweight * f["weight"], first), f["counts"]))
        dt = de[:, None] * p["a"] * f["s"] * (1 - f["t"] ** 2)
        ds = de[:, None] * p["a"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (dz * f["weight"][:, None] + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        return {
            "w": x.T @ dh, "b": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ ds, "a": (f["t"] * f["s"]).T @ de,
            "c": f["z"].T @ dy, "d": dy.sum(),
        }

    def fit(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> Attention:
        """Adam over all training documents, both labels weighing the same."""
        good = float(label.sum())
        if good in (0, len(label)):
            self.constant = (good + 1) / (len(label) + 1)
            return self
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.spread
        share = np.where(label == 1, 0.5 / good, 0.5 / (len(label) - good))
        one = {k: np.zeros_like(v) for k, v in self.p.items()}
        two = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, ROUNDS + 1):
            for k, g in self._gradient(x, first, label, share).items():
                g = g + 1e-3 * self.p[k]
                one[k], two[k] = 0.9 * one[k] + 0.1 * g, 0.99 * two[k] + 0.01 * g * g
                self.p[k] = self.p[k] - 0.02 * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def score(self, docs: list[bytes]) -> np.ndarray:
        if self.constant is not None or not docs:
            return np.full(len(docs), self.constant or 0.0)
        x, first = passages(docs)
        # sums differ in their last bits by a row's place in the batch; equal texts get equal scores
        return np.round(self._forward((x - self.mean) / self.spread, first)["y"], 12)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAINING) -> Attention:
    """A model from at most ``bound`` labelled documents that are not held out.

    A document with several labels counts by the smallest one, an id with several texts by that with the smallest hash; null labels
    and null ids are left out. Where there is no label,
    or one kind only, every score is the share of good labels, counting one more good one.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = texts(docs).join(F.broadcast(known), "doc_id")  # at most ``bound`` rows
    # one text for each id, whatever the order and number of its rows
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct(F.md5("text").alias("hash"), "text")).alias("own"))
    rows = rows.select("doc_id", F.col("own.text").alias("text"), "quality")
    shaped = rows.select("doc_id", "text", "quality").mapInArrow(_training, "doc_id long, quality int, rows int, x binary")
    found = {row.doc_id: row for row in shaped.toLocalIterator()}
    if not found:
        return Attention().fit(np.zeros((0, FEATURES)), np.zeros(0, int), np.zeros(0))
    ordered = [found[key] for key in sorted(found)]
    x = np.concatenate([np.frombuffer(row.x, np.float16).reshape(row.rows, FEATURES) for row in ordered])
    counts = np.array([row.rows for row in ordered])
    label = np.array([1.0 if row.quality == 1 else 0.0 for row in ordered])
    return Attention().fit(x.astype(np.float32), np.cumsum(counts) - counts, label)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[slice, list[bytes]]]:
    """The texts of a batch as bytes, in runs of a few megabytes."""
    bodies = batch.column("text").cast(pa.binary())
    low, size = 0, 0
    held: list[bytes] = []
    for row, body in enumerate(bodies):
        held.append(body.as_py())
        size += len(held[-1])
        if size > 4 << 20:
            yield slice(low, row + 1), held
            low, size, held = row + 1, 0, []
    if held:
        yield slice(low, len(bodies)), held


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own, docs in _texts(batch):
            x, first = passages(docs)
            counts = np.diff([*first, len(x)])
            blobs = [part.astype(np.float16).tobytes() for part in np.split(x, first[1:])]
            part = batch.slice(own.start, own.stop - own.start)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.array(counts, pa.int32()), pa.array(blobs, pa.binary())],
                names=["doc_id", "quality", "rows", "x"],
            )


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, docs in _texts(batch):
                ids = batch.column("doc_id").slice(own.start, own.stop - own.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(model.value.score(docs))], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = TRAINING) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher is better) and ``predicted`` for every row of ``docs``.

    Only the text is an input of a score. Null and empty texts score as one empty passage; equal texts get equal scores; very
    long texts are read passage by passage; repeated rows stay; no rows give no rows. Training as in ``train``.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels, bound))
    scored = texts(docs).mapInArrow(_score(model), "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns; each row is judged by its own text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def good(bodies: pa.Array) -> np.ndarray:
        scores = [model.value.score(own) for _, own in _texts(pa.RecordBatch.from_arrays([bodies], names=["text"]))]
        return np.concatenate(scores) >= threshold if scores else np.zeros(0, bool)

    return kept_by(docs, good)
