"""Ranked lexical search by dense blocks: tiles of items' term weights times tiles of documents' term impacts.

Weights and impacts are whole numbers, held as float64 for the matrix products of BLAS. A tile of terms is as wide as keeps every
sum of products below 2^53, where float64 is exact whatever the order of the additions; tiles are added up as 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideledger.llm.common import texts

# sizes of blocks and tiles; they bound memory and change no result
BLOCK_BYTES = 4 << 20
ITEMS = 256
TERMS = 2048
DOCUMENTS = 512
TILE_BYTES = 4 << 20
SALTS = 64
# an impact is below this, and products must add up to less than 2^53
IMPACT = 10**6
EXACT = 1 << 53

# bytes outside terms become blanks, A to Z lower case; bytes above 127 belong to terms
_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(32 if byte in _SEPARATORS else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of digits, letters A to Z in lower case, and characters outside ASCII."""
    return (text or "").encode().translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Tile:
    """Some items' weights for some terms: ``where`` is the term's column or -1, ``weights`` items x columns."""

    items: slice
    where: np.ndarray
    weights: np.ndarray


class Block:
    """A block of items: ids, vocabulary, and after the statistics of the corpus its tiles."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.ids = [item for item, _ in items]
        self.counts = [Counter(term for text in bodies for term in terms(text)) for _, bodies in items]
        self.vocabulary = {term: place for place, term in enumerate(dict.fromkeys(t for count in self.counts for t in count))}
        self.n_docs = self.n_terms = 0
        self.tiles: list[Tile] = []

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        """Takes in the corpus: documents with a term, their terms, and documents by term."""
        self.n_docs, self.n_terms = n_docs, n_terms
        weights = {place: weight(n_docs, df[place]) for place in df}
        for low in range(0, len(self.ids), ITEMS):
            own = slice(low, min(low + ITEMS, len(self.ids)))
            columns: dict[int, dict[int, int]] = {}
            for row, count in enumerate(self.counts[own]):
                for term, times in count.items():
                    place = self.vocabulary[term]
                    if weights.get(place):
                        columns.setdefault(place, {})[row] = times * weights[place]
            self.tiles.extend(_tiles(own, columns, len(self.vocabulary)))


def _tiles(items: slice, columns: dict[int, dict[int, int]], n_terms: int) -> Iterator[Tile]:
    """Tiles of up to ``TERMS`` columns whose sums of products stay below ``EXACT``."""
    room = EXACT // IMPACT - 1
    n_items = items.stop - items.start
    held: list[tuple[int, dict[int, int]]] = []
    sums = [0] * n_items

    def tile() -> Tile:
        where = np.full(n_terms, -1, np.int64)
        weights = np.zeros((n_items, len(held)))
        for column, (place, rows) in enumerate(held):
            where[place] = column
            weights[list(rows), column] = list(rows.values())
        return Tile(items, where, weights)

    for place, rows in columns.items():
        while rows:
            # a weight beyond the room of a tile goes into several
            part = {row: min(value, room) for row, value in rows.items()}
            if held and (len(held) == TERMS or any(sums[row] + value > room for row, value in part.items())):
                yield tile()
                held, sums = [], [0] * n_items
            held.append((place, part))
            for row, value in part.items():
                sums[row] += value
            rows = {row: value - part[row] for row, value in rows.items() if value > part[row]}
            if rows:
                yield tile()
                held, sums = [], [0] * n_items
    if held:
        yield tile()


def _counted(vocabulary: dict[bytes, int], bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of terms of each text; and for terms of the vocabulary the text, the term and the occurrences in it."""
    found = [terms(body) for body in bodies]
    sizes = np.array([len(own) for own in found], np.int64)
    get, width = vocabulary.get, len(vocabulary)
    flat = np.fromiter((get(term, -1) for own in found for term in own), np.int64, int(sizes.sum()))
    rows = np.repeat(np.arange(len(bodies)), sizes)
    kept = flat >= 0
    cells, times = np.unique(rows[kept] * width + flat[kept], return_counts=True)
    return sizes, cells // max(width, 1), cells % max(width, 1), times


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in groups of bounded number and size, with the row of the first."""
    held, size, low = [], 0, 0
    for row, text in enumerate(batch.column("text"), 1):
        held.append(text.as_py())
        size += len(held[-1])
        if len(held) == DOCUMENTS or size >= TILE_BYTES or row == batch.num_rows:
            yield low, held
            held, size, low = [], 0, row


def _statistics(sent):
    """Documents by term; -1 counts documents with a term, -2 their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value.vocabulary
        df = np.zeros(len(vocabulary), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for _, bodies in _groups(batch):
                sizes, _, places, _ = _counted(vocabulary, bodies)
                n_docs += int((sizes > 0).sum())
                n_terms += int(sizes.sum())
                df += np.bincount(places, minlength=len(vocabulary))
        places = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *places.tolist()], pa.int64()), pa.array([n_docs, n_terms, *df[places].tolist()], pa.int64())],
            names=["term", "n"],
        )

    return run


class Best:
    """The best ``k`` documents of every item so far: by score, then by id (null last)."""

    def __init__(self, k: int, n_items: int):
        self.k = k
        # item, score, id, whether the id is null
        self.found = np.zeros((4, 0), np.int64)
        self.least = np.ones(n_items, np.int64)

    def add(self, items: slice, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """Takes in a tile of scores, items x documents. Documents that tie with the last one are weighed, too."""
        least = self.least[items]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        rows, columns = np.nonzero(scores >= least[:, None])
        if not len(rows):
            return
        found = np.stack([rows + items.start, scores[rows, columns], ids[columns], unnamed[columns]])
        found = np.concatenate([self.found, found], axis=1)
        item, score, names, nulls = found
        found = found[:, np.lexsort((names, nulls, -score, item))]
        item = found[0]
        starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.r_[starts, len(item)]))
        self.found = found[:, rank < self.k]
        last = found[:, rank == self.k - 1]
        self.least[last[0]] = last[1]


def _search(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = Best(k, len(block.ids))
        for batch in batches:
            names = batch.column("doc_id")
            nulls = names.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = names.fill_null(0).to_numpy()
            for low, bodies in _groups(batch):
                for tile, scores in _scores(block, bodies):
                    best.add(tile, scores, ids[low : low + len(bodies)], nulls[low : low + len(bodies)])
        item, score, ids, nulls = best.found
        docs = pa.array(ids, pa.int64(), mask=nulls.astype(bool))
        named = pa.array([block.ids[place] for place in item], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(item), named, docs, pa.array(score)], names=["item", "item_id", "doc_id", "score"])

    return run


def _scores(block: Block, bodies: list[str]) -> Iterator[tuple[slice, np.ndarray]]:
    """Scores of texts, items x texts, by tile of items."""
    sizes, rows, places, times = _counted(block.vocabulary, bodies)
    if not len(rows):
        return
    stretch = np.array([25 + 75 * size * block.n_docs // block.n_terms for size in sizes.tolist()], np.int64)
    impacts = 1_000_000_000 * times // (1000 * times + 8 * stretch[rows])
    total = items = None
    for tile in block.tiles:
        column = tile.where[places]
        kept = column >= 0
        dense = np.zeros((tile.weights.shape[1], len(bodies)))
        dense[column[kept], rows[kept]] = impacts[kept]
        part = (tile.weights @ dense).astype(np.int64)
        if items == tile.items:
            total += part
        else:
            if items is not None:
                yield items, total
            total, items = part, tile.items
    if items is not None:
        yield items, total


def best_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    A term is a run of digits, letters (A to Z in lower case) and characters outside ASCII; the whole of a text counts. A term's
    weight is floor(1000 ln((2N + 2) / (2 df + 1))) with N the documents that have a term, its impact in a document
    10^9 tf div (1000 tf + 8 m) with m = 25 + 75 n N div L for n terms here and L in all documents; a score adds weight times
    impact over the item's terms, repeats included. Only scores above 0 are given; equal ones go by ascending ``doc_id``,
    null ids last.

    Every row of ``docs`` is a document, repeated ids included; null and empty texts have no terms. Rows of ``items`` with one
    ``item_id`` (null is an id, too) are one item with the terms of its different texts; items without terms, and empty tables,
    give no rows. Other columns are ignored.

    Two narrow passes over the documents for each block of about ``BLOCK_BYTES`` of items: statistics of its vocabulary, then
    scores. A task sends ``k`` rows an item; these are cut down within ``SALTS`` groups and then as a whole.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    found = None
    for number in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        grouped = own.groupBy("item_id").agg(F.sort_array(F.collect_set("text")).alias("texts")).orderBy("item_id").collect()
        block = Block([(row.item_id, row.texts) for row in grouped])
        asked = spark.sparkContext.broadcast(block)
        counts = rows.select("text").mapInArrow(_statistics(asked), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        df = {row.term: row.n for row in counts.collect()}
        asked.unpersist()
        block.weigh(df.pop(-1, 0), df.pop(-2, 0), df)
        part = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), k), "item long, item_id long, doc_id long, score long")
        part = part.select(F.lit(number).alias("block"), "*", (F.spark_partition_id() % SALTS).alias("salt"))
        found = part if found is None else found.unionAll(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = F.row_number().over(Window.partitionBy("block", "item", "salt").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("block", "item").orderBy(*order))
    found = found.withColumn("rank", first).filter(F.col("rank") <= k)
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
