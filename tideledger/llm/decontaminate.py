"""Benchmark decontamination: pigeonhole seeds of every item, nested edit filters over whole arrays, exact edit verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import kept_by, texts

#: edits allowed, as a share of the item's characters
EDITS = 0.2
#: bytes of benchmark text that are sent to the tasks at a time
BLOCK_BYTES = 8 << 20
#: letters of the grams that are counted before distances: one edit spoils at most this many
GRAM = 4
#: seeds of the groups that are compared before a whole item
GROUPS = (4, 8)
# letters that are looked up at a time, few enough for a processor's cache, and hits that are followed at a time
AT_A_TIME, HITS = 1 << 16, 1 << 17
# zero letters around texts: more than a group with its edits, or a word of eight, reaches
PAD = 128
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split())


def laid_out(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, a byte for each letter, with zero bytes around each, and where each begins.

    Letters beyond Latin-1 share bytes, so unequal bytes are unequal letters.
    """
    flat = np.frombuffer("".join(["\0" * PAD, "\0".join(bodies), "\0" * PAD]).encode("utf-32-le"), np.uint32)
    wide = flat > 255
    mixed = ((flat[wide] * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    flat = flat.astype(np.uint8)
    flat[wide] = np.maximum(mixed, 1)
    sizes = np.array([len(body) + 1 for body in bodies], np.int64)
    return flat, np.cumsum(sizes) - sizes + PAD


def octets(flat: np.ndarray) -> np.ndarray:
    """At every place the eight bytes from there on as a number, the first one lowest."""
    return np.ndarray(len(flat) - 7, "<u8", flat.tobytes(), strides=(1,)).astype(np.uint64)


def _lowest(sizes: np.ndarray) -> np.ndarray:
    """Masks of that many (0 to 7) low bytes."""
    return (np.uint64(1) << (sizes.astype(np.uint64) * np.uint64(8))) - np.uint64(1)


def one_edit(there: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ``own`` (``sizes`` bytes, 7 at most) is within one edit of some beginning of ``there`` (eight bytes)."""
    mask = _lowest(sizes)
    other = (there ^ own) & mask
    # equal bytes before the first other one; all of them if there is none
    same = np.where(other == 0, sizes, np.bitwise_count((other & (~other + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.uint64)
    same = np.minimum(same, np.uint64(6))
    low, next_ = same * np.uint64(8), same * np.uint64(8) + np.uint64(8)
    rest = mask >> low
    changed = other >> next_ == 0
    added = ((there >> next_) ^ (own >> low)) & rest == 0
    lost = ((there >> low) ^ (own >> next_)) & (mask >> next_) == 0
    return (other == 0) | changed | added | lost


class Groups:
    """Neighbouring seeds, ``width`` at a time, as patterns of at most 64 letters for bit-parallel columns."""

    def __init__(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray, edits: np.ndarray):
        self.begin, self.size, self.edits = begin, size, edits
        kind = np.uint32 if size.max(initial=0) <= 32 else np.uint64
        self.masks = np.zeros((len(size), 32), kind)
        row = np.repeat(np.arange(len(size)), size)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        letter = flat[np.repeat(begin, size) + inner] & 31
        np.bitwise_or.at(self.masks, (row, letter), kind(1) << inner.astype(kind))

    def least(self, flat: np.ndarray, at: np.ndarray, group: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """No more than the fewest edits of the group to a part of the text that begins and ends within ``slack`` of its place.

        ``at`` is where the group begins without edits. Letters that share the low bits of their bytes count as equal.
        """
        kind, now = self.masks.dtype.type, self.size[group].astype(np.int16)
        if not len(at):
            return now
        top = kind(1) << (self.size[group] - 1).astype(kind)
        at, best = at - slack, now.copy()
        up, down = np.full(len(at), ~kind(0)), np.zeros(len(at), kind)
        for step in range(int((self.size[group] + 2 * slack).max())):
            same = self.masks[group, flat.take(at + step, mode="clip") & 31]
            level = same | down
            diagonal = (((same & up) + up) ^ up) | same
            rise, fall = down | ~(diagonal | up), up & diagonal
            now += (rise & top) != 0
            now -= (fall & top) != 0
            rise, fall = rise << kind(1), fall << kind(1)
            up, down = fall | ~(level | rise), rise & level
            np.minimum(best, now, out=best)
        return best


def _slots(words: np.ndarray, length: int, bits: int) -> np.ndarray:
    return ((words & np.uint64((1 << 8 * length) - 1)) * _PRIME) >> np.uint64(64 - bits)


class Index:
    """A block of benchmark items, cut up so that no part of a text within the allowed edits is missed.

    An item that may have k edits is cut into k + 1 seeds. An edit spoils one seed at most, so of neighbouring seeds, 8 at a
    time, some group has fewer edits than seeds; so has some group of 4 within it, some pair within that, and some seed has
    none. Equal seeds are looked up at every letter of a text, and what fails at the pair, the 4 or the 8 is dropped. A seed
    has at most 5 letters, as a fifth of the letters may be edited.
    """

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(key, body) for key, text in items if (body := normalised(text))]
        bodies = [body for _, body in self.items]
        self.grams = [[body[k : k + GRAM] for k in range(len(body) - GRAM + 1)] for body in bodies]
        flat, begins = laid_out(bodies)
        sizes = np.array([len(body) for body in bodies], np.int64)
        self.allowed = np.array([int(EDITS * len(body)) for body in bodies], np.int64)
        seeds = self.allowed + 1
        self.owner = np.repeat(np.arange(len(bodies)), seeds)
        self.begins, self.first = begins, np.cumsum(seeds) - seeds
        number, total = np.arange(len(self.owner)) - self.first[self.owner], seeds[self.owner]

        def cut(place: np.ndarray) -> np.ndarray:
            return np.minimum(place, total) * sizes[self.owner] // total

        self.offset, length = cut(number), cut(number + 1) - cut(number)
        words = octets(flat)
        place = begins[self.owner] + self.offset
        # the other seed of the pair, read away from this one; one that is alone has a neighbour of no letters
        self.right = number % 2 == 0
        self.length, self.beside = length, np.where(self.right, cut(number + 2) - cut(number + 1), cut(number) - cut(number - 1))
        self.other = np.where(self.right, words[place + length], words[place - 8].byteswap()) & _lowest(self.beside)
        self.groups, self.group = [], []
        for width in GROUPS:
            low = number // width * width
            head = number == low
            begin, size, edits = cut(low), cut(low + width) - cut(low), np.minimum(low + width, total) - low - 1
            self.groups.append(Groups(flat, (begins[self.owner] + begin)[head], size[head], edits[head]))
            self.group.append((np.cumsum(head) - 1, self.offset - begin))
        self.lengths, self.tables = sorted(set(length.tolist())), {}
        for own in self.lengths:
            seed = np.flatnonzero(length == own)
            # some sixteen slots for a seed, within bounds
            bits = min(max((16 * len(seed)).bit_length(), 12), 24)
            slot = _slots(words[place[seed]], own, bits)
            filled, counts = np.unique(slot, return_counts=True)
            marks = np.zeros(1 << bits, bool)
            marks[filled] = True
            order = np.argsort(slot, kind="stable")
            self.tables[own] = bits, marks, np.cumsum(marks, dtype=np.int32), np.cumsum(counts) - counts, counts, seed[order]

    def far(self, item: int, region: str, allowed: int) -> bool:
        """Too few of the item's grams are in ``region`` for any part of it to be within ``allowed`` edits."""
        there = {region[k : k + GRAM] for k in range(len(region) - GRAM + 1)}
        grams = self.grams[item]
        return sum(gram in there for gram in grams) < len(grams) - GRAM * allowed

    def candidates(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in ``flat``, item, place in the item) of equal seeds in groups that are near enough, as arrays."""
        waiting, size = [], 0
        for place, seed in self._paired(flat):
            waiting.append((place, seed))
            size += len(place)
            if size >= HITS:
                yield self._grouped(flat, waiting)
                waiting, size = [], 0
        if waiting:
            yield self._grouped(flat, waiting)

    def _paired(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of equal seeds whose pair is within one edit."""
        words = octets(flat)
        for low in range(PAD, len(flat) - PAD, AT_A_TIME):
            own = words[low : min(low + AT_A_TIME, len(flat) - PAD)]
            for length in self.lengths:
                bits, marks, rank, begin, counts, seeds = self.tables[length]
                slot = _slots(own, length, bits).astype(np.int64)
                rows = np.flatnonzero(marks.take(slot))
                bucket = rank.take(slot[rows]) - 1
                size = counts[bucket]
                # a run of hits that is followed at a time; a single place may have more
                edges = np.flatnonzero(np.diff(np.cumsum(size) // HITS)) + 1
                for first, last in zip([0, *edges], [*edges, len(rows)], strict=True):
                    many = size[first:last]
                    inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    seed = seeds[np.repeat(begin[bucket[first:last]], many) + inner]
                    place, right = np.repeat(low + rows[first:last], many), self.right[seed]
                    there = words[np.where(right, place + length, place - 8)]
                    there = np.where(right, there, there.byteswap())
                    near = one_edit(there, self.other[seed], self.beside[seed])
                    yield place[near], seed[near]

    def _grouped(self, flat: np.ndarray, waiting: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, seed = (np.concatenate(part) for part in zip(*waiting, strict=True))
        for groups, (group, inner) in zip(self.groups, self.group, strict=True):
            edits = groups.edits[group[seed]]
            near = groups.least(flat, place - inner[seed], group[seed], edits) <= edits
            place, seed = place[near], seed[near]
        return place, self.owner[seed], self.offset[seed]

    def could(self, flat: np.ndarray, begin: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether the largest groups of an item, each within twice its edits of its place, sum up to no more than them."""
        groups, (group, _) = self.groups[-1], self.group[-1]
        many = -(-(self.allowed[item] + 1) // GROUPS[-1])
        row = np.repeat(np.arange(len(item)), many)
        own = group[self.first[item]][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        at = begin[row] + groups.begin[own] - self.begins[item][row]
        return np.bincount(row, groups.least(flat, at, own, 2 * self.allowed[item][row]), len(item)) <= self.allowed[item]


def least_edits(item: str, text: str) -> int:
    """The smallest edit distance of ``item`` to any part of ``text``, by bit-parallel columns."""
    size = len(item)
    masks: dict[str, int] = {}
    for place, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | 1 << place
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, now = full, 0, size
    best = size
    for letter in text:
        same = masks.get(letter, 0)
        flat = same | down
        diagonal = ((((same & up) + up) ^ up) | same) & full
        rise, fall = (down | ~(diagonal | up)) & full, up & diagonal
        now += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = (fall | ~(flat | rise)) & full, rise & flat
        best = min(best, now)
    return best


def _held(found: Index, texts_: pa.Array) -> dict[tuple[int, int], int]:
    """Fewest edits by (row, item) of a batch's texts."""
    rows: dict[tuple[int, int], int] = {}
    bodies: list[str] = []
    low = size = 0
    for row, text in enumerate(texts_):
        bodies.append(normalised(text.as_py()))
        size += len(bodies[-1])
        if size > 1 << 20 or row + 1 == len(texts_):
            rows.update({(low + k, item): n for (k, item), n in _verified(found, bodies).items()})
            low, size, bodies = row + 1, 0, []
    return rows


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        for batch in batches:
            rows = _held(found, batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            hits = [(ids[row], found.items[item][0], n, len(found.items[item][1])) for (row, item), n in rows.items()]
            columns = list(zip(*hits, strict=True)) or [()] * 4
            names = ["doc_id", "item_id", "edits", "n_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)

    return run


def _verified(index: Index, bodies: list[str]) -> dict[tuple[int, int], int]:
    """Fewest edits by (text, item), for candidates within the allowed share."""
    best: dict[tuple[int, int], int] = {}
    if not index.items:
        return best
    flat, begins = laid_out(bodies)
    tried: set[tuple[int, int, int]] = set()
    for place, item, offset in index.candidates(flat):
        row = np.searchsorted(begins, place, "right") - 1
        begin = place - begins[row] - offset
        # what begins within the allowed edits of another is searched with it
        named = np.stack([row, item, begin // (index.allowed[item] + 1)])
        kept = np.unique(named, axis=1, return_index=True)[1]
        kept = kept[index.could(flat, place[kept] - offset[kept], item[kept])]
        for row, item, begin, near in zip(row[kept].tolist(), item[kept].tolist(), begin[kept].tolist(), named[2, kept].tolist(), strict=True):
            key, body, allowed = (row, item), index.items[item][1], int(index.allowed[item])
            if best.get(key) == 0 or (row, item, near) in tried:
                continue
            tried.add((row, item, near))
            slack = 2 * allowed
            region = bodies[row][max(0, begin - slack) : max(0, begin + len(body) + slack)]
            if index.far(item, region, allowed):
                continue
            edits = 0 if body in region else least_edits(body, region)
            if edits <= allowed:
                best[key] = min(edits, best.get(key, edits))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that it holds: ``doc_id``, ``item_id``, ``edits``, ``n_chars`` of the item.

    A document holds an item if some part of its text is within ``EDITS`` of the item's length in edits, both in lower case
    and with single blanks. Candidates are equal seeds, at every letter, whose neighbours are near enough for an item within
    its edits (see ``Index``), so none is missed; the whole item is then compared. Null and empty texts hold nothing; items of less than five
    letters may have no edits; rows that repeat an id count as one document, and so do items; null ids of either stay, as one
    id; empty tables give no rows.

    The benchmark goes to the tasks in blocks of about ``BLOCK_BYTES``, one narrow pass over the documents for each block.
    """
    rows = texts(docs)
    found = None
    for index in _indexes(benchmark):
        part = rows.mapInArrow(_search(index), "doc_id long, item_id long, edits long, n_chars long")
        found = part if found is None else found.unionAll(part)
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.min("n_chars").alias("n_chars"))


def _indexes(benchmark: DataFrame) -> Iterator:
    """The benchmark's items as broadcasts of about ``BLOCK_BYTES``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    for number in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number).distinct()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(row.item_id, row.text) for row in own.collect()]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; each row is judged by its own text.

    A narrow pass for each block of the benchmark, one behind the other.
    """
    kept = docs
    for index in _indexes(benchmark):
        kept = kept_by(kept, _clean(index))
    return kept


def _clean(index):
    def clean(bodies: pa.Array) -> np.ndarray:
        kept = np.ones(len(bodies), bool)
        kept[[row for row, _ in _held(index.value, bodies)]] = False
        return kept

    return clean
