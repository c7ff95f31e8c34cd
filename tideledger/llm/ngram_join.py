"""N-gram Jaccard join: universe partition and pigeonhole, segment subsets, one-deletion neighbourhoods, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tideledger.llm.common import ROWS_AT_ONCE, IdMap, marked_rows, row_texts, texts, written
from tideledger.llm.components import components
from tideledger.llm.shingles import batches_of_sets, mixed, shingle_sets

#: Ways to index a part of the universe: whole (no difference allowed in it), cut into that many pieces of which any one may
#: differ, or with each single element left out (0).
CHOICES = (1, 3, 4, 6, 0)
#: Cost model: what a false candidate costs against a signature, and the chance that an unrelated set has a given shingle.
CHECK_COST, COMMON = 50.0, 1e-5
#: Times that sets with too few shared signatures are left out.
ROUNDS = 2
#: Signatures are sorted in so many turns, each with its own share of them, so that a turn's shuffle files are gone before the next.
TURNS = 2
#: Sets that one task compares with as many others.
BLOCK = 256


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``over / under`` between sets of ``width``-word shingles."""

    width: int = 5
    over: int = 4
    under: int = 5

    def linked(self, common, one, two):
        return self.under * common >= self.over * (one + two - common)

    def most(self, size: int) -> int:
        """The largest set that can be linked to one of ``size``."""
        return size * self.under // self.over

    def apart(self, one: int, two: int) -> int:
        """The most elements that are in only one of two linked sets of these sizes."""
        return (one + two) * (self.under - self.over) // (self.under + self.over)


@dataclass(frozen=True)
class Band:
    """How sets of ``low`` to ``high`` elements find partners of up to ``top``: ``parts`` parts, each indexed by ``pieces``."""

    number: int
    low: int
    high: int
    top: int
    apart: int
    parts: int
    pieces: int


@cache
def bands(similarity: Similarity, rows: int, size: int) -> tuple[Band, ...]:
    """Size bands up to sets of ``size``; ``rows`` is the number of documents.

    Sets of a band that are linked differ in at most ``apart`` elements. Parts allow no difference or one; they are given
    out so that the allowances sum up to more than ``apart``, by the choice with the least cost: signatures, plus the
    false candidates to check, which grow with the table and shrink with the elements behind a signature. There are some
    parts more than needed, because only parts with elements are indexed.
    """
    found: list[Band] = []
    low = 1
    while low <= size:
        high = max(low, similarity.most(low))
        top = max(high, similarity.most(high))
        apart = similarity.apart(high, top)
        best = None
        for pieces in CHOICES:
            needed = apart + 1 if pieces == 1 else -(-(apart + 1) // 2)
            parts = needed
            while _filled(parts, low, pieces) < needed and parts < 2 * needed:
                parts += 1
            per_part = low / parts
            own = per_part if pieces == 1 else per_part * (pieces - 1) / pieces if pieces else max(per_part - 1, 0)
            signatures = parts * (1 if pieces == 1 else pieces or per_part + 1)
            cost = signatures * (1 + CHECK_COST * rows / 20 * COMMON * max(own, 0.05) * math.exp(-2 * own))
            if best is None or cost < best[0]:
                best = (cost, parts, pieces)
        found.append(Band(len(found), low, high, top, apart, best[1], best[2]))
        low = high + 1
    return tuple(found)


def _filled(parts: int, size: int, pieces: int) -> float:
    """Parts of a random set of ``size`` that surely have what their signatures need, three deviations below the mean."""
    mean = size / parts
    empty = math.exp(-mean) if pieces == 1 else math.exp(-mean) * (1 + mean)
    return parts * (1 - empty) - 3 * math.sqrt(parts * empty * (1 - empty))


def _signatures(own: np.ndarray, band: Band) -> np.ndarray:
    """Signatures of one set in one band.

    A part's elements are summed up as hashes. If two linked sets have at most ``apart`` differences, some part with elements
    of a set holds no more than it allows, unless the set has too few such parts; only then are signatures of nothing given
    out too. So two linked sets share a signature: by a filled part of either, or, if both have too few, by any part.
    """
    part = ((own >> np.uint64(33)) % np.uint64(band.parts)).astype(np.int64)
    weight = mixed(own, band.number + 1)
    if band.pieces == 1:
        return _sums(part, weight, band.parts, band, band.apart + 1, 1)
    if band.pieces == 0:
        sums, counts = _grouped(part, weight, band.parts)
        out = np.concatenate([sums, sums[part] - weight])
        place, left = np.concatenate([np.arange(band.parts), part]), np.concatenate([counts, counts[part] - 1])
        short = 2 * int((counts >= 2).sum()) < band.apart + 1
        return _keyed(out, place, band)[(left > 0) | short]
    piece = ((own >> np.uint64(13)) % np.uint64(band.pieces)).astype(np.int64)
    sums, counts = _grouped(part * band.pieces + piece, weight, band.parts * band.pieces)
    sums, counts = sums.reshape(-1, band.pieces), counts.reshape(-1, band.pieces)
    out, left = sums.sum(1)[:, None] - sums, counts.sum(1)[:, None] - counts
    short = 2 * int((left.min(1) > 0).sum()) < band.apart + 1
    return _keyed(out.ravel(), np.arange(out.size), band)[(left.ravel() > 0) | short]


def _grouped(place: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros(size, np.uint64)
    np.add.at(sums, place, weight)
    return sums, np.bincount(place, minlength=size)


def _sums(place: np.ndarray, weight: np.ndarray, size: int, band: Band, needed: int, least: int) -> np.ndarray:
    sums, counts = _grouped(place, weight, size)
    short = int((counts >= least).sum()) < needed
    return _keyed(sums, np.arange(size), band)[(counts > 0) | short]


def _keyed(sums: np.ndarray, place: np.ndarray, band: Band) -> np.ndarray:
    return mixed(sums + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), 1000 + band.number)


def signatures(own: np.ndarray, similarity: Similarity, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set, in its own band and in the one below as a larger partner, and what ``_spared`` says of them."""
    size = len(own)
    # bands don't depend on how far they are listed, so they are listed to a power of two and kept
    listed = bands(similarity, rows, 1 << size.bit_length())
    number = next(band.number for band in listed if band.low <= size <= band.high)
    found = [_spared(own, listed[number])]
    if number and size <= listed[number - 1].top:
        found.append(_spared(own, listed[number - 1]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _spared(own: np.ndarray, band: Band) -> tuple[np.ndarray, np.ndarray]:
    """A band's signatures of one set, and for each the band's number and how many the set can spare, as one number.

    A linked set differs in ``apart`` elements at most, each of which touches one part. A filled part without a difference shares its
    one signature or, where pieces or elements are left out, two at least; there a part with a single difference shares one still. So
    all but ``apart`` of the filled parts' signatures, counted once or twice, are those of the linked set, too: a set can spare one less.
    """
    keys = np.unique(_signatures(own, band))
    part = ((own >> np.uint64(33)) % np.uint64(band.parts)).astype(np.int64)
    if band.pieces > 1:
        piece = ((own >> np.uint64(13)) % np.uint64(band.pieces)).astype(np.int64)
        held = np.bincount(part * band.pieces + piece, minlength=band.parts * band.pieces).reshape(-1, band.pieces)
        filled = int(((held > 0).sum(1) > 1).sum())
    else:
        filled = int((np.bincount(part) > (band.pieces == 0)).sum())
    spare = max(0, filled * (1 if band.pieces == 1 else 2) - band.apart - 1)
    return keys, np.full(len(keys), band.number << 32 | spare, np.int64)


def set_number(own: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    one, two = mixed(own, 5).sum(dtype=np.uint64), mixed(own, 6).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _describe(width: int, with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part, sets in batches_of_sets(batches, width):
                arrays, names = [part.column("doc_id"), *_numbers(sets)], ["doc_id", "n_shingles", "one", "two"]
                if with_text:
                    arrays, names = [*arrays, part.column("text")], [*names, "text"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _numbers(sets: list[np.ndarray]) -> list[pa.Array]:
    """Sizes and names of sets."""
    names = [set_number(own) for own in sets]
    return [pa.array(column, pa.int64()) for column in ([len(own) for own in sets], [n for n, _ in names], [n for _, n in names])]


def _describe_rows(width: int):
    """Sizes and names of rows' sets, beside the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(low, ROWS_AT_ONCE)
                    sets = shingle_sets([text.as_py() for text in row_texts(part).cast(pa.binary())], width)
                    yield pa.RecordBatch.from_arrays([*_numbers(sets), part.column("row")], names=["n_shingles", "one", "two", "row"])

    return run


def _index(similarity: Similarity, rows: int, turn: int = 0, turns: int = 1):
    """Signatures of sets, those that fall to one of so many turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for _, sets in batches_of_sets(batches, similarity.width):
                named = {set_number(own): own for own in sets if len(own)}
                found = [signatures(own, similarity, rows) for own in named.values()]
                taken = [keys % np.uint64(turns) == turn for keys, _ in found]
                found = [(keys[own], kinds[own]) for (keys, kinds), own in zip(found, taken, strict=True)]
                sizes = [len(keys) for keys, _ in found]
                keys = np.concatenate([np.zeros(0, np.uint64), *(keys for keys, _ in found)])
                kinds = np.concatenate([np.zeros(0, np.int64), *(kinds for _, kinds in found)])
                names = np.repeat(np.array([one for one, _ in named], np.int64), sizes)
                for low in range(0, len(keys), 1 << 16):
                    own = slice(low, low + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[own].view(np.int64)), pa.array(names[own]), pa.array(kinds[own])], names=["signature", "one", "kind"]
                    )

    return run


def _verify(similarity: Similarity):
    """Linked rows among pairs of texts; a text that comes again in a batch is hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1024):
                part = batch.slice(low, 1024)
                known: dict[int, np.ndarray] = {}
                for id_, text in (("a", "text_a"), ("b", "text_b")):
                    ids, bodies = part.column(id_).to_pylist(), part.column(text).cast(pa.binary())
                    new = {key: row for row, key in enumerate(ids) if key not in known}
                    sets = shingle_sets([bodies[row].as_py() for row in new.values()], similarity.width)
                    known.update(zip(new, sets, strict=True))
                pairs = zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True)
                kept = [pair for pair in pairs if _similar(known[pair[0]], known[pair[1]], similarity)]
                yield _links(kept)

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    one, two = [a for a, _ in pairs], [b for _, b in pairs]
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])


def _similar(one: np.ndarray, two: np.ndarray, similarity: Similarity) -> bool:
    if min(len(one), len(two)) * similarity.under < max(len(one), len(two)) * similarity.over:
        return False
    common = len(one) + len(two) - len(np.union1d(one, two))
    return bool(similarity.linked(common, len(one), len(two)))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Elements that each two of ``sets`` have in common, from the elements that more than one of them has."""
    owner = np.repeat(np.arange(len(sets)), [len(own) for own in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[place] > 1
    owner, column = owner[keep], shared[place[keep]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(shared[-1]) + 1 if len(values) else 0, 4096):
        own = (column >= low) & (column < low + 4096)
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[own], column[own] - low] = 1
        total += held @ held.T
    return total


def _compare(similarity: Similarity):
    """Links between the sets of a block that aren't in one component yet, as few as connect them."""

    def run(block: pa.Table) -> pa.Table:
        ids, component = block.column("doc_id").to_pylist(), np.array(block.column("component").to_pylist())
        sets = shingle_sets([text.as_py() for text in block.column("text").combine_chunks().cast(pa.binary())], similarity.width)
        sizes = np.array([len(own) for own in sets])
        close = similarity.linked(common_counts(sets), sizes[:, None], sizes[None, :])
        close &= component[:, None] != component[None, :]
        kept, root = [], {name: name for name in component.tolist()}

        def top(name: int) -> int:
            while root[name] != name:
                root[name] = root[root[name]]
                name = root[name]
            return name

        for one, two in np.argwhere(np.triu(close)):
            left, right = top(int(component[one])), top(int(component[two]))
            if left != right:
                root[left] = right
                kept.append((ids[one], ids[two]))
        return pa.Table.from_batches([_links(kept)])

    return run


def _joined_pairs(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    one = bodies.select(F.col("one").alias("low"), F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = bodies.select(F.col("one").alias("name"), F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(two, "name").join(one, "low").select("a", "b", "text_a", "text_b")


def near_copies(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs`` (``doc_id``, ``text``, any others).

    Documents are linked when their sets of ``width``-word shingles have at least the given Jaccard similarity; a component is
    named by its smallest ``doc_id``. Texts without words (null, empty or blank) are linked with nothing, and their component
    is their own id. A text with fewer words than ``width`` is one shingle. Rows that repeat an id are one class or linked as
    any others; a null id gets its class's component and null if it is alone. No rows give no rows. Sets are compared as 64-bit
    shingle hashes, and named by 128 bits.

    1. Equal sets are one class, represented by the smallest id; classes are summed up before they are shuffled.
    2. Every set gives out its signatures; sets that share one are candidates. The signature table is sorted once, and each
       candidate meets the first set of its signature.
       Sets that share no more of them than the pigeonhole has to spare are linked with none (``_members``).
    3. Those pairs are verified on whole texts, which are fetched for candidates only, and linked sets become components.
    4. Sets of signatures that still hold several components are compared across components, in blocks, and only links that
       connect components leave a block. So every candidate pair is compared or already connected, and no group's pairs are
       ever listed.
    """
    sized, classes, repeated = _classed(docs, similarity)
    if repeated:
        smallest = classes.groupBy("component").agg(F.min("least").alias("smallest"))
        classes = classes.join(smallest, "component").withColumn("component", F.col("smallest"))
    classes = classes.select("n_shingles", "one", "two", "component")
    placed = sized.filter("n_shingles > 0").join(classes, ["n_shingles", "one", "two"])
    placed = placed.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return placed.unionAll(sized.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _classed(docs: DataFrame, similarity: Similarity) -> tuple[DataFrame, DataFrame, bool]:
    """Sets of rows, classes of equal sets with their components' keys, and whether keys are other than smallest ids."""
    rows = texts(docs)
    sized = rows.mapInArrow(_describe(similarity.width), "doc_id long, n_shingles long, one long, two long")
    sized = written(sized, "sizes")
    classes = sized.filter("n_shingles > 0").groupBy("n_shingles", "one", "two").agg(F.min("doc_id").alias("least"))
    classes, repeated = _represented(written(classes, "classes"), sized)
    links = _found_links(rows, sized, classes, repeated, similarity)
    if links is not None:
        classes = classes.join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
    else:
        classes = classes.withColumn("component", F.lit(None).cast("long"))
    classes = classes.select("n_shingles", "one", "two", "least", F.coalesce("component", "rep").alias("component"))
    return sized, classes, repeated is not None


def _represented(classes: DataFrame, sized: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes with the key ``rep`` that stands for them in links, and the ids of rows with different sets.

    The smallest id stands for a class. Where that is null or an id of other sets too, a hash of the set's name does
    (``odd``); where no class is so, there is no table of ids.
    """
    ends = [end(name).alias(f"{end.__name__}_{name}") for name in ("one", "two") for end in (F.min, F.max)]
    repeated = sized.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*ends)
    repeated = written(repeated.filter("min_one != max_one OR min_two != max_two").select("doc_id"), "repeated")
    plain = classes.withColumn("rep", F.col("least")).withColumn("odd", F.lit(False))
    nameless = classes.filter("least IS NULL")
    if not repeated.limit(1).count() and not nameless.limit(1).count():
        return plain, None
    own = F.xxhash64("n_shingles", "one", "two")
    same = plain["least"] == repeated["doc_id"]
    parts = [
        plain.filter("least IS NOT NULL").join(repeated, same, "left_anti"),
        plain.join(repeated, same, "left_semi").withColumns({"rep": own, "odd": F.lit(True)}),
        nameless.withColumns({"rep": own, "odd": F.lit(True)}),
    ]
    return written(parts[0].unionByName(parts[1]).unionByName(parts[2]), "classes"), repeated


def _bodies(rows: DataFrame, found: DataFrame, repeated: DataFrame | None, width: int) -> DataFrame:
    """``one``, ``rep`` as ``doc_id`` and a text of each class: by its smallest id, or by the set's name if that is odd."""
    plain = found.filter("NOT odd")
    bodies = IdMap(plain.select(F.col("rep").alias("doc_id"))).rows(rows, True)
    bodies = bodies.join(plain, bodies["doc_id"] == plain["rep"]).select("one", "doc_id", "text")
    if repeated is not None:
        unsure = rows.filter("doc_id IS NULL").unionAll(rows.join(repeated, "doc_id", "left_semi"))
        named = unsure.mapInArrow(_describe(width, True), "doc_id long, n_shingles long, one long, two long, text string")
        named = named.drop("doc_id").join(found.filter("odd"), ["n_shingles", "one", "two"])
        bodies = bodies.unionAll(named.select("one", F.col("rep").alias("doc_id"), "text"))
    return bodies.dropDuplicates(["one", "doc_id"])


def _found_links(
    rows: DataFrame, sized: DataFrame, classes: DataFrame, repeated: DataFrame | None, similarity: Similarity
) -> DataFrame | None:
    """Links between representatives, enough to connect every component; None where no two sets share a signature."""
    count, schema = sized.count(), "signature long, one long, kind long"
    members = _members([rows.mapInArrow(_index(similarity, count, turn, TURNS), schema) for turn in range(TURNS)])
    pairs = members.select("low", "name").distinct()
    wanted = members.select(F.col("name").alias("one")).unionAll(members.select(F.col("low").alias("one"))).distinct()
    found = classes.join(wanted, "one", "left_semi").select("n_shingles", "one", "two", "rep", "odd")
    found = written(found, "candidates")
    if not found.limit(1).count():
        return None
    bodies = _bodies(rows, found, repeated, similarity.width)
    bodies = written(bodies, "bodies")
    first = written(_joined_pairs(pairs, bodies).mapInArrow(_verify(similarity), "a long, b long"), "links")
    return first.unionAll(written(_compared(members, found, bodies, components(first, 2), similarity), "links"))


def _members(indexes: list[DataFrame]) -> DataFrame:
    """``signature``, ``kind``, ``low`` (the first set that has it) and ``name`` of the others, of signatures that can tell a link.

    ``indexes`` have every signature of their own; only those that several sets share are written, one index after the other.

    A set that shares no more signatures than it can spare is linked with none, and goes. What it shared may then be left to one set
    alone, so this is done ``ROUNDS`` times. So passages that many texts have in common give hardly any candidates, while sets that
    share much keep all their signatures, the frequent ones by which a large group meets its first set.
    """
    group = W.partitionBy("signature")

    def found(index: DataFrame) -> DataFrame:
        index = index.select(
            "signature", "kind", F.col("one").alias("name"), F.lag("one").over(group.orderBy("one")).alias("last"),
            F.min("one").over(group).alias("low"), F.max("one").over(group).alias("high"),
        )
        # copies of a set lie next to each other
        return index.filter("low != high AND (last IS NULL OR name != last)").select("signature", "kind", "name")

    shared = reduce(DataFrame.unionAll, [written(found(index), "shared") for index in indexes])
    for _ in range(ROUNDS):
        enough = shared.groupBy("name", "kind").agg(F.count("*").alias("held")).filter("held > (kind & 4294967295)")
        shared = shared.join(enough.select("name", "kind"), ["name", "kind"])
        both = [F.min("name").over(group).alias("low"), F.max("name").over(group).alias("high")]
        shared = written(shared.select("signature", "kind", "name", *both).filter("low != high"), "shared")
    # the first set of a signature is the one the others meet
    return shared.select("signature", "kind", "low", "name").filter("name != low")


def _compared(members: DataFrame, found: DataFrame, bodies: DataFrame, known: DataFrame, similarity: Similarity) -> DataFrame:
    """Links across the components ``known`` between sets that share a signature, apart from each signature's first set.

    Sets go into blocks with others that met the same first set; a block is compared with itself and with every block that it
    shares an open signature with. Blocks are compared by their sets' signatures first, so only texts of sets that share more of them
    with some set than either can spare are sent, each once for such a pair of blocks.
    """
    belongs = found.join(known, found["rep"] == known["node"], "left")
    belongs = belongs.select(F.col("one").alias("name"), F.col("rep").alias("doc_id"), F.coalesce("component", "rep").alias("component"))
    placed = members.join(belongs, "name")
    open_ = placed.groupBy("signature").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    placed = written(placed.join(open_.filter("least != most").select("signature"), "signature"), "open")
    met = placed.groupBy("name", "doc_id", "component").agg(F.min("low").alias("first"))
    blocks = met.groupBy("first").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = met.join(blocks, "first").withColumn("block", F.xxhash64("first", F.pmod(F.hash("name", "doc_id"), "blocks")))
    dealt = written(dealt.select("name", "doc_id", "component", "block"), "blocks")
    there = placed.select("signature", "name", "doc_id", "kind").join(dealt, ["name", "doc_id"])
    held = there.groupBy("block", "doc_id", "component", "kind").agg(F.collect_list(F.hash("signature")).alias("held"))
    there = written(there.select("signature", "block").distinct(), "shared")
    pairs = there.withColumnRenamed("block", "i").join(there.withColumnRenamed("block", "j"), "signature").filter("i <= j")
    pairs = pairs.select("i", "j").distinct().withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    near = pairs.join(written(held, "held"), "block").groupBy("i", "j").applyInArrow(_meeting, "i long, j long, doc_id long")
    near = written(near, "near")
    texts_ = bodies.select("doc_id", "text").dropDuplicates(["doc_id"]).join(dealt.select("doc_id", "component").distinct(), "doc_id")
    full = near.join(texts_, "doc_id").select("i", "j", "doc_id", "component", "text")
    return full.groupBy("i", "j").applyInArrow(_compare(similarity), "a long, b long")


def _meeting(block: pa.Table) -> pa.Table:
    """The sets of two blocks that share more signatures with a set of another component than either of them can spare.

    Signatures are 32-bit hashes here; what a set loses by equal ones counts as shared.
    """
    kinds, component, ids = (np.array(block.column(name).to_pylist(), np.int64) for name in ("kind", "component", "doc_id"))
    held = [row.values.to_numpy() for row in block.column("held").combine_chunks()]
    sets = [np.unique(own) for own in held]
    lost = np.array([len(every) - len(own) for every, own in zip(held, sets, strict=True)])
    band, spare = kinds >> 32, (kinds & 0xFFFFFFFF) - lost
    near = common_counts(sets) > np.maximum(spare[:, None] - lost[None, :], spare[None, :] - lost[:, None])
    near &= (component[:, None] != component[None, :]) & (band[:, None] == band[None, :])
    found = np.unique(ids[near.any(1)])
    names = {name: pa.array(np.full(len(found), block.column(name)[0].as_py(), np.int64)) for name in ("i", "j")}
    return pa.table({**names, "doc_id": pa.array(found)})


def drop_near_copies(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near copies, with all their columns.

    The smallest ``doc_id`` of a group stays (null after all others); of its rows with that id the one whose set has the smallest
    name, so that null and repeated ids keep one row of each group, too. Texts without words all stay.
    """
    sized, classes, _ = _classed(docs, similarity)
    least = F.struct(F.col("least").isNull().alias("nameless"), "least", "n_shingles", "one", "two")
    first = classes.groupBy("component").agg(F.min(least).alias("first"))
    first = first.select(*[F.col(f"first.{name}").alias(f"first_{name}") for name in ("least", "n_shingles", "one", "two")])
    first = written(first, "first")

    def same(rows: DataFrame) -> Column:
        equal = [rows[name] == first[f"first_{name}"] for name in ("n_shingles", "one", "two")]
        return reduce(lambda a, b: a & b, equal, rows["doc_id"].eqNullSafe(first["first_least"]))

    # rows stay where they lie unless their id is one that goes or comes again
    filled = sized.filter("n_shingles > 0")
    again = filled.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    marked, stay = marked_rows(docs, filled.join(first, same(filled), "left_anti").select("doc_id").unionAll(again))
    schema = StructType([*StructType.fromDDL("n_shingles long, one long, two long").fields, StructField("row", docs.schema)])
    rows = marked.mapInArrow(_describe_rows(similarity.width), schema).withColumn("doc_id", F.col("row.doc_id").cast("long"))
    one_each = rows.join(first, same(rows), "left_semi").dropDuplicates(["doc_id", "n_shingles", "one", "two"])
    return reduce(DataFrame.unionAll, [part.select("row.*") for part in (stay, one_each, rows.filter("n_shingles = 0"))])
