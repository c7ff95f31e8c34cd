"""The prefix trie of rebuilt conversations, from composable fingerprints.

The fingerprint of a sequence of turns is (length, sum of letter i times B^i) for four primes; fingerprints of neighbours compose:
(n, f) and (m, g) give (n + m, f + B^n g). So a rebuilt conversation, the head of one conversation and the rest of another, has
its fingerprints from those of the two, and no rebuilt text is ever made. Prefixes with one fingerprint are one node only if
their last turns and their parents are the same, which is checked; if ever they aren't, other factors B are taken.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideledger.llm.common import written
from tideledger.operators.ordered import CHUNK, ordered_chunks

#: primes below 2^31: products fit 64 bits
MODULI = (2147483647, 2147483629, 2147483587, 2147483579)
TRIES = 8
# depths in one window, and characters of ids in one row
DEPTHS = 1024
ID_CHARS = 1 << 16

SUMS = [f"f{i}" for i in range(4)]
BEFORE = [f"e{i}" for i in range(4)]
CLASS = ["x", "y", "tie"]
KEY = ["depth", "a", "b"]


@dataclass(frozen=True)
class Rebuild:
    """How a conversation is rebuilt: ``head`` turns (0 to ``most``) of conversation ``base``, then its own after as many."""

    base: Callable[[Column], Column] = lambda conv: conv - conv % 20
    head: Callable[[Column], Column] = lambda conv: F.crc32(conv.cast("string")) % 4
    most: int = 3


def _hashes(role: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(role, text), F.xxhash64(F.lit(1), text, role)


def turn_classes(conversations: DataFrame, hashes: Callable = _hashes) -> DataFrame:
    """``conv_id``, ``turn``, the class of the turn (``x``, ``y``, ``tie``) and its words; one class is one role and text.

    Where different turns share a hash, ``tie`` tells them apart; texts are compared once, after equal ones are one row.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    x, y = hashes(F.col("role"), F.col("text"))
    turns = turns.withColumns({"x": x, "y": y})
    shared = turns.select("x", "y", "role", "text").distinct().groupBy("x", "y").count().filter("count > 1").select("x", "y")
    if shared.isEmpty():
        turns = turns.withColumn("tie", F.lit(0))
    else:
        told = turns.join(shared, ["x", "y"], "left_semi").select("x", "y", "role", "text").distinct()
        tie = F.row_number().over(Window.partitionBy("x", "y").orderBy("role", "text"))
        turns = turns.join(told.withColumn("tie", tie), ["x", "y", "role", "text"], "left").fillna(0, ["tie"])
    return turns.select("conv_id", "turn", *CLASS, F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"))


class Factors:
    """The factors B of one try, their powers, and the composition of fingerprints."""

    def __init__(self, seed: int, moduli: tuple[int, ...] = MODULI):
        some = random.Random(seed)
        self.moduli = moduli
        self.factors = [some.randrange(2, p - 1) for p in moduli]

    def power(self, n: int) -> list[int]:
        return [pow(b, n, p) for b, p in zip(self.factors, self.moduli, strict=True)]

    def powers(self, i: int, exponents: np.ndarray) -> np.ndarray:
        p, square = self.moduli[i], self.factors[i]
        found = np.ones(len(exponents), np.int64)
        for bit in range(int(exponents.max(initial=0)).bit_length()):
            odd = (exponents >> bit) & 1 == 1
            found[odd] = found[odd] * square % p
            square = square * square % p
        return found

    def composed(self, first: tuple[int, list[int]], second: tuple[int, list[int]]) -> tuple[int, list[int]]:
        shift = self.power(first[0])
        sums = [(f + s * g) % p for f, g, s, p in zip(first[1], second[1], shift, self.moduli, strict=True)]
        return first[0] + second[0], sums


def _letters(factors: Factors, x: np.ndarray, y: np.ndarray, tie: np.ndarray) -> list[np.ndarray]:
    """A turn's letter for each prime, from 1 on."""
    halves = [x & 0xFFFFFFFF, (x >> 32) & 0xFFFFFFFF, y & 0xFFFFFFFF, (y >> 32) & 0xFFFFFFFF]
    return [1 + (half + 7 * tie) % (p - 1) for half, p in zip(halves, factors.moduli, strict=True)]


def _scan(factors: Factors):
    """Places and fingerprints of a conversation's prefixes, counted from where it begins in its chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_place, open_sums = None, 0, [0] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, conv, x, y, tie = (batch.column(c).to_numpy() for c in (CHUNK, "conv_id", *CLASS))
            new = np.r_[(chunk[0], conv[0]) != open_key, (chunk[1:] != chunk[:-1]) | (conv[1:] != conv[:-1])]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
            # rows that go on with the conversation of the last batch
            goes_on = np.cumsum(new) == 0
            place = np.arange(1, len(conv) + 1) - begin + np.where(goes_on, open_place, 0)
            columns = [batch.column(c) for c in (CHUNK, "conv_id", *CLASS, "n_words")] + [pa.array(place)]
            before = []
            for i, letters in enumerate(_letters(factors, x, y, tie)):
                p = factors.moduli[i]
                own = letters * factors.powers(i, place - 1) % p
                sums = np.cumsum(own)
                sums = (sums - (sums - own)[begin] + np.where(goes_on, open_sums[i], 0)) % p
                columns.append(pa.array(sums))
                before.append(pa.array((sums - own) % p))
                open_sums[i] = int(sums[-1])
            open_key, open_place = (chunk[-1], conv[-1]), int(place[-1])
            yield pa.RecordBatch.from_arrays(columns + before, names=[CHUNK, "conv_id", *CLASS, "n_words", "place", *SUMS, *BEFORE])

    return run


def _carried(local: DataFrame, factors: Factors) -> DataFrame:
    """For every chunk that begins inside a conversation: its turns and sums in earlier chunks, and B to their number.

    One row for each range partition comes to the driver, where they are composed in order.
    """
    ends = local.groupBy(CHUNK).agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"))
    own = [F.pmod(F.sum(F.pmod(F.col(f) - F.col(e), F.lit(p))), F.lit(p)).alias(f) for f, e, p in zip(SUMS, BEFORE, factors.moduli, strict=True)]
    tails = local.join(F.broadcast(ends.select(CHUNK, F.col("last").alias("conv_id"))), [CHUNK, "conv_id"])
    tails = tails.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("n"), *own)
    rows, conv, held = [], None, (0, [0] * 4)
    for row in ends.join(tails, CHUNK).orderBy(CHUNK).collect():
        tail = (row["n"], [row[f] for f in SUMS])
        if row["first"] == conv:
            rows.append((row[CHUNK], conv, held[0], *held[1], *factors.power(held[0])))
            held = factors.composed(held, tail) if row["last"] == conv else tail
        else:
            held = tail
        conv = row["last"]
    names = [f"{CHUNK} int", "conv_id long", "held long", *[f"h{i} long" for i in range(4)], *[f"w{i} long" for i in range(4)]]
    return local.sparkSession.createDataFrame(rows, ", ".join(names))


def _prefixes(classes: DataFrame, factors: Factors) -> DataFrame:
    """Every turn with its place in its conversation and the sums up to and before it, for conversations of any length."""
    order = ["conv_id", "turn", *CLASS, "row"]
    # equal rows differ by their place in the table, so that they may be split
    chunks = ordered_chunks(classes.withColumn("row", F.monotonically_increasing_id()), *order)
    dealt = chunks.repartition(CHUNK).sortWithinPartitions(CHUNK, *order).select(CHUNK, "conv_id", *CLASS, "n_words")
    longs = ", ".join(f"{c} long" for c in ["n_words", "place", *SUMS, *BEFORE])
    local = written(dealt.mapInArrow(_scan(factors), f"{CHUNK} int, conv_id long, x long, y long, tie int, {longs}"), "prefixes")
    # at most one row for each range partition
    found = local.join(F.broadcast(_carried(local, factors)), [CHUNK, "conv_id"], "left")
    sums = {"place": F.col("place") + F.coalesce("held", F.lit(0))}
    for i, p in enumerate(factors.moduli):
        for name in (SUMS[i], BEFORE[i]):
            sums[name] = F.pmod(F.coalesce(f"h{i}", F.lit(0)) + F.coalesce(f"w{i}", F.lit(1)) * F.col(name), F.lit(p))
    return found.withColumns(sums).select("conv_id", "place", *CLASS, "n_words", *SUMS, *BEFORE)


def _headers(prefixes: DataFrame, rebuild: Rebuild, factors: Factors) -> DataFrame:
    """One row for each conversation: turns, sums, its first turns, and the same of its base as far as it is used."""
    heads = range(1, rebuild.most + 1)
    parts = [*SUMS, *CLASS, "n_words"]
    firsts = [F.max(F.when(F.col("place") == j, F.col(c))).alias(f"{c}_{j}") for j in heads for c in parts]
    whole = [F.pmod(F.sum(F.pmod(F.col(f) - F.col(e), F.lit(p))), F.lit(p)).alias(f) for f, e, p in zip(SUMS, BEFORE, factors.moduli, strict=True)]
    own = prefixes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *whole, *firsts)
    own = own.withColumns({"h": rebuild.head(F.col("conv_id")).cast("long"), "base": rebuild.base(F.col("conv_id"))})
    turns = F.array(*[F.struct(*[F.col(f"{c}_{j}").alias(c) for c in parts]) for j in heads]).alias("turns")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), turns)
    used = F.least("h", F.coalesce("base_n", F.lit(0)))
    found = own.join(bases, "base", "left").withColumn("k", used)
    for i, p in enumerate(factors.moduli):
        skipped = F.coalesce(*[F.when(F.col("h") == j, F.col(f"{SUMS[i]}_{j}")) for j in heads], F.lit(0))
        headed = F.when(F.col("k") > 0, F.col("turns")[(F.col("k") - 1).cast("int")][SUMS[i]]).otherwise(0)
        back = [F.when(F.col("h") - F.col("k") == j, F.lit(pow(factors.factors[i], -j, p))) for j in heads]
        found = found.withColumns({f"s{i}": skipped, f"q{i}": headed, f"w{i}": F.coalesce(*back, F.lit(1))})
    keep = [f"{c}{i}" for c in "sqw" for i in range(4)]
    return found.select("conv_id", "n", "h", "k", *SUMS, *keep, F.slice("turns", F.lit(1), F.col("k").cast("int")).alias("turns"))


def _rebuilt(sums: list[str], factors: Factors) -> list[Column]:
    """Sums of own prefixes, moved behind the head: the head's, and what follows the skipped turns, shifted."""
    return [
        F.pmod(F.col(f"q{i}") + F.col(f"w{i}") * F.pmod(F.col(c) - F.col(f"s{i}"), F.lit(p)), F.lit(p))
        for i, (c, p) in enumerate(zip(sums, factors.moduli, strict=True))
    ]


def _packed(sums: list[Column], names: tuple[str, str]) -> list[Column]:
    """Four sums in two numbers."""
    return [(sums[j] * (1 << 31) + sums[j + 1]).alias(name) for j, name in zip((0, 2), names, strict=True)]


def _members(prefixes: DataFrame, headers: DataFrame, factors: Factors) -> DataFrame:
    """One row for each conversation and depth: the prefix, its parent, the class and words of its last turn."""
    columns = ["conv_id", *KEY, "pa", "pb", *CLASS, "n_words"]
    zero = F.lit(0).cast("long")
    nothing = [zero.alias(c) for c in (*KEY, "pa", "pb", "x", "y")]
    roots = headers.select("conv_id", *nothing, F.lit(0).alias("tie"), zero.alias("n_words"))
    heads = headers.select("conv_id", "turns", F.posexplode("turns").alias("at", "last"))
    heads = heads.withColumn("above", F.when(F.col("at") > 0, F.try_element_at("turns", F.col("at"))))
    heads = heads.select(
        "conv_id",
        (F.col("at") + 1).cast("long").alias("depth"),
        *_packed([F.col("last")[f] for f in SUMS], ("a", "b")),
        *_packed([F.coalesce(F.col("above")[f], zero) for f in SUMS], ("pa", "pb")),
        *[F.col("last")[c].alias(c) for c in (*CLASS, "n_words")],
    )
    links = headers.select("conv_id", "h", "k", *[f"{c}{i}" for c in "sqw" for i in range(4)])
    tails = prefixes.join(links, "conv_id").filter("place > h")
    tails = tails.select(
        "conv_id",
        F.expr("k + place - h").alias("depth"),
        *_packed(_rebuilt(SUMS, factors), ("a", "b")),
        *_packed(_rebuilt(BEFORE, factors), ("pa", "pb")),
        *CLASS,
        "n_words",
    )
    return roots.select(columns).unionAll(heads.select(columns)).unionAll(tails.select(columns))


def _nodes(members: DataFrame) -> DataFrame:
    """One row for each fingerprint, with what its prefixes must have in common."""
    common = ["pa", "pb", *CLASS, "n_words"]
    same = F.lit(True)
    for c in common:
        same = same & (F.min(c) == F.max(c))
    return members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in common], same.alias("same")
    )


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key's ids, joined by commas, in rows of bounded size."""
    names = [*KEY, "first", "ids"]
    for batch in batches:
        depth, a, b, conv = (batch.column(c).to_numpy() for c in (*KEY, "conv_id"))
        breaks = np.flatnonzero((np.diff(depth) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
        cuts = np.unique(np.r_[breaks, np.arange(0, len(conv), ID_CHARS // 20)])
        for low in range(0, len(cuts), 4096):
            part = cuts[low : low + 4096]
            ends = np.r_[cuts[low + 1 : low + 4097], len(conv)][: len(part)]
            ids = [",".join(map(str, conv[begin:end].tolist())) for begin, end in zip(part, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[part]) for c in (depth, a, b, conv)), pa.array(ids)], names=names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every key's ids; rows come in order, and only one digest is open."""
    names = [*KEY, "ends_sha256"]
    key, digest = None, None
    for batch in batches:
        done = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if own != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, digest.hexdigest())], names=names)


def _ends(headers: DataFrame, factors: Factors) -> DataFrame:
    """The digest of the conversations that end at a node. A node's ids are ordered by range, packed, and read as a stream."""
    last = [F.when(F.col("n") > F.col("h"), f).otherwise(F.col(f"q{i}")) for i, f in enumerate(_rebuilt(SUMS, factors))]
    depth = F.expr("k + greatest(n - h, 0)").alias("depth")
    chunks = ordered_chunks(headers.select("conv_id", depth, *_packed(last, ("a", "b"))), *KEY, "conv_id")
    sorted_ids = chunks.repartition(CHUNK).sortWithinPartitions(CHUNK, *KEY, "conv_id").select(*KEY, "conv_id")
    packs = sorted_ids.mapInArrow(_packs, "depth long, a long, b long, first long, ids string")
    packs = packs.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return packs.mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def _above(nodes: DataFrame) -> DataFrame:
    """What nodes above one with the same ``conv_id`` save; in windows of ``DEPTHS`` depths, and of one row for each."""
    own = nodes.filter("n_convs > 1").select("conv_id", *KEY, F.expr("(n_convs - 1) * n_words").alias("own"))
    own = own.withColumn("part", F.expr(f"depth div {DEPTHS}"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy("conv_id", "part").agg(F.sum("own").alias("all"))
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("opening"))
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("inner", F.coalesce(F.sum("own").over(inside), F.lit(0)))
    return own.join(parts, ["conv_id", "part"]).select(*KEY, (F.col("opening") + F.col("inner")).alias("above"))


def prefix_trie(
    conversations: DataFrame, rebuild: Rebuild | None = None, hashes: Callable = _hashes, moduli: tuple[int, ...] = MODULI
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (``conv_id``, ``turn``, ``role``, ``text``; others are ignored).

    A node is a sequence of the first ``depth`` rebuilt turns (role and text); the root has none, and every conversation is a member
    of it. ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null at the root); ``n_convs``, ``n_children``
    and ``n_leaves`` count members, children and childless nodes below, itself included; ``saved_tokens`` adds up, over the node and all
    below, members but one times words of the last turn; ``ends_sha256`` digests the ids of members with no further turn.

    Turns go by ``turn``, null first, ones with equal ``turn`` by a hash of role and text; repeated rows are turns of their own.
    Null roles and texts are empty. Rows with a null ``conv_id`` belong to no conversation and add nothing. An empty table has
    no node.

    Sums below a node need no walk of the trie: each node belongs to its smallest member, so a node's sum is that of its members'
    nodes, less those above it. Nothing is gathered by conversation or node: long conversations and common prefixes are split.
    """
    rebuild = rebuild or Rebuild()
    classes = turn_classes(conversations, hashes)
    for seed in range(TRIES):
        factors = Factors(seed, moduli)
        prefixes = _prefixes(classes, factors)
        headers = written(_headers(prefixes, rebuild, factors), "headers")
        members = written(_members(prefixes, headers, factors), "members")
        nodes = written(_nodes(members), "nodes")
        if nodes.filter("NOT same").isEmpty():
            return _described(members, nodes, headers, factors)
    raise RuntimeError(f"{TRIES} sets of factors each give two prefixes one fingerprint")


def _described(members: DataFrame, nodes: DataFrame, headers: DataFrame, factors: Factors) -> DataFrame:
    below = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    below = below.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(below, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved = F.sum(F.expr("(n_convs - 1) * n_words")).alias("saved")
    totals = nodes.groupBy("conv_id").agg(saved, F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"))
    sums = members.select("conv_id", *KEY).join(totals, "conv_id", "left").groupBy(*KEY)
    sums = sums.agg(F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("n_leaves"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, KEY, "left").join(_above(nodes), KEY, "left").join(_ends(headers, factors), KEY, "left")
    found = found.join(parents, ["depth", "pa", "pb"], "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.when(F.col("n_convs") > 1, F.col("saved") - F.col("above")).otherwise(0).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
