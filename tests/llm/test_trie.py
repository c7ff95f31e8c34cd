"""The prefix trie of rebuilt conversations against a plain version that builds every text."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tideledger.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n int, depth int, x long, a string, tie int"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns, key=lambda t: t[:2])] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 4
        # a remainder has the sign of the id, as in SQL
        base = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        rebuilt[conv] = (*own.get(base, [])[:head], *turns[head:])
    members = {}
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[kid] for kid in kids.get(path, [])) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[kid] for kid in kids.get(path, []))
    out = []
    for path, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if len(rebuilt[conv]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        row = (min(convs), len(path), parent, len(convs), len(kids.get(path, [])), leaves[path], saved[path])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, "a", 5) for row in rows], SCHEMA)


def found(spark, rows, **more):
    return sorted(map(tuple, prefix_trie.prefix_trie(table(spark, rows), **more).collect()), key=repr)


def invented(seed, n=120, words=3):
    some = random.Random(seed)
    rows = []
    for conv in range(n):
        if conv % 40 == 20:
            continue
        for turn in range(some.randint(1, 6)):
            text = " ".join(some.choices(["yes", "no", "so be it"], k=some.randint(0, words)))
            rows.append((conv, turn, some.choice(["user", "assistant"]), text))
    return rows


def odd():
    rows = [(None, 1, "user", "nobody's turn"), (None, None, None, None), (7, None, None, None), (7, 2, "user", None), (7, 1, None, "a b")]
    # repeated rows, negative and very large ids, a base that is absent, and conversations shorter than their heads
    rows += [(27, 5, "user", "same"), (27, 5, "user", "same"), (27, 5, "user", "same"), (-3, 0, "user", "x"), (-23, 1, "user", "x")]
    rows += [(2**62, 0, "user", "big"), (2**62 + 1, 0, "user", "big"), *((45 + n, 0, "user", "only") for n in range(15))]
    # long conversations, alike for a while; role and text are told apart
    rows += [(conv, turn, "user", f"turn {turn if turn < 700 else turn * conv}") for conv in (100, 120, 140) for turn in range(1500)]
    rows += [(160, 0, "user", "ab"), (180, 0, "usera", "b"), (200, 0, "", "userab"), (220, 0, "u\0", ""), (240, 0, "u", "\0")]
    return rows


def test_odd_rows(spark):
    assert found(spark, odd()) == plain(odd())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed):
    rows = invented(seed)
    assert found(spark, rows) == plain(rows)


def test_many_equal_conversations(spark):
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(0, 20_000, 20) for turn in range(2)] + [(1, 0, "user", "t0")]
    assert found(spark, rows) == plain(rows)


def test_colliding_turn_hashes(spark):
    def weak(role, text):
        return F.pmod(F.xxhash64(role, text), F.lit(5)), F.lit(0).cast("long")

    rows = invented(3, 60)
    assert found(spark, rows, hashes=weak) == plain(rows)


def test_colliding_fingerprints(spark, monkeypatch):
    """Small primes give some tries two prefixes with one fingerprint; these are seen, and another try is taken."""
    rows, tried = invented(4, 40, words=1), []
    original = prefix_trie.Factors.__init__

    def noted(self, seed, moduli):
        tried.append(seed)
        original(self, seed, moduli)

    monkeypatch.setattr(prefix_trie.Factors, "__init__", noted)
    assert found(spark, rows, moduli=(7, 5, 5, 5)) == plain(rows)
    assert len(tried) > 1
    monkeypatch.setattr(prefix_trie, "TRIES", 2)
    with pytest.raises(RuntimeError):
        found(spark, rows, moduli=(5, 5, 5, 5))


def test_scan_over_batches():
    """A conversation that goes on over batches and chunks has the sums that it has in one piece."""
    import numpy as np
    import pyarrow as pa

    factors = prefix_trie.Factors(1)
    some = np.random.default_rng(1)
    conv = np.sort(some.integers(0, 6, 400))
    x, y = some.integers(-(2**63), 2**63 - 1, (2, 400))
    names = [prefix_trie.CHUNK, "conv_id", "x", "y", "tie", "n_words"]

    def run(cuts):
        columns = [np.zeros(400, np.int32), conv, x, y, np.zeros(400, np.int32), np.ones(400, np.int64)]
        parts = [pa.RecordBatch.from_arrays([pa.array(c[a:b]) for c in columns], names=names) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.Table.from_batches(list(prefix_trie._scan(factors)(iter(parts)))).to_pydict()

    whole = run([0, 400])
    assert whole == run([0, 1, 2, 50, 50, 133, 399, 400])
    for own in np.unique(conv):
        rows = np.flatnonzero(conv == own)
        letters = [letter[rows] for letter in prefix_trie._letters(factors, x, y, np.zeros(400, np.int32))]
        for i, p in enumerate(factors.moduli):
            sums = 0
            for place, row in enumerate(rows):
                assert whole[f"e{i}"][row] == sums
                sums = (sums + int(letters[i][place]) * pow(factors.factors[i], place, p)) % p
                assert whole[f"f{i}"][row] == sums and whole["place"][row] == place + 1


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
