"""Exact dedup, suffix dedup and the n-gram join against plain versions, with odd rows."""

import random

import brute
import duckdb
import pytest

from tideledger.llm import exact_dedup, ngram_join, suffix_dedup
from tideledger.llm.components import components
from tideledger.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, lang string, hash string, size int, rep long, signature long, keep_id long"
EXTRA = ("en", "h", 1, 2, 3, 4)


def table(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA)


def sample():
    path = "/root/testdata/sf0.001/documents.parquet"
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{path}'").fetchall()


def test_exact_copies(spark):
    rows = [(5, "a b"), (3, "ab"), (9, " a  b "), (4, "ba"), (7, None), (8, " \t"), (2, " ab"), (6, "ab"), (None, "a\nb"), (4, "ba")]
    found = exact_dedup.exact_copies(table(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found if row.doc_id != 4}
    assert {key: by_id[key].keep_id for key in (5, 3, 9, 6, None)} == dict.fromkeys((5, 3, 9, 6, None), 9)
    assert by_id[9].kept and not by_id[5].kept and by_id[9].group_size == 5
    # the blank text of two characters stays before the null one
    assert by_id[7].keep_id == by_id[8].keep_id == 8
    assert by_id[2].keep_id == 2
    # one of two equal rows stays
    assert sorted(row.kept for row in found if row.doc_id == 4) == [False, True]


def test_exact_collisions(spark, monkeypatch):
    """Different texts under one hash are told apart by their bytes."""
    from pyspark.sql import functions as F

    hashed = exact_dedup._hashed
    monkeypatch.setattr(exact_dedup, "_hashed", lambda docs: hashed(docs).withColumn("hash", F.unhex(F.lit("00"))))
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, "b"), (5, "c")]
    found = {row.doc_id: (row.keep_id, row.group_size) for row in exact_dedup.exact_copies(table(spark, rows)).collect()}
    assert found == {1: (3, 2), 3: (3, 2), 2: (2, 2), 4: (2, 2), 5: (5, 1)}


def test_drop_copies(spark):
    rows = [(1, "x y"), (2, "xy"), (3, "z"), (3, "z"), (None, "w"), (4, None)]
    left = exact_dedup.drop_copies(table(spark, rows))
    assert left.columns == table(spark, rows).columns
    assert sorted((row.doc_id or 0, row.text or "") for row in left.collect()) == [(0, "w"), (1, "x y"), (3, "z"), (4, "")]


def test_drop_copies_by_text(spark):
    """Every text keeps its longest row, where ids are null or repeated as well."""
    rows = [(None, "a b"), (None, "c"), (None, "ab"), (7, "d"), (7, "e"), (7, "e "), (7, "  e"), (7, "  e"), (8, "d"), (9, "c")]
    for order in (rows, rows[::-1]):
        left = exact_dedup.drop_copies(table(spark, order)).collect()
        assert sorted((row.doc_id or 0, row.text) for row in left) == [(0, "a b"), (7, "  e"), (7, "d"), (9, "c")]


def test_collisions_under_one_id(spark, monkeypatch):
    """Different texts under one hash and one id, null too, are all kept."""
    from pyspark.sql import functions as F

    hashed = exact_dedup._hashed
    monkeypatch.setattr(exact_dedup, "_hashed", lambda docs: hashed(docs).withColumn("hash", F.unhex(F.lit("00"))))
    left = exact_dedup.drop_copies(table(spark, [(1, "a"), (1, "b"), (None, "c"), (None, "d"), (None, "c")])).collect()
    assert sorted((row.doc_id or 0, row.text) for row in left) == [(0, "c"), (0, "d"), (1, "a"), (1, "b")]


def test_empty_tables(spark):
    empty = table(spark, [])
    assert exact_dedup.exact_copies(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert ngram_join.near_copies(empty).count() == 0
    assert ngram_join.drop_near_copies(empty).columns == empty.columns


def pasted(seed):
    """Texts put together from shared blocks of few letters."""
    rng = random.Random(seed)
    blocks = ["".join(rng.choice("ab ") for _ in range(rng.choice([30, 60, 130]))) for _ in range(12)]

    def part():
        if rng.random() < 0.7:
            return rng.choice(blocks)[rng.randrange(20) :]
        return "".join(rng.choice("abcdef é") for _ in range(rng.randrange(60)))

    rows = [(key, "".join(part() for _ in range(rng.randrange(6)))) for key in range(120)]
    return rows + [(900, None), (901, ""), (902, "a" * 400), (903, "a" * 70), (904, "xy" * 100), (905, "yx" * 60), (906, rows[3][1]), (907, "Is on. " * 90 + "b" + "Is on. " * 40)]


@pytest.mark.parametrize("crowded", [50_000, 4])
def test_suffix_dedup(spark, monkeypatch, crowded):
    rows = pasted(3)
    found = suffix_dedup.remove_repeats(table(spark, rows))
    if crowded == 4:
        # workers import the module anew, so the path for crowded anchors is run here
        found = None
    expected = brute.suffix_dedup(rows)
    if found is not None:
        got = {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) for row in found.collect()}
        assert got == expected
        return
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "AT_A_TIME", 8)
    assert local_suffix_dedup(rows) == {key: value[1] for key, value in expected.items()}


def local_suffix_dedup(rows):
    """Removed bytes by document, from the same steps without Spark."""
    import numpy as np
    import pyarrow as pa

    bodies = [(text or "").encode() for _, text in rows]
    with np.errstate(over="ignore"):
        owner, places, keys = suffix_dedup.anchors(bodies)
    reach, length = suffix_dedup.REACH, suffix_dedup.LENGTH
    records = sorted(
        (int(key.view(np.int64)), min(int(place), reach), bodies[row][max(0, place - reach) : place + length], rows[row][0], int(place) << 16)
        for row, place, key in zip(owner, places, keys, strict=True)
    )
    columns = [*zip(*records, strict=True), [None] * len(records), [0] * len(records)]
    kinds = [("key", pa.int64()), ("before", pa.int32()), ("body", pa.binary()), ("doc_id", pa.int64()), ("place", pa.int64()), ("more", pa.list_(pa.int64())), ("sub", pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])
    parts = [batch.slice(low, 5) for low in range(0, len(batch), 5)]
    spans, strings = [], []
    for out in suffix_dedup._matched(iter(parts)):
        for row in out.to_pylist():
            (spans if row["string"] is None else strings).append(row)
    least = {}
    for row in strings:
        least[row["string"]] = min(row["doc_id"], least.get(row["string"], row["doc_id"]))
    assert strings
    spans += [row for row in strings if row["doc_id"] > least[row["string"]]]
    gone = {key: set() for key, _ in rows}
    for row in spans:
        gone[row["doc_id"]].update(range(row["place"] >> 16, (row["place"] >> 16) + row["size"]))
    return {key: len(value) for key, value in gone.items()}


def test_suffix_dedup_documents(spark):
    rows = sample()
    found = suffix_dedup.remove_repeats(table(spark, rows)).collect()
    got = {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) for row in found}
    assert got == brute.suffix_dedup(rows)


def test_suffix_dedup_ids(spark):
    """Rows that repeat an id and null ids don't judge each other; null ids come last."""
    long = "the quick brown fox jumps over the lazy dog and runs away from here"
    found = suffix_dedup.remove_repeats(table(spark, [(1, long), (1, long), (None, long), (None, "x" + long[1:])])).collect()
    assert sorted((row.doc_id or 99, row.n_removed) for row in found) == [(1, 0), (1, 0), (99, len(long) - 1), (99, len(long))]
    assert {row.kept for row in found if row.doc_id is None} == {"x", ""}


@pytest.mark.parametrize("step", [1, -1])
def test_suffix_dedup_of_many_rows_without_ids(spark, step):
    """Each row loses what smaller ids hold, and only that; rows of one id, or without one, don't judge each other."""
    some = random.Random(5)
    text = lambda n: "".join(some.choices("abcdefgh ", k=n))
    shared = [text(120) for _ in range(3)]
    rows = [(1, shared[0] + text(80)), (1, text(200)), (2, shared[1]), (2, shared[2] + shared[2]), (2**63 - 1, text(70))]
    rows += [(None, text(100) + (some.choice(shared) if n % 3 else "") + text(100)) for n in range(2000)]
    rows += [(None, rows[6][1]), (None, shared[1]), (3, rows[9][1][:150]), (3, rows[9][1][60:])]
    expected = []
    for key, body in rows:
        smaller = {t[i : i + 50] for k, t in rows if k is not None and (key is None or k < key) for i in range(len(t) - 49)}
        gone = set()
        for i in range(len(body) - 49):
            if body[i : i + 50] in smaller:
                gone.update(range(i, i + 50))
        expected.append((key, "".join(c for i, c in enumerate(body) if i not in gone)))
    found = suffix_dedup.remove_repeats(table(spark, rows[::step])).collect()
    assert sorted(((row.doc_id, row.kept) for row in found), key=repr) == sorted(expected, key=repr)


def test_sorted_suffixes():
    import numpy as np

    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 12)).astype(np.uint8)
    groups = np.sort(rng.integers(0, 9, 300))
    groups = np.unique(groups, return_inverse=True)[1]
    with np.errstate(over="ignore"):
        order, common = suffix_dedup.sorted_suffixes(rows, groups)
    assert [(groups[row], rows[row].tobytes()) for row in order] == sorted((groups[row], rows[row].tobytes()) for row in range(300))
    for place in range(1, 300):
        one, two = order[place - 1], order[place]
        same = rows[one] == rows[two]
        expected = 0 if groups[one] != groups[two] else (12 if same.all() else int(np.argmin(same)))
        assert common[place] == expected


@pytest.mark.parametrize("numbers", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_near_copies(spark, numbers):
    rng = random.Random(1)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.choice([2, 5, 14, 40, 120]))] for _ in range(14)]
    rows = [(1000, None), (1001, " \n"), (1002, "Hello"), (1003, "hello"), (1004, "a b"), (1005, "A  b")]
    for key in range(150):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            own[rng.randrange(len(own))] = rng.choice(["new", "old", "odd", "x"])
        rows.append((key, " ".join(own)))
    found = ngram_join.near_copies(table(spark, rows), ngram_join.Similarity(*numbers)).collect()
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found} == brute.near_copies(rows, *numbers)


def test_near_copies_of_one_text(spark, monkeypatch):
    """One group of many variants: links between any two of them count, not only those with the first."""
    rng = random.Random(4)
    base = [f"w{number}" for number in range(80)]
    rows = []
    for key in range(260):
        own = list(base)
        for _ in range(rng.randrange(9)):
            own[rng.randrange(80)] = f"v{rng.randrange(1000)}"
        rows.append((key, " ".join(own)))
    similarity = ngram_join.Similarity(3, 9, 10)
    found = ngram_join.near_copies(table(spark, rows), similarity).collect()
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found} == brute.near_copies(rows, 3, 9, 10)


def test_near_copies_of_odd_ids(spark):
    """Texts under null ids and under ids that other texts have too are linked as any others."""
    rng = random.Random(7)
    rows, expected = [], []
    for number in range(12):
        base = [f"w{number}x{place}" for place in range(60)]

        def variant(base=base):
            return " ".join([*base[:-1], f"v{rng.randrange(10**9)}"])

        one, two, three, other = variant(), variant(), variant(), f"other text number {number}"
        low, high = 1000 + number, 2000 + number
        # a null id beside a real one; null ids alone; an id of two texts, of which another row stands for one
        rows += ([(None, one), (high, two)], [(None, one), (None, two)], [(low, other), (high, other), (high, one), (high + 1000, two), (None, three)])[number % 3]
        expected += ([(0, high), (high, high)], [(0, 0), (0, 0)], [(low, low), (high, low), (high, high), (high + 1000, high), (0, high)])[number % 3]
    for order in (rows, rows[::-1]):
        found = ngram_join.near_copies(table(spark, order), ngram_join.Similarity(3, 9, 10)).collect()
        assert sorted((row.doc_id or 0, row.component_id or 0) for row in found) == sorted(expected)


@pytest.mark.parametrize("rows", [1, 10**6, 10**14])
@pytest.mark.parametrize("numbers", [(3, 9, 10), (5, 4, 5), (3, 1, 2)])
def test_signatures_meet(rows, numbers):
    """Two linked sets share a signature, whatever choice the cost model makes."""
    import numpy as np

    similarity, rng = ngram_join.Similarity(*numbers), np.random.default_rng(8)
    for size in (1, 2, 3, 5, 8, 13, 21, 55, 144, 400):
        for _ in range(20):
            own = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
            other = own
            while True:
                smaller = other[1:] if rng.random() < 0.5 else np.unique(np.append(other, rng.integers(0, 1 << 62, dtype=np.uint64)))
                common = len(np.intersect1d(own, smaller))
                if not len(smaller) or not similarity.linked(common, len(own), len(smaller)):
                    break
                other = smaller
            with np.errstate(over="ignore"):
                one, two = (ngram_join.signatures(x, similarity, rows) for x in (own, other))
                assert len(np.intersect1d(one[0], two[0]))
                # each shares more signatures with the other, in one of its bands, than it can spare there
                both, left = set(np.intersect1d(one[0], two[0]).tolist()), []
                for keys, kinds in (one, two):
                    rest = [set(keys[kinds == kind].tolist()) & both for kind in np.unique(kinds).tolist()]
                    left.append({key for own, kind in zip(rest, np.unique(kinds).tolist(), strict=True) if len(own) > kind & 0xFFFFFFFF for key in own})
                assert left[0] & left[1]


def test_shingle_sets():
    texts = [text for _, text in sample()] + ["", "A b", "Ä b c", "x" * 3_000_000, "a b c " * 50_000]
    sets = shingle_sets([text.encode() for text in texts], 3)
    assert [len(own) for own in sets] == [len(brute.shingles(text, 3)) for text in texts]
    assert (shingle_sets([b"A b  c\td"], 3)[0] == shingle_sets([b"a B c D"], 3)[0]).all()


def test_components(spark):
    links = [(key, key + 1) for key in range(100, 160)] + [(5, 9), (9, 5), (7, 9)] + [(300, key) for key in range(301, 340)]
    found = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[key] for key in range(100, 161)} == {100}
    assert found[9] == found[7] == 5 and {found[key] for key in range(300, 340)} == {300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
