"""Near copies in large tables: candidates stay few, texts stay where they lie."""

import random

import brute
import numpy as np
import pytest

from tideledger.llm import ngram_join

SCHEMA = "doc_id long, text string, lang string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "en") for row in rows], SCHEMA)


@pytest.mark.parametrize("rows", [10**5, 10**7, 10**14])
def test_sets_with_a_common_passage_are_no_candidates(rows):
    """Whatever way to index a large table gets, sets that share a third of their elements share no more than they can spare."""
    similarity, rng = ngram_join.Similarity(5, 4, 5), np.random.default_rng(3)
    assert rows == 10**5 or any(band.pieces != 1 for band in ngram_join.bands(similarity, rows, 512))
    for size in (150, 300, 450):
        passage = rng.integers(0, 1 << 62, size // 3, dtype=np.uint64)
        one, two = (np.unique(np.append(passage, rng.integers(0, 1 << 62, size - size // 3, dtype=np.uint64))) for _ in range(2))
        with np.errstate(over="ignore"):
            (keys, kinds), (others, _) = (ngram_join.signatures(own, similarity, rows) for own in (one, two))
        for kind in np.unique(kinds).tolist():
            assert len(np.intersect1d(keys[kinds == kind], others)) <= kind & 0xFFFFFFFF


def test_turns_share_the_signatures():
    similarity, text = ngram_join.Similarity(), " ".join(f"w{n}" for n in range(90))
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1]), pa.array([text])], names=["doc_id", "text"])

    def given(*turn):
        return [key for out in ngram_join._index(similarity, 10, *turn)(iter([batch])) for key in out.column("signature").to_pylist()]

    assert sorted(given(0, 2) + given(1, 2)) == sorted(given()) and given(0, 2) and given(1, 2)


def test_texts_stay_where_they_lie(spark):
    """Only rows of ids that go or come again are shuffled; all others come out as they were."""
    rng = random.Random(2)
    base = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join([*base[:-1], f"v{n}"]) if n % 50 == 0 else " ".join(f"x{rng.randrange(10**6)}" for _ in range(40))) for n in range(400)]
    rows += [(None, "one two three"), (None, None), (700, ""), (701, rows[1][1]), (2, "another text of a known id")]
    left = ngram_join.drop_near_copies(table(spark, rows))
    groups = brute.near_copies([row for row in rows[:400]], 5, 4, 5)
    expected = [row for row in rows[:400] if groups[row[0]][1] == row[0]] + [(None, "one two three"), (None, None), (700, ""), (2, "another text of a known id")]
    assert sorted(map(str, ((row.doc_id, row.text) for row in left.collect()))) == sorted(map(str, expected))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "strategy=broadcast" in plan
    marked, stay = ngram_join.marked_rows(table(spark, rows), table(spark, rows).filter("doc_id = 2 OR doc_id IS NULL").select("doc_id"))
    assert marked.count() == 4 and stay.count() == len(rows) - 4
