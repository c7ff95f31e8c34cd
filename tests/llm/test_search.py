"""Ranked lexical search against a plain version in whole numbers."""

import math
import random
import re
from collections import Counter

import pytest

from tideledger.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, item long, score long, rank int, salt int, block int, term string"


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    held = [(doc, Counter(plain_terms(text))) for doc, text in docs]
    n_docs = sum(1 for _, count in held if count)
    n_terms = sum(sum(count.values()) for _, count in held)
    df = Counter(term for _, count in held for term in count)
    texts = {}
    for item, text in items:
        texts.setdefault(item, set()).add(text or "")
    out = []
    for item, bodies in texts.items():
        asked = Counter(term for body in bodies for term in plain_terms(body))
        scores = []
        for doc, count in held:
            n = sum(count.values())
            score = 0
            for term, times in asked.items():
                if count[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 25 + (75 * n * n_docs) // n_terms
                    score += times * w * ((1000000000 * count[term]) // (1000 * count[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(*row, 1, 2, 3, 4, 5, "x") for row in docs], SCHEMA),
        spark.createDataFrame([(*row, 1, 2) for row in items], "item_id long, text string, doc_id long, rank int"),
    )


def found(spark, docs, items, **more):
    result = lexical_search.best_documents(*tables(spark, docs, items), **more)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, result.collect()), key=repr)


def invented(seed, n_docs=150, n_items=20):
    some = random.Random(seed)
    words = [f"w{n}" for n in range(40)] + ["Été", "你好", "x1", "A", "a"]

    def text(most):
        return some.choice([" ", ",", "\0", "_"]).join(some.choices(words, k=some.randint(0, most)))

    docs = [(n, text(30)) for n in range(n_docs)]
    # copies tie with their originals
    docs += [(1000 + n, docs[some.randrange(n_docs)][1]) for n in range(40)]
    return docs, [(n, text(12)) for n in range(n_items)]


ODD_DOCS = [
    (None, "alpha beta"), (None, "alpha beta"), (None, None), (3, "alpha beta"), (3, "alpha"), (3, "alpha beta"), (4, ""), (5, " ,. "),
    (6, "ALPHA alpha\talpha"), (7, "beta " * 50_000 + "rare"), (8, "K kelvin K"), (9, "alpha-beta_gamma"), (2**62, "gamma delta"),
]
ODD_ITEMS = [
    (None, "alpha"), (None, "beta"), (1, "alpha alpha beta"), (1, "alpha alpha beta"), (2, None), (3, ""), (4, "nowhere"), (5, "rare"),
    (6, "k K"), (7, "Gamma delta"), (8, "beta " * 3000),
]


def test_odd_rows(spark):
    assert found(spark, ODD_DOCS, ODD_ITEMS) == plain(ODD_DOCS, ODD_ITEMS)
    assert found(spark, ODD_DOCS, ODD_ITEMS, k=1) == plain(ODD_DOCS, ODD_ITEMS, k=1)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed):
    docs, items = invented(seed)
    assert found(spark, docs, items) == plain(docs, items)


def test_small_tiles(spark, monkeypatch):
    docs, items = invented(3)
    # blocks, tiles and groups are taken apart here, so that workers see the same sizes
    asked = lexical_search.Block([(item, [text]) for item, text in items])
    counts = Counter(term for _, text in docs for term in set(plain_terms(text)))
    held = [len(plain_terms(text)) for _, text in docs]
    df = {place: counts[term.decode()] for term, place in asked.vocabulary.items() if counts[term.decode()]}
    for n_items, n_terms, exact in ((256, 2048, 1 << 53), (7, 5, 1 << 53), (3, 4, 7000 * 10**6), (256, 2048, 1200 * 10**6)):
        monkeypatch.setattr(lexical_search, "ITEMS", n_items)
        monkeypatch.setattr(lexical_search, "TERMS", n_terms)
        monkeypatch.setattr(lexical_search, "EXACT", exact)
        asked.tiles = []
        asked.weigh(sum(n > 0 for n in held), sum(held), df)
        for tile in asked.tiles:
            assert tile.weights.shape[1] <= n_terms
            assert (tile.weights.sum(axis=1) * 10**6 < exact).all()
        best = lexical_search.Best(10, len(items))
        for low in range(0, len(docs), 13):
            part = docs[low : low + 13]
            for own, scores in lexical_search._scores(asked, [text for _, text in part]):
                ids = lexical_search.np.array([doc for doc, _ in part])
                best.add(own, scores, ids, ids * 0)
        got = {(items[item][0], doc, score) for item, score, doc, _ in best.found.T.tolist()}
        assert got == {(item, doc, score) for item, _, doc, score in plain(docs, items)}


def test_blocks_of_items(spark, monkeypatch):
    docs, items = invented(4)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 300)
    assert found(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = invented(5, 3, 3)
    assert found(spark, [], items) == [] == found(spark, docs, [])
    assert found(spark, [(1, None), (2, " ")], items) == []
