"""Stages decide by row: null ids, ids that repeat with other texts, equal rows, both row orders."""

import random

import pytest
from pyspark.sql import functions as F

from tideledger.llm import decontaminate, ngram_join, quality

SCHEMA = "doc_id long, text string, row int, one string, n_shingles double, `first` string"
ITEM = "The seven bridges of the old town cross the river at places that no map has ever shown quite right."


def prose(seed, words=60):
    some = random.Random(seed)
    return " ".join("".join(some.choices("abcdefghij", k=6)) for _ in range(words))


def table(spark, rows):
    return spark.createDataFrame([(*row, place, "x", 0.5, None) for place, row in enumerate(rows)], SCHEMA).repartition(3)


def left(df):
    assert df.columns == ["doc_id", "text", "row", "one", "n_shingles", "first"]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("step", [1, -1])
def test_contaminated_rows_go_and_others_stay(spark, step):
    held = f"{prose(1, 20)} {ITEM} {prose(2, 20)}"
    rows = [(None, held), (None, prose(3)), (None, prose(4)), (7, held), (7, prose(5)), (8, prose(6)), (9, None), (9, "")]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    clean = [row for row in rows if row[1] != held]
    assert left(decontaminate.drop_contaminated(table(spark, rows[::step]), items)) == sorted(clean, key=repr)


@pytest.mark.parametrize("step", [1, -1])
def test_rejected_rows_go_and_others_stay(spark, step):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = {r.doc_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    rows = [tuple(r) for r in docs.collect()]
    good = [text for key, text in rows if scored[key]][:40]
    bad = [text for key, text in rows if not scored[key]][:10]
    assert good and bad
    # the labelled rows train the same model; these rows have ids without labels
    odd = [(None, text) for text in good[:20] + bad] + [(10**9, text) for text in good + bad] + [(None, good[0])]
    kept = quality.keep_good(table(spark, [*rows, *odd][::step]), labels).filter(F.coalesce("doc_id", F.lit(10**9)) == 10**9)
    expected = [row for row in odd if row[1] not in set(bad)]
    assert left(kept) == sorted(expected, key=repr)


def test_training_ignores_the_order_and_number_of_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(key, prose(key)) for key, _ in rows[:40]] + rows[:30]
    schema = "doc_id long, text string"
    one = quality.train(spark.createDataFrame(rows, schema), labels)
    two = quality.train(spark.createDataFrame(rows[::-1] + rows[:50], schema).repartition(5), labels)
    texts = [text.encode() for _, text in rows[:60]]
    assert abs(one.score(texts) - two.score(texts)).max() == 0


@pytest.mark.parametrize("step", [1, -1])
def test_one_row_of_each_group_of_near_copies(spark, step):
    first, second, third = prose(11, 200), prose(12, 200), prose(13, 200)
    near = lambda text: text + " one more word"
    rows = [
        # near copies without ids; equal rows; one id in two groups
        (None, first), (None, near(first)), (None, first), (5, prose(14)), (5, prose(14)),
        (2, second), (3, near(second)), (3, third), (4, near(third)), (6, near(third) + " x"), (None, third),
        # no words: linked with nothing
        (None, None), (None, ""), (8, " \n"), (8, " \n"),
    ]
    kept = left(ngram_join.drop_near_copies(table(spark, rows[::step])))
    lone = [(None, None), (None, ""), (8, " \n"), (8, " \n")]
    assert [row for row in kept if row in lone] == sorted(lone, key=repr)
    others = [row for row in kept if row not in lone]
    assert len(others) == 4
    assert (2, second) in others and (3, third) in others and (5, prose(14)) in others
    assert sum(key is None and text in (first, near(first)) for key, text in others) == 1


def test_thousands_of_null_ids(spark):
    texts = [prose(n, 30) for n in range(700)]
    rows = [(None, text) for text in texts + [f"{text} and" for text in texts[:300]] + texts[:200]]
    kept = left(ngram_join.drop_near_copies(table(spark, rows)))
    assert len(kept) == 700 and all(key is None for key, _ in kept)
