"""Decontamination, quality, personal data and licenses against plain versions and held-out labels."""

import hashlib
import random
import zlib

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tideledger.llm import decontaminate, licenses, pii, quality

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, spans string, item_id long, kept boolean"


def table(spark, rows):
    return spark.createDataFrame([(*row, 0.5, "s", 7, True) for row in rows], SCHEMA)


def fetched(sql):
    return duckdb.connect().execute(sql).fetchall()


def test_decontamination(spark):
    docs = fetched(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'")
    items = fetched(f"SELECT item_id, text FROM '{DATA}/benchmark.parquet'")
    planted = {(key, item) for key, text in docs for item, body in items if body in text}
    benchmark = spark.createDataFrame(items + [(None, None), (500, ""), (501, "abc"), items[0]], "item_id long, text string")
    found = decontaminate.contaminated(table(spark, docs), benchmark).collect()
    texts, bodies = dict(docs), dict(items)
    got = {(row.doc_id, row.item_id): row.edits for row in found}
    assert planted <= set(got)
    for (key, item), n in got.items():
        body = decontaminate.normalised(bodies[item])
        assert n <= 0.2 * len(body)
        assert n == brute.edits(body, decontaminate.normalised(texts[key])) or (key, item) not in planted


def test_decontamination_with_edits(spark):
    """Every passage with up to a twentieth of its letters changed is found, in whatever surroundings."""
    items = fetched(f"SELECT item_id, text FROM '{DATA}/benchmark.parquet'")
    clean = [text for _, text in fetched(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' ORDER BY doc_id LIMIT 40")]
    rng = random.Random(2)
    docs, planted = [], set()
    for key, (item, body) in enumerate(items * 3):
        letters = list(body)
        for _ in range(len(body) // 20):
            place = rng.randrange(len(letters))
            letters[place : place + 1] = rng.choice([[], ["q"], [letters[place], "z"]])
        around = clean[key % 40][:200]
        docs.append((key, f"{around} {''.join(letters).upper()}\n{around}"))
        planted.add((key, item))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(row.doc_id, row.item_id) for row in decontaminate.contaminated(table(spark, docs), benchmark).collect()}
    assert len(planted & found) >= 0.97 * len(planted)


def edited(rng, body, n, letters):
    """``body`` after ``n`` edits at random places."""
    own = list(body)
    for _ in range(n):
        place = rng.randrange(len(own))
        own[place : place + 1] = rng.choice([[], [rng.choice(letters)], [own[place], rng.choice(letters)]])
    return "".join(own)


@pytest.mark.parametrize("size", [10, 24, 47, 100, 233, 390])
def test_decontamination_recall(spark, size):
    """At 10, 15 and 20 % edits by item length: the documents, items and edits of brute force, all of them."""
    rng = random.Random(size)
    letters = "etaoinsh rdlu"
    items = [(key, "".join(rng.choice(letters) for _ in range(size)).replace(" ", "x", 1).strip()) for key in range(8)]
    docs = []
    for key, (_, body) in enumerate(items * 6):
        around = "".join(rng.choice(letters) for _ in range(150))
        docs.append((key, around + edited(rng, body, int((0.1, 0.15, 0.2)[key // 16] * len(body)), letters) + around[::-1]))
    expected = {}
    for key, text in docs:
        for item, body in items:
            own = decontaminate.normalised(body)
            n = decontaminate.least_edits(own, decontaminate.normalised(text))
            if n <= int(0.2 * len(own)):
                expected[key, item] = n
    assert len(expected) >= 40
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(table(spark, docs), benchmark).collect()
    assert {(row.doc_id, row.item_id): row.edits for row in found} == expected


def test_decontamination_without_blanks(spark):
    """Passages inside text without blanks are found, whole or with letters of several bytes added or lost."""
    rng = random.Random(5)
    letters = [chr(0x4E00 + place) for place in range(600)] + list("ぁあぃいぅうぇえกขฃคฅฆ\U00020000")
    items = [(key, "".join(rng.choice(letters) for _ in range(10 + 15 * key))) for key in range(8)]
    docs, expected = [], {}
    for key, (item, body) in enumerate(items * 4):
        own, limit = list(body), int(0.2 * len(body))
        for _ in range((0, limit, limit, limit)[key // 8]):
            place = rng.randrange(len(own))
            own[place : place + 1] = ([], [own[place], "字"], ["a"])[key // 8 - 1]
        text = "".join(rng.choice(letters) for _ in range(400)) + "".join(own) + "".join(rng.choice(letters) for _ in range(90))
        docs.append((key, text))
        expected[key, item] = brute.edits(body, text)
        assert expected[key, item] <= limit
    found = decontaminate.contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(row.doc_id, row.item_id): row.edits for row in found} == expected


def test_decontamination_of_odd_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, [(1, None), (2, ""), (None, "This passage is in the benchmark, word for word."), (3, "clean"), (3, "clean")])
    assert decontaminate.contaminated(docs, none).count() == 0
    items = spark.createDataFrame([(1, "this passage is  in the benchmark, word for word.")], "item_id long, text string")
    assert [(row.doc_id, row.item_id, row.edits) for row in decontaminate.contaminated(docs, items).collect()] == [(None, 1, 0)]
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(row.doc_id for row in left.collect()) == [1, 2, 3, 3]
    assert decontaminate.contaminated(table(spark, []), items).count() == 0


def test_decontamination_by_short_items(spark):
    """Items of any length are searched, shortest ones as they are, and a null item id isn't 0."""
    items = [(0, "this one is in the text"), (None, "another one that is there"), (1, "北京"), (2, "Qz7"), (3, "walrus"), (4, " "), (5, "京北")]
    docs = [(1, "so THIS one is in the text"), (2, "and another one that is there."), (3, "我住在北京的北边"), (4, "aQz7b"), (5, "a walris"), (6, "Qz 7 walls")]
    found = decontaminate.contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(1, 0, 0), (2, None, 0), (3, 1, 0), (4, 2, 0), (5, 3, 1)}
    assert {(row.doc_id, row.item_id, row.edits) for row in found} == expected


def test_benchmark_blocks(spark, monkeypatch):
    items = fetched(f"SELECT item_id, text FROM '{DATA}/benchmark.parquet'")
    docs = [(key, f"before {body} after") for key, body in items]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2_000)
    found = decontaminate.contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(key, key) for key, _ in items} <= {(row.doc_id, row.item_id) for row in found}


def test_least_edits():
    rng = random.Random(3)
    for _ in range(200):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 90)))
        assert decontaminate.least_edits(item, text) == brute.edits(item, text)


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels, bound=1500)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    good = [row.predicted for row in rows if row.quality == 1]
    bad = [row.predicted for row in rows if row.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_quality_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "A short clean text."), (3, "A short clean text."), (None, "x"), (4, "word " * 60_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(table(spark, rows), none).collect()
    assert len(found) == len(rows) and all(row.score == 1 and row.predicted == 1 for row in found)
    labels = [(1, 0, 0), (3, 1, 0), (3, None, 0), (None, 1, 0), (4, 0, 0), (5, 1, 0), (6, 0, None)]
    own = quality.quality_scores(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(own) == len(rows) and all(0 <= row.score <= 1 for row in own)
    assert len({row.score for row in own if row.doc_id in (1, 2)}) == 1
    left = quality.keep_good(table(spark, rows), none)
    assert left.columns == table(spark, []).columns and left.count() == len(rows)
    assert quality.quality_scores(table(spark, []), none).count() == 0


def test_attention_gradient():
    """The gradient agrees with small differences of the loss."""
    rng = np.random.default_rng(0)
    model = quality.Attention()
    x, first = rng.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5])
    label, share = np.array([1.0, 0.0, 1.0]), np.array([0.5, 0.2, 0.3])

    def loss():
        y = model._forward(x, first)["y"]
        return -(share * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum()

    gradient = model._gradient(x, first, label, share)
    for name in "wbvuacd":
        place = tuple(0 for _ in model.p[name].shape)
        old = model.p[name].copy()
        values = []
        for step in (1e-5, -1e-5):
            model.p[name] = old.copy()
            model.p[name][place] += step
            values.append(loss())
        model.p[name] = old
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(float(np.asarray(gradient[name])[place]), abs=1e-6)


def test_held_out(spark):
    rows = spark.range(200).select("id", quality.held_out(F.col("id")).alias("held")).collect()
    assert all(row.held == (zlib.crc32(str(row.id).encode()) % 4 == 2) for row in rows)


PII_TEXTS = [
    None, "", "a@b", "x.y@z.com,u@v.w.x@q.r", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.0255", "4111 1111-1111 1111",
    "41111111111111111111111", "4111  1111 1111 1111", "+1 (705) 555-5569 +12 +1-234 5678901234567890", "+12345678", "++49 30 901820",
    "mail: jo@ex-am.org.\nip 10.0.0.1 \U0001f600 after 8.8.8.8", "call (705) 555-5569 now", "9" * 5000, "a." * 4000 + "@b" + ".c" * 4000,
    "jo (at) example (dot) com", "4111111111111112", "1,2," * 3000, "١٢ x@é.com",
]


def test_personal_data(spark):
    docs = fetched(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'")
    rows = docs + [(5000 + place, text) for place, text in enumerate(PII_TEXTS)] + [(None, "a@b.cd"), (5003, PII_TEXTS[3])]
    found = pii.digests(pii.personal_data(table(spark, rows))).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    added = 0
    for row in found:
        base = brute.personal_data(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (row.doc_id, row.spans, base)
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == base.count(f"{kind}:")
        spans = row.spans.split(",")
        assert set(filter(None, base.split(","))) <= set(spans)
        added += len(set(spans) - set(base.split(",")) - {""})
    # what the votes add is little: the base patterns are strict
    assert added <= 0.05 * sum(row.n_email + row.n_ip + row.n_card + row.n_phone for row in found)


def test_personal_data_of_long_texts(spark):
    """Thousands of spans in one text, over many runs; candidates inside base spans are left out wherever they are."""
    rng = random.Random(8)
    parts = ["ann.{n}@mail{n}.example.org", "10.{m}.0.{m}", "10.{m}.999.1", "+33 6 12 34 5{m} 7", "call 555-010-{n:04d}", "4111 1111 1111 1111;", "word"]
    texts = [" ".join(rng.choice(parts).format(n=n, m=n % 10) for n in range(size)) for size in (127, 128, 129, 6000)]
    rows = list(enumerate(texts))
    found = {row.doc_id: row for row in pii.digests(pii.personal_data(table(spark, rows))).collect()}
    for key, text in rows:
        base = brute.personal_data(text)
        assert found[key].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        own = [tuple(map(int, span.split(":")[1:])) for span in base.split(",")]
        for span in set(found[key].spans.split(",")) - set(base.split(",")):
            start, end = map(int, span.split(":")[1:])
            assert not any(low < end and start < high for low, high in own)


def test_personal_data_of_empty_table(spark):
    assert pii.digests(pii.personal_data(table(spark, []))).count() == 0
    only = pii.digests(pii.personal_data(table(spark, [(1, "nothing here")]))).collect()
    assert [(row.doc_id, row.n_card, row.spans) for row in only] == [(1, 0, "")]


def test_reliabilities(spark):
    """Planted labelers: a pattern's posterior follows the votes."""
    rng = random.Random(6)
    rows = []
    for key in range(3000):
        true = rng.random() < 0.6
        votes = [(1 if (rng.random() < right) == true else -1) if rng.random() < seen else 0 for right, seen in ((0.95, 1), (0.8, 0.9), (0.7, 0.5))]
        rows.append((key, [(0, 0, 9, False, votes, ["f"])]))
    schema = "doc_id long, spans array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>,features:array<string>>>"
    truth = pii.reliabilities(spark.createDataFrame(rows, schema)).select(F.explode("truth")).collect()
    by_votes = {tuple(row.key): row.value for row in truth}
    assert by_votes[1, 1, 1] > 0.95 and by_votes[-1, -1, -1] < 0.05
    assert by_votes[1, 1, 0] > by_votes[1, -1, 0] > by_votes[-1, -1, 0]


def test_licenses(spark):
    rows = fetched(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'")
    lines = {name: bodies[0] for name, bodies in licenses.TEMPLATES.items()}
    extra = [
        "Licensed under the Apache License, Version 2.0. x Licensed under the Apache License, Version 2.0.", None, "",
        "this work is LICENSED under  the gnu general public license version 3", "released under license", "license " * 20_000,
        "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software and its associated documentation "
        'files (the "Software"), to deal in the Software without any restriction',
    ]
    rows += [(5000 + place, text) for place, text in enumerate(extra)] + [(None, lines["MIT"]), (5000, extra[0])]
    found = licenses.license_scan(table(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is not None and row.doc_id < 5000:
            text = dict(rows)[row.doc_id]
            assert set(filter(None, row.licenses.split(","))) == {name for name, line in lines.items() if line in text}
    odd = {row.doc_id: row for row in found}
    assert odd[5000].n_found == 2 and odd[5000].licenses == "Apache-2.0"
    assert odd[5001].n_found == odd[5002].n_found == odd[5004].n_found == odd[5005].n_found == 0
    assert odd[5003].licenses == "GPL-3.0" and odd[5006].licenses == "MIT" and 0.8 <= odd[5006].coverage < 1
    assert odd[None].licenses == "MIT" and odd[None].spans == "MIT:0:30"
    assert licenses.license_scan(table(spark, [])).count() == 0


def test_license_texts(spark):
    """Whole texts and headers, bare or inside other text and with small changes, are reported under their own name."""
    rows, expected = [], {}
    for name, bodies in licenses.known_templates().items():
        for body in bodies:
            own = body.split()
            changed = " ".join(word for place, word in enumerate(own) if len(own) < 60 or place % 40 != 7)
            for text in (body, f"Some words before it.\n{changed}\nand words after it"):
                expected[len(rows)] = name
                rows.append((len(rows), text))
    found = licenses.license_scan(table(spark, rows)).collect()
    assert {row.doc_id: row.licenses for row in found} == expected
    names = set(expected.values())
    assert {"GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "BSL-1.0", "Unlicense", "CC-BY-SA-4.0"} <= names


def test_alignment():
    """Pairs are equal words, rising on both sides, and no fewer than the unique words in one order."""
    rng = random.Random(9)
    for _ in range(200):
        template = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 20))]
        text = [word for word in template if rng.random() < 0.8]
        for _ in range(rng.randrange(6)):
            text.insert(rng.randrange(len(text) + 1), rng.choice("abcxyz"))
        pairs = licenses.align(text, template)
        assert all(text[one] == template[two] for one, two in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
    assert licenses.align(list("xaybzc"), list("abc")) == [(1, 0), (3, 1), (5, 2)]
    assert [4, 1, 2, 9, 3][licenses.rising([4, 1, 2, 9, 3])[0]] == 1
