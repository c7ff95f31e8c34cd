"""The pipeline, stage by stage against plain versions, and its registration."""

import brute
import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tideledger.llm import quality

DATA = "/root/testdata/sf0.01"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram jaccard join", "benchmark decontamination", "best-fit packing"
    ]


def kept_by_each(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    schema, kept = docs.schema, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
        rows = docs.collect()
        docs = spark.createDataFrame(rows, schema)
        kept.append({row.doc_id: row.text for row in rows})
    return kept


def test_stages(spark):
    every = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    items = [row[0] for row in duckdb.connect().execute(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()]
    good, single, distinct, clean = kept_by_each(spark)
    docs, labels = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels).filter("predicted = 1").collect()
    assert set(good) == {row.doc_id for row in scored}
    best = {}
    for key, text in good.items():
        body = brute.BLANK.sub("", text)
        best[body] = min(best.get(body, (1, 0)), (-len(text), key))
    assert set(single) == {key for _, key in best.values()}
    groups = brute.near_copies(list(single.items()), 5, 4, 5)
    assert set(distinct) == {key for key, (_, group) in groups.items() if key == group}
    held = {key for key, text in distinct.items() if any(item in text for item in items)}
    assert not held & set(clean) and len(distinct) - len(clean) <= len(held) + 3
    assert all(every[key] == text for key, text in clean.items())


def test_run(spark):
    """The last stage packs what the others keep."""
    clean = kept_by_each(spark)[-1]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, DATA).collect()
    lengths = {}
    for row in rows:
        lengths[row.doc_id] = lengths.get(row.doc_id, 0) + row.length
    assert lengths == {key: len(library.encode(text, add_special_tokens=False).ids) + 1 for key, text in clean.items()}
