"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one row of each class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideledger.llm.common import BLANKS, texts, written

# collided hashes are looked up by one of this many buckets, so what the driver sees of them is bounded
BUCKETS = 1024


def _hashed(docs: DataFrame) -> DataFrame:
    """``doc_id``, code points, the text without blanks, its 128-bit hash and its SHA-256."""
    body = texts(docs).select(
        "doc_id", F.char_length("text").alias("points"), F.regexp_replace("text", BLANKS, "").alias("body")
    )
    return body.select(
        "doc_id", "points", "body", F.unhex(F.md5("body")).alias("hash"), F.sha2("body", 256).alias("text_sha256")
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each (hash, bytes): its size and the row that stays. Copies are summed before the shuffle."""
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("last"))).alias("best")
    return rows.groupBy("hash", "body").agg(F.count("*").alias("group_size"), best)


def _placed(rows: DataFrame, classes: DataFrame, on: list[str]) -> DataFrame:
    found = classes.select(*on, "group_size", (-F.col("best.last")).alias("keep_id"))
    return rows.join(found, on).select("doc_id", "points", "keep_id", "group_size", "text_sha256", "copy")


def exact_copies(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``, any others) with the row that stands for its text.

    Texts are equal when the same bytes remain without ASCII blanks. The row with the most code points, then the smallest
    ``doc_id``, stays. A null text is empty, and all empty texts are one class. Rows that repeat a ``doc_id`` with the same
    text count in ``group_size``; one of them is kept. A null ``doc_id`` loses against any other; a class of null ids only
    has a null ``keep_id`` and keeps one row. No rows give no rows.

    The shuffle carries each text once per map task, however many copies there are. Classes are found by (hash, bytes),
    written without the bytes, and joined to the rows by hash alone. Should two texts share a hash, the rows in the
    buckets of such hashes are joined by bytes as well.
    """
    return _decided(docs).drop("points")


def _decided(docs: DataFrame) -> DataFrame:
    """``exact_copies`` with the code points of each row's text."""
    rows = _hashed(docs)
    classes = written(_classes(rows).select("hash", "group_size", "best"), "copies")
    bucket = F.pmod(F.xxhash64("hash"), F.lit(BUCKETS))
    shared = classes.groupBy("hash").agg(F.count("*").alias("texts")).filter("texts > 1")
    odd = shared.agg(F.collect_set(bucket).alias("buckets")).scalar()
    collided = (F.size(odd) > 0) & F.array_contains(odd, bucket)
    # repeats of a row are numbered, so that one of them stays
    again = W.partitionBy("doc_id", "hash").orderBy(F.desc("points"))
    numbered = rows.withColumn("copy", F.row_number().over(again))
    told_apart = W.partitionBy("doc_id", "hash", "body").orderBy(F.desc("points"))
    plain = _placed(numbered.drop("body").filter(~collided), classes.filter(~collided), ["hash"])
    other = rows.filter(collided).withColumn("copy", F.row_number().over(told_apart))
    exact = _placed(other, _classes(rows.filter(collided)), ["hash", "body"])
    return plain.unionByName(exact).select(
        "doc_id",
        "points",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    A row is known by its ``doc_id`` (null is an id too), the SHA-256 of its text without blanks and its code points, so ids
    may be null or repeat with other texts. Of rows that agree in all three one stays.
    """
    kept = _decided(docs).filter("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha256"), F.col("points").alias("__kept_points")
    )
    text = F.coalesce(docs["text"], F.lit(""))
    named = docs.withColumns(
        {
            "__id": docs["doc_id"].cast("long"),
            "__sha256": F.sha2(F.regexp_replace(text, BLANKS, ""), 256),
            "__points": F.char_length(text),
        }
    )
    same = (
        named["__id"].eqNullSafe(kept["__kept_id"])
        & (named["__sha256"] == kept["__kept_sha256"])
        & (named["__points"] == kept["__kept_points"])
    )
    own = ["__id", "__sha256", "__points"]
    return named.join(kept, same, "left_semi").dropDuplicates(own).drop(*own)
