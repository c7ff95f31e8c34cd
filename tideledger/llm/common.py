"""What the text operators share: input shape, written intermediate tables, public tokenizers."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tideledger.session import new_path

BLANKS = r"[\x20\x09-\x0D]+"
# a tokenizer file is sent to every worker; larger ones are refused
SPEC_BYTES = 64 << 20
MAP_BITS = 1 << 23
# rows with all their columns that Python holds apart from the batch they came in
ROWS_AT_ONCE = 1024
# while a table is written: its shuffle files go at the end, and Python workers get small batches
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there and Python code behind it runs once.

    Spark frees the write's shuffle files when it ends, for nothing reads them again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = {key: spark.conf.get(key) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def _place(id_: Column | str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(MAP_BITS))


def _words(ids: DataFrame) -> DataFrame:
    """The bit map of the ids of a table: ``word`` and its ``bits``, where there are any."""
    words = ids.select(_place().alias("place"))
    words = words.select(F.expr("place div 64").alias("word"), F.expr("shiftleft(1L, int(place % 64))").alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _marked(bits, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy()
            marked = ((bits.value[places >> 6] >> (places & 63)) & 1).astype(bool)
            yield batch.filter(pa.array(marked == wanted)).drop_columns(["place"])

    return run


class IdMap:
    """Which ids are in a table, as a bit map of fixed size that every task gets.

    An id of the table is always marked; others are too where the map is crowded. What a caller does with marked rows must be
    right for those as well, so the map spares shuffles but decides nothing.
    """

    def __init__(self, ids: DataFrame):
        bits = np.zeros(MAP_BITS // 64, np.int64)
        for row in _words(ids).toLocalIterator():
            bits[row.word] = row.bits
        self.sent = ids.sparkSession.sparkContext.broadcast(bits)

    def rows(self, docs: DataFrame, marked: bool) -> DataFrame:
        """The rows (``doc_id``, ``text``) whose id is marked, or those whose id isn't."""
        found = docs.select("doc_id", "text", _place().alias("place"))
        return found.mapInArrow(_marked(self.sent, marked), "doc_id long, text string")


def with_row(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, so that no names clash and a text is sent to Python once."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))


def marked_rows(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``with_row`` of the rows whose id is marked in the map of ``ids``, null ones too, and of those whose id isn't (see ``IdMap``)."""
    words = F.broadcast(written(_words(ids), "map"))
    place = _place(F.col("row.doc_id").cast("long"))
    rows = with_row(docs).withColumns({"place": place, "word": F.floor(place / 64)})
    rows = rows.join(words, "word", "left").withColumn("marked", F.expr("shiftrightunsigned(coalesce(bits, 0L), int(place % 64)) & 1"))
    return rows.filter("marked = 1").select("row"), rows.filter("marked = 0").select("row")


def row_texts(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of ``with_row``, null ones as empty."""
    rows = batch.column("row")
    return pc.fill_null(rows.flatten()[rows.type.get_field_index("text")], "")


def kept_by(docs: DataFrame, keep: Callable) -> DataFrame:
    """The rows of ``docs`` for which ``keep``, given an array of texts, is true: each row is decided where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                kept = pa.array(np.asarray(keep(row_texts(part)), bool))
                yield pa.RecordBatch.from_arrays([part.column("row").filter(kept)], names=["row"])

    return with_row(docs).mapInArrow(run, StructType([StructField("row", docs.schema)])).select("row.*")


class Encoder:
    """Token ids of one tokenizers file.

    A byte-level BPE whose merges are in id order is run by tiktoken from the same vocabulary, several times faster;
    any other file, and any text that holds a special string, goes through the tokenizers library itself.
    Both give the same ids; the tests compare them.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        parsed = json.loads(spec)
        self.special = [token["content"] for token in parsed.get("added_tokens", [])]
        self.quick = _ranked(parsed, self.special)

    def ids(self, text: str) -> np.ndarray:
        if self.quick is None or any(token in text for token in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.quick.encode_to_numpy(text, disallowed_special=())


def _ranked(parsed: dict, special: list[str]):
    """The tiktoken form of a byte-level BPE file, or None if it isn't one with the usual split."""
    import tiktoken

    model, split = parsed["model"], parsed.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
    if not plain or split.get("add_prefix_space") or parsed.get("normalizer") or model.get("ignore_merges"):
        return None
    vocab = {word: number for word, number in model["vocab"].items() if word not in special}
    merged = [vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
    if merged != sorted(merged):
        return None
    letters = byte_letters()
    ranks = {bytes(letters[letter] for letter in word): number for word, number in vocab.items()}
    # the split of byte-level BPE, a fixed value of this vocabulary
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def byte_letters() -> dict[str, int]:
    """Byte-level BPE files write a byte as a letter: printable bytes as themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(0x100 + place): byte for place, byte in enumerate(hidden)}


_LOADED: dict[int, Encoder] = {}


def loaded(spec: str) -> Encoder:
    """One encoder for each worker process and file."""
    if hash(spec) not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[hash(spec)] = Encoder(spec)
    return _LOADED[hash(spec)]


def sent_spec(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast; workers need no copy of it on their disks."""
    if os.path.getsize(path) > SPEC_BYTES:
        raise ValueError(f"{path} is larger than {SPEC_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())
