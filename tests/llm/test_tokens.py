"""Token counts, token files and packing against the tokenizers library."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideledger.llm import packing, token_counts, token_output
from tideledger.llm.common import loaded
from tideledger.session import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\n x", "x  y", "it's  we'll", "<|endoftext|>", "a <|endoftext|> b",
    "a\0b c", "\U0001f600 你好", "1234 56,78!! ?", "x" * 5000, "\t \t", "tab\t tab", "ab " * 3000,
]
SCHEMA = "doc_id long, text string, ids int, length int, part int, start long, block int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def rows():
    some = duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    return some + [(1000 + place, text) for place, text in enumerate(ODD)]


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4, 5) for row in rows], SCHEMA)


def test_encoder(library):
    encoder = loaded(open(PATH, encoding="utf-8").read())
    assert encoder.quick is not None
    for low in range(0, 0x30000, 97):
        text = "".join(f"a{chr(c)}1 {chr(c)}b {chr(c)}!" for c in range(low, low + 97) if not 0xD800 <= c < 0xE000)
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab '\n\t 1.,é !\x1c\x85s"), max_size=40))
def test_pieces(text):
    encoder = loaded(open(PATH, encoding="utf-8").read())
    cut = token_counts.pieces(text, encoder.special)
    whole = encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text).tolist() == whole
    if cut is not None:
        assert [n for piece in cut for n in encoder.library.encode(piece, add_special_tokens=False).ids] == whole


def test_counts(spark, library, rows):
    found = {row.doc_id: row for row in token_counts.token_counts(table(spark, rows), PATH).collect()}
    assert len(found) == len(rows)
    for key, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[key].n_bytes, found[key].n_tokens, found[key].over_limit) == (len((text or "").encode()), n, n > 1024)


def test_counts_of_other_files(spark):
    library = Tokenizer.from_file(WORDS)
    some = [(1, "Hello  World"), (2, None), (None, "x"), (1, "Hello  World")]
    found = token_counts.token_counts(table(spark, some), WORDS).collect()
    expected = [(key, len(library.encode(text or "", add_special_tokens=False).ids)) for key, text in some]
    assert sorted((row.doc_id or 0, row.n_tokens) for row in found) == sorted((key or 0, n) for key, n in expected)


def test_files(spark, library, rows):
    path = token_output.write_token_ids(table(spark, rows), PATH, new_path(spark, "ids"))
    found = {row.doc_id: row for row in token_output.token_digests(spark, path).collect()}
    start = 0
    for key, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (found[key].start, found[key].n_tokens, found[key].ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert sum(row.n_tokens for row in token_output.read_token_ids(spark, path, ["n_tokens"]).collect()) == start


def test_file_format(spark, rows):
    import glob

    path = token_output.write_token_ids(table(spark, rows), PATH, new_path(spark, "ids"))
    files = sorted(glob.glob(f"{path.removeprefix('file://').removeprefix('file:')}/part-*"))
    ends = []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        keys = pq.read_table(file, columns=["doc_id"]).column("doc_id").to_pylist()
        assert keys == sorted(keys)
        ends += [keys[0], keys[-1]] if keys else []
        for group in range(meta.num_row_groups):
            columns = {meta.row_group(group).column(n).path_in_schema: meta.row_group(group).column(n) for n in range(meta.num_columns)}
            assert all(column.has_offset_index and column.has_column_index for column in columns.values())
            assert any("DICT" in e or "DELTA" in e for name, c in columns.items() if "ids" in name for e in c.encodings)
    assert ends == sorted(ends)


def test_files_of_odd_tables(spark):
    empty = token_output.write_token_ids(table(spark, []), PATH, new_path(spark, "ids"))
    assert token_output.token_digests(spark, empty).count() == 0
    twice = token_output.write_token_ids(table(spark, [(1, "b"), (1, "b"), (None, "x")]), PATH, new_path(spark, "ids"))
    assert sorted((row.doc_id or 0, row.start) for row in token_output.token_digests(spark, twice).collect()) == [(0, 0), (1, 2), (1, 4)]


def test_packing(spark, library, rows):
    packed = packing.packed_documents(table(spark, rows), PATH).collect()
    pieces, sequences = {}, {}
    for row in packed:
        pieces.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    total = 0
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        at = 0
        for number, row in enumerate(sorted(pieces[key], key=lambda row: row.piece)):
            part = np.array(ids[at : at + row.length], "<u4")
            assert (row.piece, row.start, row.ids_crc32) == (number, at, zlib.crc32(part.tobytes()))
            assert row.length <= 2048 and (number == 0 or row.length == 2048)
            at += row.length
        assert at == len(ids) and len(pieces[key]) == -(-len(ids) // 2048)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 2


def test_sequences(spark, library):
    some = [(1, "one two"), (2, "three"), (3, None), (1, "one two"), (None, "four")]
    packed = packing.packed_documents(table(spark, some), PATH, capacity=8, with_ids=True)
    held = [row.ids for row in packing.sequences(packed).collect()]
    assert all(len(ids) <= 8 for ids in held)
    expected = [n for _, text in some for n in library.encode(text or "", add_special_tokens=False).ids + [0]]
    assert sorted(n for ids in held for n in ids) == sorted(expected)
    assert packing.packed_documents(table(spark, []), PATH).count() == 0


def test_sum_of_squares():
    """Every place has the least sum of squared counts among the open bins with room."""
    rng = np.random.default_rng(5)
    lengths = -np.sort(-rng.integers(1, 30, 300))
    bins, offsets = packing.place(lengths, 30)
    left: dict[int, int] = {}
    for size, number, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):

        def cost(gap, size=size):
            counts: dict[int, int] = {}
            gaps = list(left.values())
            gaps.remove(gap)
            for other in [*gaps, gap - size]:
                if other:
                    counts[other] = counts.get(other, 0) + 1
            return sum(n * n for n in counts.values())

        room = {gap for gap in left.values() if gap >= size}
        if room:
            assert cost(left[number]) == min(map(cost, room))
        else:
            assert number not in left
        assert offset == 30 - left.get(number, 30)
        left[number] = left.get(number, 30) - size
