"""BPE encoding by backtracking over longest matches, and decoding through an offset table.

A pair of tokens is compatible if BPE of their joined letters gives just these two. A sequence of tokens whose neighbours are
all compatible is the BPE of its letters, and there is only one, so an encoder may look for it in any order: it takes the
longest token that fits, and goes back where nothing fits. No place of a word is given up twice, so time is linear.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tideledger.llm.common import byte_letters, sent_spec, texts

# bounds of a worker's memory; they change no token
CACHED = 1 << 19
PAIRS = 1 << 20
CHUNK = 64
TOKENS_AT_ONCE = 1 << 20
IDS_IN_BATCH = 1 << 22

# characters which no normal form joins or changes, and which Python lowers as the library does; the tests compare all of them
_PLAIN = (
    "\\x00-\\x1b\\x20-\\x7f\\xa0-ʯΈ-ΡΤ-ώЀ-҂Ҋ-ԥ‐-‧‰-⁞"
    "₠-₹、-〩ぁ-ゖ゠-ヿ一-鿋가-힣！-｠"
)
_OTHER = re.compile(f"[^{_PLAIN}]")
# how a file with word ends cuts texts: fixed values of that file
_LOWERING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class Merges:
    """A vocabulary's merges as a pair-compatibility table and an Aho-Corasick automaton.

    Tokens have own numbers here: letters first, then merged tokens in the order of their merges.
    """

    def __init__(self, model: dict):
        suffix = model.get("end_of_word_suffix") or ""
        odd = [key for key in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(key)]
        if model.get("type") != "BPE" or odd:
            raise ValueError(f"not a plain BPE model: {model.get('type')}, {odd}")
        vocab, letters = model["vocab"], byte_letters()
        pairs = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        words = [letter + end for end in dict.fromkeys(("", suffix)) for letter in sorted(letters, key=letters.get)]
        self.n_letters = len(words)
        words += ["".join(pair) for pair in pairs]
        if len(set(words)) != len(words) or not all(word in vocab for word in words):
            raise ValueError("not a byte-level BPE in which every merge makes a token of its own")
        number = {word: place for place, word in enumerate(words)}
        self.ids = np.array([vocab[word] for word in words], np.uint32)
        self.left = [*range(self.n_letters), *(number[a] for a, _ in pairs)]
        self.right = [*range(self.n_letters), *(number[b] for _, b in pairs)]
        self.size = len(words)
        self.merged = {number[a] * self.size + number[b]: number[a + b] for a, b in pairs}
        self.known: dict[int, bool] = {}
        # a letter of a word is its byte; the last letter, where words have ends, is its byte above 255
        shapes = [chr(place) for place in range(self.n_letters)]
        reached = [True] * self.n_letters
        for token in range(self.n_letters, self.size):
            a, b = self.left[token], self.right[token]
            shapes.append(shapes[a] + shapes[b])
            # a token that BPE of its own letters doesn't give never occurs
            reached.append(reached[a] and reached[b] and self._compatible(a, b, token))
        self.ends = bool(suffix)
        self.length = [len(shape) for shape in shapes]
        known = {shape: token for token, shape in enumerate(shapes) if reached[token]}
        self.shorter = [-1] * self.size
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for shape, token in known.items():
            self.automaton.add_word(shape, token)
            self.shorter[token] = next((known[shape[:n]] for n in range(len(shape) - 1, 0, -1) if shape[:n] in known), -1)
        self.automaton.make_automaton()

    def _compatible(self, a: int, b: int, limit: int) -> bool:
        """Whether BPE leaves the border of ``a`` and ``b`` alone, as far as merges before ``limit`` go.

        Merges are undone from the last one back; the border falls if its two sides would have been merged before that.
        """
        while True:
            if self.merged.get(a * self.size + b, limit) < limit:
                return False
            if a < self.n_letters and b < self.n_letters:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                # of equal merges the left one comes first
                limit, b = b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.size + b
        fits = self.known.get(key)
        if fits is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            fits = self.known[key] = self._compatible(a, b, self.size)
        return fits

    def tokens(self, word: bytes) -> list[int]:
        """The BPE tokens of one word, by their own numbers."""
        if not word:
            return []
        shape = word.decode("latin-1")
        if self.ends:
            shape = shape[:-1] + chr(256 + word[-1])
        length, shorter, size = self.length, self.shorter, len(shape)
        longest = [-1] * (size + 1)
        for end, token in self.automaton.iter(shape):
            # of the tokens that start at one place, longer ones end later
            longest[end - length[token]] = token
        # the place before the first letter is the last entry
        place, token = -1, longest[-1]
        if length[token] == size:
            return [token]
        usable = bytearray(b"\1") * (size + 1)
        found = [token]
        place += length[token]
        token, size = longest[place], size - 1
        known, step = self.known, self.size
        while place < size:
            last = found[-1] * step if found else None
            while token >= 0:
                if usable[place + length[token]]:
                    if last is None:
                        break
                    fits = known.get(last + token)
                    if fits or fits is None and self.compatible(found[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                place += length[token]
                token = longest[place]
            else:
                # nothing goes on from here: never end here again, and take a shorter token before
                usable[place] = 0
                token = found.pop()
                place -= length[token]
        return found


class OffsetTable:
    """Byte strings by number, laid end to end; ``joined`` puts those of many numbers together without a loop."""

    def __init__(self, strings: Iterable[bytes]):
        strings = list(strings)
        self.blob = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(string) for string in strings], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> Iterator[bytes]:
        """The strings of ``numbers`` in order, in parts of bounded size."""
        for low in range(0, len(numbers), TOKENS_AT_ONCE):
            part = numbers[low : low + TOKENS_AT_ONCE]
            sizes = self.sizes[part]
            skipped = np.cumsum(sizes) - sizes
            yield self.blob[np.arange(sizes.sum()) + np.repeat(self.begins[part] - skipped, sizes)].tobytes()


class Codec:
    """Encoding and decoding as the tokenizers library does for one file, without added begin and end tokens."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        library, parsed = Tokenizer.from_str(spec), json.loads(spec)
        added = parsed.get("added_tokens", [])
        if any(token.get(key) for token in added for key in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("an added token that takes in its surroundings")
        self.merges = Merges(parsed["model"])
        self.added = {token["content"]: np.array([token["id"]], np.uint32).tobytes() for token in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.letters = byte_letters()
        self.words = self._word_pattern(parsed)
        self.known: dict[str, bytes] = {}
        names = {number: word for word, number in parsed["model"]["vocab"].items()} | {t["id"]: t["content"] for t in added}
        decoder = parsed.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"no decoding for {decoder['type']}")
        # without a decoder the library joins the vocabulary's entries by a space
        self.gap = 0 if decoder else 1
        order = range(max(names) + 1)
        self.shown = OffsetTable(b" " * self.gap + self._written(names.get(number, ""), bool(decoder)) for number in order)
        self.numerals = OffsetTable(b" %d" % number for number in order)

    @staticmethod
    def _word_pattern(parsed: dict):
        """The pattern of a file that lowers its text and cuts it at white space, or None for other files."""
        cuts = (parsed.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lowers = (parsed.get("normalizer") or {}).get("normalizers") == _LOWERING
        if not lowers or len(cuts) != 2 or cuts[0].get("type") != "Split" or cuts[1] != _BYTES:
            return None
        kept = cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        pattern = cuts[0]["pattern"].get("Regex", "")
        # pieces must not hold white space
        return regex.compile(pattern) if kept and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") else None

    def _written(self, word: str, as_bytes: bool) -> bytes:
        if as_bytes and all(letter in self.letters for letter in word):
            return bytes(self.letters[letter] for letter in word)
        return word.encode()

    def _coded(self, words: Iterable[bytes]) -> bytes:
        """The ids of words, as little-endian unsigned 32-bit integers."""
        found = [token for word in words for token in self.merges.tokens(word)]
        return self.merges.ids[found].astype("<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a run without white space. Its words are kept, and the run itself if it is one word or none."""
        words = self.words.findall(chunk)
        if len(words) > 1:
            return b"".join([self.known.get(word) or self._word(word) for word in words])
        return self._word(words[0] if words else "")

    def _word(self, word: str) -> bytes:
        found = self.merges.ids[self.merges.tokens(word.encode())].astype("<u4").tobytes()
        if len(word) <= CHUNK:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[word] = found
        return found

    def _plain(self, text: str) -> Iterable[bytes]:
        """The ids of a text without special strings, in parts."""
        if self.words is not None and (text.isascii() and text.isprintable() or not _OTHER.search(text)):
            known = self.known
            return [known.get(chunk) or self._chunk(chunk) for chunk in text.lower().split()]
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        cut = self.pre_tokenizer.pre_tokenize_str(normal) if self.pre_tokenizer else [(normal, None)]
        letters = self.letters
        return [self._coded(bytes(letters[letter] for letter in word) for word, _ in cut)]

    def encode(self, text: str) -> np.ndarray:
        parts = self.special.split(text) if self.special else [text]
        ids = [coded for part in parts for coded in ([self.added[part]] if part in self.added else self._plain(part))]
        return np.frombuffer(b"".join(ids), "<u4")

    def decode_parts(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decoded text of ``ids`` in parts of UTF-8; a part may end inside a character."""
        return _without_first(self.shown.joined(ids), self.gap)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.decode_parts(ids)).decode("utf-8", "replace")

    def numeral_parts(self, ids: np.ndarray) -> Iterator[bytes]:
        """The ids in decimal, joined by one space, in parts."""
        return _without_first(self.numerals.joined(ids), 1)


def _without_first(parts: Iterator[bytes], n: int) -> Iterator[bytes]:
    for part in parts:
        yield part[n:]
        n = 0


_LOADED: dict[int, Codec] = {}


def codec(spec: str) -> Codec:
    """One codec for each worker process and file."""
    key = hash(spec)
    if key not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[key] = Codec(spec)
    return _LOADED[key]


def _digest(parts: Iterable[bytes]) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def _encode(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(spec.value)
        for batch in batches:
            low, held, size = 0, [], 0
            for row, text in enumerate(batch.column("text"), 1):
                held.append(coder.encode(text.as_py()))
                size += len(held[-1])
                if size >= IDS_IN_BATCH or row == batch.num_rows:
                    ends = np.cumsum([0, *map(len, held)], dtype=np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id")[low:row], ids], names=["doc_id", "ids"])
                    low, held, size = row, [], 0

    return run


def _decode(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(spec.value)
        for batch in batches:
            bodies = [None if ids.as_py() is None else coder.decode(ids.values.to_numpy()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.string())], names=["doc_id", "text"])

    return run


def _round_trip(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(spec.value)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column("text"):
                ids = coder.encode(text.as_py())
                counts.append(len(ids))
                coded.append(_digest(coder.numeral_parts(ids)))
                decoded.append(_digest(_whole(coder, ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _whole(coder: Codec, ids: np.ndarray) -> Iterable[bytes]:
    """The decoded text in UTF-8; only files with entries that aren't whole characters need it in one piece."""
    return coder.decode_parts(ids) if coder.gap else [coder.decode(ids).encode()]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) for every row of ``docs`` (``doc_id``, ``text``, any others).

    The ids are those of the tokenizers library for the file at ``path`` without added begin and end tokens, truncation or
    padding; the file has a byte-level BPE, with or without word ends, else ``ValueError``. Special strings inside a text
    become their ids. Null and empty texts, and texts of white space where the file drops it, have no ids; repeated rows and
    null ids stay; no rows give no rows.

    One narrow pass. Runs without white space are kept with their ids in a worker's cache of bounded size.
    """
    spec = sent_spec(docs.sparkSession, path)
    return texts(docs).mapInArrow(_encode(spec), "doc_id long, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` for every row of ``coded`` (``doc_id``, ``ids``, any others), special tokens included.

    A null list of ids gives a null text and an empty one an empty text; ids must be of the file at ``path``.
    """
    spec = sent_spec(coded.sparkSession, path)
    return coded.selectExpr("cast(doc_id AS long) AS doc_id", "ids").mapInArrow(_decode(spec), "doc_id long, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of the decimal ids and of the decoded text, as ``encoded`` and ``decoded`` give them.

    Both run in one narrow pass, and neither the ids nor the decoded texts leave the worker. Rows are as in ``encoded``.
    """
    spec = sent_spec(docs.sparkSession, path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts(docs).mapInArrow(_round_trip(spec), schema)
