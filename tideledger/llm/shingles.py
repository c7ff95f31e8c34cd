"""Distinct word shingles of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(2024)
# a random number for each byte; A-Z count as a-z, and blanks end a word
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
# texts that are hashed at a time
_BYTES = 1 << 20


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed random-looking permutation of 64-bit numbers."""
    x = (x ^ np.uint64(salt)) + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, known: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006 - a cache
    while len(known[0]) < n:
        known[0] = np.concatenate([known[0], known[0] * (known[0][-1] * _STEP)])
    return known[0][:n]


def _word_hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``flat`` begin, and their hashes; a byte weighs by its place in the word."""
    solid = ~_BLANK[flat]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    sizes = ends - starts
    places = np.flatnonzero(solid)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(len(places)) - np.repeat(begins, sizes)
    terms = _BYTE[flat[places]] * _powers(int(sizes.max()))[inside]
    return starts, mixed(np.add.reduceat(terms, begins) + sizes.astype(np.uint64))


def _some(bodies: list[bytes], width: int) -> list[np.ndarray]:
    flat = np.frombuffer(b" ".join(bodies) + b" ", np.uint8)
    limits = np.cumsum([len(body) + 1 for body in bodies])
    starts, words = _word_hashes(flat)
    last = np.searchsorted(starts, limits, "left")
    first = np.concatenate([[0], last[:-1]])
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = mixed(rolled * _STEP + words[k : k + len(rolled)], k)
    sets = []
    for low, high in zip(first, last, strict=True):
        if high - low >= width:
            sets.append(np.unique(rolled[low : high - width + 1]))
        elif high > low:
            short = np.uint64(high - low)
            for word in words[low:high]:
                short = mixed(np.array([short * _STEP + word]), 77)[0]
            sets.append(np.array([short]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def shingle_sets(bodies: list[bytes], width: int) -> list[np.ndarray]:
    """For each text its distinct ``width``-word shingles, hashed and sorted.

    Words are runs of non-blanks with A-Z in lower case. A text with fewer words is one shingle, one without words has none.
    """
    sets: list[np.ndarray] = []
    low = size = 0
    with np.errstate(over="ignore"):
        for row, body in enumerate(bodies):
            size += len(body)
            if size > _BYTES or row + 1 == len(bodies):
                sets.extend(_some(bodies[low : row + 1], width))
                low, size = row + 1, 0
    return sets


def batches_of_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Arrow batches with a ``text`` column, cut to some thousand rows, with their shingle sets."""
    for batch in batches:
        for low in range(0, len(batch), 2048):
            part = batch.slice(low, 2048)
            yield part, shingle_sets([text.as_py() for text in part.column("text").cast(pa.binary())], width)
