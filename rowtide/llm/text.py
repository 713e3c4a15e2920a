"""Words of texts as numpy arrays, straight from Arrow's string buffers.

A word is a run of ASCII digits, ASCII letters and characters beyond ASCII; A-Z count as a-z. In UTF-8
every byte of a character beyond ASCII is 0x80 or more, so words can be cut byte by byte.
Words and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 4 << 20

#: The word pattern, for SQL and for small Python helpers.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BLANK = 32
_TABLE = np.full(256, BLANK, np.uint8)
_TABLE[48:58] = np.arange(48, 58)
_TABLE[65:91] = np.arange(97, 123)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)

_BASE = 0x9E3779B97F4A7C15
_WRAP = 1 << 64


class Words(NamedTuple):
    """``hashes`` of all words; the words of text i are ``docs[i]:docs[i + 1]``."""

    hashes: np.ndarray
    docs: np.ndarray


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and where each text begins and ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def cuts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows with at most ``limit`` in all; a larger row is alone."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + limit, "right")) - 1)
        yield low, high
        low = high


def slices(batch: pa.RecordBatch, text, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of bounded text; ``text`` gives a batch's string column."""
    _, at = strings(text(batch))
    for low, high in cuts(np.diff(at), limit):
        yield batch.slice(low, high - low)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return table(_BASE), table(pow(_BASE, -1, _WRAP))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing step of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, by one running sum over all bytes."""
    power, inverse = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    spread = (sums[end] - sums[start]) * inverse[start]
    return mix(spread + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans(low: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; ``at`` are places that no word crosses."""
    inside = low != BLANK
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, stop = at[:-1][at[:-1] < len(low)], at[1:][at[1:] > 0] - 1
    first[begin], last[stop] = inside[begin], inside[stop]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(column) -> Words:
    """Hashes of the words of each text."""
    raw, at = strings(column)
    low = _TABLE[raw]
    start, end = spans(low, at)
    return Words(hash_spans(low, start, end), np.searchsorted(start, at))


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case and all that is in no word blank."""
    return _TABLE[raw]


def shingles(found: Words, width: int) -> Words:
    """Hashes of each ``width`` consecutive words. A text with fewer words, but not none, is one
    shingle of all its words."""
    counts = np.diff(found.docs)
    padded = np.concatenate([found.hashes, np.zeros(width, np.uint64)])
    rolled = np.zeros(len(found.hashes), np.uint64)
    for step in range(width):
        rolled = rolled * np.uint64(_BASE) + padded[step : step + len(found.hashes)]
    kept = np.maximum(counts - width + 1, np.minimum(counts, 1))
    docs = np.concatenate([[0], np.cumsum(kept)])
    at = np.repeat(found.docs[:-1] - docs[:-1], kept) + np.arange(docs[-1])
    hashes = rolled[at]
    for row in np.flatnonzero((counts > 0) & (counts < width)):
        whole = 0
        for value in found.hashes[found.docs[row] : found.docs[row + 1]].tolist():
            whole = (whole * _BASE + value + 1) % _WRAP
        hashes[docs[row]] = whole
    return Words(mix(hashes), docs)


def hash_sequences(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch ``at[i]:at[i + 1]`` of hashes, in order."""
    power, inverse = _powers(1 << max(16, len(hashes).bit_length()))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes) * power[: len(hashes)], out=sums[1:])
    return mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]] + np.diff(at).astype(np.uint64))
