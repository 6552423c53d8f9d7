"""Words of a batch of texts as arrays: bytes classed by a table, runs found, words numbered, all without a loop over words."""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: What a byte is to a reader: between words, a break between pieces, or a letter.
SPACE, BREAK, LETTER = 0, 1, 2
#: Multiplier of a word's hash, an odd number of 64 bits.
_BASE = 0x9E3779B97F4A7C15


class Words(NamedTuple):
    """Words of a batch, in order: their bytes one after the other, lengths, row, and whether a break or a text's start lies
    before."""

    data: np.ndarray
    lengths: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def array(self) -> pa.Array:
        """The words as an Arrow array of strings."""
        ends = np.zeros(len(self.lengths) + 1, np.int64)
        np.cumsum(self.lengths, out=ends[1:])
        return pa.LargeStringArray.from_buffers(len(self.lengths), pa.py_buffer(ends), pa.py_buffer(self.data))


@functools.cache
def classes(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """The class of each of 256 bytes."""
    table = np.full(256, LETTER, np.uint8)
    table[list(spaces)] = SPACE
    table[list(breaks)] = BREAK
    return table


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def words(texts: pa.Array, table: np.ndarray) -> Words:
    """The words of a column of texts, with A-Z as a-z; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    start = texts.offset
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[start : start + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = table[raw]
    letter = kind == LETTER
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    at = offsets[:-1][offsets[:-1] < len(raw)]
    begins[at] = letter[at]  # a text's first letter begins a word
    starts = np.flatnonzero(begins)
    # letters of a word run up to the first byte that is none, or to the next word's start
    data = _LOWER[raw[letter]]
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(letter, out=before[1:])
    lengths = np.diff(np.append(before[starts], before[-1]))
    del before
    row = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.flatnonzero(kind == BREAK)
    passed = np.searchsorted(breaks, starts)
    first = np.ones(len(starts), bool)
    first[1:] = (row[1:] != row[:-1]) | (passed[1:] != passed[:-1])
    return Words(data, lengths, row, first)


def hashes(found: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return hashed(found.data, found.lengths)


def hashed(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; equal runs have equal hashes wherever they stand."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    within = np.arange(len(data)) - np.repeat(starts, lengths)
    out = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[within], starts)
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers mixed, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@functools.lru_cache(4)
def _power_table(size: int) -> np.ndarray:
    out = np.full(size, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(length: int) -> np.ndarray:
    return _power_table(1 << max(6, (length - 1).bit_length()))
