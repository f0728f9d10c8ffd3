"""Words of whole texts as 64-bit hashes, straight from Arrow's UTF-8 buffers.

Texts never become Python strings. Work goes in blocks of a few MB, so the
longest text costs its own bytes plus sixteen bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2_000_000
_TABLE = np.random.default_rng(20240607).integers(0, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def space_separated() -> np.ndarray:
    """Byte classes of words [^\\x20\\x09-\\x0D]+: True inside a word."""
    word = np.ones(256, bool)
    word[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return word


def letters_and_digits() -> np.ndarray:
    """Byte classes of words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    word = np.ones(256, bool)
    word[:128] = False
    for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        word[lo:hi] = True
    return word


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


LOWER = _lower()
#: By place in a word, up to so many: what each byte adds to the hash.
PLACES = 32
with np.errstate(over="ignore"):
    _ADDED = _TABLE[:PLACES, None] * (LOWER.astype(np.uint64) + np.uint64(1))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def folded(columns: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One hash of several columns, in order."""
    with np.errstate(over="ignore"):
        out = np.full(len(columns[0]), np.uint64(seed) + np.uint64(len(columns)), np.uint64)
        for c in columns:
            out = mixed(out * _FOLD + c)
    return out


@dataclass
class Words:
    """Words of several texts: text i has words first[i] to first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> bytes:
        """The lower-cased bytes of word i."""
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of about BLOCK_BYTES of text, never cutting a text, with their bytes and offsets from 0."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def hashed_words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Words:
    """Find and hash the words of texts laid end to end. The hash is of the lower-cased bytes and the length."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(starts, offsets)
    hashes = np.empty(len(starts), np.uint64)
    step = 1 << 17
    for i in range(0, len(starts), step):
        s, e = starts[i : i + step], ends[i : i + step]
        hashes[i : i + step] = _hash(data, s, e)
    return Words(data, starts, ends, first, hashes)


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    length = ends - starts
    long = length > 4096
    # longest words first, so that the words with a byte at a place come in one run
    order = np.argsort(np.where(long, 0, length).astype(np.int16), kind="stable")[::-1]
    n = np.where(long, 0, length)[order]
    begin, sums = starts[order], np.zeros(len(starts), np.uint64)
    out = np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for place in range(min(PLACES, int(n[0]) if len(n) else 0)):
            some = slice(0, int(np.searchsorted(-n, -place)))
            sums[some] += np.take(_ADDED[place], data[begin[some] + place])
        more = int(np.searchsorted(-n, -PLACES))
        if more:
            rest = n[:more] - PLACES
            at = np.concatenate(([0], np.cumsum(rest)))
            place = PLACES + np.arange(at[-1]) - np.repeat(at[:-1], rest)
            value = LOWER[data[np.repeat(begin[:more], rest) + place]].astype(np.uint64) + np.uint64(1)
            sums[:more] += np.add.reduceat(value * _TABLE[place], at[:-1])
        out[order] = sums
        for i in np.flatnonzero(long):
            h = np.uint64(0)
            for at in range(starts[i], ends[i], 1 << 16):
                value = LOWER[data[at : min(at + (1 << 16), ends[i])]].astype(np.uint64) + np.uint64(1)
                h = mixed(np.array([h], np.uint64))[0] + (value * _TABLE[: len(value)]).sum(dtype=np.uint64)
            out[i] = h
        return mixed(out + length.astype(np.uint64) * _FOLD)
