"""Words of Arrow text columns as numpy arrays: bounds and 64-bit hashes, many documents at once.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``. Texts are read from Arrow's own UTF-8
buffer, so that no Python string is made per document or word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BLOCK = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a finaliser of two multiplications)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_BYTE[SPACE] = 0
_POWERS = powers(_BASE | _U(1), _BLOCK)
_BLOCK_STEP = powers(_BASE | _U(1), _BLOCK + 1)[-1]


@dataclass
class Texts:
    """Some consecutive rows of a batch. ``doc_first[i]`` is the number of words before row i."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc_first: np.ndarray

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def joined(self, keep: np.ndarray | None = None, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the words, each followed by one space; where each word begins, and the end).

        ``keep`` picks words; ``table`` maps bytes.
        """
        lengths = self.ends - self.starts
        solid = self.data[~SPACE[self.data]]
        if keep is not None:
            solid, lengths = solid[np.repeat(keep, lengths)], lengths[keep]
        begin = np.concatenate(([0], np.cumsum(lengths + 1)))
        out = np.full(int(begin[-1]), 0x20, dtype=np.uint8)
        inside = np.ones(len(out), dtype=bool)
        inside[begin[1:] - 1] = False
        out[inside] = solid if table is None else table[solid]
        return out, begin


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text); nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end; a text's end also ends a word. ``gap``: bytes of no word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~gap[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = solid
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = solid
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; equal words have equal hashes in any text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = starts[0]
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data) - first) - np.repeat(starts - first, spans)
    weight = _POWERS[place & (_BLOCK - 1)]
    if place.max() >= _BLOCK:
        weight = weight * powers(_BLOCK_STEP, int(place.max() // _BLOCK) + 1)[place // _BLOCK]
    sums = np.add.reduceat(_BYTE[data[first:]] * weight, starts - first)
    return mix(sums + (ends - starts).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))


def lower(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Bytes mapped by ``table``; capital Latin-1 letters become small ones."""
    out = table[data]
    lead = np.zeros(len(data), dtype=bool)
    lead[1:] = data[:-1] == 0xC3
    out[lead & (out >= 0x80) & (out <= 0x9E) & (out != 0x97)] += 32
    return out


def row_cuts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows (from, to) of at most ``limit`` bytes (or one longer text)."""
    at = 0
    while at < len(offsets) - 1:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(offsets) - 1)
        yield at, to
        at = to


def slices(column: pa.Array, limit: int = SLICE_BYTES, table: np.ndarray | None = None) -> Iterator[Texts]:
    """Rows of a text column in slices of at most ``limit`` bytes (or one longer text).

    With ``table``, texts are first mapped by ``lower``.
    """
    data, offsets = text_buffer(column)
    for at, to in row_cuts(offsets, limit):
        part, own = data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        part = part if table is None else lower(part, table)
        starts, ends = word_bounds(part, own)
        yield Texts(slice(at, to), part, own, starts, ends, np.searchsorted(starts, own))


def plain_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
