"""Vectorised views of text batches: words, lines and hashes straight from Arrow's UTF-8 buffers.

A batch of documents is one run of bytes with offsets. Word boundaries, counts and 64-bit word hashes come
from a fixed number of numpy passes over those bytes, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that numpy works on at once (a longer document is a block of its own).
BLOCK_BYTES = 1 << 20

# ASCII space and the control characters from tab to carriage return separate words
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = 1 << 16
#: base**i and base**-i modulo 2**64 for i < _LOW; greater powers are a product of two entries.
_LOW_POWERS = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_LOW - 1, x, np.uint64)]), dtype=np.uint64) for x in (_BASE, _BASE_INVERSE)]


def _high_powers(n: int) -> list[np.ndarray]:
    """base**(i * _LOW) and its inverse for i <= n // _LOW."""
    return [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n // _LOW, pow(x, _LOW, 1 << 64), np.uint64)]), dtype=np.uint64)
            for x in (_BASE, _BASE_INVERSE)]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mixer: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Block:
    """Some consecutive documents of a batch. ``offsets`` has one entry more than there are documents."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each document."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def blocks(column: pa.Array | pa.ChunkedArray, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about ``most`` bytes; a null text counts as an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield Block(i, data[off[i]:off[j]], off[i:j + 1] - off[i])
        i = j


class Hasher:
    """Hashes of any byte ranges of one block, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        high, self.high = _high_powers(len(data))
        up = (high[:, None] * _LOW_POWERS[0][None, :min(_LOW, max(len(data), 1))]).reshape(-1)[:len(data)]
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * up, dtype=np.uint64, out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _LOW_POWERS[1][start & (_LOW - 1)] * self.high[start >> 16]
        return mix64((self.prefix[end] - self.prefix[start]) * down)


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray      # index of the document in the block
    first: np.ndarray    # per document, position of its first word; one entry more than documents


def words(block: Block, separator: np.ndarray = SEPARATOR) -> Words:
    """Maximal runs of bytes that are no separators, never across documents."""
    inside = ~separator[block.data]
    n = len(inside)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = block.offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, block.offsets, "left")
    return Words(start, end, np.repeat(np.arange(block.size), np.diff(first)), first)


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width`` consecutive words of a document, and the position of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
    inside = np.flatnonzero(doc[:n] == doc[width - 1:])
    return mix64(h[inside]), inside


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
