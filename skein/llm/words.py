"""Words and their hashes for whole Arrow batches at once, over the UTF-8 bytes.

The two word rules in use split at ASCII bytes only, so they can be judged byte by byte:
SPACED takes runs of anything but white space, ALNUM runs of digits, letters and non-ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is taken whole, alone.
BLOCK_BYTES = 1_000_000
#: Rows that are worked on at once.
BLOCK_ROWS = 4_000

_BYTES = np.arange(256)
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x1E3779B97F4A7C15 % int(_PRIME)
_BASE_INVERSE = pow(_BASE, -1, int(_PRIME))
#: Powers of the base and of its inverse, modulo the prime.
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: The lowest k bytes of 8.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end] for all spans: 8 bytes a step, every step mixed, all spans at once."""
    left = ends - starts
    h = mix(left.astype(np.uint64) + np.uint64(0xA0761D6478BD642F))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    live, at = np.flatnonzero(left > 0), starts
    left = left[live]
    at = at[live]
    while len(live):
        x = h[live] ^ (eights[at] & _LOW[np.minimum(left, 8)])
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        h[live] = x ^ (x >> np.uint64(29))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return mix(h)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, of numbers below it: halves of 31 and 30 bits."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a0 * b1 + a1 * b0
    return _modulo(np.uint64(2) * (a1 * b1) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _modulo(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & _PRIME)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            powers, step = np.ones(1, np.uint64), base
            while len(powers) < size:
                powers = np.concatenate([powers, _times(powers, np.full(len(powers), step, np.uint64))])
                step = step * step % int(_PRIME)
            _POWERS[i] = powers
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for all spans: differences of one running polynomial modulo 2^61 - 1, shifted to a common origin.

    A prime, as modulo a power of two there are sequences that collide whatever the base.
    """
    up, down = _powers(len(values) + 1)
    terms = _times(_modulo(values), up[:-1])
    running = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(terms & np.uint64((1 << 31) - 1), out=running[0, 1:])
    np.cumsum(terms >> np.uint64(31), out=running[1, 1:])
    total = _modulo(_times(_modulo(running[1]), np.full(len(values) + 1, 1 << 31, np.uint64)) + _modulo(running[0]))
    raw = _times(_modulo(total[ends] + (_PRIME - total[starts])), down[starts])
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive values; shorter input gives none. Runs of powers of two are put together from halves."""
    if len(hashes) < k or k < 1:
        return np.empty(0, np.uint64)

    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA0761D6478BD642F))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))

    done, size, power, width = None, 0, hashes, 1
    while width <= k:
        if k & width:
            n = len(hashes) - size - width + 1
            done, size = (power[:n] if done is None else pair(done[:n], power[size : size + n])), size + width
        if 2 * width <= k:
            power = pair(power[:-width], power[width:])
        width *= 2
    return mix(done + np.uint64(k))


@dataclass
class Block:
    """Some consecutive rows: text bytes, and the words in them. A row's words are first[i]:first[i + 1]."""

    row: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def joined(self, i: int) -> bytes:
        """The words of row i, joined by one space."""
        a, b = self.first[i], self.first[i + 1]
        whole, base = self.data[self.offsets[i] : self.offsets[i + 1]].tobytes(), self.offsets[i]
        return b" ".join([whole[s - base : e - base] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most BLOCK_ROWS rows and so many bytes each, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1), a + BLOCK_ROWS)
        yield a, b
        a = b


def blocks(column: pa.Array | pa.ChunkedArray, word: np.ndarray, lower: bool = False, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's rows in blocks, with the words that the byte rule `word` finds in them."""
    data, offsets = text_bytes(column)
    for a, b in row_blocks(offsets, most):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if lower:
            part = LOWER[part]
        inside = word[part]
        before, after = np.zeros(len(part) + 1, bool), np.zeros(len(part) + 1, bool)
        before[1:], after[:-1] = inside, inside
        before[at] = False  # rows don't run into one another
        after = after[1:]
        after[at[1:][at[1:] > at[:-1]] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after) + 1
        yield Block(a, part, at, starts, ends, np.searchsorted(starts, at))
