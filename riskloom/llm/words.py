"""Vectorised word arrays over Arrow text columns (numpy inside Spark tasks).

Words are the runs of bytes other than space and 0x09..0x0D. UTF-8 never uses those bytes
inside a character, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are expanded into numpy arrays at a time (a longer single text is taken whole).
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Words of more bytes are hashed one by one; shorter ones by 8 bytes at a time, all words together.
_LONG = 128
_FIRST_BYTES = np.append((np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1), ~np.uint64(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int) -> np.uint64:
    """A 64-bit constant for a seed."""
    return mix(np.array([seed + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]


def window_names(names: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A name for each ``width`` neighbouring names: those of 1, 2, 4 .. neighbours, the last two overlapping.

    Each step mixes its operands through a bijection that is not linear in them, so no arrangement of the
    same names cancels out; different windows share a 64-bit name with the odds of two random numbers.
    """
    if len(names) < width:
        return np.zeros(0, np.uint64)
    factor, size = seeded(seed) | np.uint64(1), 1
    while 2 * size <= width:
        names, size = mix(names[:-size] * factor + names[size:]), 2 * size
    over = width - size
    return mix(names[: len(names) - over] * factor + names[over:]) if over else mix(names ^ factor)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a text column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of whole texts of about ``size`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


class Words:
    """Words of some texts: byte starts and ends, and per text the range of its words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.raw = _LOWER[raw] if lower else raw
        n = len(raw)
        inside = ~_SPACE[raw]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | first[:n]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.of_text = np.searchsorted(self.starts, offsets)  # text i has words of_text[i]:of_text[i+1]

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    def names(self, seed: int) -> np.ndarray:
        """A 64-bit name of each word, by its bytes; names of two seeds are independent."""
        size, key = self.ends - self.starts, seeded(seed)
        padded = np.append(self.raw, np.zeros(8, np.uint8))
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the 8 bytes from each byte on
        out = mix(mix(eight[self.starts] & _FIRST_BYTES[np.minimum(size, 8)] ^ key) + size.astype(np.uint64))
        more, at = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            lane = eight[self.starts[more] + at] & _FIRST_BYTES[np.minimum(size[more] - at, 8)]
            out[more] = mix(out[more] * (key | np.uint64(1)) + lane)
            at += 8
            more = more[size[more] > at]
        long = np.flatnonzero(size > _LONG)
        if len(long):
            data, spans = memoryview(padded), zip(self.starts[long].tolist(), self.ends[long].tolist())
            out[long] = np.array([xxhash.xxh3_64_intdigest(data[i:j], int(key)) for i, j in spans], np.uint64)
        return out

    def heads(self) -> np.ndarray:
        """True at the first word of each text."""
        out = np.zeros(len(self) + 1, bool)
        out[self.of_text] = True
        return out[:-1]
