"""Whole columns of text as byte arrays: words, hashes and windows without a loop per word.

A word is a maximal run of bytes other than space and U+0009 to U+000D.  Texts are
worked on in pieces of bounded size, cut between texts, or between words of a text that
is longer than a piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))


class Powers:
    """Powers of the rolling hash's base and of its inverse, grown as needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        if len(cls.up) <= n:
            size = max(n + 1, PIECE_BYTES + 4096)
            for name, base in (("up", ODD), ("down", _INVERSE)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors, dtype=np.uint64))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of ``data``."""
    Powers.grow(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * Powers.up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes get equal hashes wherever they stand."""
    return mix((prefix[ends] - prefix[starts]) * Powers.down[starts])


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def row_blocks(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of a single longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words of the texts between ``offsets``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def word_cut(data: np.ndarray, start: int, limit: int) -> int:
    """The end of a piece from ``start`` that does not cut a word."""
    end = start + limit
    while end < len(data):
        spaces = np.flatnonzero(SPACE[data[end : end + limit]])
        if len(spaces):
            return end + int(spaces[0])
        end += limit
    return len(data)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.

    ``table`` maps each byte before it is hashed, as for case folding.
    """
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for i, j in row_blocks(offsets):
        start, stop = int(offsets[i]), int(offsets[j])
        while True:
            end = stop
            if stop - start > 2 * PIECE_BYTES:
                end = start + word_cut(data[start:stop], 0, PIECE_BYTES)
            piece = data[start:end] if table is None else table[data[start:end]]
            bounds = np.clip(offsets[i : j + 1] - start, 0, end - start)
            starts, ends = word_spans(piece, bounds)
            hashes.append(span_hash(prefix_hash(piece), starts, ends))
            counts[i:j] += np.diff(np.searchsorted(starts, bounds))
            start = end
            if start >= stop:
                break
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts
