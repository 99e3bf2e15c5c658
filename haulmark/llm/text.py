"""Words of many texts at once as 64-bit hashes, with numpy over Arrow buffers.

Texts are handled in pieces of bounded size, so a worker holds a few dozen
bytes for each byte of a piece; a single long text is one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 250_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers; a longer stream begins with the shorter."""
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * _GOLD + np.uint64(seed))


_BYTES = stream(256, 11)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def pieces(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (first, after) of a string column, of about ``size`` bytes, with their bytes and the byte offset of each row; null is empty."""
    size = size or PIECE_BYTES
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        after = min(after, len(column))
        yield first, after, data[offsets[first] : offsets[after]], offsets[first : after + 1] - offsets[first]
        first = after


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word (runs of bytes other than white space), where each text's words begin, and each word's first and after-last byte.

    A word's hash sums, over its bytes, a fixed random number of the byte times
    one of its place, so equal words have equal hashes whatever their text.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = word & edge[:-1]
    begin[1:] |= word[1:] & ~word[:-1]
    end = word & edge[1:]
    end[:-1] |= word[:-1] & ~word[1:]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), begin, end
    length = end - begin
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    chars = data[word]
    value = _BYTES[_FOLD[chars] if fold else chars]
    value *= stream(int(length.max()), 23)[place] | np.uint64(1)
    hashes = mix(np.add.reduceat(value, first) + length.astype(np.uint64) * _GOLD)
    return hashes, np.searchsorted(begin, offsets), begin, end


def shingles(hashes: np.ndarray, starts: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the distinct hashes of its runs of ``width`` words, ascending; of fewer words, the whole sequence is one."""
    factor = stream(max(width, 1), 37) | np.uint64(1)
    n = len(hashes)
    runs = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        runs += hashes[j : j + len(runs)] * factor[j]
    runs = mix(runs + np.uint64(width))
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            out.append(mix(np.array([(hashes[a:b] * factor[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
