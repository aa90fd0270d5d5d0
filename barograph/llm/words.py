"""Words, word hashes and window hashes of whole Arrow columns, by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same words in Spark's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of ``flat`` texts; ``gap`` marks the bytes between words."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    word = ~gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(seed: int) -> tuple[np.ndarray, np.uint64]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64), np.uint64(rng.integers(1 << 40, 1 << 62) | 1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_WORDS_AT_ONCE = 1 << 17


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, gap: np.ndarray = _IS_SPACE) -> np.ndarray:
    """A 64-bit hash of each word; between the words there may only be bytes of ``gap``."""
    table, base = _constants(seed)
    table[gap] = 0
    weights = powers(base, int((ends - starts).max(initial=0)) + 1)
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), _WORDS_AT_ONCE):
        begins, stops = starts[at : at + _WORDS_AT_ONCE], ends[at : at + _WORDS_AT_ONCE]
        part = data[begins[0] : stops[-1]]
        place = np.arange(begins[0], stops[-1]) - np.repeat(begins, np.diff(begins, append=stops[-1]))
        place[gap[part]] = 0
        out[at : at + len(begins)] = np.add.reduceat(table[part] * weights[place], begins - begins[0])
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes begin, begin + 1, ... of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def window_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` values, whichever rows they belong to."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = int(_constants(seed)[1])
    out, done, run, length = None, 0, hashes, 1
    while True:
        if size & length:
            piece = run[done : done + n]
            out = piece.copy() if out is None else out + piece * np.uint64(pow(base, done, 1 << 64))
            done += length
        if done == size:
            return mix(out)
        run = run[:-length] + run[length:] * np.uint64(pow(base, length, 1 << 64))
        length *= 2
