"""Vectorised scanning of UTF-8 text held in Arrow buffers.

Every helper works on a whole Arrow batch at once: the bytes of all texts lie
end to end in one numpy array, and words are found with array operations, so no
Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
#: A-Z take the codes of a-z: hashing folds ASCII case.
_BYTE_CODE[65:91] = _BYTE_CODE[97:123]
_POSITION_CODE = _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow(n: int) -> None:
    """Make the tables of powers of the base at least ``n`` long."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            table = np.full(size, np.uint64(base), dtype=np.uint64)
            table[0] = 1
            with np.errstate(over="ignore"):
                globals()[name] = np.cumprod(table, dtype=np.uint64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the n+1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_pieces(batch: pa.RecordBatch, most_bytes: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together stay near ``most_bytes``; one longer text is a slice of its own."""
    # Workers live on: what Arrow keeps of earlier batches would stay beside the next ones.
    pa.default_memory_pool().release_unused()
    ends = flat_bytes(batch.column("text"))[1][1:]
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield batch.slice(start, end - start)
        start = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n+1 word offsets of the texts.

    A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; texts never
    share a word.
    """
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, equal for words that differ in ASCII case only."""
    _grow(1 << 16)
    out = np.empty(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        # Pieces whose powers stay in the tables; a piece ends where a word does.
        first = 0
        while first < len(starts):
            last = int(np.searchsorted(ends, starts[first] + 1_000_000, side="right"))
            last = max(last, first + 1)
            low, high = int(starts[first]), int(ends[last - 1])
            _grow(high - low + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[data[low:high]] * _powers[: high - low], dtype=np.uint64, out=sums[1:])
            s, e = starts[first:last] - low, ends[first:last] - low
            out[first:last] = (sums[e] - sums[s]) * _inverses[s] + (e - s).astype(np.uint64) * _MULTIPLIER
            first = last
    return mix(out)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and the n+1 shingle offsets.

    A text with fewer words gives its whole sequence as one shingle; a text
    without words gives none.
    """
    counts = np.diff(offsets)
    n_shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate(([0], np.cumsum(n_shingles)))
    text = np.repeat(np.arange(len(counts)), n_shingles)
    start = offsets[text] + np.arange(out_offsets[-1]) - out_offsets[text]
    length = np.minimum(counts[text], width)
    total = length.astype(np.uint64) * _MULTIPLIER
    with np.errstate(over="ignore"):
        for k in range(width):
            here = start + k
            value = words[np.minimum(here, max(len(words) - 1, 0))] * _POSITION_CODE[k] if len(words) else np.zeros(0, np.uint64)
            total += np.where(k < length, mix(value), np.uint64(0))
    return mix(total), out_offsets
