"""Word shingles of whole texts as 64-bit hashes, computed a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# White space of the word rule: space and U+0009 to U+000D.
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_POWERS = [np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        size = max(256, 1 << (n - 1).bit_length())
        factors = np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64)
        factors[0] = 1
        _POWERS[0] = np.multiply.accumulate(factors)
    return _POWERS[0]


def offsets(column: pa.Array) -> np.ndarray:
    """Where each value of a string or binary array begins (one more at the end), for either width of offsets."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    own = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return own[column.offset : column.offset + len(column) + 1].astype(np.int64)


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text is a range of its own."""
    sizes = np.diff(offsets(column))
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string array, and each text's first word (one more at the end)."""
    n = len(column)
    at = offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = at - at[0]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    inside = ~_BREAKS[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    lengths = last - first + 1
    letters = _LOWER[raw[inside]].astype(np.uint64)
    letters += np.uint64(1)
    at = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    letters *= _powers(int(lengths.max()))[place]
    words = mix(np.add.reduceat(letters, at) + lengths.astype(np.uint64))
    return words, np.searchsorted(first, bounds)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word shingles of one text; a shorter text is one shingle."""
    factors = _odd(size, 7)
    if len(words) < size:
        if not len(words):
            return words
        return mix(np.array([(words * factors[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))]))
    n = len(words) - size + 1
    out = words[:n] * factors[0]
    for k in range(1, size):
        out += words[k : k + n] * factors[k]
    return mix(out)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text; null and wordless texts have none."""
    for start, end in slices(column):
        words, at = word_hashes(column.slice(start, end - start))
        for lo, hi in zip(at[:-1], at[1:]):
            yield np.unique(shingle_hashes(words[lo:hi], size))
