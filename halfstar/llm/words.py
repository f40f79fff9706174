"""Words and word shingles of many texts at once, as 64-bit hashes in NumPy arrays.

Works on the buffers of Arrow string columns, without a Python object per word. A word
is ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. Hashes stand for the words: two
different ones share a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that are hashed at once; bounds the arrays, not the texts.
SEGMENT = 1 << 18
#: Bytes of text that `grouped` gathers into one step.
STEP = 1 << 23

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Another scrambling of 64-bit integers for each salt."""
    return mix(x + np.uint64((salt * BASE + 0x632BE59BD9B4E019) % (1 << 64)))


def _powers(of: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(of))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def at_least(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(BASE, n), _powers(INVERSE, n)
        return cls.up, cls.down


def span_hashes(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of 64-bit terms, wherever it stands."""
    up, down = _Powers.at_least(len(terms) + 1)
    sums = np.zeros(len(terms) + 1, dtype=np.uint64)
    np.cumsum((terms + np.uint64(1)) * up[: len(terms)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + np.uint64(1))


def _segment(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words in some bytes; ``first`` marks starts of texts."""
    inside = ~_SPACE[data]
    fresh = np.empty(len(data), dtype=bool)  # no word goes on from the byte before
    fresh[0] = True
    np.logical_not(inside[:-1], out=fresh[1:])
    fresh |= first
    starts = np.flatnonzero(inside & fresh)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    last = np.empty(len(data), dtype=bool)  # no word goes on in the byte after
    last[-1] = True
    np.logical_or(~inside[1:], first[1:], out=last[:-1])
    ends = np.flatnonzero(inside & last) + 1
    return span_hashes(_LOWER[data].astype(np.uint64), starts, ends), starts


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each starts, with the end at last; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each text's first word with the end at last."""
    if not len(texts):
        return np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    data, at = text_buffers(texts)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[at] = True
    hashes, positions, low = [], [], 0
    while low < len(data):
        high = min(low + SEGMENT, len(data))
        while high < len(data) and not (first[high] or _SPACE[data[high]]):
            more = np.flatnonzero(_SPACE[data[high : high + SEGMENT]] | first[high : high + SEGMENT][: len(data) - high])
            high = high + int(more[0]) if len(more) else min(high + SEGMENT, len(data))
        found, starts = _segment(data[low:high], first[low:high])
        hashes.append(found)
        positions.append(starts + low)
        low = high
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(positions), at)


def shingle_hashes(words: np.ndarray, at: np.ndarray, width: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, and where each text's begin, with the end at last.

    A text of fewer words than ``width`` has none, or with ``whole_if_short`` one of
    all its words, if it has any.
    """
    counts = np.diff(at)
    many = np.maximum(counts - width + 1, 0)
    if whole_if_short:
        many[(counts > 0) & (counts < width)] = 1
    starts = np.concatenate([[0], np.cumsum(many)])
    # the word at which each shingle begins
    begins = np.arange(starts[-1]) + np.repeat(at[:-1] - starts[:-1], many)
    length = np.repeat(np.minimum(counts, width), many).astype(np.uint64)
    out = salted(length, 1)
    for k in range(width):
        have = length > np.uint64(k)
        if have.all():
            out = salted(out + words[begins + k], 2)
        else:
            out[have] = salted(out[have] + words[begins[have] + k], 2)
    return out, starts


def distinct_sets(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and where each text's begin."""
    parts = [np.unique(values[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return (np.concatenate(parts) if parts else values), np.concatenate([[0], np.cumsum(sizes)])


def grouped(batches: Iterator[pa.RecordBatch], step: int = STEP, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Deal Arrow batches anew, so that each holds about ``step`` bytes of text, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        bins = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // step
        cuts = [0, *(np.flatnonzero(np.diff(bins)) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(int(a), int(b - a))
