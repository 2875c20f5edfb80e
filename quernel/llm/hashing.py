"""Hashes of words and of word windows over whole batches of UTF-8 bytes, in numpy.

Words are maximal runs without white space, A-Z lower-cased. A word's hash is a
polynomial over random byte values, taken from running sums, so the cost is a few
array operations per batch and none per word. All is modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
U64 = np.uint64

_draw = np.random.Generator(np.random.PCG64(20240601))
_VALUE = _draw.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_draw.integers(2**61, 2**62)) * 2 + 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _VALUE[_LOWER]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... by doubling."""
    out = np.ones(n, dtype=U64)
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * U64(pow(base, done, 2**64))
        done += take
    return out


_UP = _powers(_BASE, SEGMENT)
_DOWN = _powers(pow(_BASE, -1, 2**64), SEGMENT)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _segment(data: np.ndarray, up: np.ndarray, down: np.ndarray, cuts: np.ndarray):
    """(hashes, starts) of the words of one segment; no word crosses one of the cuts."""
    space = _IS_SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    before[cuts] = True
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[cuts[cuts > 0] - 1] = True
    word = ~space
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after)
    sums = np.cumsum(_VALUE[data] * up[: len(data)])
    first = np.where(starts > 0, sums[starts - 1], U64(0))
    return mix((sums[ends] - first) * down[starts]), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hashes of all words, index of each text's first word and the total) of texts laid end to end.

    Text i is data[offsets[i]:offsets[i + 1]]. Works through the bytes in
    segments that end at a white space or at the end of a text; only a single
    longer word makes a longer segment.
    """
    base, stop = int(offsets[0]), int(offsets[-1])
    hashes, places = [], []
    at = base
    while at < stop:
        end = min(at + SEGMENT, stop)
        if end < stop:
            # back to the last text end or white space of the segment, if there is one
            bound = offsets[np.searchsorted(offsets, end, side="right") - 1]
            blank = np.flatnonzero(_IS_SPACE[data[max(at, end - 4096) : end]])
            last = max(at, end - 4096) + int(blank[-1]) + 1 if len(blank) else at
            best = max(int(bound), last)
            if best > at:
                end = best
            else:
                more = np.flatnonzero(_IS_SPACE[data[end:stop]])
                end = min(
                    end + int(more[0]) + 1 if len(more) else stop,
                    int(offsets[np.searchsorted(offsets, at, side="right")]),
                )
        size = end - at
        up, down = (_UP, _DOWN) if size <= SEGMENT else (_powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size))
        low, high = np.searchsorted(offsets, at), np.searchsorted(offsets, end)
        got, starts = _segment(data[at:end], up, down, (offsets[low:high] - at).astype(np.int64))
        hashes.append(got)
        places.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, dtype=U64), np.zeros(len(offsets), dtype=np.int64)
    places = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(places, offsets).astype(np.int64)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of so many words; of all words where there are fewer, none where there is none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, U64(size))
    for k in range(size):
        out = out * U64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k]
    return mix(out)


def bytes_of(column: pa.Array):
    """(bytes, offsets) of a binary column; a null is empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def batch_words(column: pa.Array, most_bytes: int = 4 << 20):
    """For each text of a column the array of its word hashes, in order; a few MB of text at a time."""
    data, offsets = bytes_of(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1)
        last = min(last, len(column))
        hashes, bounds = word_hashes(data, offsets[first : last + 1])
        for i in range(last - first):
            yield hashes[bounds[i] : bounds[i + 1]]
        first = last
