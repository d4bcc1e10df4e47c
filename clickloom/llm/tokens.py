"""Words of Arrow string columns as 64-bit hashes, in numpy without a loop over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 1 << 20
#: Bytes whose numbers, of eight bytes each and several at a time, stay in a core's cache.
_CACHED = 1 << 15


def _blank(data: np.ndarray) -> np.ndarray:
    """Which bytes are space, tab, LF, VT, FF or CR; in UTF-8 never part of another character."""
    return (data == 0x20) | (data - np.uint8(0x09) < 5)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64, a bijection of 64-bit numbers."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


class _Powers:
    """Powers of an odd number modulo 2**64, made as far as they are needed."""

    def __init__(self, base: np.uint64):
        self.base, self.made = base, np.ones(1, dtype=np.uint64)

    def __reduce__(self):  # what was made stays here when a function goes to a worker
        return _Powers, (self.base,)

    def upto(self, n: int) -> np.ndarray:
        if len(self.made) < n:
            size = max(n, 2 * _CHUNK)
            factors = np.full(size, self.base, dtype=np.uint64)
            factors[0] = 1
            self.made = np.cumprod(factors, dtype=np.uint64)
        return self.made[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INVERSE)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each pair, equal for equal contents.

    A polynomial modulo 2**64, so some long sequences of two values meet: it may tell what to
    look at, but not what is equal.
    """
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * _UP.upto(len(values)), out=sums[1:])
    down = _DOWN.upto(len(values) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_ODD = np.uint64(0x9E3779B97F4A7C15)


#: Places in a word whose numbers are looked up.
_PLACES = 32


def _byte_numbers(spots: np.ndarray, seed: int) -> np.ndarray:
    """A pseudorandom number for each spot, 256 times a place in a word plus the byte there."""
    return mix(spots.astype(np.uint64) * _ODD + mix(np.uint64([seed + 1])))


@cache
def _table(seed: int) -> np.ndarray:
    return _byte_numbers(np.arange(256 * _PLACES), seed)


def _word_hash(data: np.ndarray, start: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each word, which is ``lengths`` bytes of ``data`` from ``start`` on.

    The sum of a pseudorandom number for each byte at its place in the word. Unlike a
    polynomial it has no structure that long words of few letters could meet by.
    """
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1])
    place -= np.repeat(first, lengths)
    spots = np.repeat(start, lengths)
    spots += place
    spots = data[spots] + (place << 8)
    if lengths.max() <= _PLACES:
        value = _table(seed)[spots]
    else:
        value = _table(seed)[np.minimum(spots, 256 * _PLACES - 1)]
        far = np.flatnonzero(place >= _PLACES)
        value[far] = _byte_numbers(spots[far], seed)
    salt = mix(np.uint64([seed + 1]))
    return mix(np.add.reduceat(value, first) ^ (lengths.astype(np.uint64) * _ODD + salt))


@dataclass
class Words:
    """Words of some texts: those of text i are first[i] to first[i + 1]."""

    data: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # of the texts in the bytes
    first: np.ndarray
    start: np.ndarray  # byte offsets of the words
    end: np.ndarray
    hash: np.ndarray

    def again(self, seed: int) -> Words:
        """The same words with hashes independent of those of other seeds."""
        return replace(self, hash=self.hashes(seed))

    def hashes(self, seed: int, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Hashes of the ``chosen`` words, in order, independent of those of other seeds."""
        return _hashes(self.data, self.start[chosen], self.end[chosen], seed)

    def text_of(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if (
            column.num_chunks
        ) else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = column.buffers()
    if offset_buffer is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if data_buffer is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data_buffer, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about _CHUNK bytes."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + _CHUNK, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def sliced(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``size`` bytes of text, whole rows each.

    Numbers beside every word take many times the memory of the text.
    """
    for batch in batches:
        ends = np.cumsum(np.append(0, pc.binary_length(batch.column(column)).fill_null(0)))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(ends, ends[i] + size, side="right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            yield batch.slice(i, j - i)
            i = j


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the words from start to end, in runs of about _CACHED bytes."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _CACHED, side="right")))
        out.append(_word_hash(data, start[i:j], end[i:j] - start[i:j], seed))
        i = j
    return np.concatenate(out)


def hashed_words(column: pa.Array | pa.ChunkedArray) -> Words:
    """All words of a string column with their hashes."""
    data, offsets = text_bytes(column)
    starts, ends = [], []
    for i, j in _slices(offsets):
        low, high = int(offsets[i]), int(offsets[j])
        if low == high:
            continue
        part = data[low:high]
        blank = _blank(part)
        edge = np.zeros(high - low + 1, dtype=bool)
        edge[offsets[i : j + 1] - low] = True
        before = np.concatenate([[True], blank[:-1]]) | edge[:-1]
        after = np.concatenate([blank[1:], [True]]) | edge[1:]
        start = np.flatnonzero(before & ~blank)
        end = np.flatnonzero(after & ~blank) + 1
        starts.append(start + low)
        ends.append(end + low)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return Words(
        data, offsets, np.searchsorted(start, offsets), start, end, _hashes(data, start, end, 0)
    )


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two sequences one after the other, from theirs."""
    both = mix(left + _ODD)
    both *= _ODD
    both += right
    return mix(both)


def _after(values: np.ndarray, n: int) -> np.ndarray:
    """The value ``n`` places on, or 0."""
    out = np.zeros_like(values)
    out[: max(len(values) - n, 0)] = values[n:]
    return out


def windows(words: Words, k: int) -> np.ndarray:
    """Hash of the k words from each word on; only starts that ``starts_of`` gives count."""
    step = max(_CACHED, k)
    parts = [_windows(words.hash[i : i + step + k], k)[:step] for i in range(0, len(words.hash), step)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _windows(hashes: np.ndarray, k: int) -> np.ndarray:
    # Doubling: k is put together from runs of 1, 2, 4, ... words.
    value, length, out, done = hashes, 1, None, 0
    while True:
        if k & length:
            out = value if out is None else _joined(out, _after(value, done))
            done += length
        if 2 * length > k:
            return out
        value = _joined(value, _after(value, length))
        length *= 2


def starts_of(words: Words, k: int) -> np.ndarray:
    """Words from which k words of the same text begin."""
    last = np.repeat(words.first[1:], np.diff(words.first))
    return np.flatnonzero(np.arange(len(words.hash)) + k <= last)
