"""Vectorised words of Arrow text columns: positions and 64-bit hashes.

A task makes one :class:`Words` and feeds it text columns.  Texts are taken in
slices of about ``SLICE_BYTES`` (a longer text is a slice of its own), so memory
follows the slice, not the batch.  Hashes depend on the word's bytes alone:
equal words hash alike in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kiln.llm.common import worker_state

SLICE_BYTES = 1 << 20
SLICE_TEXTS = 2000
BASE = np.uint64(0x9E3779B97F4A7C15)            # odd, so invertible modulo 2**64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WORD_BASE = np.uint64(0xD1342543DE82EF95)
WORD_BASE_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))

#: Bytes that separate words: white space, or all ASCII but digits and letters.
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_ALNUM = np.array([b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return memory that earlier tasks of this Python worker have freed to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):              # another C library
        pass


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Slice:
    """Words of some consecutive texts.  ``first[i]:first[i+1]`` are text i's words."""

    def __init__(self, at: int, data, offsets, starts, ends, hashes, first):
        self.at, self.data, self.offsets = at, data, offsets
        self.starts, self.ends, self.hashes, self.first = starts, ends, hashes, first
        self.counts = np.diff(first)

    def __len__(self) -> int:
        return len(self.counts)

    def text_of(self) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))


class Words:
    def __init__(self, separators: np.ndarray = WHITE, lower: bool = True):
        worker_state().clear()                     # what another operator kept in this Python worker
        give_back()
        codes = np.arange(256)
        if lower:
            codes[65:91] += 32
        self.table = mix(codes.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        self.separators = separators[codes]
        self.up = self.down = np.ones(1, np.uint64)
        self.word_up = self.word_down = np.ones(1, np.uint64)

    def slices(self, texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
        """Slices of a text column in order; null texts have no words."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        for low in range(0, len(texts), SLICE_TEXTS):
            some = texts.slice(low, SLICE_TEXTS).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(some.buffers()[1], np.int64)[some.offset: some.offset + len(some) + 1]
            raw = some.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
            at = 0
            while at < len(some):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
                yield self.split(low + at, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at])
                at = to

    def split(self, at: int, data: np.ndarray, offsets: np.ndarray) -> Slice:
        n = len(data)
        apart = self.separators[data]
        before = np.empty(n + 1, bool)
        before[0], before[1:] = True, apart
        before[offsets] = True                     # no word crosses from text to text
        starts = np.flatnonzero(before[:-1] & ~apart)
        after = np.empty(n + 1, bool)
        after[:-1], after[-1] = apart, True
        after[offsets] = True
        ends = np.flatnonzero(after[1:] & ~apart) + 1
        if n > len(self.up):
            self.up, self.down = powers(BASE, n * 5 // 4), powers(BASE_INVERSE, n * 5 // 4)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)) if n else np.empty(0, np.uint64)
        return Slice(at, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))

    def windows(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of each run of k consecutive words; runs may cross texts, see ``Slice.left``."""
        return self.runs(hashes, np.arange(max(0, len(hashes) - k + 1)), k)

    def runs(self, hashes: np.ndarray, starts: np.ndarray, sizes) -> np.ndarray:
        """Hash of the run of ``sizes`` words from each start; equal runs of words hash alike."""
        n = len(hashes)
        if n > len(self.word_up):
            self.word_up, self.word_down = powers(WORD_BASE, n * 5 // 4), powers(WORD_BASE_INVERSE, n * 5 // 4)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.word_up[:n], out=sums[1:])
        return mix((sums[starts + sizes] - sums[starts]) * self.word_down[starts] + np.asarray(sizes).astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value in each run of ``width`` values (the leftmost of equals)."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        span += step
    return at


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of ``width`` that begins at one of ``starts``."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + width, n), -1)
    return np.cumsum(marks[:n]) > 0
