"""A compressed FM-index over words: suffix array by doubling, wavelet matrix, backward search in lockstep."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of an integer text in the order of their first ``depth`` symbols at least (0 is smallest)."""
    rank, span, n = text.astype(np.int64), 1, len(text)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - span] = rank[span:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        span *= 2
        if span >= depth or new.all():
            return order


class Bits:
    """Packed bits with a count of ones before each 64 of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed.view(np.uint8)[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1].astype(np.uint32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block].astype(np.int64) + np.bitwise_count(self.words[block] & low)


class FMIndex:
    """Occurrences of word sequences in a text of symbols from 0 to sigma - 1."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        order = suffix_array(text, depth)
        symbols = text[order - 1]                                   # the Burrows-Wheeler transform
        self.size = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:-1]
        self.levels = []
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit), int((~bit).sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.base = self.rank(np.arange(sigma), np.zeros(sigma, np.int64))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` goes in the last level on the way of ``symbol``."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Rows of the suffixes that begin with a symbol and go on as those in [low, high)."""
        shift = self.first[symbol] - self.base[symbol]
        return shift + self.rank(symbol, low), shift + self.rank(symbol, high)


def repeated_windows(text: np.ndarray, sigma: int, starts: np.ndarray, ends: np.ndarray, width: int):
    """Runs of windows that occur twice or more in the text: (stream, first window's start, number of windows).

    Streams [start, end) of the text are searched side by side.  A window is matched from
    its last word backwards; when a suffix of it turns out to be unique, every window that
    holds it is, and the search goes on behind.  After a window that repeats, longer and
    longer stretches are tried at once, by halves of what is left of the stream.
    """
    index = FMIndex(text, sigma, width + int((ends - starts).max(initial=width)))
    lane = np.flatnonzero(ends - starts >= width)
    s, end, more = starts[lane].copy(), ends[lane], np.zeros(len(lane), np.int64)
    at = s + width
    low, high = np.zeros(len(lane), np.int64), np.full(len(lane), index.size)
    found = []
    while len(lane):
        low, high = index.extend(text[at - 1], low, high)
        at = at - 1
        failed = high - low < 2
        done = ~failed & (at == s)
        if done.any():
            found.append((lane[done], s[done], more[done] + 1))
        single, several = more == 0, more > 0
        left = end - width - s                                      # windows after this one
        rest = done & single & (left > 0)                           # a window repeats: try all that is left
        half = failed & several & (more > 1)                        # a stretch does not: try half of it
        next_s = np.where(failed & single, at + 1, np.where(done & ~rest, s + more + 1, np.where(failed & several & (more == 1), s + 1, s)))
        more = np.where(rest, left, np.where(half, more // 2, np.where(failed | done, 0, more)))
        again = failed | done
        s = next_s
        at = np.where(again, s + width + more, at)
        low, high = np.where(again, 0, low), np.where(again, index.size, high)
        alive = s + width <= end
        if not alive.all():
            lane, s, end, more, at, low, high = (x[alive] for x in (lane, s, end, more, at, low, high))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))
