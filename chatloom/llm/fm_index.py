"""A compressed FM-index over short word sequences, in numpy.

The sequences of a shard are concatenated with separators; the Burrows-Wheeler transform of the
concatenation is kept in a wavelet matrix (one packed bit vector with block ranks per bit of the
alphabet). Searches run for many sequences at once, one backward step each per round.
"""
from __future__ import annotations

import numpy as np


class BitRank:
    """A packed bit vector with the number of ones before each 64-bit block."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(n // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1]))
        self.zeros = n - int(ones.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones in [0, i) for each i."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """``sequences``: int arrays over 1..alphabet-1 (0 is the separator); ``owner``: a number per
    sequence (the id of its first document, ranked)."""

    def __init__(self, sequences: list[np.ndarray], owner: np.ndarray, alphabet: int):
        count = len(sequences)
        text = np.concatenate([np.concatenate((s, [0])) for s in sequences]).astype(np.int64)
        ends = np.cumsum([len(s) + 1 for s in sequences]) - 1
        # separators sort by their place, so no comparison runs past one
        first = text + count
        first[ends] = np.arange(count)
        order = self.suffixes(first)
        self.size = len(text)
        bwt = text[order - 1]                     # place 0 is preceded by the last separator
        self.levels = []
        current = bwt
        self.bits = max(1, int(alphabet - 1).bit_length())
        for shift in range(self.bits - 1, -1, -1):
            bit = (current >> shift) & 1
            self.levels.append(BitRank(bit.astype(np.uint8)))
            current = np.concatenate((current[bit == 0], current[bit == 1]))
        counts = np.bincount(bwt, minlength=alphabet)
        self.smaller = np.concatenate(([0], np.cumsum(counts)[:-1]))
        symbols = np.arange(alphabet)
        self.base = self.descend(symbols, np.zeros(alphabet, np.int64))
        # least owner in a suffix range: a sparse table of minima over power-of-two ranges
        which = np.searchsorted(ends, order)
        self.minima = [owner[which].astype(np.int32)]
        while 2 ** len(self.minima) <= self.size:
            last, half = self.minima[-1], 2 ** (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def suffixes(first: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n = len(first)
        rank = np.unique(first, return_inverse=True)[1].astype(np.int64)
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = new
            step *= 2
            if rank[order[-1]] == n - 1 or step >= n:
                return order

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Places mapped through all levels along each symbol's bits."""
        for level, shift in zip(self.levels, range(self.bits - 1, -1, -1)):
            ones = level.ones(place)
            place = np.where((symbol >> shift) & 1, level.zeros + ones, place - ones)
        return place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Suffix ranges after one backward step by ``symbol``."""
        shift = self.smaller[symbol] - self.base[symbol]
        both = self.descend(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        n = len(symbol)
        return both[:n] + shift, both[n:] + shift

    def least_owner(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least owner in each non-empty range."""
        span = high - low
        level = np.frexp(span.astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int32)
        for k in np.unique(level):
            at = level == k
            table = self.minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out

    def earlier_matches(self, sequences: list[np.ndarray], owner: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
        """For each sequence, maximal intervals of ``least`` words or more that also occur in a
        sequence of a smaller owner (matching statistics above the threshold, as intervals).

        All sequences are searched in step. A search runs backward from an end and stops at the
        first word that leaves no earlier owner; no later interval can hold that word and that end,
        so the next search ends one word before, or where an interval of ``least`` words that starts
        at that word would end.
        """
        out: list[list[tuple[int, int]]] = [[] for _ in sequences]
        lengths = np.array([len(s) for s in sequences], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        flat = np.concatenate(sequences) if sequences else np.zeros(0, np.int64)
        live = np.flatnonzero(lengths >= least)
        end = lengths[live].copy()
        at = end.copy()
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        while len(live):
            symbol = flat[starts[live] + at - 1]
            new_low, new_high = self.extend(symbol, low, high)
            good = new_low < new_high
            idx = np.flatnonzero(good)
            good[idx] = self.least_owner(new_low[idx], new_high[idx]) < owner[live[idx]]
            at = np.where(good, at - 1, at)
            low, high = np.where(good, new_low, 0), np.where(good, new_high, self.size)
            stop = ~good | (at == 0)
            for k in np.flatnonzero(stop & (end - at >= least)).tolist():
                out[live[k]].append((int(at[k]), int(end[k])))
            next_end = np.where(good, 0, np.minimum(end - 1, at - 1 + least))
            end = np.where(stop, next_end, end)
            at = np.where(stop, end, at)
            low, high = np.where(stop, 0, low), np.where(stop, self.size, high)
            keep = ~stop | (end >= least)
            live, end, at, low, high = live[keep], end[keep], at[keep], low[keep], high[keep]
        return out
