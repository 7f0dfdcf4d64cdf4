"""A compressed full-text index over sequences of integers, and matching statistics against it.

The Burrows-Wheeler transform is kept in a wavelet matrix (one packed bit vector with block
ranks per level); a batch of patterns is searched backwards in lock step, each step one set of
vectorised rank queries. When no longer match exists, a pattern falls back to the enclosing
interval of the next smaller common prefix, so all its matching statistics come from one pass.
"""

from __future__ import annotations

import numpy as np

from perfkit.llm.common import ship


class WaveletMatrix:
    """Rank of any symbol in any prefix of an integer sequence."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        begin = np.zeros(sigma, dtype=np.int64)
        all_symbols = np.arange(sigma)
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view(np.uint64)
            counts = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(int(len(bits) - bits.sum()))
            begin = self._down(len(self.words) - 1, begin, (all_symbols >> level) & 1)
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.begin = begin  # where each symbol starts below the last level

    def _down(self, i: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        block = at >> 6
        inside = self.words[i][block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        ones = self.before[i][block] + np.bitwise_count(inside)
        return np.where(bit == 1, self.zeros[i] + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[i] before position at[i]."""
        for i in range(self.levels):
            at = self._down(i, at, (symbol >> (self.levels - 1 - i)) & 1)
        return at - self.begin[symbol]


class FMIndex:
    """Index of several sequences; symbols are 1..sigma-1, and 0 stands for a sequence's end."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, sigma: int):
        """``symbols``: the sequences one after another."""
        ends = np.cumsum(lengths + 1) - 1  # every sequence is followed by an end mark of its own
        n = len(symbols) + len(lengths)
        is_end = np.zeros(n, dtype=bool)
        is_end[ends] = True
        text = np.zeros(n, dtype=np.int64)
        text[~is_end] = symbols
        self.source = np.repeat(np.arange(len(lengths)), lengths + 1)
        rank = np.where(is_end, np.cumsum(is_end) - 1, text + len(lengths))
        ranks, depth = [rank], 1
        self.order = np.argsort(rank, kind="stable")
        while depth <= int(lengths.max(initial=0)):  # end marks differ: no longer prefix can be shared
            after = np.full(n, -1, dtype=np.int64)
            after[:n - depth] = rank[depth:]
            pair = rank * (n + sigma + len(lengths) + 1) + after + 1
            self.order = np.argsort(pair, kind="stable")
            new = np.ones(n, dtype=bool)
            new[1:] = np.diff(pair[self.order]) != 0
            rank = np.empty(n, dtype=np.int64)
            rank[self.order] = np.cumsum(new) - 1
            ranks.append(rank)
            depth *= 2
        bwt = text[self.order - 1]
        self.wavelet = WaveletMatrix(bwt, sigma)
        self.first = len(lengths) + np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])[:sigma]
        self.sigma, self.n = sigma, n
        self._prefixes(ranks)

    def _prefixes(self, ranks: list[np.ndarray]) -> None:
        """Common prefix of each suffix with the one before, and the nearest smaller on either side."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            inside = (a < self.n) & (b < self.n)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
            step = same.astype(np.int64) << k
            a, b, common = a + step, b + step, common + step
        self.lcp = np.concatenate([[-1], common, [-1]])
        self.above = self._nearest_smaller(self.lcp)
        self.below = len(self.lcp) - 1 - self._nearest_smaller(self.lcp[::-1])[::-1]

    @staticmethod
    def _nearest_smaller(values: np.ndarray) -> np.ndarray:
        """Index of the nearest smaller entry to the left, by pointer jumping (0 at the border)."""
        at = np.maximum(np.arange(len(values)) - 1, 0)
        todo = np.arange(len(values))
        while True:
            todo = todo[(values[at[todo]] >= values[todo]) & (at[todo] > 0)]
            if not len(todo):
                return at
            at[todo] = at[at[todo]]

    def matching_statistics(self, patterns: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every pattern position: the length of the longest match that starts there, and one
        place of it in the suffix order. Symbol 0 in a pattern matches nothing."""
        length = np.zeros(len(patterns), dtype=np.int64)
        place = np.zeros(len(patterns), dtype=np.int64)
        stop = offsets[:-1]
        at = offsets[1:] - 1
        lo = np.zeros(len(stop), dtype=np.int64)
        hi = np.full(len(stop), self.n, dtype=np.int64)
        depth = np.zeros(len(stop), dtype=np.int64)
        live = np.flatnonzero(at >= stop)
        while len(live):
            c = patterns[at[live]]
            both = self.wavelet.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            base = self.first[c]
            new_lo, new_hi = base + both[:len(c)], base + both[len(c):]
            found = (new_lo < new_hi) & (c > 0)
            good = live[found]
            lo[good], hi[good] = new_lo[found], new_hi[found]
            depth[good] += 1
            length[at[good]], place[at[good]] = depth[good], lo[good]
            at[good] -= 1
            rest = live[~found]
            alone = rest[depth[rest] == 0]
            at[alone] -= 1  # the symbol does not occur at all
            cut = rest[depth[rest] > 0]
            edge = np.where(self.lcp[lo[cut]] >= self.lcp[hi[cut]], lo[cut], hi[cut])
            depth[cut] = np.maximum(self.lcp[edge], 0)
            whole = depth[cut] == 0
            lo[cut] = np.where(whole, 0, self.above[edge])
            hi[cut] = np.where(whole, self.n, self.below[edge])
            live = live[at[live] >= stop[live]]
        return length, place

    def least_per_class(self, values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes with equal prefixes of ``length`` form classes: (class of each place, least value
        of the class), for one value per sequence."""
        new = self.lcp[:self.n] < length
        new[0] = True
        first = np.flatnonzero(new)
        return np.cumsum(new) - 1, np.minimum.reduceat(values[self.source[self.order]], first)


ship(__name__)
