"""A compressed full-text index of a collection of texts, and matching statistics of other texts against it.

The collection's suffixes are sorted, each text ended by a terminator of its own. Kept are the Burrows-Wheeler transform, as a
wavelet matrix of packed bits with counts for every 64 of them, and of the suffixes' common prefixes, up to ``depth``, the
runs that share ``depth`` symbols with the values between them. Searches go backward, one symbol of every pattern at a time:
the interval of suffixes that begin with the match so far is narrowed by two ranks; where nothing is left, the match is
shortened to that of the interval's parent, the next longer interval, until it can be extended. A match is cut at ``depth``.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class _Wavelet:
    """Ranks in a sequence of symbols: a level of bits for each bit of a symbol, the highest first."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.width = max(1, (size - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        rest, n = symbols, len(symbols)
        for level in range(self.width - 1, -1, -1):
            bit = (rest >> level) & 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: -(-n // 8)] = np.packbits(bit.astype(bool), bitorder="little")
            packed = packed.view("<u8")
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]))
            self.zeros.append(n - int(bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        # where a symbol's own places begin, in the order that the last level leaves
        order = np.arange(size)
        back = np.zeros(size, np.int64)
        for level in range(self.width):
            back = (back << 1) | ((order >> level) & 1)
        counts = np.bincount(symbols, minlength=size)
        by = np.argsort(back, kind="stable")
        self.begins = np.empty(size, np.int64)
        self.begins[by] = np.cumsum(counts[by]) - counts[by]

    def ranks(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is before each place, from where the symbol begins."""
        for k, level in enumerate(range(self.width - 1, -1, -1)):
            word = at >> 6
            ones = self.before[k][word] + np.bitwise_count(self.bits[k][word] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE))
            at = np.where((symbols >> level) & 1, self.zeros[k] + ones, at - ones)
        return at - self.begins[symbols]


def _sorted_suffixes(line: np.ndarray, left: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The order of all suffixes, and for widths 1, 2, 4, ... the ranks of the strings of that many symbols. ``left`` is how
    many symbols there are from each place to the end of its text, terminator included."""
    ranks, width, rank = [], 1, line.astype(np.int64)
    while True:
        ranks.append((width, rank.astype(np.int32)))
        if width >= longest:
            return np.argsort(rank, kind="stable"), ranks
        second = np.zeros(len(line), np.int64)
        inside = np.flatnonzero(left > width)
        second[inside] = rank[inside + width] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(line), np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
        width *= 2


class FMIndex:
    """``texts`` one after the other as symbols from 1 up to below ``size``, of ``sizes``; each has a number, its owner."""

    def __init__(self, texts: np.ndarray, sizes: np.ndarray, owners: np.ndarray, size: int, depth: int):
        many, n = len(sizes), len(texts) + len(sizes)
        ends = np.cumsum(sizes + 1)
        line = np.zeros(n, np.int64)
        real = np.ones(n, bool)
        real[ends - 1] = False
        line[real] = texts
        which = np.repeat(np.arange(many), sizes + 1)
        left = ends[which] - np.arange(n)
        order, ranks = _sorted_suffixes(line, left, int(sizes.max(initial=0)) + 1)
        begins = np.zeros(n, bool)
        begins[ends - sizes - 1] = True
        self.n, self.depth = n, depth
        self.wavelet = _Wavelet(np.where(begins[order], 0, line[order - 1]), size)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=size))[:-1]])
        # common prefixes of neighbours, up to depth: by halves of the greatest width, as far as both texts go
        common = np.zeros(n, np.int64)
        a, b = order[:-1], order[1:]
        most = np.minimum(np.minimum(left[a], left[b]) - 1, depth)
        got = np.zeros(len(a), np.int64)
        for width, rank in reversed(ranks):
            more = np.flatnonzero(got + width <= most)
            same = more[rank[a[more] + got[more]] == rank[b[more] + got[more]]]
            got[same] += width
        common[1:] = np.minimum(got, most)
        common[:1] = -1
        starts = np.flatnonzero(common < depth)
        self.run = np.append(np.cumsum(common < depth) - 1, len(starts))
        self.starts = np.append(starts, n)
        self.common = np.append(common[starts], -1)
        self.before, self.after = _smaller_beside(self.common)
        self.least = np.minimum.reduceat(owners[which[order]], starts) if n else np.zeros(0, owners.dtype)

    def _parents(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next longer intervals, in runs, and how many symbols their suffixes share."""
        p = np.where(self.common[low] >= self.common[high], low, high)
        return self.before[p], self.after[p], np.maximum(self.common[p], 0)

    def matching_statistics(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the patterns how many symbols from there on, ``depth`` at most, are somewhere in the collection, and,
        where these are ``depth``, the least owner of a text that has them (else -1). Symbols unknown to the collection are 0."""
        ends = np.cumsum(sizes)
        length, owner = np.zeros(len(patterns), np.int64), np.full(len(patterns), -1, np.int64)
        runs = len(self.starts) - 1
        low, high, match = np.zeros(len(sizes), np.int64), np.full(len(sizes), runs), np.zeros(len(sizes), np.int64)
        for step in range(1, int(sizes.max(initial=0)) + 1):
            open_ = np.flatnonzero(sizes >= step)
            symbol = patterns[ends[open_] - step]
            gone = open_[symbol == 0]
            low[gone], high[gone], match[gone] = 0, runs, 0
            open_, symbol = open_[symbol > 0], symbol[symbol > 0]
            while len(open_):
                both = self.wavelet.ranks(np.concatenate([symbol, symbol]), self.starts[np.concatenate([low[open_], high[open_]])])
                a, z = self.first[symbol] + both[: len(open_)], self.first[symbol] + both[len(open_) :]
                fits = a < z
                some = open_[fits]
                low[some], high[some] = self.run[a[fits]], self.run[z[fits] - 1] + 1
                match[some] = np.minimum(match[some] + 1, self.depth)
                # what can't be extended by the symbol is shortened, unless nothing is matched
                rest = ~fits & (match[open_] > 0)
                open_, symbol = open_[rest], symbol[rest]
                low[open_], high[open_], match[open_] = self._parents(low[open_], high[open_])
            open_ = np.flatnonzero(sizes >= step)
            at = ends[open_] - step
            length[at] = match[open_]
            full = match[open_] == self.depth
            owner[at[full]] = self.least[low[open_][full]]
        return length, owner


def _smaller_beside(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before it, and the first one after it, that has a smaller value; its own where none has."""
    n = len(values)
    at = np.arange(n)
    before, after = at.copy(), at.copy()
    for v in np.unique(values).tolist():
        here = np.flatnonzero(values == v)
        last = np.maximum.accumulate(np.where(values < v, at, -1))[here]
        next_ = np.minimum.accumulate(np.where(values < v, at, n)[::-1])[::-1][here]
        before[here], after[here] = np.where(last >= 0, last, here), np.where(next_ < n, next_, here)
    return before, after
