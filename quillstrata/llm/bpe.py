"""Byte-pair merges of many words at once.

All words lie in one flat array of symbols, each with the number of its word. A round finds the minimum rank of every
word's pairs by segment, merges the leftmost occurrences of that pair in all words together, and compacts the array;
words with no pair left leave it. The result is that of merging one pair at a time, best rank first and leftmost among
equals: where a merged symbol could take part in a pair of a rank as good (`hasty`), only a word's leftmost pair is merged.

A word of more than LONG symbols would be walked through by each of thousands of rounds. It has its rounds alone: the
places of its pairs lie by rank, links to the neighbours take the place of compaction, and a round touches what it merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

NONE = np.iinfo(np.int32).max
LONG = 2048


class MergeTable:
    """Ranks and results of pairs of symbols, sought by binary search over packed keys."""

    def __init__(self, size: int, pairs: Iterable[tuple[int, int, int, int]]):
        """size: number of symbols; pairs: (left, right, rank, result), the least rank merged first."""
        table = np.array(sorted(pairs), np.int64).reshape(-1, 4)
        self.size = size
        self.keys = table[:, 0] * size + table[:, 1]
        self.rank, self.result = table[:, 2].astype(np.int32), table[:, 3].astype(np.int32)
        best = np.full(size + 1, NONE, np.int64)
        np.minimum.at(best, table[:, 0], table[:, 2])
        np.minimum.at(best, table[:, 1], table[:, 2])
        self.hasty = best[self.result] <= self.rank

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table, -1 if it isn't there. Symbols of size or more are in no pair."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left < self.size) & (right < self.size), at, -1)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """symbols and the number of the word of each, ascending, when no pair is left."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if len(symbols) > LONG:
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(symbols)])
            for at, n in zip(first[size > LONG].tolist(), size[size > LONG].tolist(), strict=True):
                own = self.merge_long(symbols[at : at + n])
                done.append((own, np.full(len(own), word[at])))
            short = np.repeat(size <= LONG, size)
            symbols, word = symbols[short], word[short]
        at = self._pairs(symbols, word)
        while len(symbols):
            rank = np.where(at >= 0, self.rank[at], NONE) if len(self.rank) else np.full(len(at), NONE)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(symbols)])
            live = np.repeat(least != NONE, size)
            if not live.all():
                done.append((symbols[~live], word[~live]))
                symbols, word, at, rank = symbols[live], word[live], at[live], rank[live]
                size, least = size[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
            chosen = rank == np.repeat(least, size)
            # of pairs that overlap, every other one from the left
            place = np.arange(len(chosen))
            run = place - np.maximum.accumulate(np.where(chosen, -1, place))
            chosen &= run % 2 == 1
            hit = np.flatnonzero(chosen)
            if (hasty := self.hasty[at[hit]]).any():
                again = np.r_[False, word[hit[1:]] == word[hit[:-1]]]
                chosen[hit[hasty & again]] = False
                hit = np.flatnonzero(chosen)
            symbols[hit] = self.result[at[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            fresh = np.zeros(len(symbols), bool)
            fresh[hit] = True
            symbols, word, at, fresh = symbols[stay], word[stay], at[stay], fresh[stay]
            fresh[:-1] |= fresh[1:]
            at[fresh] = self._pairs(symbols, word, np.flatnonzero(fresh))
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The symbols of one word when no pair is left."""
        n, symbols = len(symbols), symbols.copy()
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        pair = np.append(self.find(symbols[:-1], symbols[1:]), -1)
        places: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def lay(at: np.ndarray) -> None:
            at = at[pair[at] >= 0]
            rank = self.rank[pair[at]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part in np.split(at, cuts) if len(at) else ():
                r = int(self.rank[pair[part[0]]])
                if r not in places:
                    heapq.heappush(ranks, r)
                places.setdefault(r, []).append(part)

        lay(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[alive[at] & (pair[at] >= 0)]
            at = at[self.rank[pair[at]] == r]
            if not len(at):
                continue
            turn = np.arange(len(at))
            run = turn - np.maximum.accumulate(np.where(np.r_[True, after[at[:-1]] != at[1:]], turn, 0))
            hit = at[run % 2 == 0]
            if (hasty := self.hasty[pair[hit]]).any():
                hasty[0] = False
                hit = hit[~hasty]
            right = after[hit]
            symbols[hit] = self.result[pair[hit]]
            alive[right] = False
            after[hit] = after[right]
            inner = hit[after[hit] < n]
            before[after[inner]] = inner
            changed = np.unique(np.concatenate([hit, before[hit]]))
            changed = changed[changed >= 0]
            pair[changed] = -1
            inner = changed[after[changed] < n]
            pair[inner] = self.find(symbols[inner], symbols[after[inner]])
            lay(changed)
            left = at[~np.isin(at, changed)]
            if len(left):
                lay(left[alive[left]])
        return symbols[alive]

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """For each symbol (of those places) the pair with its right neighbour in the word."""
        places = np.arange(len(symbols)) if places is None else places
        out = np.full(len(places), -1)
        inner = places < len(symbols) - 1
        inner[inner] = word[places[inner]] == word[places[inner] + 1]
        p = places[inner]
        out[inner] = self.find(symbols[p], symbols[p + 1])
        return out
