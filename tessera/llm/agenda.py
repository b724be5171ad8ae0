"""Merging of many words at once, each with its own agenda of adjacent symbol pairs."""

from __future__ import annotations

import numpy as np

NEVER = 1 << 30  # rank of a pair that makes nothing


class PairAgendas:
    """Merges by rank: ``pairs`` are ``(left symbol, right symbol, rank, product)``."""

    def __init__(self, n_symbols: int, pairs: list[tuple[int, int, int, int]]):
        self.n_symbols = n_symbols
        rows = np.array(sorted((a * n_symbols + b, r, m) for a, b, r, m in pairs),
                        dtype=np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.makes = (np.ascontiguousarray(rows[:, k]) for k in range(3))

    def _rank(self, owner: np.ndarray, sym: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that begin at these places."""
        after = np.minimum(at + 1, len(sym) - 1)
        keys = sym[at] * self.n_symbols + sym[after]
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[found] == keys) & (after > at) & (owner[at] == owner[after])
        return np.where(known, self.ranks[found], NEVER), self.makes[found]

    def merge(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge words given as one run of symbols and the size of each word (none empty).

        Each step takes the best pair (lowest rank, then leftmost) off every
        agenda.  Returns the word, the symbol and the first place in ``sym`` of
        each symbol that is left, in order.
        """
        owner, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(sym))
        if not len(self.keys):
            return owner, sym, place
        ended: list[tuple[np.ndarray, ...]] = []
        rank, makes = self._rank(owner, sym, place)
        sym = sym.copy()
        while len(sym):
            first = np.ones(len(owner), dtype=bool)
            first[1:] = owner[1:] != owner[:-1]
            starts = np.flatnonzero(first)
            best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), starts)
            live = best >> 32 < NEVER
            at = best[live] & 0xFFFFFFFF
            if not live.all():  # words whose agenda is empty
                over = np.repeat(~live, np.diff(np.append(starts, len(sym))))
                ended.append((owner[over], sym[over], place[over]))
                kept = ~over
                at = (np.cumsum(kept) - 1)[at]
                owner, sym, place, rank, makes = (x[kept] for x in (owner, sym, place, rank, makes))
            if not len(at):
                break
            sym[at] = makes[at]
            kept = np.ones(len(sym), dtype=bool)
            kept[at + 1] = False
            owner, sym, place, rank, makes = (x[kept] for x in (owner, sym, place, rank, makes))
            at = at - np.arange(len(at))  # one symbol is gone from each word before it
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near], makes[near] = self._rank(owner, sym, near)
        owner, sym, place = (np.concatenate(x) for x in zip(*ended))
        order = np.argsort(place)
        return owner[order], sym[order], place[order]
