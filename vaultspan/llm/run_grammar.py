"""A run-length grammar by recompression, and longest common extensions on it.

Rounds alternate. Block compression replaces every maximal run a^k by one symbol;
pair compression deals the symbols into left and right ones and replaces every pair
of a left and a right symbol by one symbol (Jez, "Recompression: a simple and powerful
technique for word equations", 2013). Whether a phrase ends between two neighbouring
symbols depends on these two alone, so equal stretches are parsed alike but for their
ends, and two positions can climb the rounds together: what is left of a phrase that
was entered in its middle is compared, whole phrases are passed on to the next round.
After the first difference they go down again, one comparison a round. A query
takes as many steps as there are rounds, a logarithm of the length; all queries of a
call take each step at once.

Negative symbols are separators: each must occur once. They are never compressed, and
a sequence must begin and end with one, so that no extension leaves the sequence.
"""

from __future__ import annotations

import numpy as np

_SIDE = np.uint64(0x9E3779B97F4A7C15)


def _dealt(symbols: np.ndarray, turn: int) -> np.ndarray:
    """True for left symbols; the deal is a hash, another one in every round."""
    x = (symbols.astype(np.uint64) + np.uint64(2 * turn + 1)) * _SIDE
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)) & np.uint64(1) == 0


class _Round:
    """Symbols of a round, and the phrases that the next round has one symbol for."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols, self.blocks = symbols, blocks
        self.first = np.append(first, len(symbols))  # where each phrase begins
        begins = np.zeros(len(symbols), dtype=np.int64)
        begins[first] = 1
        self.phrase = np.cumsum(begins) - 1

    def mirrored(self) -> _Round:
        twin = object.__new__(_Round)
        twin.symbols, twin.blocks = self.symbols[::-1], self.blocks
        twin.first = len(self.symbols) - self.first[::-1]
        twin.phrase = len(self.first) - 2 - self.phrase[::-1]
        return twin


class RunGrammar:
    """Grammar of a sequence of int64 symbols; see the module for separators."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self._rounds: list[_Round] = []
        fresh = int(symbols.max(initial=0)) + 1
        separators = int((symbols < 0).sum())
        turn, stale = 0, 0
        # down to about a symbol between separators; what the last round leaves is compared one by one
        while len(symbols) > 2 * separators and stale < 8:
            for blocks in (True, False):
                before = len(symbols)
                symbols, fresh = self._block(symbols, fresh) if blocks else self._pair(symbols, fresh, turn)
                stale = 0 if len(symbols) < before else stale + 1
            turn += 1
        self._last = symbols
        self._back = [r.mirrored() for r in self._rounds]

    def _block(self, symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
        if len(first) == len(symbols):
            return symbols, fresh
        size = np.diff(np.append(first, len(symbols)))
        return self._replaced(symbols, first, np.flatnonzero(size > 1), size, fresh, True)

    def _pair(self, symbols: np.ndarray, fresh: int, turn: int) -> tuple[np.ndarray, int]:
        real, left = symbols >= 0, _dealt(symbols, turn)
        joined = (real & left)[:-1] & (real & ~left)[1:]
        if not joined.any():
            return symbols, fresh
        first = np.flatnonzero(np.append(True, ~joined))
        second = np.append(symbols, 0)[np.minimum(first + 1, len(symbols))]
        return self._replaced(symbols, first, np.flatnonzero(np.append(joined, False)[first]), second, fresh, False)

    def _replaced(
        self, symbols: np.ndarray, first: np.ndarray, which: np.ndarray, rest: np.ndarray, fresh: int, blocks: bool
    ) -> tuple[np.ndarray, int]:
        """The next round: phrases ``which`` get a symbol for (first symbol, rest), all others keep theirs."""
        self._rounds.append(_Round(symbols, first, blocks))
        following = symbols[first]
        low, high = following[which], rest[which]
        order = np.lexsort((high, low))
        changes = np.append(True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1]))
        names = np.empty(len(which), dtype=np.int64)
        names[order] = np.cumsum(changes) - 1
        following[which] = names + fresh
        return following, fresh + int(changes.sum())

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols are equal from ``i`` and from ``j`` on; i and j differ."""
        return self._extend(self._rounds, self._last, i, j)

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols are equal before ``i`` and before ``j``; i and j differ."""
        return self._extend(self._back, self._last[::-1], self.size - i, self.size - j)

    @staticmethod
    def _extend(rounds: list[_Round], last: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = i.astype(np.int64), j.astype(np.int64)
        differ = np.full(len(a), len(rounds))  # the round in which the symbols at a and b differ
        live = np.arange(len(a))
        for level, r in enumerate(rounds):
            x, y = a[live], b[live]
            left = np.minimum(r.first[r.phrase[x] + 1] - x, r.first[r.phrase[y] + 1] - y)
            inside = (r.first[r.phrase[x]] != x) | (r.first[r.phrase[y]] != y)
            step = np.where(inside & (r.symbols[x] == r.symbols[y]), left, 0)
            x, y = x + step, y + step
            up = (r.first[r.phrase[x]] == x) & (r.first[r.phrase[y]] == y)
            up &= ~inside | (step > 0)
            a[live], b[live] = np.where(up, r.phrase[x], x), np.where(up, r.phrase[y], y)
            differ[live[~up]] = level
            live = live[up]
        while len(live):
            live = live[last[a[live]] == last[b[live]]]
            a[live] += 1
            b[live] += 1
        for level in range(len(rounds) - 1, -1, -1):
            r, down = rounds[level], np.flatnonzero(differ > level)
            x, y = a[down], b[down]
            size = np.minimum(r.first[x + 1] - r.first[x], r.first[y + 1] - r.first[y]) if r.blocks else 1
            x, y = r.first[x], r.first[y]
            step = np.where(r.symbols[x] == r.symbols[y], size, 0)
            a[down], b[down] = x + step, y + step
        return a - i
