"""A cache from short byte strings to lists of numbers that is searched for whole arrays of strings."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from vulnlake.llm.arrays import ragged

# Strings up to this length are keys of the table as two words; longer ones are keys of a dictionary.
WORDS = 16
# Odd multipliers for hashing.
SPREAD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class SliceTable:
    """`learn` gives the numbers of new strings, as bytes of 32-bit integers.

    The table has 2 ** `bits` places and starts anew when it is over half full. Slices come to it in parts of a quarter of
    its places at most, so it never fills, memory is bounded and the results never depend on what it holds.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], bits: int = 21):
        self.learn, self.bits = learn, bits
        self._clear()

    def _clear(self) -> None:
        n = 1 << self.bits
        self.low, self.high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.length, self.entry = np.zeros(n, np.uint8), np.full(n, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.known = 0
        self.first, self.size = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32)
        self.store, self.used = np.zeros(1 << 12, np.int32), 0

    def _add(self, new: list[bytes]) -> np.ndarray:
        """Numbers of the entries made for new strings."""
        learned = self.learn(new)
        flat = np.frombuffer(b"".join(learned), np.int32)
        sizes = np.fromiter(map(len, learned), np.int64, len(learned)) // 4
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while self.known + len(new) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        made = np.arange(self.known, self.known + len(new))
        self.store[self.used : self.used + len(flat)] = flat
        self.first[made] = self.used + np.cumsum(sizes) - sizes
        self.size[made] = sizes
        self.used += len(flat)
        self.known += len(new)
        return made

    def _find(self, low, high, length) -> tuple[np.ndarray, np.ndarray]:
        """(entries, -1 where there is none; the place where each was found or would go)"""
        place = (low * np.uint64(SPREAD[0])) ^ (high * np.uint64(SPREAD[1])) ^ (length.astype(np.uint64) * np.uint64(SPREAD[2]))
        place ^= place >> np.uint64(32)
        place = ((place * np.uint64(SPREAD[0])) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.entry[place]
        same = (self.low[place] == low) & (self.high[place] == high) & (self.length[place] == length)
        open_ = np.flatnonzero((out >= 0) & ~same)
        while len(open_):
            at = (place[open_] + 1) & ((1 << self.bits) - 1)
            place[open_] = at
            out[open_] = self.entry[at]
            same = (self.low[at] == low[open_]) & (self.high[at] == high[open_]) & (self.length[at] == length[open_])
            open_ = open_[(out[open_] >= 0) & ~same]
        return out, place

    def _short(self, joined: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        length = (stops - starts).astype(np.uint8)
        padded = joined + bytes(WORDS)
        words = np.ndarray((len(joined) + 8,), np.uint64, padded, 0, (1,))
        mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        low = words[starts] & mask[np.minimum(length, 8)]
        high = words[starts + 8 * (length > 8)] & mask[np.maximum(length, 8) - 8]
        found, _ = self._find(low, high, length)
        miss = np.flatnonzero(found < 0)
        if len(miss):
            distinct: dict[bytes, int] = {}
            which = [distinct.setdefault(joined[a:b], len(distinct)) for a, b in zip(starts[miss].tolist(), stops[miss].tolist())]
            which = np.array(which)
            made = self._add(list(distinct))
            found[miss] = made[which]
            one = np.zeros(len(distinct), np.int64)
            one[which] = miss
            left = one
            while len(left):  # of several that go to one place, one goes there now
                there, place = self._find(low[left], high[left], length[left])
                taken, first = np.unique(place, return_index=True)
                own = left[first]
                self.low[taken], self.high[taken], self.length[taken] = low[own], high[own], length[own]
                self.entry[taken] = found[own]
                left = np.delete(left, first)
        return found

    def ids(self, joined: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all slices of `joined`, which are in order, one after the other; how many each slice has)"""
        part = 1 << (self.bits - 2)
        if len(starts) <= part:
            return self._part(joined, starts, stops)
        out = []
        for k in range(0, len(starts), part):
            own, ends = starts[k : k + part], stops[k : k + part]
            out.append(self._part(joined[own[0] : ends[-1]], own - own[0], ends - own[0]))
        numbers, sizes = zip(*out)
        return np.concatenate(numbers), np.concatenate(sizes)

    def _part(self, joined: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.known > 1 << (self.bits - 1):
            self._clear()
        entries = np.zeros(len(starts), np.int64)
        short = stops - starts <= WORDS
        if short.any():
            entries[short] = self._short(joined, starts[short], stops[short])
        longer = np.flatnonzero(~short)
        if len(longer):
            own = [joined[a:b] for a, b in zip(starts[longer].tolist(), stops[longer].tolist())]
            new = [x for x in dict.fromkeys(own) if x not in self.long]
            if new:
                self.long.update(zip(new, self._add(new).tolist()))
            entries[longer] = [self.long[x] for x in own]
        sizes = self.size[entries].astype(np.int64)
        return self.store[ragged(self.first[entries], sizes)], sizes
