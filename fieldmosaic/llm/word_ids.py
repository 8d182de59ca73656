"""Token ids of all words of a batch of texts at once, out of a table that a tokenizer library fills."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from fieldmosaic.llm.common import mix, powers

SLOTS = 1 << 21  # of the table of a worker, if not given; it starts anew when half of them are taken
FLAT = 1 << 23  # ids it holds at most before it starts anew
HASHED = 64  # characters; longer words are encoded each time they occur


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class WordIds:
    """Open addressing by 64-bit word hashes; `encode` turns a list of words into a list of id lists."""

    def __init__(self, encode: Callable[[list[str]], list], slots: int = SLOTS):
        self.encode, self.least = encode, slots
        self.clear()

    def clear(self, words: int = 0) -> None:
        """An empty table that has room for so many words."""
        self.slots = max(self.least, 2 << int(words).bit_length())
        self.keys, self.words = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self.flat, self.first = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        self.size = 0  # words; the ids of word k are flat[first[k] : first[k + 1]]

    def _find(self, codes: np.ndarray) -> np.ndarray:
        found = np.full(len(codes), -1, np.int64)
        at, todo = (codes & np.uint64(self.slots - 1)).astype(np.int64), np.arange(len(codes))
        while len(todo):
            keys = self.keys[at]
            hit = keys == codes[todo]
            found[todo[hit]] = self.words[at[hit]]
            go = ~hit & (keys != 0)
            todo, at = todo[go], (at[go] + 1) & (self.slots - 1)
        return found

    def _insert(self, codes: np.ndarray, words: np.ndarray) -> None:
        at, todo = (codes & np.uint64(self.slots - 1)).astype(np.int64), np.arange(len(codes))
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = codes[todo[free]]
            won = self.keys[at] == codes[todo]
            self.words[at[won]] = words[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & (self.slots - 1)

    def _add(self, ids: list) -> np.ndarray:
        """Numbers of new words with these ids."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        fresh = np.concatenate([np.asarray(x, np.int32) for x in ids])
        start, past = int(self.first[self.size]), self.size + len(ids)
        while start + len(fresh) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while past + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.flat[start : start + len(fresh)] = fresh
        self.first[self.size + 1 : past + 1] = start + np.cumsum(sizes)
        numbers, self.size = np.arange(self.size, past), past
        return numbers

    def ids(self, text: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids before each word and in all)."""
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        if self.size > self.slots // 2 or self.size + len(starts) > self.slots // 4 * 3 or self.first[self.size] > FLAT:
            self.clear(len(starts))
        up, down = powers(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) * up[: len(codes)], out=sums[1:])
        sizes = ends - starts
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + sizes.astype(np.uint64)) | np.uint64(1)
        words = self._find(hashes)
        long = sizes > HASHED
        words[long] = -1
        new = np.flatnonzero((words < 0) & ~long)
        if len(new):
            distinct, where = np.unique(hashes[new], return_index=True)
            spots = new[where]
            self._insert(distinct, self._add(self.encode([text[a:b] for a, b in zip(starts[spots].tolist(), ends[spots].tolist())])))
            words[new] = self._find(hashes[new])
        if long.any():
            words[long] = self._add(self.encode([text[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist())]))
        begins, counts = self.first[words], self.first[words + 1] - self.first[words]
        upto = np.zeros(len(words) + 1, np.int64)
        np.cumsum(counts, out=upto[1:])
        return self.flat[np.repeat(begins - upto[:-1], counts) + np.arange(upto[-1])], upto
