"""A double-array trie over sequences of 64-bit word hashes, built and followed with numpy.

A state is a slot. From state ``s`` the word with number ``w`` leads to slot ``base[s] + w``, if that slot's ``check`` names ``s``.
Words are numbered by their place in the sorted array of all hashes of the trie.
"""

from __future__ import annotations

import numpy as np

_ROOT, _NONE = -2, -1


class Trie:
    """``paths``: one row per phrase, its word hashes from the left; ``lengths``: how many words each has."""

    def __init__(self, paths: np.ndarray, lengths: np.ndarray):
        self.depth = int(lengths.max()) if len(lengths) else 0
        present = np.arange(paths.shape[1]) < lengths[:, None]
        self.words, number = np.unique(paths[present], return_inverse=True)
        ids = np.full(paths.shape, -1, np.int64)
        ids[present] = number
        size = len(self.words) + 1
        self.base, self.check, self.accept = np.zeros(size, np.int32), np.full(size, _NONE, np.int32), np.full(size, -1, np.int32)
        self._free, self._low, self._open, self._top = np.ones(size, bool), 0, size - 1, size - 1
        state = ids[:, 0].copy()
        first = np.unique(state)
        self.check[first] = _ROOT
        self._free[first] = False
        self._end(state, lengths == 1)
        for k in range(1, self.depth):
            own = np.flatnonzero(lengths > k)
            key, where = np.unique((state[own] << 32) | ids[own, k], return_inverse=True)
            slots = self._place(key >> 32, key & 0xFFFFFFFF)
            state[own] = slots[where]
            self._end(state, lengths == k + 1)
        end = int(np.flatnonzero(self.check != _NONE).max(initial=-1)) + 1
        self.base, self.check, self.accept = self.base[:end].copy(), self.check[:end].copy(), self.accept[:end].copy()
        del self._free

    def _end(self, state: np.ndarray, here: np.ndarray) -> None:
        self.accept[state[here]] = np.flatnonzero(here)

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, len(self.base) * 5 // 4) - len(self.base)
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, _NONE, np.int32))
            self.accept = np.append(self.accept, np.full(more, -1, np.int32))
            self._free = np.append(self._free, np.ones(more, bool))

    def _place(self, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Slots for the children ``words`` of ``parents``; sorted by parent, then by word."""
        edge = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        many = np.diff(np.append(edge, len(parents)))
        slots = np.empty(len(parents), np.int64)
        for g in np.argsort(-many, kind="stable").tolist():
            m = int(many[g])
            if m == 1:
                break  # only single children are left
            own = slice(int(edge[g]), int(edge[g]) + m)
            base = self._find(words[own])
            at = base + words[own]
            self._free[at] = False
            self.check[at] = parents[own]
            self.base[parents[own.start]] = base
            self._top = max(self._top, int(at[-1]) + 1)
            slots[own] = at
        single = edge[many == 1]
        if len(single):
            free = np.flatnonzero(self._free)
            if len(free) < len(single):
                self._grow(len(self.base) + len(single))
                free = np.flatnonzero(self._free)
            at = free[: len(single)]
            self._free[at] = False
            self.check[at] = parents[single]
            self.base[parents[single]] = at - words[single]
            self._top = max(self._top, int(at[-1]) + 1)
            slots[single] = at
        return slots

    def _find(self, words: np.ndarray) -> int:
        """A base at which all of the words' slots are free: near the first free slot, in the open end, or beyond all."""
        low = self._low
        while low < len(self._free) and not self._free[low]:
            ahead = self._free[low : low + 4096]
            low += int(ahead.argmax()) if ahead.any() else len(ahead)
        self._low = low
        width = 512 if len(words) < 8 else 4096
        offsets = (words - words[0]).tolist()
        for start, tries in ((low, 4 if len(words) < 64 else 0), (self._open, 16)):
            for at in range(start, start + tries * width, width):
                self._grow(at + offsets[-1] + width)
                fits = self._free[at : at + width].copy()
                for i, x in enumerate(offsets[1:]):
                    fits &= self._free[at + x : at + x + width]
                    if i & 15 == 15 and not fits.any():
                        break
                hit = int(fits.argmax())
                if fits[hit]:
                    return at + hit - int(words[0])
        self._open = self._top
        self._grow(self._top + offsets[-1] + 1)
        return self._top - int(words[0])

    def follow(self, hashes: np.ndarray, number: np.ndarray, piece: np.ndarray):
        """For each level the accepted phrases: all positions of a text advance together, one word a level.

        The text's words are ``hashes[number]``; ``piece`` numbers the piece of each, and no phrase goes beyond its
        piece. Yields arrays of phrase numbers.
        """
        if not len(self.words) or not len(number):
            return
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        word = np.where(self.words[at] == hashes, at, -1)[number]
        place = np.flatnonzero(word >= 0)
        place = place[self.check[word[place]] == _ROOT]
        state = word[place]
        for k in range(self.depth):
            if k:
                ahead = place + k
                inside = ahead < len(word)
                place, state, ahead = place[inside], state[inside], ahead[inside]
                inside = (piece[ahead] == piece[place]) & (word[ahead] >= 0)
                place, state, ahead = place[inside], state[inside], ahead[inside]
                to = self.base[state] + word[ahead]
                inside = (to >= 0) & (to < len(self.check))
                inside[inside] = self.check[to[inside]] == state[inside]
                place, state = place[inside], to[inside]
            found = self.accept[state]
            yield found[found >= 0]
