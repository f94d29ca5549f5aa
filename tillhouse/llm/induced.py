"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as S (smaller than the next suffix) or L, the leftmost S suffix of each run (LMS) is sorted
first, and all others are induced from those: one sweep up for L, one down for S. A sweep goes bucket by bucket; in a
bucket it moves in waves, so each step is an array operation. LMS suffixes are ordered by the recursion of the method:
the substrings between them are sorted by the same two sweeps, named, and the string of names is sorted in turn. When
that string has more symbols than a bucket sweep is good for, its suffixes are ranked by doubling.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> np.ndarray:
    """True where a suffix is of type S. The end of the string counts as smaller than any symbol."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64), append=-1))  # >0: rises, S
    at = np.where(step != 0, np.arange(n), n - 1)
    nxt = np.minimum.accumulate(at[::-1])[::-1]  # next place where the symbol changes
    return step[nxt] > 0


def _place(sa: np.ndarray, room: np.ndarray, symbols: np.ndarray, items: np.ndarray, down: bool) -> None:
    """Append ``items`` to their buckets in the given order; ``room`` is each bucket's next free place."""
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    counts = np.bincount(symbols, minlength=len(room))
    rank = np.arange(len(items)) - (np.cumsum(counts) - counts)[sorted_symbols]
    if down:
        sa[room[sorted_symbols] - rank] = items[order]
        room -= counts
    else:
        sa[room[sorted_symbols] + rank] = items[order]
        room += counts


def induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The order of all suffixes, given the LMS positions in (some) order: one sweep up, one down."""
    n = len(s)
    sizes = np.bincount(s, minlength=symbols)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    sa = np.full(n, -1, np.int32)

    per = np.bincount(s[lms], minlength=symbols)
    seeds = lms[np.argsort(s[lms], kind="stable")]
    seed_at = np.cumsum(per) - per

    # sweep up: suffix i of type L stands behind suffix i + 1, in the order of the latter
    room = heads.copy()
    if n and not is_s[n - 1]:
        sa[room[s[n - 1]]] = n - 1
        room[s[n - 1]] += 1
    for c in np.flatnonzero(sizes):
        done = heads[c]
        while done < room[c]:
            wave = sa[done : room[c]]
            done = room[c]
            prev = wave[wave > 0] - 1
            prev = prev[~is_s[prev]]
            if len(prev):
                _place(sa, room, s[prev], prev, False)
        wave = seeds[seed_at[c] : seed_at[c] + per[c]]
        prev = wave[wave > 0] - 1
        prev = prev[~is_s[prev]]
        if len(prev):
            _place(sa, room, s[prev], prev, False)

    # sweep down: suffix i of type S stands before suffix i + 1
    l_end = room
    room = ends - 1
    for c in np.flatnonzero(sizes)[::-1]:
        done = ends[c] - 1
        while done > room[c]:
            wave = sa[room[c] + 1 : done + 1][::-1]
            done = room[c]
            prev = wave[wave > 0] - 1
            prev = prev[is_s[prev]]
            if len(prev):
                _place(sa, room, s[prev], prev, True)
        wave = sa[heads[c] : l_end[c]][::-1]
        prev = wave[wave > 0] - 1
        prev = prev[is_s[prev]]
        if len(prev):
            _place(sa, room, s[prev], prev, True)
    return sa


def _doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` by their first ``depth`` symbols; settled suffixes are not touched again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = names[order[1:]] != names[order[:-1]]
    rank = np.empty(n, np.int64)
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = first
    have = 1
    while have < depth:
        tied = ~fresh | ~np.append(fresh[1:], True)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        items = order[slots]
        behind = items + have
        key = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        group = rank[items]
        again = np.lexsort((key, group))
        items, key, group = items[again], key[again], group[again]
        order[slots] = items
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        fresh[slots] = new
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[items] = first[slots]
        have *= 2
    return order


def suffix_array(s: np.ndarray, symbols: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of ``s`` (values below ``symbols``).

    With ``depth``, suffixes that agree in at least that many symbols may stand in any order among themselves.
    """
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    is_s = classify(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) > 1:
        # sort the LMS substrings by the two sweeps, then name equal ones alike
        order = induce(s, is_s, lms, symbols)
        mark = np.zeros(n, bool)
        mark[lms] = True
        by_substring = order[mark[order]]
        length = np.empty(n, np.int32)
        length[lms] = np.append(np.diff(lms) + 1, n - lms[-1])
        a, b = by_substring[:-1], by_substring[1:]
        differ = length[a] != length[b]
        same = np.flatnonzero(~differ)
        k = 0
        while len(same):
            same = same[k < length[a[same]]]
            if not len(same):
                break
            other = s[a[same] + k] != s[b[same] + k]
            differ[same[other]] = True
            same = same[~other]
            k += 1
        # the last LMS substring runs into the end of the string and equals no other
        differ |= (a == lms[-1]) | (b == lms[-1])
        name = np.empty(n, np.int32)
        name[by_substring] = np.append(0, np.cumsum(differ))
        reduced = name[lms]
        names = int(reduced.max()) + 1
        if names == len(lms):
            lms = by_substring
        elif names <= 256 and depth is None:
            lms = lms[suffix_array(reduced, names)]
        else:
            lms = lms[_doubling(reduced, len(lms) if depth is None else depth)]
    return induce(s, is_s, lms, symbols)


def common_prefixes(raw: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """For sorted positions of ``raw``: does each share ``width`` bytes with the one before it?

    The common prefixes of neighbours, cut at ``width`` and compared eight bytes at a time; every position must have
    ``width`` bytes behind it.
    """
    shared = np.zeros(len(order), bool)
    live = np.arange(1, len(order))
    if width < 8:
        for k in range(width):
            live = live[raw[order[live] + k] == raw[order[live - 1] + k]]
        shared[live] = True
        return shared
    words = np.ndarray((max(len(raw) - 7, 0),), "<u8", raw.tobytes(), strides=(1,))
    for k in [*range(0, width - 7, 8), width - 8]:
        live = live[words[order[live] + k] == words[order[live - 1] + k]]
    shared[live] = True
    return shared
