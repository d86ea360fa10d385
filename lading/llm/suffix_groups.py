"""Suffix array by suffix grouping (Baier 2016), linear in the text's length.

Phase 1 sorts the suffixes into groups by their longest Lyndon prefix.  It
starts with groups of equal first symbols and processes groups in descending
order.  For each suffix of the group at hand it finds the previous smaller
suffix: the nearest one to the left whose group is lower, reached by following
the pointers of suffixes already processed.  The suffixes pointed at move out
of their group into new groups just above it, those pointed at more often
higher.

Phase 2 walks the array in ascending order: the suffix before a placed one,
and those on its chain of previous-smaller pointers, take the next free place
of their group.  Nothing is renamed or sorted again.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of ``symbols`` in lexicographic order; a
    suffix that is a prefix of another comes first."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    by_symbol = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[by_symbol])) + 1
    members = [m.tolist() for m in np.split(by_symbol, cuts)]
    size = [len(m) for m in members]
    above = [*range(1, len(members)), -1]  # groups as a linked list
    below = [*range(-1, len(members) - 1)]
    group = np.zeros(n, np.int64)
    group[by_symbol[cuts]] = 1
    group[by_symbol] = np.cumsum(group[by_symbol])
    group = group.tolist()
    done = bytearray(n)
    smaller = [-1] * n  # previous smaller suffix

    g = len(members) - 1
    while g >= 0:
        # Members rise; pointers therefore rise too, and equal ones are adjacent.
        pointed: list[int] = []
        times: list[int] = []
        last = -1
        for i in members[g]:
            if group[i] != g:
                continue
            done[i] = 1
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                if j == last:
                    times[-1] += 1
                else:
                    pointed.append(j)
                    times.append(1)
                    last = j
        if len(pointed) == 1:
            j = pointed[0]
            h = group[j]
            if size[h] > 1:
                new = len(members)
                members.append([j])
                size.append(1)
                size[h] -= 1
                group[j] = new
                up = above[h]
                above.append(up)
                below.append(h)
                below[up] = above[h] = new
        elif pointed:
            levels: dict[int, list[int]] = {}
            for j, t in zip(pointed, times, strict=True):
                levels.setdefault(t, []).append(j)
            for t in sorted(levels, reverse=True):
                moved: dict[int, list[int]] = {}
                for j in levels[t]:
                    moved.setdefault(group[j], []).append(j)
                for h, js in moved.items():
                    if len(js) == size[h]:
                        continue  # all that is left of the group: it stays where it is
                    new = len(members)
                    members.append(js)
                    size.append(len(js))
                    size[h] -= len(js)
                    for j in js:
                        group[j] = new
                    up = above[h]
                    above.append(up)
                    below.append(h)
                    below[up] = above[h] = new
        g = below[g]

    start = [0] * len(members)
    g, at = 0, 0
    while g >= 0:
        start[g] = at
        at += size[g]
        g = above[g]
    placed = bytearray(n)
    order = [0] * n
    j = n - 1
    for k in range(-1, n):
        if k >= 0:
            j = order[k] - 1
        while j >= 0 and not placed[j]:
            h = group[j]
            order[start[h]] = j
            start[h] += 1
            placed[j] = 1
            j = smaller[j]
    return np.array(order, np.int64)
