"""Suffix sorting by Lyndon grouping (after Baier, 2016): linear, and without renaming or recursion.

First pass: suffixes start in groups by their first symbol, and the groups are taken from the highest to the lowest.
When a group is taken, each of its suffixes finds its previous suffix that stands in a lower group (earlier results are
pointers over which it jumps), and every previous suffix found moves into a new group right behind its old one, those
that were found more often further up. In the end the suffixes of a group share their longest Lyndon prefix.
Second pass: from the lowest suffix on, the suffix before each placed one, and along the pointers those it belongs to,
take the next free place of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """The suffixes of ``text`` in order; its last symbol must be smaller than all others."""
    n = len(text)
    if n == 0:
        return []
    order = np.argsort(text, kind="stable")
    firsts = np.flatnonzero(np.concatenate([[True], np.diff(text[order]) != 0]))
    sizes = np.diff(np.append(firsts, n))
    start_of = np.empty(n, np.int64)
    start_of[order] = np.repeat(firsts, sizes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    slots, group, place = order.tolist(), start_of.tolist(), place.tolist()
    size = dict(zip(firsts.tolist(), sizes.tolist()))
    previous = [-1] * n

    end = n - 1
    while end > 0:
        start = group[slots[end]]
        found: dict[int, int] = {}
        for s in sorted(slots[start : end + 1]):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, times in found.items():
            by_count.setdefault(times, []).append(p)
        for times in sorted(by_count, reverse=True):
            # to the back of their groups, ...
            moved: dict[int, list[int]] = {}
            for p in by_count[times]:
                g = group[p]
                size[g] -= 1
                last, at = g + size[g], place[p]
                other = slots[last]
                slots[last], slots[at] = p, other
                place[p], place[other] = last, at
                moved.setdefault(g, []).append(p)
            # ... where they become groups of their own
            for g, own in moved.items():
                new = g + size[g]
                size[new] = len(own)
                if new != g:
                    for p in own:
                        group[p] = new
        end = start - 1

    out, placed, free = [-1] * n, [False] * n, {}
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            at = free.get(g, g)
            out[at] = j
            free[g] = at + 1
            placed[j] = True
            j = previous[j]
    return out
