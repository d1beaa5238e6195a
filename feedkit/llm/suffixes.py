"""Suffix array by linear grouping.

A suffix's group is its longest Lyndon prefix. Groups start as first symbols and are taken in
descending order; each member points to the nearest earlier suffix of a lower group, and the suffixes
pointed at move, by how often they were, into new groups behind their own, since the member's prefix
now belongs to theirs. When all groups are done, the suffixes that end where the next smaller one
begins are found through the same pointers, and each group's order is emitted in one sweep over the
array, without renaming and without recursion.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Suffixes of `text` in ascending order; its last symbol must be its smallest, and be unique."""
    symbols = np.asarray(text, np.int64)
    n = len(symbols)
    if n == 0:
        return []
    by_symbol = np.argsort(symbols, kind="stable")
    ordered = symbols[by_symbol]
    opens = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    group_of = np.empty(n, np.int64)
    sizes = np.diff(np.append(opens, n))
    group_of[by_symbol] = np.repeat(opens, sizes)
    # A group is the place where it starts in `row`; `at` is each suffix's place there.
    row, group = by_symbol.tolist(), group_of.tolist()
    places = np.empty(n, np.int64)
    places[by_symbol] = np.arange(n)
    at = places.tolist()
    size = dict(zip(opens.tolist(), sizes.tolist(), strict=True))
    before = [-1] * n

    end = n
    while end:
        own = group[row[end - 1]]
        members = row[own:end]
        if len(members) > 1:
            members.sort()
        end = own
        hits: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= own:
                p = before[p]
            before[s] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        if not hits:
            continue
        by_count: dict[int, list[int]] = {}
        for p, k in hits.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved = by_count[k]
            shrunk: dict[int, int] = {}
            for p in moved:
                home = group[p]
                size[home] -= 1
                shrunk[home] = shrunk.get(home, 0) + 1
                here, last = at[p], home + size[home]
                other = row[last]
                row[last], row[here] = p, other
                at[p], at[other] = last, here
            for p in moved:
                home = group[p]
                group[p] = home + size[home]
            for home, many in shrunk.items():
                size[home + size[home]] = many

    out, front = [-1] * n, list(range(n))
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            own = group[j]
            out[front[own]] = j
            front[own] += 1
            placed[j] = 1
            j = before[j]
    return out
