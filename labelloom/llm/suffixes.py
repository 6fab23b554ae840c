"""Suffix sorting by grouping, in linear time (Baier's algorithm).

Suffixes are grouped by their longest Lyndon prefix, and the groups ordered by it, without renaming
and recursion:

1. Groups by first symbol are processed in descending order. Of each suffix in the group at hand the
   pointer to the last suffix before it in a lower group is followed; what that one has for a prefix
   so far ends where this one begins, so it is prolonged by this group's prefix, and moves to a new
   group right above its old one. Processed suffixes are passed over by halving paths.
2. Suffixes of one group differ by what follows their prefixes, which is a smaller suffix in each
   case. So when the suffixes come out in ascending order, each hands those whose prefixes end where
   it begins to the next free places of their groups.
"""

from __future__ import annotations

from collections import Counter, defaultdict


def suffix_array(text: bytes | list[int]) -> list[int]:
    """The starts of the suffixes of ``text`` in ascending order."""
    n = len(text) + 1  # with an end that is smaller than all symbols
    by_symbol = defaultdict(list)
    for place, symbol in enumerate(text):
        by_symbol[symbol].append(place)
    members = [[n - 1], *(by_symbol[s] for s in sorted(by_symbol))]
    group = [0] * n
    for g, places in enumerate(members):
        for place in places:
            group[place] = g
    length = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    higher = [*range(1, len(members)), -1]
    before = list(range(n + 1))  # of each place + 1: it, or on the way to the last unprocessed one
    smaller = [n] * n
    descending = []
    at = len(members) - 1
    while at >= 0:
        own = [p for p in members[at] if group[p] == at]
        members[at] = own
        if own:
            descending.append(at)
            size = length[at]
            for p in own:
                before[p + 1] = p
                smaller[p] = p + size
            times: Counter[int] = Counter()
            for p in own:
                x = p
                while before[x] != x:
                    before[x] = before[before[x]]
                    x = before[x]
                if x:
                    times[x - 1] += 1
            moved = defaultdict(list)
            for p, k in times.items():
                moved[group[p], k].append(p)
            for old, k in sorted(moved, reverse=True):  # the most repeated end up highest
                new = len(members)
                members.append(moved[old, k])
                length.append(length[old] + k * size)
                for p in members[new]:
                    group[p] = new
                above = higher[old]
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
        at = lower[at]
    free, start = [0] * len(members), 0
    for g in reversed(descending):
        free[g] = start
        start += len(members[g])
    handed = [[] for _ in range(n + 1)]
    for p in range(n - 1):
        handed[smaller[p]].append(p)
    order = [n - 1] * n
    for i in range(n):
        for p in handed[order[i]]:
            g = group[p]
            order[free[g]] = p
            free[g] += 1
    return order[1:]
