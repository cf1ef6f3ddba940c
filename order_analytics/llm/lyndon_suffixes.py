"""Suffix arrays by linear grouping of suffixes with equal Lyndon prefixes.

The first phase groups suffixes by their longest Lyndon prefix, in lexicographic order of the prefixes.
Groups are intervals of one array. They are taken in descending order; for each suffix of a group, its
previous smaller suffix (the next to the left in a smaller group) is found by following such pointers.
That suffix's prefix goes on with the group's prefix as many times as it was found, so those found most often move to a new
group right above their old one first. The second phase emits the order: going up through the suffixes
found so far, the suffix before each, and then those its pointers lead to, take the next place of their
groups. Nothing is renamed, no smaller string is sorted, and the members of a group are taken as they lie. Only the symbols are sorted at
the start, and how many times suffixes of a group were found, of which there are at most a root of its size different ones.

Published as: U. Baier, Linear-time Suffix Sorting - A New Approach for Suffix Array Construction, 2016.
"""

from __future__ import annotations

import numpy as np

#: A suffix whose previous smaller suffix has not been looked for.
UNKNOWN = -2


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. The last symbol must be smaller than all others and occur once."""
    count = len(symbols)
    if count == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    heads = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(heads)
    of_place = starts[np.cumsum(heads) - 1]
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    group = np.empty(count, np.int64)
    group[order] = of_place
    size = np.zeros(count, np.int64)
    size[starts] = np.diff(np.append(starts, count))
    held, place, group, size = order.tolist(), place.tolist(), group.tolist(), size.tolist()
    smaller = _group_by_prefix(held, place, group, size)
    return np.array(_emit(count, group, smaller), np.int64)


def _group_by_prefix(held: list[int], place: list[int], group: list[int], size: list[int]) -> list[int]:
    """Refine the groups to Lyndon groups; the previous smaller suffix of each, -1 where there is none."""
    smaller = [UNKNOWN] * len(held)
    last = len(held) - 1
    while last >= 0:
        head = group[held[last]]
        found: dict[int, int] = {}
        for suffix in held[head : last + 1]:
            if smaller[suffix] != UNKNOWN:
                continue
            # members of the group that are met on the way and have no pointer yet get the same one
            met, left = [suffix], suffix - 1
            while left >= 0 and group[left] >= head:
                if smaller[left] == UNKNOWN:
                    met.append(left)
                    left -= 1
                else:
                    left = smaller[left]
            for member in met:
                smaller[member] = left
            if left >= 0:
                found[left] = found.get(left, 0) + len(met)
        last = head - 1
        if not found:
            continue
        times = set(found.values())
        if len(times) == 1:
            _raise(found, held, place, group, size)
        else:
            for time in sorted(times, reverse=True):
                _raise([suffix for suffix, n in found.items() if n == time], held, place, group, size)
    return smaller


def _raise(suffixes, held: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Move suffixes out of their groups, those of one group to a new one right above it."""
    changed = set()
    for suffix in suffixes:
        head = group[suffix]
        changed.add(head)
        size[head] -= 1
        top = head + size[head]
        here, other = place[suffix], held[top]
        held[here], held[top] = other, suffix
        place[other], place[suffix] = here, top
    fresh = {head: head + size[head] for head in changed}
    for suffix in suffixes:
        head = group[suffix] = fresh[group[suffix]]
        size[head] += 1


def _emit(count: int, group: list[int], smaller: list[int]) -> list[int]:
    free = list(range(count))
    placed = [False] * count
    order = [-1] * count
    order[0] = count - 1
    placed[count - 1] = True
    free[0] = 1
    for rank in range(count):
        suffix = order[rank] - 1
        while suffix >= 0 and not placed[suffix]:
            head = group[suffix]
            order[free[head]] = suffix
            free[head] += 1
            placed[suffix] = True
            suffix = smaller[suffix]
    return order
