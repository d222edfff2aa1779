"""Suffix arrays of many texts at once by linear grouping along Lyndon prefixes.

Suffixes are grouped by first symbol. Groups are taken from the highest down: every suffix of the group
points at the nearest earlier suffix of a lower group (its previous smaller one), and those
pointed at are split from their group, the more pointers the higher. In the end suffixes share a
group just if they start with the same Lyndon word. Going up through the array that is being
filled, each suffix then sends the one before it, and on along the pointers, to the next free place
of its group. There is no recursion and no renaming. All texts take their steps together, as numpy
operations over one group of each, so a step costs little more for a thousand texts than for one.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    n = ends - starts
    total = int(n.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(n) - n), n)


def suffix_arrays(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The suffix array of each text of non-negative symbols (without the empty suffix)."""
    if not texts:
        return []
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    ends = 1 + np.cumsum(lengths)
    begins = ends - lengths
    total = int(ends[-1])
    symbols = np.zeros(total, np.int64)  # place 0 belongs to no text; every text ends with its own least symbol, 0
    owner = np.zeros(total, np.int64)
    for k, text in enumerate(texts):
        symbols[begins[k] : ends[k] - 1] = text + 1
        owner[begins[k] : ends[k]] = k + 1
    group, previous = _group(symbols, owner, begins, ends)
    array = _order(group, previous, begins, ends)
    return [array[b + 1 : e] - b for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]


def _group(symbols: np.ndarray, owner: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the first place of its final group, and the pointer to its previous smaller suffix."""
    total = len(symbols)
    array = np.lexsort((symbols, owner))
    place = np.empty(total, np.int64)
    place[array] = np.arange(total)
    new = np.ones(total, bool)
    new[1:] = (symbols[array[1:]] != symbols[array[:-1]]) | (owner[array[1:]] != owner[array[:-1]])
    firsts = np.flatnonzero(new)
    group = np.empty(total, np.int64)
    group[array] = firsts[np.cumsum(new) - 1]
    group_end = np.zeros(total + 1, np.int64)
    group_end[firsts] = np.append(firsts[1:], total)
    previous = np.arange(-1, total - 1)
    marked = np.zeros(total, bool)
    current, low = ends.copy(), begins
    while True:
        going = current - 1 > low
        if not going.all():
            current, low = current[going], low[going]
            if not len(current):
                return group, previous
        first = group[array[current - 1]]
        sizes = current - first
        members = array[_ranges(first, current)]
        at, bottom = np.repeat(first, sizes), np.repeat(low, sizes)
        current = first
        # everything between a suffix and its pointer is in this group or a higher one
        pointer = members - 1
        previous[members] = pointer
        open_ = np.flatnonzero(group[pointer] >= at)
        while len(open_):
            further = previous[pointer[open_]]
            pointer[open_] = further
            previous[members[open_]] = further
            open_ = open_[group[further] >= at[open_]]
        hit = np.sort(pointer[pointer >= bottom])
        if not len(hit):
            continue
        edge = np.empty(len(hit), bool)
        edge[0] = True
        np.not_equal(hit[1:], hit[:-1], out=edge[1:])
        starts = np.flatnonzero(edge)
        hit, times = hit[starts], np.diff(np.append(starts, len(hit)))
        old = group[hit]
        order = np.lexsort((times, old))
        hit, times, old = hit[order], times[order], old[order]
        edge = np.empty(len(hit), bool)
        edge[0] = True
        np.not_equal(old[1:], old[:-1], out=edge[1:])
        starts = np.flatnonzero(edge)
        counts = np.diff(np.append(starts, len(hit)))
        tails = group_end[old[starts]] - counts
        target = np.arange(len(hit)) + np.repeat(tails - starts, counts)
        # those hit go to the end of their group, and whoever stood there takes their places
        came_from = place[hit]
        marked[hit] = True
        stood = array[target]
        moved = stood[~marked[stood]]
        marked[hit] = False
        holes = came_from[came_from < np.repeat(tails, counts)]
        array[holes], place[moved] = moved, holes
        array[target], place[hit] = hit, target
        group_end[old[starts]] = tails
        edge[1:] |= times[1:] != times[:-1]
        runs = np.flatnonzero(edge)
        group[hit] = np.repeat(target[runs], np.diff(np.append(runs, len(hit))))
        group_end[target[runs]] = target[np.append(runs[1:], len(hit)) - 1] + 1


def _order(group: np.ndarray, previous: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix arrays, each in the places of its text."""
    array = np.full(len(group), -1, np.int64)
    free = np.arange(len(group))
    todo = np.ones(len(group), bool)
    array[begins] = ends - 1
    todo[ends - 1] = False
    todo[0] = False
    at, bottom, stop = begins.copy(), begins, ends
    while len(at):
        suffix = array[at] - 1
        low = bottom
        while True:
            go = suffix >= low
            go &= todo[suffix]
            suffix, low = suffix[go], low[go]
            if not len(suffix):
                break
            own = group[suffix]
            slot = free[own]
            array[slot] = suffix
            free[own] = slot + 1
            todo[suffix] = False
            suffix = previous[suffix]
        at = at + 1
        keep = at < stop
        if not keep.all():
            at, bottom, stop = at[keep], bottom[keep], stop[keep]
    return array
