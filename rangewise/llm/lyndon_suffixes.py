"""Suffix arrays by linear grouping, for many texts at once.

Suffixes are grouped by their Lyndon prefix. Groups start as first symbols
and are processed from the greatest down: each member points to the previous
suffix of a smaller group (found by jumping over greater ones), and suffixes
pointed at move to new groups right above their own, the more pointers the
higher. After that a group holds exactly the suffixes of one Lyndon prefix.
The order inside groups follows without renaming: going up, when a suffix
has its place, the suffixes whose Lyndon prefix ends where it begins take the
next places of their groups.

Numpy carries one group per text and step, so texts of a batch advance
together; the steps are as many as the groups of the text that has most.

A text ends with ``END``, its least symbol, which occurs nowhere else in it.
"""

from __future__ import annotations

import numpy as np

END = 0


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    total = np.cumsum(size)
    return np.arange(total[-1]) + np.repeat(start - total + size, size)


def _initial(text: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, group starts by suffix and group sizes by start: first symbols."""
    n = len(text)
    owner = np.repeat(np.arange(len(low) - 1), np.diff(low))
    key = owner * (int(text.max()) + 1) + text
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    size = np.zeros(n, np.int64)
    size[first] = np.diff(np.append(first, n))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, size[first])
    return order, group, size


def group_suffixes(text: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase one: each suffix's final group start and previous-smaller pointer
    (under the text's first place if there is none), and group sizes."""
    order, group, size = _initial(text, low)
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    prev = np.arange(n) - 1
    moving = np.zeros(n, bool)
    live = np.flatnonzero(np.diff(low) > 0)
    base, high = low[live], low[live + 1].copy()
    while len(base):
        start = group[order[high - 1]]
        count = high - start
        members = order[_ranges(start, count)]
        floor, least = np.repeat(start, count), np.repeat(base, count)
        # members' own pointers shorten while they are followed, so runs cost a logarithm
        todo = np.arange(len(members))
        while True:
            to = prev[members[todo]]
            todo = todo[(to >= least[todo]) & (group[to] >= floor[todo])]
            if not len(todo):
                break
            prev[members[todo]] = prev[prev[members[todo]]]
        to = prev[members]
        to = np.sort(to[to >= least])
        if len(to):
            edge = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            times, to = np.diff(np.append(edge, len(to))), to[edge]
            rank = np.lexsort((times, group[to]))
            to, times = to[rank], times[rank]
            old = group[to]
            edge = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
            each = np.diff(np.append(edge, len(to)))
            parent = old[edge]
            tail = parent + size[parent] - each
            slots = _ranges(tail, each)
            was = place[to]
            moving[to] = True
            there = order[slots]
            stay = there[~moving[there]]
            free = was[was < np.repeat(tail, each)]
            order[free], place[stay] = stay, free
            order[slots], place[to] = to, slots
            moving[to] = False
            size[parent] -= each
            new = np.flatnonzero(np.concatenate(
                [[True], (old[1:] != old[:-1]) | (times[1:] != times[:-1])]))
            sizes = np.diff(np.append(new, len(to)))
            size[slots[new]] = sizes
            group[to] = np.repeat(slots[new], sizes)
        keep = start > base
        base, high = base[keep], start[keep]
    return group, prev, size


def suffix_arrays(text: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The suffix arrays of texts ``text[low[k]:low[k + 1]]``, each in its own
    places, as positions in ``text``."""
    low = np.asarray(low, np.int64)
    if not len(text):
        return np.empty(0, np.int64)
    group, prev, size = group_suffixes(text, low)
    n = len(text)
    out = np.full(n, -1, np.int64)
    placed = np.zeros(n, bool)
    filled = np.zeros(n, np.int64)  # by group start
    live = np.flatnonzero(np.diff(low) > 0)
    base, top = low[live], low[live + 1]
    out[base] = top - 1  # END alone
    placed[top - 1] = True
    filled[base] = 1
    now, at = base.copy(), base.copy()  # current group, next place to go on from
    while len(now):
        end = now + filled[now]
        count = end - at
        here = out[_ranges(at, count)]
        least = np.repeat(base, count)
        to, turn = here - 1, np.arange(len(here))
        found, turns = [], []
        while True:
            ok = to >= least[turn]
            to, turn = to[ok], turn[ok]
            ok = ~placed[to]
            to, turn = to[ok], turn[ok]
            if not len(to):
                break
            placed[to] = True
            found.append(to)
            turns.append(turn)
            to = prev[to]
        if found:
            to, turn = (found[0], turns[0]) if len(found) == 1 else (
                np.concatenate(found), np.concatenate(turns))
            rank = np.lexsort((turn, group[to]))
            to = to[rank]
            goal = group[to]
            edge = np.flatnonzero(np.concatenate([[True], goal[1:] != goal[:-1]]))
            each = np.diff(np.append(edge, len(to)))
            out[_ranges(goal[edge] + filled[goal[edge]], each)] = to
            filled[goal[edge]] += each
        at = end
        over = at == now + size[now]
        now = np.where(over, at, now)
        keep = ~(over & (at == top))
        now, at, base, top = now[keep], at[keep], base[keep], top[keep]
    return out
