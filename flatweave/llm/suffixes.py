"""Suffix arrays by linear grouping construction, for many short strings in step.

Suffixes are grouped by their Lyndon prefix. Groups are taken in descending order; each member's
previous-smaller pointer names the suffix whose Lyndon prefix this member's prefix extends, and
the suffixes named once, twice, ... move behind the rest of their group as new groups. A second
pass then emits each group's order: when a suffix gets its rank, those whose Lyndon prefix ends
where it starts take the next places of their groups. Nothing is renamed or sorted again.

Strings are independent lanes. Every step handles the next group (then the next rank) of each
lane, as array operations over all lanes.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all lanes' suffixes, each lane's in order, lanes one after another.

    symbols are the lanes end to end; each must end with its only 0.
    """
    n, lanes = len(symbols), len(lengths)
    if not n:
        return np.zeros(0, dtype=np.int64)
    base = np.cumsum(lengths) - lengths
    lane = np.repeat(np.arange(lanes), lengths)
    order, group, previous = _groups(symbols, base, lengths, lane)
    return _ranks(order, group, previous, base, lengths, lane)


def _groups(symbols, base, lengths, lane):
    """Final groups (a group is named by its first place) and previous-smaller pointers."""
    n = len(symbols)
    keys = lane * (int(symbols.max()) + 1) + symbols
    order = np.argsort(keys, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    ranked = keys[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    counts = np.diff(np.append(first, n))
    # One more cell stands for "before the lane": below every group.
    group = np.empty(n + 1, dtype=np.int64)
    group[order] = np.repeat(first, counts)
    group[n] = -1
    size = np.zeros(n, dtype=np.int64)
    size[first] = counts
    previous = np.arange(-1, n, dtype=np.int64)
    previous[base] = n
    previous[n] = n
    named = np.zeros(n, dtype=bool)

    stop = base + lengths
    active = np.arange(len(base))
    while len(active):
        end = stop[active]
        start = group[order[end - 1]]
        many = end - start
        shift = np.cumsum(many) - many
        members = order[np.repeat(start - shift, many) + np.arange(int(many.sum()))]
        below = np.repeat(start, many)
        found = previous[members]
        wrong = np.flatnonzero(group[found] >= below)
        while len(wrong):
            found[wrong] = previous[found[wrong]]
            previous[members[wrong]] = found[wrong]
            wrong = wrong[group[found[wrong]] >= below[wrong]]
        found = found[found < n]
        if len(found):
            _split(found, order, place, group, size, named)
        stop[active] = start
        active = active[start > base[active]]
    return order, group, previous


def _split(found, order, place, group, size, named) -> None:
    """Move the suffixes found behind the rest of their groups, by how often they were found."""
    found.sort()
    at = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    times = np.diff(np.append(at, len(found)))
    found = found[at]
    home = group[found]
    by = np.lexsort((times, home))
    found, times, home = found[by], times[by], home[by]
    run = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
    count = np.diff(np.append(run, len(found)))
    end = home[run] + size[home[run]]
    target = np.repeat(end - count - run, count) + np.arange(len(found))
    floor = np.repeat(end - count, count)
    named[found] = True
    there = order[target]
    out = there[~named[there]]
    if len(out):
        places = place[found]
        free = places[places < floor]
        order[free] = out
        place[out] = free
    named[found] = False
    order[target] = found
    place[found] = target
    size[home[run]] -= count
    new = np.append(True, (home[1:] != home[:-1]) | (times[1:] != times[:-1]))
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, len(found)))
    group[found] = np.repeat(target[at], many)
    size[target[at]] = many


def _ranks(order, group, previous, base, lengths, lane):
    """Emit every lane's suffixes in order, a place of each lane at a time."""
    n = len(order)
    out = np.empty(n, dtype=np.int64)
    ready = np.zeros(n + 1, dtype=bool)
    ready[n] = True
    following = np.arange(n, dtype=np.int64)  # the next free place of a group, at its name
    out[base] = base + lengths - 1
    ready[base + lengths - 1] = True
    before = np.arange(-1, n, dtype=np.int64)
    before[base] = n
    rank = base.copy()
    last = base + lengths - 1
    at = before[out[base]]
    active = np.arange(len(base))
    while len(active):
        now = at[active]
        waiting = ~ready[now]
        some = active[waiting]
        if len(some):
            suffix = now[waiting]
            home = group[suffix]
            free = following[home]
            out[free] = suffix
            following[home] = free + 1
            ready[suffix] = True
            at[some] = previous[suffix]
        rest = active[~waiting]
        if len(rest):
            rank[rest] += 1
            done = rank[rest] > last[rest]
            rest = rest[~done]
            at[rest] = before[out[rank[rest]]]
            if done.any():
                active = active[rank[active] <= last[active]]
    return out


def naive(symbols: np.ndarray) -> list[int]:
    """The suffix array of one lane by comparing whole suffixes, for tests."""
    return sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
