"""Bin completion: as few bins as possible for a table of sizes and how often each occurs.

The work is on counts per size, of which there are no more than the capacity, however many items
there are: a filling is taken as often as its sizes allow at once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

Filling = tuple[tuple[int, int], ...]  # (size, how many), larger sizes first
Packing = list[tuple[int, Filling]]  # (how many bins, filling of each)

NODES = 20_000  # fillings tried after the first way down
WAYS = 4  # fillings tried for one largest item
FIRST = 256  # first sizes of a triple


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by the sum of sizes, by how many items of a least size fit into
    one bin, and by items too large to share a bin."""
    sizes = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])  # of sizes below
    amount = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = capacity // 2
    best = -(-int(amount[-1]) // capacity)
    beside = capacity // np.maximum(sizes, 1)  # so many of a size fit into a bin
    best = max(best, int((-(-(number[-1] - number[:-1]) // beside))[1:].max()))
    for least in range(half + 1):
        top = capacity - least  # above it an item is alone among sizes from `least` on
        alone = int(number[-1] - number[top + 1])
        halves = int(number[top + 1] - number[half + 1])
        room = halves * capacity - int(amount[top + 1] - amount[half + 1])
        rest = int(amount[half + 1] - amount[least]) - room
        best = max(best, alone + halves + max(0, -(-rest // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> Packing:
    """Best fit, larger items first, with equal bins kept together."""
    open_bins: list[Packing] = [[] for _ in range(capacity + 1)]  # by gap
    some = np.zeros(capacity + 1, bool)

    def put(gap: int, times: int, filling: Filling) -> None:
        if times:
            open_bins[gap].append((times, filling))
            some[gap] = True

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            gap = size + int(some[size:].argmax())
            if some[gap]:
                times, filling = open_bins[gap].pop()
                some[gap] = bool(open_bins[gap])
            else:
                times, filling, gap = left, (), capacity
            each = min(gap // size, left)
            used = min(times, left // each)
            put(gap - each * size, used, (*filling, (size, each)))
            if filling:
                put(gap, times - used, filling)
            left -= used * each
    return [b for bins in open_bins for b in bins]


def _tails(counts: np.ndarray, gap: int, most: int) -> list[tuple[int, ...]]:
    """One, two or three sizes that fill a gap exactly, larger ones first. One size that does is as
    good as any smaller ones that do, so nothing else is looked at then."""
    if counts[gap]:
        return [(gap,)]
    pairs = _pairs(counts, gap, gap, most)
    if pairs:
        return pairs
    found = []
    for first in (np.flatnonzero(counts[: gap - 1])[::-1][:FIRST]).tolist():
        if first * 3 < gap:
            break
        counts[first] -= 1
        rest = gap - first
        if rest <= first and counts[rest]:
            found.append((first, rest))
        else:
            found += [(first, *p) for p in _pairs(counts, rest, first, most)]
        counts[first] += 1
        if len(found) >= most:
            break
    return found[:most]


def _pairs(counts: np.ndarray, gap: int, largest: int, most: int) -> list[tuple[int, int]]:
    low, high = gap // 2 + 1, min(largest, gap - 1)
    found = []
    if low <= high:
        there = (counts[low : high + 1] > 0) & (counts[gap - high : gap - low + 1][::-1] > 0)
        found = [(low + i, gap - low - i) for i in np.flatnonzero(there)[::-1][:most].tolist()]
    if len(found) < most and gap % 2 == 0 and gap // 2 <= largest and counts[gap // 2] > 1:
        found.append((gap // 2, gap // 2))
    return found


def fillings(counts: np.ndarray, gap: int, most: int = WAYS) -> list[Counter]:
    """Ways to fill a gap, those with least waste first; in none of them another item would fit."""
    if not gap:
        return [Counter()]
    exact = _tails(counts, gap, most)
    if exact:
        return [Counter(t) for t in exact]
    fits = np.flatnonzero(counts[: gap + 1])
    if not len(fits):
        return [Counter()]
    found = []
    for size in fits[::-1][:most].tolist():
        # Where many fit, most of them are taken at once and the end is searched.
        take = max(1, min(int(counts[size]), gap // size - 2))
        counts[size] -= take
        for rest in fillings(counts, gap - take * size, 1 if found else most):
            found.append(rest + Counter({size: take}))
        counts[size] += take
    return sorted(found, key=lambda f: gap - sum(s * n for s, n in f.items()))[:most]


def pack(counts: np.ndarray, capacity: int, nodes: int = NODES) -> Packing:
    """Branch and bound over the fillings around the largest item left.

    Best fit gives the first solution to beat, and again whenever half of what was left has been
    placed. A way is left as soon as its waste shows that it cannot save a bin. It ends when the
    lower bound is met, all ways are tried, or `nodes` fillings were tried after the first way down;
    the best packing found is complete in any case.
    """
    counts = counts.astype(np.int64).copy()
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(t for t, _ in best)
    left = int((counts * np.arange(capacity + 1)).sum())
    stack: list[tuple[list, int, Filling]] = []  # ways not tried, bins, filling
    used, tried, down, again = 0, 0, False, left // 2

    def ways() -> list:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = [f + Counter({top: 1}) for f in fillings(counts, capacity - top)]
        counts[top] += 1
        return [tuple(sorted(f.items(), reverse=True)) for f in found][::-1]

    def change(filling: Filling, times: int) -> int:
        for size, number in filling:
            counts[size] += times * number
        return times * sum(s * n for s, n in filling)

    def settle(rest: Packing) -> None:
        nonlocal best, best_bins
        bins = used + sum(t for t, _ in rest)
        if bins < best_bins:
            best, best_bins = [(t, f) for _, t, f in stack] + rest, bins

    options: list = []
    fresh = True
    while best_bins > bound:
        if fresh:
            if not left:
                settle([])
                down = True
            elif not down and left <= again:
                settle(best_fit(counts, capacity))
                again = left // 2
            options = ways() if left and used + -(-left // capacity) < best_bins else []
            down = down or not options
            fresh = False
        elif options:
            if down:
                tried += 1
                if tried > nodes:
                    break
            filling = options.pop()
            times = min(int(counts[s]) // n for s, n in filling)
            stack.append((options, times, filling))
            left += change(filling, -times)
            used += times
            fresh = True
        elif stack:
            options, times, filling = stack.pop()
            left += change(filling, times)
            used -= times
        else:
            break
    return best
