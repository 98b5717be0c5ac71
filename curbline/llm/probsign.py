"""Weighted shingles of texts and their ProbMinHash signatures, in numpy; runs inside Arrow batches."""

from __future__ import annotations

import numpy as np

from .grams import BASE, MIX, Stream

SHINGLE = 5  # fixed value: words of a shingle


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of every element (the finaliser of SplitMix64; its constants are fixed
    values)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle codes, counts, text of each, digest of every text's words).

    Words are lower-cased and stand between white space. A text of one to four words has a single
    shingle of all its words; a text without words has none, and digest 0.
    """
    stream = Stream(texts, "word")
    start, _, code = stream.word_codes()
    owner, n = stream.text[start], stream.n
    code = scramble(code)
    words = np.bincount(owner, minlength=n)
    place = np.arange(len(code)) - np.repeat(np.cumsum(words) - words, words)
    # The digest sums codes scrambled with their places, so it depends on the order.
    mixed = scramble(code ^ (place.astype(np.uint64) * MIX))
    digest = np.zeros(n, np.uint64)
    np.add.at(digest, owner, mixed)
    count = max(0, len(code) - SHINGLE + 1)
    joined = np.full(count, SHINGLE, np.uint64)
    for k in range(SHINGLE):
        joined = scramble(joined * BASE + code[k : k + count])
    fine = owner[:count] == owner[SHINGLE - 1 :] if count else np.zeros(0, bool)
    few = np.flatnonzero((words > 0) & (words < SHINGLE))
    shingles = np.concatenate([joined[fine], digest[few]])
    texts_of = np.concatenate([owner[:count][fine], few])
    order = np.lexsort((shingles, texts_of))
    shingles, texts_of = shingles[order], texts_of[order]
    first = np.ones(len(shingles), bool)
    first[1:] = (shingles[1:] != shingles[:-1]) | (texts_of[1:] != texts_of[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(shingles)))
    return shingles[at], counts, texts_of[at], digest


def signatures(
    shingles: np.ndarray, counts: np.ndarray, owner: np.ndarray, n: int, registers: int, seed: int
) -> np.ndarray:
    """ProbMinHash signatures: [text, register] -> a shingle; two texts agree in a register with
    the probability Jaccard similarity of their weighted shingles.

    Every shingle sends points at the rate of its weight, each to a random register, which keeps the
    shingle of its earliest point. Times and registers follow from the shingle alone. A shingle is
    done when its next point comes after the latest of the text's registers; longer runs of points
    are drawn as fewer shingles are left. `registers` is a power of two.
    """
    times = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    start = scramble(shingles ^ np.uint64(seed))
    now = np.zeros(len(shingles))
    weight = counts.astype(np.float64)
    alive = np.arange(len(shingles))
    drawn, run = 0, 1
    while len(alive):
        steps = np.arange(drawn, drawn + run, dtype=np.uint64) * MIX
        bits = scramble(start[alive][:, None] + steps)
        gaps = -np.log1p(-(bits >> np.uint64(11)).astype(np.float64) / 2.0**53)
        points = now[alive][:, None] + np.cumsum(gaps / weight[alive][:, None], axis=1)
        now[alive] = points[:, -1]
        latest = times.reshape(n, registers).max(axis=1)
        early = points < latest[owner[alive]][:, None]
        row, _ = np.nonzero(early)
        point = points[early]
        register = (scramble(bits[early]) & np.uint64(registers - 1)).astype(np.int64)
        place = owner[alive][row] * registers + register
        np.minimum.at(times, place, point)
        won = times[place] == point
        kept[place[won]] = shingles[alive][row[won]]
        latest = times.reshape(n, registers).max(axis=1)
        alive = alive[now[alive] < latest[owner[alive]]]
        drawn += run
        run = 1 if len(alive) > 20_000 else min(2 * run, 256)
    return kept.reshape(n, registers)


def similarity(
    a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray
) -> float:
    """The probability Jaccard similarity of two weighted sets: the sum over common elements i of
    1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    common, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(common) == 0:
        return 0.0
    x, y = a_counts[at_a].astype(np.float64), b_counts[at_b].astype(np.float64)
    only_a, only_b = a_counts.sum() - x.sum(), b_counts.sum() - y.sum()
    # max(x_j / x_i, y_j / y_i) takes the first where the ratio x_j / y_j is at least that of i
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below_y = np.concatenate([[0.0], np.cumsum(y)])
    above_x = x.sum() - np.concatenate([[0.0], np.cumsum(x)])
    at = np.searchsorted(ratio, ratio, "left")
    total = (above_x[at] + only_a) / x + (below_y[at] + only_b) / y
    return float((1.0 / total).sum())
