"""Hashed character n-grams of many texts at once, in numpy; runs inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT_CHARS = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
SPACE = np.uint32(32)
_kinds: dict[str, np.ndarray] = {}


def char_table(kind: str) -> np.ndarray:
    """For every code point, whether str.<kind> holds for it; "word" is all but the white space of
    the contracts."""
    if kind == "word" and kind not in _kinds:
        _kinds[kind] = np.ones(0x110000, bool)
        _kinds[kind][[9, 10, 11, 12, 13, 32]] = False
    if kind not in _kinds:
        _kinds[kind] = np.array([getattr(chr(c), kind)() for c in range(0x110000)])
    return _kinds[kind]


def segments(texts: list[str], most: int = SEGMENT_CHARS) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts in portions of about `most` characters: (number of the text of each part, parts). A
    longer text comes in several parts, cut behind a blank where there is one."""
    numbers, parts, size = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > most:
                blank = max(text.rfind(" ", at, at + most), text.rfind("\n", at, at + most))
                end = blank + 1 if blank > at else at + most
            if parts and size + end - at > most:
                yield np.array(numbers), parts
                numbers, parts, size = [], [], 0
            numbers.append(number)
            parts.append(text[at:end])
            size += end - at
            at = end
            if at >= len(text):
                break
    if parts:
        yield np.array(numbers), parts


class Stream:
    """Texts as one row of code points: lower case, everything but `kind` as single blanks, a
    blank before and behind every text. `text` has the number of the text of each place. With
    `once`, a word that repeats directly behind itself stands once."""

    def __init__(self, texts: list[str], kind: str, once: bool = False):
        lowered = [t.lower() for t in texts]
        data = " ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(data, np.uint32)
        lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
        owner = np.repeat(np.arange(len(texts)), lengths)  # a text and the blank before it
        keeps = char_table(kind)[points]
        points = np.where(keeps, points, SPACE)
        stays = np.ones(len(points), bool)
        stays[1:] = keeps[1:] | keeps[:-1]
        self.n = len(texts)
        self.points = points[stays].astype(np.uint64)
        self.blank = ~keeps[stays]
        self.text = np.append(owner, len(texts) - 1)[stays] if len(texts) else owner
        self.has = np.bincount(owner[keeps[:-1]], minlength=self.n) > 0
        if once:
            self._drop_repeats()

    def _drop_repeats(self) -> None:
        start, end, code = self.word_codes()
        again = np.flatnonzero((code[1:] == code[:-1]) & (self.text[start[1:]] == self.text[start[:-1]])) + 1
        if len(again) == 0:
            return
        step = np.zeros(len(self.points) + 1, np.int32)
        step[start[again]] += 1
        step[end[again] + 1] -= 1  # with the blank behind it
        stays = np.cumsum(step[:-1]) == 0
        self.points, self.blank, self.text = self.points[stays], self.blank[stays], self.text[stays]

    def grams(self, n: int, bits: int, inside_words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of every n-gram; with inside_words, blanks may stand at the ends only;
        without, an n-gram has a letter at least and letters of one text only. A blank between two texts begins the later one and may end a word of the earlier."""
        count = len(self.points) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.full(count, n, np.uint64)
        for k in range(n):
            code *= BASE
            code += self.points[k : k + count]
        code *= MIX
        bucket = (code >> np.uint64(64 - bits)).astype(np.int64)
        owner = self.text[:count]
        if inside_words:
            fine = np.ones(count, bool)
            for k in range(1, n - 1):
                fine &= ~self.blank[k : k + count]
            if n > 1:
                fine &= ~(self.blank[:count] & self.blank[n - 1 :])
            owner = np.where(self.blank[:count], self.text[min(1, n - 1) : min(1, n - 1) + count], owner)
        else:
            # Whose blank stands between two texts depends on its neighbours, so letters decide.
            low, high = np.full(count, self.n), np.full(count, -1)
            for k in range(n):
                own, blank = self.text[k : k + count], self.blank[k : k + count]
                low = np.where(blank, low, np.minimum(low, own))
                high = np.where(blank, high, np.maximum(high, own))
            fine, owner = low == high, low
        return bucket[fine], owner[fine]

    def word_codes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and 64-bit code of every word."""
        edge = np.flatnonzero(self.blank)
        start, end = edge[:-1] + 1, edge[1:]
        full = end > start
        start, end = start[full], end[full]
        power = np.cumprod(np.full(len(self.points) + 1, BASE, np.uint64))
        back = np.cumprod(np.full(len(self.points) + 1, _inverse(BASE), np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.points * power[:-1])])
        return start, end, (sums[end] - sums[start]) * back[start] * MIX

    def words(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of every whole word."""
        start, _, code = self.word_codes()
        return (code >> np.uint64(64 - bits)).astype(np.int64), self.text[start]


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))
