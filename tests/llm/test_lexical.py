"""Ranked search against scoring every document for every item by hand."""

import math
import random
import re

import numpy as np
import pytest

from curbline.llm import lexical
from llm_documents import make, none, odd  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def by_hand(docs, items, k=10):
    split = [(i, cut(t)) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    n, total = len(split), sum(len(t) for _, t in split)
    df = {}
    for _, terms in split:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(cut(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, own in split:
            m = 100 - 90 + (90 * len(own) * n) // total
            score = 0
            for t in terms:
                tf = own.count(t)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1)))
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if b else i, -s) for r, (s, b, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id BIGINT, text STRING, score INT, rank INT")


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def words(rng, n, vocabulary=60):
    return " ".join(f"W{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}{rng.choice(['', ',', '.', ' —é'])}" for _ in range(n))


@pytest.mark.parametrize("pairs", [lexical.PAIRS, 40])
def test_against_scoring_everything(spark, make, pairs):
    rng = random.Random(6)
    docs = [(i, words(rng, rng.randrange(60)), "en", "a") for i in range(300)]
    docs += [(1000 + i, "w1 w2 w3", "en", "a") for i in range(25)]  # ties
    docs += docs[:5] + [(None, "w1 w2 w3 w4", "en", "b"), (None, "w1 w2 w3", "en", "b")]
    items = [(i, words(rng, rng.randrange(12))) for i in range(30)]
    items += [(3, "w7 w8 w9"), (None, "w1 W2"), (77, None), (78, ""), (79, "unknown"), (80, "w1 w2 w3")]
    out = lexical.ranked(make(docs), items_of(spark, items), pairs=pairs)
    assert got(out) == by_hand([(d[0], d[1]) for d in docs], items)


def test_odd_documents_and_empty_tables(spark, odd, none):
    items = [(1, "one two, WORT5 und 中文"), (2, "é́ 123"), (3, " ")]
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(lexical.ranked(odd, items_of(spark, items))) == by_hand(rows, items)
    assert got(lexical.ranked(none, items_of(spark, items))) == []
    assert got(lexical.ranked(odd, items_of(spark, []))) == []


def test_portions_of_long_texts_keep_terms_whole(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(lexical, "CHUNK", 7)
    for _ in range(300):
        text = "".join(rng.choices("aB é中-_ 1", k=rng.randrange(60)))
        assert [t.decode() for part in lexical.terms_of(text) for t in part] == cut(text)


def test_shared_sets_are_added_once():
    rng = random.Random(2)
    common = [set(rng.sample(range(100), 15)) for _ in range(4)]
    items = [common[i % 4] | set(rng.sample(range(100), 5)) for i in range(40)] + [set(), {5}]
    graph = lexical.Graph(items, 100)
    impacts = np.array([[rng.randrange(1000) for _ in range(9)] for _ in range(100)])
    plain = np.array([impacts[sorted(own)].sum(axis=0) if own else np.zeros(9, int) for own in items])
    assert (graph.scores(impacts) == plain).all()
    assert graph.additions() < sum(max(0, len(own) - 1) for own in items) / 2
