"""Exact top-k against scoring everything."""

import math
import random

import numpy as np
import pytest

from curbline.llm import topk

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, score INT, x STRING"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "clash") for i, v in rows], SCHEMA)


def by_hand(rows, k=5, parts=50):
    fit = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (q, a) in enumerate(fit):
        if q % parts:
            continue
        found = sorted((-sum(map(int.__mul__, a, b)), i) for m, (i, b) in enumerate(fit) if m != n and len(a) == len(b) and a)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_values", [topk.BLOCK_VALUES, 840])
def test_against_everything(spark, block_values):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, [0.125] * 12) for i in range(60)]  # ties
    rows += [(2000, None), (2050, [0.1, None] * 6), (2100, [float("nan")] * 12), (2150, [float("inf")] + [0.0] * 11)]
    rows += [(2200, [1.0, 2.0]), (2201, [0.5, -1.0]), (2250, []), (None, [0.3] * 12), (3000, [0.0] * 12), (3001, [1e6] * 12)]
    rows += rows[:20]
    out = topk.nearest(vectors(spark, rows), block_values=block_values)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, out.collect())) == by_hand(rows)


def test_few_and_no_vectors(spark):
    assert topk.nearest(vectors(spark, [])).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert sorted(map(tuple, topk.nearest(vectors(spark, rows)).collect())) == by_hand(rows)


def test_copies_have_a_rank_each(spark):
    rows = [(50, [1.0, 0.5]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.5]), (50, [1.0, 0.5])]
    out = sorted(map(tuple, topk.nearest(vectors(spark, rows)).collect()))
    assert out == by_hand(rows) and [r[2] for r in out if r[1] < 3] == [1, 1, 1, 1]


def test_wide_vectors(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 0.05) for _ in range(768)]) for i in range(120)]
    assert sorted(map(tuple, topk.nearest(vectors(spark, rows), block_values=20_000).collect())) == by_hand(rows)


def clustered(rng, n=8000, width=16, groups=20):
    centers = rng.integers(-120, 121, (groups, width))
    return centers[rng.integers(0, groups, n)] + rng.integers(-4, 5, (n, width))


def test_few_postings_are_read_where_vectors_are_clustered():
    rows = clustered(np.random.default_rng(3))
    index = topk.Index(rows)
    n, asked, scored = len(rows), range(0, 200), 0
    everything = np.arange(n)
    for q in asked:
        scores = rows @ rows[q]
        scores[q] = -(10**15)
        best = np.lexsort((everything, -scores))[:5]
        known = int(np.sort(scores[:1000])[-5])  # what the sample of an operator's run tells
        fit = index.possible(rows[q], everything != q, 5, known)
        assert set(best) <= set(fit.tolist())
        scored += len(fit)
    assert index.read < 0.5 * len(asked) * rows.size
    assert index.read + scored * rows.shape[1] < len(asked) * rows.size


@pytest.mark.parametrize("scale", [1, 1 << 24])
def test_bounds_hold_for_any_vectors(scale):
    rng = np.random.default_rng(5)
    for _ in range(40):
        rows = rng.integers(-9, 10, (rng.integers(1, 60), 6)) * scale
        index = topk.Index(rows, levels=4)
        query = rng.integers(-9, 10, 6)
        others = rng.random(len(rows)) < 0.8
        scores = np.sort((rows @ query)[others])[::-1]
        for least in (None, int(scores[2]) if len(scores) > 2 else None):
            fit = index.possible(query, others, 3, least)
            assert others[fit].all()
            assert np.sort((rows[fit] @ query))[::-1][:3].tolist() == scores[:3].tolist()
        assert not len(scores) or index.best_possible(query) >= scores[0]
