"""Signatures and similarities in numpy."""

import random

import numpy as np
import pytest

from curbline.llm.probsign import signatures, similarity, weighted_shingles


def direct(x, y):
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)


def arrays(counts):
    keys = sorted(counts)
    return np.array(keys, np.uint64), np.array([counts[k] for k in keys], np.int32)


@pytest.mark.parametrize("seed", range(6))
def test_similarity_is_the_definition(seed):
    rng = random.Random(seed)
    x = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(25)}
    y = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(25)}
    assert similarity(*arrays(x), *arrays(y)) == pytest.approx(direct(x, y))


def test_signatures_estimate_it():
    rng = random.Random(4)
    base = {rng.getrandbits(60): rng.choice([1, 1, 1, 4]) for _ in range(300)}
    for share in (0.02, 0.1, 0.4):
        other = {(k if rng.random() > share else rng.getrandbits(60)): w for k, w in base.items()}
        (a, aw), (b, bw) = arrays(base), arrays(other)
        owner = np.repeat([0, 1], [len(a), len(b)])
        kept = signatures(np.concatenate([a, b]), np.concatenate([aw, bw]), owner, 2, 1024, 7)
        assert (kept[0] == kept[1]).mean() == pytest.approx(direct(base, other), abs=0.06)


def test_signatures_fill_every_register_for_one_shingle():
    kept = signatures(np.array([9], np.uint64), np.array([3]), np.array([0]), 1, 128, 1)
    assert (kept == 9).all()


def test_shingles_of_few_words_and_none():
    _, counts, owner, digest = weighted_shingles(["a b", "", "a b c d e f a b c d e", "A  B\n"])
    assert owner.tolist().count(0) == 1 and owner.tolist().count(1) == 0
    assert digest[0] == digest[3] != digest[2]
    assert sorted(counts[owner == 2].tolist()) == [1] * 5 + [2]
