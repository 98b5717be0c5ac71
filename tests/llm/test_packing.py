"""Packing: the bins of small tables against all packings, and whole documents against the library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curbline.llm import completion, packing
from curbline.llm.wordbpe import WordVocabulary
from llm_documents import make, none, odd  # noqa: F401
from test_tokens import strings

WORDS = public_tokenizers.path("word_bpe_49k.json")


def counted(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def checked(found, sizes, capacity):
    held = Counter()
    for times, filling in found:
        assert times > 0 and 0 < sum(s * n for s, n in filling) <= capacity
        for s, n in filling:
            held[s] += times * n
    assert held == Counter(sizes)
    return sum(t for t, _ in found)


def fewest(sizes, capacity):
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity and bins[j] not in bins[:j]:
                bins[j] += sizes[i]
                place(i + 1, bins)
                bins[j] -= sizes[i]
        place(i + 1, bins + [sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best[0]


def test_fewest_bins_of_small_tables():
    rng = random.Random(8)
    better = 0
    for _ in range(250):
        capacity = rng.choice([10, 20, 50])
        sizes = [rng.randrange(1, capacity + 1) if rng.random() < 0.3 else rng.randrange(capacity // 6, capacity // 2 + 1) or 1 for _ in range(rng.randrange(1, 12))]
        counts = counted(sizes, capacity)
        bins = checked(completion.pack(counts, capacity), sizes, capacity)
        assert completion.lower_bound(counts, capacity) <= bins == fewest(sizes, capacity)
        fit = checked(completion.best_fit(counts, capacity), sizes, capacity)
        better += bins < fit
    assert better  # best fit alone is not enough


@pytest.mark.parametrize("shape", ["uniform", "small", "ones", "large", "triples"])
def test_large_tables_meet_the_bound(shape):
    rng = np.random.default_rng(2)
    sizes = {
        "uniform": rng.integers(1, 4097, 50_000),
        "small": np.minimum(4096, rng.lognormal(4.5, 1.2, 80_000).astype(int) + 1),
        "ones": np.concatenate([np.ones(300_000, int), rng.integers(1, 900, 20_000), np.full(9, 4096)]),
        "large": rng.integers(1500, 4097, 20_000),
        "triples": rng.integers(1100, 1500, 30_000),
    }[shape]
    counts = counted(sizes, 4096)
    bins = checked(completion.pack(counts, 4096, 300), sizes.tolist(), 4096)
    bound = completion.lower_bound(counts, 4096)
    assert bins <= bound + max(1, bound // 500 if shape in ("large", "triples", "uniform") else 0)


def test_ids_are_the_librarys():
    own, reference = WordVocabulary(WORDS), Tokenizer.from_file(WORDS)
    assert own.known
    extra = ["İstanbul Ⱥ Ƀ", "it's DON'T 'Re", "<|startoftext|>a<|endoftext|>", "é é", "１２ 12", "\x1ca\x85b\xa0c", "ΑΣ ΑΣ."]
    for text in strings() + extra:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def by_hand(rows, capacity):
    reference, out = Tokenizer.from_file(WORDS), []
    for i, text in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            out.append((i, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=str)


def gapless(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [4096, 16])
def test_whole_documents(spark, make, odd, capacity):
    rng = random.Random(1)
    docs = odd.unionByName(
        make([(100 + i, " ".join(rng.choices(["alpha", "be", "it's", "42"], k=rng.randrange(40))), "en", "a") for i in range(300)])
    ).repartition(5)
    out = packing.placed(docs, WORDS, capacity=capacity).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r)[:5] for r in out], key=str) == by_hand(rows, capacity)
    counts = counted([r.length for r in out], capacity)
    assert gapless(out, capacity) <= completion.lower_bound(counts, capacity) + 1


def test_sequences_hold_their_documents(spark, make):
    docs = make([(i, "word " * (i % 7), "en", "a") for i in range(50)] + [(99, None, None, None)])
    out = packing.sequences(docs, WORDS, capacity=12).collect()
    assert sorted(i for r in out for i in r.doc_ids) == [*range(50), 99]
    assert all(len(r.ids) == 4 * r.n_tokens <= 48 for r in out)
    assert sum(np.frombuffer(bytes(r.ids), "<u4").tolist().count(1) for r in out) == 51


def test_empty_table(spark, none):
    assert packing.placed(none, WORDS).collect() == []
    assert packing.placed(none, WORDS).columns == [c.split()[0] for c in packing.PLACED.split(", ")]
