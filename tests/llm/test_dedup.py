"""Exact and near duplicates against brute force, and the odd cases."""

import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from llm_documents import make, none, odd  # noqa: F401
from curbline.llm import chunk_dedup, near_dup


def exact_by_hand(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, k, i))
    out = []
    for members in groups.values():
        first = min(members)
        out += [(m[4], first[4], len(members)) for m in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("digest", [chunk_dedup.chunk_digest, lambda c: F.pmod(F.length(c), 3).cast("bigint")])
def test_exact_groups_also_when_chunks_share_digests(make, odd, digest):
    rng = random.Random(3)
    words = ["".join(rng.choices("sceuabt", k=rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 900))) for _ in range(40)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\n"]))) for i in range(160)]
    docs = make([(i, t, "en", "a") for i, t in rows]).unionByName(odd)
    want, groups = exact_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
    out = chunk_dedup.exact_groups(docs, digest=digest, sizes=(8, 40)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in out), key=str) == want
    assert sum(r["kept"] for r in out) == groups
    kept = chunk_dedup.deduplicate(docs, digest=digest, sizes=(8, 40))
    assert kept.columns == docs.columns and kept.count() == groups


def test_full_rows_are_moved_once(make):
    docs = make([(i % 40, f"text {i % 9}", "en", str(i)) for i in range(200)] + [(None, "text 1", "en", "b")] * 3)
    kept = chunk_dedup.deduplicate(docs)
    spark = docs.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = chunk_dedup.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(text_key" in line]
    assert len(moved) == 1
    one = sorted(map(str, kept.collect()))
    assert len(one) == 9 and one == sorted(map(str, chunk_dedup.deduplicate(docs.repartition(3)).collect()))


def test_chunks_are_the_whole_text_and_follow_the_content(spark):
    rng = random.Random(5)
    body = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzа中", k=60_000))
    df = spark.createDataFrame([(body,), ("xyz" * 700 + body,), ("",), ("s" * 9000,)], "text STRING")
    first, shifted, empty, flat = [r[0] for r in df.select(chunk_dedup.chunks(F.col("text"))).collect()]
    assert "".join(first) == body and empty == [] and [len(c) for c in flat] == [4096, 4096, 808]
    assert all(len(c) >= 512 for c in first[:-1])
    assert len(set(first) & set(shifted)) >= len(first) - 4


def test_exact_on_nothing(none):
    assert chunk_dedup.exact_groups(none).count() == 0 and chunk_dedup.deduplicate(none).count() == 0


def edited(rng, words, share):
    return [w if rng.random() > share else f"neu{rng.randint(0, 10**6)}" for w in words]


def near_by_hand(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        counts = defaultdict(int)
        for k in range(max(1, len(w) - 4) if w else 0):
            counts[tuple(w[k : k + 5])] += 1
        sets.append(counts)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = 0
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if not x or not y:
            near = not x and not y
        else:
            near = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y) >= 0.8
        if near:
            links += 1
            up[max(root(a), root(b))] = min(root(a), root(b))
    best = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        best[root(k)].append(i)
    ids = {r: min((i for i in m if i is not None), default=None) for r, m in best.items()}
    return [(i, ids[root(k)], len(best[root(k)])) for k, (i, _) in enumerate(rows)], links


@pytest.mark.parametrize("block", [4, 1024])
def test_near_classes_against_all_pairs(make, odd, block):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choices(words, k=60)
    rows = []
    for _ in range(5):
        base = rng.choices(words, k=rng.randint(40, 160))
        rows += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05]))) for _ in range(8)]
    rows += [" ".join(passage + rng.choices(words, k=rng.randint(5, 40))) for _ in range(12)]
    rows += [" ".join(["same line here again now"] * k) for k in (3, 4, 9)]
    docs = make([(100 + i, t, "en", "a") for i, t in enumerate(rows)]).unionByName(
        odd.where("doc_id IS NULL OR doc_id NOT IN (8, 9)")
    )
    found = near_dup.near_classes(docs, block=block)
    want, links = near_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert links > 20
    got = sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in found.collect()), key=str)
    assert got == sorted(want, key=str)


def test_a_chain_that_no_single_member_holds(make):
    """Neighbours are near, the ends are not, and no text is near to all."""
    words = [f"w{i}" for i in range(220)]
    texts = [" ".join(words[k : k + 180]) for k in range(0, 40, 8)]
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    assert {r["class_id"] for r in near_dup.near_classes(docs, block=2).collect()} == {0}


def test_keep_one_keeps_all_columns(odd, none):
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(map(str, [1, 4, 7, 8, 10, 11]))
    assert near_dup.near_classes(none).count() == 0 and near_dup.keep_one(none).count() == 0
