"""Mixing: targets against the sharing done step by step, and what every mix must keep."""

import random

import pytest
from pyspark.sql import functions as F

from llm_documents import make, none, odd  # noqa: F401
from curbline.llm import mixing


def shared_out(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, open_ones, rest = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while rest > 1e-9 and open_ones:
        whole = sum(weight[s] for s in open_ones)
        over = 0.0
        for s in list(open_ones):
            target[s] += rest * weight[s] / whole
            if target[s] >= 3 * sizes[s]:
                over += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_ones.discard(s)
        rest = over
    return target


@pytest.fixture(scope="module")
def docs(make):
    rng = random.Random(2)
    rows = []
    for i in range(500):
        source = rng.choice(["hot"] * 6 + ["a", "b", "é", "Z", None, "zero"])
        n = 0 if source == "zero" else rng.choice([0, 1, 7, 40, 300])
        rows.append((i, " ".join(["w"] * n), "en", source))
    return make(rows + [(900, "one two", "en", "tiny"), (None, "a b c", "en", "a"), (7, "w w", "en", "b"), (7, "w w", "en", "b")])


@pytest.mark.parametrize("block", [8, 64])
def test_targets_taken_and_limits(docs, block):
    taken, sources, plan = mixing.mix(docs, block_words=block, shard_slots=32)
    rows = taken.collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = shared_out(sizes)
    got = {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
    for source, target in want.items():
        assert got[source] == round(target)  # the last slot is cut to meet it
    # every slot of a source is dealt once, and no block more often than its passes
    slots = plan.collect()
    quota = {r["source_no"]: r["slots"] for r in sources.collect()}
    for number, n in quota.items():
        assert sorted(s["ordinal"] for s in slots if s["source_no"] == number) == list(range(n))


def test_reruns_agree(docs):
    def run(df):
        taken, _, _ = mixing.mix(df, block_words=16)
        return sorted(map(str, taken.drop("row").collect()))

    assert run(docs) == run(docs.repartition(7))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 128])
def test_permutations(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("bigint"))
    for key in (1, 2):
        out = [r[0] for r in df.select(mixing.permuted(F.col("id"), F.col("n"), F.lit(key), 5)).collect()]
        assert sorted(out) == list(range(n))
    if n > 50:
        assert sum(abs(a - b) == 1 for a, b in zip(out, out[1:])) < n / 4


def test_shards_draw_by_the_targets(docs):
    _, sources, plan = mixing.mix(docs, block_words=4, shard_slots=200)
    quota = {r["source_no"]: r["slots"] for r in sources.collect()}
    total = sum(quota.values())
    shards = {}
    for s in plan.collect():
        counts = shards.setdefault(s["shard"], {})
        counts[s["source_no"]] = counts.get(s["source_no"], 0) + 1
    assert all(sum(shards[k].values()) == 200 for k in range(total // 200))
    for k in range(total // 400):  # towards the end, slots pass to sources below their quota
        c = shards[k]
        for number, n in quota.items():
            p = n / total
            assert abs(c.get(number, 0) - 200 * p) <= 6 * (200 * p * (1 - p)) ** 0.5 + 3


def test_documents_of_the_mix(docs, odd, none):
    taken, _, _ = mixing.mix(docs, block_words=8)
    mixed = mixing.mixed_documents(docs, block_words=8)
    assert mixed.columns == docs.columns
    share = {r["doc_id"]: r["taken"] / r["size"] for r in taken.collect() if r["size"] and r["doc_id"] not in (7, None)}
    counts = {}
    for r in mixed.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    for i, x in share.items():
        assert int(x) <= counts.get(i, 0) <= int(x) + (x % 1 > 0)
    assert mixing.mix(odd)[0].count() == odd.count()
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix(none)[0].count() == 0 and mixing.mixed_documents(none).count() == 0


def test_repeated_rows_and_rows_without_id(make):
    """Half of all rows have no id, some are repeated often: targets are met all the same."""
    rng = random.Random(8)
    rows = [(None, " ".join(["w"] * rng.randrange(1, 60)) + f" {i}", "en", "hot") for i in range(400)]
    rows += [(5, "a b c d e f g h", "en", "a")] * 20 + [(6, "x y z", "en", "b")] * 300
    rows += [(100 + i, f"v {i} v v", "en", "c") for i in range(400)]
    docs = make(rows)
    options = {"block_words": 8, "shard_slots": 64}
    taken, _, _ = mixing.mix(docs, **options)
    target, got = {}, {}
    for r in taken.collect():
        target[r["source"]] = r["target"]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
    assert got == {s: round(t) for s, t in target.items()}
    out = mixing.mixed_documents(docs, **options).collect()
    words = {}
    for r in out:
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    for s in ("a", "b"):  # one text each, so only the last copy is left to chance
        size = 8 if s == "a" else 3
        assert abs(words[s] - target[s]) <= max(size, 0.01 * target[s])
    assert set(out[0].asDict()) == set(docs.columns)


def test_many_sources(make):
    docs = make([(i, "w " * (i % 7), "en", f"s{i:04}") for i in range(600)])
    taken, sources, plan = mixing.mix(docs, block_words=4, shard_slots=32)
    quota = {r["source_no"]: r["slots"] for r in sources.collect() if r["slots"]}
    dealt = {}
    for r in plan.collect():
        dealt[r["source_no"]] = dealt.get(r["source_no"], 0) + 1
    assert dealt == quota
