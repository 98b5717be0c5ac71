"""Toxicity, language identification and language-model scores: held-out quality and exact parts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_documents import make, none, odd  # noqa: F401
from curbline.llm import gru, langid, lm_score, toxicity

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}


def word(rng, letters):
    return "".join(rng.choices(letters, k=rng.randint(2, 6)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(240):
        lang = rng.choice(list(LETTERS))
        words = [word(rng, LETTERS[lang]) for _ in range(rng.randint(5, 80))]
        rows.append((i, " ".join(words), lang, "a"))
    return rows


def test_language_of_held_out_texts(make, odd, none, corpus):
    out = langid.languages_of(make(corpus)).collect()
    truth = {i: lang for i, _, lang, _ in corpus}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] == truth[r["doc_id"]] and 0.5 < r["score"] <= 1
    alone = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, langid.learn(make(corpus))).collect()}
    assert alone[1] == alone[2] == alone[3] == alone[11] == ("und", 0.0) and alone[10][0] != "und"
    assert langid.languages_of(make(corpus).unionByName(odd)).count() == len(corpus) + odd.count()
    assert langid.languages_of(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, langid.learn(none)).collect()} == {"und"}


def test_languages_are_those_of_a_plain_loop(make, odd, corpus):
    """Naive Bayes over dicts, one text at a time; only the bucket of an n-gram is the operator's."""
    signs = [(i, t + end, lang, s) for (i, t, lang, s), end in zip(corpus, [".", "", " ", "! ?", " 7 x"] * 48)]
    docs = make(signs).unionByName(odd)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]

    def grams(text):
        line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        found = [(n, line[k : k + n]) for n in langid.LENGTHS for k in range(len(line) - n + 1)]
        return [(n, bucket(g)) for n, g in found if g.strip()]

    def bucket(gram):
        code = len(gram)
        for c in gram:
            code = (code * 0x100000001B3 + ord(c)) % (1 << 64)
        return code * 0x9E3779B97F4A7C15 % (1 << 64) >> (64 - langid.BITS)

    counts, sums, texts = {}, Counter(), Counter()
    for i, t, lang in rows:
        if None not in (i, t, lang) and zlib.crc32(str(i).encode()) % 4 != 2:
            texts[lang] += 1
            counts.setdefault(lang, Counter()).update(grams(t))
    for lang, own in counts.items():
        for (n, _), c in own.items():
            sums[lang, n] += c
    out = Counter((str(r["doc_id"]), r["lang_pred"], round(r["score"], 3)) for r in langid.languages_of(docs).collect())
    expected = Counter()
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            expected[str(i), "und", 0.0] += 1
            continue
        logs = {
            lang: math.log(texts[lang] / sum(texts.values()))
            + sum(math.log((own[g] + 1) / (sums[lang, g[0]] + (1 << langid.BITS))) for g in grams(t))
            for lang, own in sorted(counts.items())
        }
        best = max(logs, key=logs.get)
        expected[str(i), best, round(1 / sum(math.exp(x - logs[best]) for x in logs.values()), 3)] += 1
    assert out == expected


def test_long_texts_are_read_to_their_end(make, corpus):
    long = " ".join(["abcd"] * 3 + ["klmn"] * 120_000)
    (r,) = langid.identify(make([(2, long, "aa", "a")]), langid.learn(make(corpus))).collect()
    assert r["lang_pred"] == "cc"


def toxic_rows(n, seed, bad=("rotzkerl", "dreckskerl", "mistvieh")):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        mark = int(rng.random() < 0.3)
        words = [word(rng, "aeioustnrl") for _ in range(rng.randint(20, 120))]
        if mark:
            for _ in range(max(2, len(words) // 25)):
                b = list(rng.choice(bad))
                k = rng.randrange(2, len(b) - 2)
                b[k] = rng.choice("aeiou")  # a spelling of its own
                words[rng.randrange(len(words))] = "".join(b)
        rows.append((i, " ".join(words), "xx", "a"))
        marks.append((i, 1, mark))
    return rows, marks


def test_toxicity_of_unseen_spellings(spark, make, odd, none):
    rows, marks = toxic_rows(700, 1)
    labels = spark.createDataFrame(marks, "doc_id BIGINT, quality INT, toxic INT")
    how = toxicity.Training(blanks=50)
    model = toxicity.learn(make(rows), labels, how=how)
    out = toxicity.score(make(rows), model, how=how).collect()
    truth = {i: m for i, _, m in marks}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.93 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out)
    scored = toxicity.score(odd, model, how=how)
    assert scored.count() == odd.count() and {r["predicted"] for r in scored.collect()} == {0}
    kept = toxicity.drop_toxic(make(rows).unionByName(odd), model, how=how)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in out) + odd.count()
    assert toxicity.scored(none, labels).count() == 0
    assert toxicity.scored(odd, labels.limit(0)).count() == odd.count()


def test_labels_of_held_out_rows_teach_nothing(spark, make):
    rows, marks = toxic_rows(120, 2)
    held = {i for i, _, _ in marks if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, q, 1 - m if i in held else m) for i, q, m in marks]
    a, b = (
        toxicity.learn(make(rows), spark.createDataFrame(m, "doc_id BIGINT, quality INT, toxic INT"), how=toxicity.Training(epochs=1, steps=1))
        for m in (marks, turned)
    )
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_a_very_long_text_and_repeated_rows_do_not_end_the_sample(spark, make):
    rows, marks = toxic_rows(160, 3)
    labels = spark.createDataFrame(marks, "doc_id BIGINT, quality INT, toxic INT")
    how = toxicity.Training(clean=60, toxic=25, steps=60, blanks=50)
    docs = make(rows)
    first = {}  # of each class the id that the sample takes first
    for r in labels.orderBy(F.xxhash64("doc_id", F.lit(how.seed))).collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % toxicity.PARTS != toxicity.REST:
            first.setdefault(r["toxic"], r["doc_id"])
    plain = toxicity.learn(docs, labels, how=how)
    for mark, n in ((0, 60), (1, 25)):
        again = docs.where(F.col("doc_id") == first[mark]).crossJoin(spark.range(n).select())
        numbers, bias = toxicity.learn(docs.unionByName(again), labels, how=how)
        assert np.array_equal(numbers, plain[0]) and bias == plain[1]
    long = F.when(F.col("doc_id") == first[0], F.repeat(F.lit("aeiou "), 2_500_000)).otherwise(F.col("text"))
    model = toxicity.learn(docs.withColumn("text", long), labels, how=how)
    truth = {i: m for i, _, m in marks}
    out = toxicity.score(docs, model, how=how).collect()
    constant = max(Counter(truth.values()).values())  # what the same answer for all gets right
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) > constant + 10


def lm_tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [" "]


def test_scores_and_their_exact_parts(make, odd, none, corpus, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 60)  # most words take the way through the join
    docs = make(corpus).unionByName(odd)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(lm_tokens(t))
    total, distinct = sum(counts.values()), len(counts)

    def key(i, t):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in lm_tokens(t))
        return str(i), len(lm_tokens(t)), sum(counts[w] > 0 for w in lm_tokens(t)), round(base, 6)

    out = lm_score.scores(docs).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out)
    assert got == sorted(key(i, t) for i, t in rows)
    assert {r["train_tokens"] for r in out} == {total}
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["n_tokens"] > 3]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm_score.scores(none).count() == 0


def test_words_are_cut_as_the_contract_says():
    import pyarrow as pa

    texts = ["", "  ", " A\x0bb\x0cC\td\re\nf  ", "\x1cx\x85y\u00a0Z \u2003 \u00c4", "one"]
    words, sizes = lm_score.words_of(pa.array(texts, pa.string()))
    expected = [lm_tokens(t)[:-1] for t in texts]
    assert [w.decode() for w in words.to_pylist()] == sum(expected, []) and sizes.tolist() == list(map(len, expected))


def test_score_is_a_loop_over_tokens(make, corpus, monkeypatch):
    """Every text by itself, a token at a time: class, unit in the class, share of the rest."""
    monkeypatch.setattr(lm_score, "FREQUENT", 400)
    kept = {}
    for name in ("make_units", "unit_room", "fit_network"):
        def keep(*args, own=getattr(lm_score, name), name=name, **more):
            kept[name] = own(*args, **more)
            return kept[name]

        monkeypatch.setattr(lm_score, name, keep)
    out = {r["doc_id"]: r["score"] for r in lm_score.scores(make(corpus)).collect()}
    known, room, lay = kept["make_units"], kept["unit_room"], lm_score.LAYOUT
    model = gru.unpacked(kept["fit_network"].astype(np.float64), lay)
    unit_of = dict(zip(known.words, known.units.tolist()))
    counts = Counter(w for i, t, *_ in corpus if zlib.crc32(str(i).encode()) % 7 != 2 for w in lm_tokens(t))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    H = gru.HIDDEN
    for i, text, *_ in corpus[::12]:
        h, total = np.zeros(H), 0.0
        for token in lm_tokens(text):
            raw = token.encode()
            unit = unit_of.get(raw)
            if unit is None:
                unit = int(lm_score.rest_of(lm_score.group_of([raw], known.centres))[0])
            group, cell = divmod(unit - lay.alone, lay.cells)
            of_class = softmax(h @ model["output"] + model["output_bias"])
            if unit < lay.alone:
                chance = of_class[unit]
            else:
                inside = softmax(h @ model["within"][group] + model["within_bias"][group])
                chance = of_class[lay.alone + group] * inside[cell]
                if cell == lay.cells - 1:
                    chance *= (counts[token] + 1) / room[unit]
            total += math.log10(chance)
            x, back = model["input"][unit] + model["bias"], h @ model["state"]
            update, reset = sigmoid(x[:H] + back[:H]), sigmoid(x[H : 2 * H] + back[H : 2 * H])
            fresh = np.tanh(x[2 * H :] + reset * back[2 * H :])
            h = update * h + (1 - update) * fresh
        assert out[i] == pytest.approx(total, rel=1e-4)


@pytest.mark.parametrize("lay", [gru.Layout(6, 0, 1), gru.Layout(2, 2, 2)])
def test_the_network_is_a_distribution_and_learns(lay):
    rng = np.random.default_rng(1)
    n = 6
    prior = np.full(n, 1 / n)
    flat = gru.initial(lay, 1, prior)
    # all sequences of three classes share the whole probability
    every = [np.array([a, b, c], np.uint8) for a in range(n) for b in range(n) for c in range(n)]
    assert np.exp(gru.log_chances(flat, every, lay)).sum() == pytest.approx(1, abs=1e-4)
    # texts that stay within one half of the classes
    texts = [rng.integers(0, 3, 40).astype(np.uint8) + 3 * rng.integers(0, 2, dtype=np.uint8) for _ in range(1500)]
    trained = gru.train(flat, texts[:1200], lay)
    per_token = gru.log_chances(trained, texts[1200:], lay).sum() / (300 * 40)
    assert per_token > -1.35  # log(1/6) is -1.79, log(1/3) is -1.10
    assert np.exp(gru.log_chances(trained, every, lay)).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("lay", [gru.Layout(4, 0, 1), gru.Layout(0, 2, 2), gru.Layout(1, 1, 3)])
def test_gradients_are_those_of_the_loss(lay):
    flat = gru.initial(lay, 3, np.full(4, 0.25)).astype(np.float64)
    text = np.array([0, 1, 2, 3, 1, 0, 2, 1], np.uint8)

    def loss(x):
        return -gru.log_chances(x, [text], lay)[0] / len(text)

    model = gru.unpacked(flat.copy(), lay)
    seen = np.full(len(flat), 1e30)  # steps too small to move: the sum of squares keeps the gradient
    base = flat.copy()
    gru._window(model, base, seen, text[:, None].astype(np.int64), np.array([[k == 0] for k in range(8)]), np.zeros((1, gru.HIDDEN)), lay)
    rng = np.random.default_rng(2)
    moved = flat.copy()
    zero = np.zeros(len(flat))
    gru._window(gru.unpacked(moved, lay), moved, zero, text[:, None].astype(np.int64), np.array([[k == 0] for k in range(8)]), np.zeros((1, gru.HIDDEN)), lay)
    for i in rng.choice(len(flat), 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        slope = (loss(up) - loss(down)) / 2e-4
        assert zero[i] == pytest.approx(slope**2, abs=2e-5)
