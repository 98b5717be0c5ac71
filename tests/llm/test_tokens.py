"""Tokens against the libraries, and the cache of counts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_documents import make, none, odd  # noqa: F401
from curbline.llm import bpe, token_counts
from curbline.llm.bytebpe import JsonVocabulary, RankVocabulary

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n=4000, seed=2):
    rng = random.Random(seed)
    pools = [
        [chr(c) for c in range(0x250)],
        list(" \t\n\r\x0b\x0c\x85\xa0ab1'sdét"),
        list("aaabc "),
        [chr(c) for c in (*range(32, 300), 0x4E00, 0x1F600, 0x200D, 0x2003, 0x3000, 0x301, 0x2028, 0x1C, 0x1F)],
        [*"<|endoftext|> a", "<|endoftext|>"],
    ]
    return ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 40))) for _ in range(n)]


def test_any_pattern_cuts_all_texts():
    pattern = r"\p{L}|\p{N}{1,2}|[^\p{L}\p{N}]+"  # letters stand alone
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = RankVocabulary(RANKS, pattern)
    assert RankVocabulary(RANKS, public_tokenizers.PATTERN).usual and not own.usual
    for text in ("hello world 12345", "it's  ", "\u4e2d hello 123", "", "\xe9t\xe9\n"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == other.encode_ordinary(text)



def test_ids_are_the_librarys(reference):
    own = RankVocabulary(RANKS, public_tokenizers.PATTERN)
    for text in strings():
        ids = np.frombuffer(own.encode(text), "<u4")
        assert ids.tolist() == reference.encode_ordinary(text)
        assert own.decode(ids) == text.encode() and own.decode(ids, 3) == text.encode()


def test_counts_are_the_librarys():
    own, library = JsonVocabulary(COUNTED), Tokenizer.from_file(COUNTED)
    for text in strings(seed=3):
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_spans_cover_split_characters(spark, make):
    texts = ["naïve \U0001f600\U0001f468‍\U0001f469 ok", "中文 text", "plain", ""]
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect():
        text = texts[r["doc_id"]]
        assert len(r["ids"]) == len(r["starts"]) == len(r["ends"])
        reached = 0
        for start, end in zip(r["starts"], r["ends"]):
            assert start <= reached and start < end
            reached = end
        assert reached == len(text)


def test_round_trip_and_odd_rows(odd, none, reference):
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    want = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in decoded.collect()), key=str) == want
    rows = bpe.digests(odd, RANKS, public_tokenizers.PATTERN).collect()
    ids = {t: np.array(reference.encode_ordinary(t), "<u4").tobytes() for _, t in want}
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(
        (str(i), len(ids[t]) // 4, hashlib.sha256(ids[t]).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for i, t in want
    )
    assert bpe.digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_half_a_character(spark):
    half = spark.createDataFrame([(1, [int(x) for x in RankVocabulary(RANKS, public_tokenizers.PATTERN).encode("中")[:1]])], "doc_id BIGINT, ids ARRAY<INT>")
    assert bpe.decode(half, RANKS, public_tokenizers.PATTERN).first()["text"] is not None


def test_cache_encodes_each_text_once(spark, make, odd, tmp_path):
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(COUNTED)
    out = token_counts.token_counts(odd, COUNTED, cache, limit=6).collect()
    assert len(out) == odd.count()
    texts = defaultdict_of(odd)
    for r in out:
        assert (r["n_tokens"], r["n_bytes"]) in texts[r["doc_id"]]
        assert r["over_limit"] == (r["n_tokens"] > 6)
    distinct = odd.select(F.coalesce("text", F.lit("")).alias("t")).distinct().count()
    assert spark.read.parquet(cache).count() == distinct
    # a stored count is used, and only new texts are added
    more = odd.unionByName(make([(50, "something new", "en", "a")]))
    changed = spark.read.parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 1000)
    other = str(tmp_path / "other")
    changed.write.parquet(other)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(more, COUNTED, other).collect()}
    assert found[2] == 1000 and found[50] == len(library.encode("something new").ids)
    assert spark.read.parquet(other).count() == distinct + 1
    # another tokenizer has counts of its own
    words = public_tokenizers.path("word_bpe_49k.json")
    again = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(more, words, other).collect()}
    assert again[50] == len(Tokenizer.from_file(words).encode("something new", add_special_tokens=False).ids)


def defaultdict_of(odd):
    library, found = Tokenizer.from_file(COUNTED), {}
    for r in odd.collect():
        t = r["text"] or ""
        found.setdefault(r["doc_id"], set()).add((len(library.encode(t, add_special_tokens=False).ids), len(t.encode())))
    return found


def test_cache_on_nothing(none, tmp_path):
    assert token_counts.token_counts(none, COUNTED, str(tmp_path / "cache")).count() == 0
