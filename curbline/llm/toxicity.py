"""Toxicity: embeddings of a text's words and subwords, averaged into a linear softmax.

The vectors and the softmax are trained jointly, by gradient steps over small groups of labelled
texts in numpy. Words share the vectors of their character n-grams, so misspellings that were never
seen lean on the n-grams they keep. The trained model comes down to one number per bucket (the
difference of the two classes' logits), and a text's logit is the mean of its buckets' numbers;
this small table is broadcast and every whole text is scored where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, remainder, ship
from .grams import Stream, segments

LENGTHS = (3, 4, 5, 6)
PARTS, REST = 5, 0  # fixed values: rows whose crc32 modulo 5 is 0 are held out
ENTRY = np.dtype([("bucket", "<i4"), ("share", "<f4")])  # of a stored bag


@dataclass(frozen=True)
class Training:
    """The sample is bounded: at most `clean` and `toxic` labelled ids of the two classes, by hash
    of the id. Each gives one whole text, however long it is.
    Every text's mean is taken as if it had `blanks` more features with the zero vector, so a few
    rare words do not decide on a short text."""

    clean: int = 3000
    toxic: int = 1000
    blanks: int = 1000
    bits: int = 18
    size: int = 8
    epochs: int = 10
    steps: int = 800  # a small sample is walked through more often, until it has had so many
    group: int = 32
    rate: float = 1.0
    seed: int = 7


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and text of every word and of every n-gram inside words. A word repeated directly
    behind itself counts once."""
    stream = Stream(texts, "isalnum", once=True)
    found = [stream.words(bits), *(stream.grams(n, bits, True) for n in LENGTHS)]
    return np.concatenate([b for b, _ in found]), np.concatenate([t for _, t in found]), stream.n


def _bags(texts: list[str], bits: int, blanks: int) -> Iterator[np.ndarray]:
    """For each text its distinct buckets and their shares. A bag has at most an entry per bucket,
    whatever the length of the text."""
    tally, at = np.zeros(1 << bits, np.int64), 0

    def closed() -> np.ndarray:
        buckets = np.flatnonzero(tally)
        counts = tally[buckets]
        tally[buckets] = 0
        bag = np.empty(len(buckets), ENTRY)
        bag["bucket"], bag["share"] = buckets, counts / max(1, counts.sum() + blanks)
        return bag

    for numbers, parts in segments(texts):
        bucket, owner, n = features(parts, bits)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(n + 1))
        for i, number in enumerate(numbers):
            if number > at:
                yield closed()
                at = number
            tally += np.bincount(bucket[order[bounds[i] : bounds[i + 1]]], minlength=1 << bits)
    if texts:
        yield closed()


def fit(bags: Sequence[np.ndarray], marks: list[int], how: Training = Training()) -> tuple[np.ndarray, float]:
    """(number per bucket, bias): the logit of class 1 is their mean over a text plus the bias."""
    rng = np.random.default_rng(how.seed)
    width = 1 << how.bits
    vectors = np.zeros((how.size, width), np.float32)  # what is never seen says nothing
    softmax = rng.normal(0, 1, (how.size, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = np.full(width, 1e-8, np.float32)
    seen_softmax, seen_bias = np.full((how.size, 2), 1e-6), np.full(2, 1e-6)
    marks = np.array(marks, np.int64)
    if len(bags) == 0 or marks.min() == marks.max():
        chance = 0.0 if len(bags) == 0 or marks.min() == 0 else 1.0
        return np.zeros(width, np.float32), (20.0 * chance - 10.0)
    groups = max(1, len(bags) // how.group)
    for _ in range(max(how.epochs, -(-how.steps // groups))):
        for own in np.array_split(rng.permutation(len(bags)), groups):
            bucket = np.concatenate([bags[i]["bucket"] for i in own])
            share = np.concatenate([bags[i]["share"] for i in own])
            lengths = [len(bags[i]) for i in own]
            owner = np.repeat(np.arange(len(own)), lengths)
            means = np.stack(
                [np.bincount(owner, v[bucket] * share, len(own)) for v in vectors], axis=1
            )
            logits = means @ softmax + bias
            chances = np.exp(logits - logits.max(axis=1, keepdims=True))
            chances /= chances.sum(axis=1, keepdims=True)
            error = chances
            error[np.arange(len(own)), marks[own]] -= 1
            error /= len(own)
            back = (error @ softmax.T).astype(np.float32)
            step_softmax, step_bias = means.T @ error, error.sum(axis=0)
            seen_softmax += step_softmax**2
            seen_bias += step_bias**2
            softmax -= (how.rate * step_softmax / np.sqrt(seen_softmax)).astype(np.float32)
            bias -= (how.rate * step_bias / np.sqrt(seen_bias)).astype(np.float32)
            touched, place = np.unique(bucket, return_inverse=True)
            steps = np.stack(
                [np.bincount(place, share * back[owner, d], len(touched)) for d in range(how.size)]
            )
            seen[touched] += (steps**2).mean(axis=0)
            vectors[:, touched] -= (how.rate * steps / np.sqrt(seen[touched])).astype(np.float32)
    toward = softmax[:, 1] - softmax[:, 0]
    return (toward @ vectors).astype(np.float32), float(bias[1] - bias[0])


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
    mark: str = "toxic", how: Training = Training(),
) -> tuple[np.ndarray, float]:
    """The model from a bounded sample of labelled rows that are not held out.

    Null texts and marks
    other than 0 and 1 teach nothing; an id marked both ways counts as marked 1. An id that stands
    in several rows is one text, that of the smallest digest."""
    ship(docs.sparkSession)
    marked = (
        labels.where(F.col(mark).isin(0, 1) & (remainder(id_col, PARTS) != REST))
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg(F.max(mark).alias("mark"))
    )
    own = docs.where(F.col(text).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text), F.lit(how.seed)).alias("digest")
    )
    single = (
        own.select("doc_id", "digest").join(marked, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("digest"), F.max("mark").alias("mark"))
    )
    clean, toxic = (
        single.where(F.col("mark") == m).orderBy(F.xxhash64("doc_id", F.lit(how.seed)), "doc_id").limit(n)
        for m, n in ((0, how.clean), (1, how.toxic))
    )
    sample = own.join(F.broadcast(clean.union(toxic)), ["doc_id", "digest"]).dropDuplicates(["doc_id"])

    def bagged(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in range(batch.num_rows):
                for bag in _bags(batch.column(2).slice(row, 1).to_pylist(), how.bits, how.blanks):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1), pa.array([bag.tobytes()], pa.binary())],
                        ["doc_id", "mark", "bag"],
                    )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in stream:
            for doc_id, own_mark, bag in zip(*(batch.column(k) for k in range(3))):
                held.append((doc_id.as_py(), own_mark.as_py(), np.frombuffer(bag.as_buffer(), ENTRY)))
        held.sort(key=lambda row: row[:2])
        numbers, bias = fit([bag for _, _, bag in held], [m for _, m, _ in held], how)
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers.tobytes()], pa.binary()), pa.array([bias])], ["numbers", "bias"]
        )

    # Texts become bags where they are read; the bags, as many as the sample has texts, are learned
    # from in one task. Only the model comes to the driver.
    id_type = own.schema["doc_id"].dataType.simpleString()
    bags = sample.select("doc_id", "mark", "text").mapInArrow(
        bagged, f"doc_id {id_type}, mark {sample.schema['mark'].dataType.simpleString()}, bag BINARY"
    )
    found = bags.repartition(1).mapInArrow(batches, "numbers BINARY, bias DOUBLE").first()
    if found is None:
        return fit([], [], how)
    return np.frombuffer(found["numbers"], np.float32), found["bias"]


def _scores(texts: list[str], numbers: np.ndarray, bias: float, how: Training) -> np.ndarray:
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for places, parts in segments(texts):
        bucket, owner, n = features(parts, how.bits)
        np.add.at(sums, places, np.bincount(owner, weights=numbers[bucket], minlength=n))
        np.add.at(counts, places, np.bincount(owner, minlength=n))
    logit = sums / np.maximum(counts + how.blanks, 1) + bias
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", id_col: str = "doc_id",
    how: Training = Training(),
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts, and texts without letters or digits, get the bias alone. A null id counts
    as held out; repeated rows repeat; an empty table gives none; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bias = sent.value
        for batch in stream:
            texts = [x or "" for x in batch.column(2).to_pylist()]
            found = _scores(texts, numbers, bias, how)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col, PARTS, REST).alias("held_out"),
        F.col(text).alias("text"),
    ).mapInArrow(batches, "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT")


def drop_toxic(
    docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", how: Training = Training()
) -> DataFrame:
    """The documents scored below one half, with all their columns; null and empty texts stay
    unless the bias alone is at one half."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bias = sent.value
        for batch in stream:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(_scores(texts, numbers, bias, how) < 0.5))

    return docs.mapInArrow(batches, docs.schema)


def scored(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """Learn from the labels and score every document."""
    return score(docs, learn(docs, labels, how=how), how=how)
