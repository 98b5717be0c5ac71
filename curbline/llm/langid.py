"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are added up over all learning rows, first in the tasks, then by
Spark; only the matrix of languages x buckets comes to the driver and goes out as log
probabilities. Its size depends on the number of languages and buckets, not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, remainder, ship
from .grams import Stream, segments

BITS = 14
LENGTHS = (1, 2, 3)
PARTS, REST = 4, 2  # fixed values: rows whose crc32 modulo 4 is 2 are held out
UNKNOWN = "und"


def _buckets(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of all n-grams (those of each length in buckets of their own), and which
    texts have a letter."""
    stream = Stream(texts, "isalpha")
    found = [stream.grams(n, bits, False) for n in LENGTHS]
    bucket = np.concatenate([b + (k << bits) for k, (b, _) in enumerate(found)])
    return bucket, np.concatenate([t for _, t in found]), stream.has


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", bits: int = BITS
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log probabilities [bucket, language]) from all learning rows: those
    with text and language whose id is not held out."""
    ship(docs.sparkSession)
    width = len(LENGTHS) << bits

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in stream:
            names = np.array(batch.column(1).to_pylist(), object)
            texts = batch.column(0).to_pylist()
            for name in sorted(set(names)):
                own = counts.setdefault(name, np.zeros(width + 1, np.int64))
                mine = [texts[i] for i in np.flatnonzero(names == name)]
                own[width] += len(mine)
                for _, parts in segments(mine):
                    own[:width] += np.bincount(_buckets(parts, bits)[0], minlength=width)
        for name, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(own[at])],
                ["lang", "bucket", "n"],
            )

    learning = docs.where(
        F.col(text).isNotNull() & F.col(lang).isNotNull() & (remainder(id_col, PARTS) != REST)
    )
    sums = (
        learning.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .mapInArrow(batches, "lang STRING, bucket BIGINT, n BIGINT")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(set(sums["lang"]))
    counts = np.zeros((width + 1, len(languages)))
    number = {name: k for k, name in enumerate(languages)}
    counts[sums["bucket"].astype(int), sums["lang"].map(number).astype(int)] = sums["n"]
    rows, grams = counts[width], counts[:width] + 1.0
    for k in range(len(LENGTHS)):  # every length is a distribution of its own
        part = grams[k << bits : (k + 1) << bits]
        part /= part.sum(axis=0, keepdims=True)
    prior = np.log(rows / rows.sum()) if len(languages) else rows
    return languages, prior, np.log(grams)


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray, np.ndarray],
    text: str = "text",
    id_col: str = "doc_id",
    bits: int = BITS,
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (the model's probability of lang_pred).

    `und` with score 0 where the text is null or has no letter, or where nothing was learned. Equal
    languages go by code point. A null id counts as held out; repeated rows repeat; an empty table
    gives none; columns but text, language and id are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    languages, prior, logs = model
    sent = spark.sparkContext.broadcast((prior, logs.astype(np.float32)))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, logs = sent.value
        for batch in stream:
            texts = [x or "" for x in batch.column(2).to_pylist()]
            sums, letters = np.tile(prior, (len(texts), 1)), np.zeros(len(texts), bool)
            for places, parts in segments(texts):
                bucket, owner, has = _buckets(parts, bits)
                np.logical_or.at(letters, places, has)
                for k in range(len(languages)):
                    own = np.bincount(owner, weights=logs[:, k][bucket], minlength=len(parts))
                    np.add.at(sums[:, k], places, own)
            if languages:
                chances = np.exp(sums - sums.max(axis=1, keepdims=True))
                chances /= chances.sum(axis=1, keepdims=True)
                scores = np.where(letters, chances.max(axis=1), 0.0)
                names = zip(chances.argmax(axis=1), letters)
                best = [languages[k] if ok else UNKNOWN for k, ok in names]
            else:
                scores, best = np.zeros(len(texts)), [UNKNOWN] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col, PARTS, REST).alias("held_out"),
        F.col(text).alias("text"),
    ).mapInArrow(batches, "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE")


def languages_of(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learn from the documents and identify every one of them."""
    return identify(docs, learn(docs, text, lang, id_col), text, id_col)
