"""Token counts through a stored cache of digests.

A count belongs to (digest of the content, digest of the tokenizer's file). Texts whose pair is in
the cache are not encoded again; of the others, each distinct text is encoded once, wherever its
copies stand, and its count is appended to the cache. The counts then meet the documents by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bytebpe import JsonVocabulary, loaded
from .common import ship

CACHE = "content STRING, tokenizer STRING, n_tokens BIGINT"
LIMIT = 1024  # fixed value: tokens of the context that texts are held against


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as source:
        return hashlib.file_digest(source, "sha256").hexdigest()


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; none where nothing has been stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(cache).distinct()


def _counted(path: str):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(JsonVocabulary, path)
        for batch in stream:
            counts = [vocabulary.count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], ["content", "n_tokens"]
            )

    return batches


def refresh_cache(docs: DataFrame, path: str, cache: str, text: str = "text") -> None:
    """Append the counts of texts that the cache lacks for this tokenizer."""
    spark = docs.sparkSession
    ship(spark)
    tokenizer = tokenizer_digest(path)
    stored = read_cache(spark, cache).where(F.col("tokenizer") == tokenizer).select("content")
    # Equal texts meet once, after each task has dropped its own copies; the text is in the
    # key, so no two texts can pass for one.
    distinct = (
        docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
        .select(F.sha2("text", 256).alias("content"), "text")
        .distinct()
    )
    (
        distinct.join(stored, "content", "left_anti")
        .select("content", "text")
        .mapInArrow(_counted(path), "content STRING, n_tokens BIGINT")
        .select("content", F.lit(tokenizer).alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )


def token_counts(
    docs: DataFrame,
    path: str,
    cache: str,
    text: str = "text",
    id_col: str = "doc_id",
    limit: int = LIMIT,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    Null counts as empty: no bytes, no tokens. Null ids stay null, repeated rows repeat, an empty
    table gives none; columns but text and id are not read. The content is digested as it stands,
    as the vocabularies here know no normal form of their own.
    """
    spark = docs.sparkSession
    refresh_cache(docs, path, cache, text)
    counts = (
        read_cache(spark, cache)
        .where(F.col("tokenizer") == tokenizer_digest(path))
        .select("content", "n_tokens")
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(whole).cast("long").alias("n_bytes"),
            F.sha2(whole, 256).alias("content"),
        )
        .join(counts, "content")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
