"""Byte-level BPE encoding and decoding of whole texts over Arrow batches.

Every text is encoded where its row is read; nothing is shuffled. A batch is as large as the
session's Arrow limits allow, and one text is worked on at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bytebpe import RankVocabulary, loaded
from .common import ship

ENCODED = "doc_id BIGINT, ids ARRAY<INT>, starts ARRAY<INT>, ends ARRAY<INT>"
DECODED = "doc_id BIGINT, data BINARY, text STRING"
DIGESTS = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
PACKED = "doc_id BIGINT, n_tokens BIGINT, ids BINARY, ids_sha256 STRING, decoded_sha256 STRING"


def _rows(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, ids, and the first and end character of every token.

    Null counts as empty, and an empty text has no ids. A null id stays null, repeated rows give
    repeated results, an empty table none. Other columns are not read.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(RankVocabulary, path, pattern)
        for batch in stream:
            ids, starts, ends = [], [], []
            for value in batch.column(1):
                whole = value.as_py()
                own = np.frombuffer(vocabulary.encode(whole), "<u4")
                first, end = vocabulary.spans(own, whole.encode())
                ids.append(own.astype("<i4"))
                starts.append(first.astype("<i4"))
                ends.append(end.astype("<i4"))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (ids, starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *lists], ["doc_id", "ids", "starts", "ends"]
            )

    return _rows(docs, text, id_col).mapInArrow(batches, ENCODED)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, the bytes of the ids, and the text they spell; bytes that are no UTF-8 come out as
    U+FFFD in the text. Null ids count as none."""
    ship(encoded.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(RankVocabulary, path, pattern)
        for batch in stream:
            data = [vocabulary.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            texts = [d.decode("utf-8", "replace") for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary()), pa.array(texts, pa.string())],
                ["doc_id", "data", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(batches, DECODED)


def _round_trip(docs, path, pattern, text, id_col, with_ids):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(RankVocabulary, path, pattern)
        for batch in stream:
            found = {"n_tokens": [], "ids": [], "ids_sha256": [], "decoded_sha256": []}
            for value in batch.column(1):
                ids = vocabulary.encode(value.as_py())
                data = vocabulary.decode(np.frombuffer(ids, "<u4"))
                found["n_tokens"].append(len(ids) // 4)
                found["ids"].append(ids if with_ids else None)
                found["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                found["decoded_sha256"].append(hashlib.sha256(data).hexdigest())
            kinds = {"n_tokens": pa.int64(), "ids": pa.binary()}
            names = [n for n in found if with_ids or n != "ids"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[n], kinds.get(n, pa.string())) for n in names)],
                ["doc_id", *names],
            )

    rows = _rows(docs, text, id_col)
    return rows.mapInArrow(batches, PACKED if with_ids else DIGESTS)


def digests(
    docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes; the cases of `encode` hold."""
    return _round_trip(docs, path, pattern, text, id_col, False)


def packed(
    docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """The digests, and the ids as little-endian unsigned 32-bit integers for writing out."""
    return _round_trip(docs, path, pattern, text, id_col, True)
