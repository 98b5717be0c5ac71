"""Packing of whole documents into as few sequences of bounded length as possible.

Documents are encoded where they are read; only one longer than a sequence is cut. What decides
about a packing is how many pieces there are of each length: a table of at most as many rows as a
sequence has tokens, whatever the corpus. completion.py packs that table. Each piece then
finds its place by its number among the pieces of its length: the number within the task that
encoded it, plus the pieces of that length in the tasks before. So all documents are packed
together, no group of documents meets in one task, and the driver holds the table of lengths and
the fillings only.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import completion
from .bytebpe import loaded
from .common import portions, shared_dir, ship
from .wordbpe import WordVocabulary

CAPACITY = 4096  # fixed value
END = 1  # fixed value: the id that ends a document
PORTION = 4_000_000  # characters worked on at a time
PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, ids BINARY, task BIGINT, place BIGINT"
PLACED = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, sequence_id BIGINT, offset BIGINT"


def _cut(path: str, capacity: int, end: int, keep: bool):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(WordVocabulary, path)
        task, met = TaskContext.get().partitionId(), Counter()
        last = np.array([end], "<u4").tobytes()
        for batch in stream:
            for own in portions(batch, 1, PORTION):
                found = []
                for doc_id, text in zip(own.column(0).to_pylist(), own.column(1)):
                    ids = vocabulary.encode(text.as_py()) + last
                    for at in range(0, len(ids), 4 * capacity):
                        data = ids[at : at + 4 * capacity]
                        length = len(data) // 4
                        found.append(
                            (doc_id, at // (4 * capacity), at // 4, length, zlib.crc32(data), data if keep else None, task, met[length])
                        )
                        met[length] += 1
                columns = list(zip(*found)) or [()] * 8
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [p.split()[0] for p in PIECES.split(", ")]
                )

    return batches


class Slots:
    """Where the n-th piece of a length goes, by ranges of n."""

    def __init__(self, packing: completion.Packing):
        taken: Counter = Counter()
        rows, sequence = [], 0
        for times, filling in packing:
            offset = 0
            for length, number in filling:
                rows.append((length, taken[length], number, sequence, offset))
                taken[length] += times * number
                offset += length * number
            sequence += times
        self.length, self.first, self.number, self.sequence, self.offset = np.array(
            sorted(rows) or [(0,) * 5], np.int64
        ).T.copy()
        self.most = max(taken.values(), default=0) + 1

    def find(self, lengths: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.length * self.most + self.first, lengths * self.most + places, "right") - 1
        beyond = places - self.first[at]
        return self.sequence[at] + beyond // self.number[at], self.offset[at] + beyond % self.number[at] * lengths


def _assigned(slots):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            length = batch.column("length").to_numpy()
            sequence, offset = slots.value.find(length, batch.column("place").to_numpy())
            names = [p.split()[0] for p in PLACED.split(", ")][:5]
            more = [n for n in batch.schema.names if n == "ids"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset), *(batch.column(n) for n in more)],
                [*names, "sequence_id", "offset", *more],
            )

    return batches


def _packed(docs: DataFrame, path: str, text: str, id_col: str, capacity: int, end: int, nodes: int, keep: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    folder = f"{shared_dir(spark)}/packing-{uuid.uuid4().hex}"
    docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).mapInArrow(_cut(path, capacity, end, keep), PIECES).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    pieces = pieces if keep else pieces.drop("ids")
    of_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, number in of_task.groupBy("length").agg(F.sum("n")).collect():  # capacity rows at most
        counts[length] = number
    slots = spark.sparkContext.broadcast(Slots(completion.pack(counts, capacity, nodes)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_task.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    numbered = pieces.join(starts, ["length", "task"]).withColumn("place", F.col("place") + F.col("before"))
    return numbered.drop("task", "before").mapInArrow(_assigned(slots), PLACED + (", ids BINARY" if keep else ""))


def placed(
    docs: DataFrame,
    path: str,
    text: str = "text",
    id_col: str = "doc_id",
    capacity: int = CAPACITY,
    end: int = END,
    nodes: int = completion.NODES,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id (from 0) and offset.

    A null text counts as empty, and an empty text is the one id that ends it. A null id stays null;
    repeated rows are packed as often as they occur; an empty table gives no rows. A text of any
    length is encoded whole and only then cut. Columns but text and id are not read.

    `nodes` bounds the search for fewer sequences, not the rows: all pieces are placed.
    """
    return _packed(docs, path, text, id_col, capacity, end, nodes, False)


def sequences(
    docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, doc_ids in order, and ids (little-endian
    unsigned 32-bit integers). A sequence is a group of at most `capacity` tokens."""
    pieces = _packed(docs, path, text, id_col, capacity, end, completion.NODES, True)
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("own"))
        .select(
            "sequence_id",
            "n_tokens",
            F.col("own.doc_id").alias("doc_ids"),
            F.aggregate("own.ids", F.lit(b""), lambda all_, one: F.concat(all_, one)).alias("ids"),
        )
    )
