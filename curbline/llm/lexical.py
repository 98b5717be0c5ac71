"""Exact ranked lexical search of many items together, by common subexpressions.

An item's score of a document is a sum over the item's terms. Sets of terms that several items
share are mined first, and every such set becomes a node of a graph: its accumulator over a slice
of documents is added up once, from the terms and smaller sets below it, and then serves all items
and larger sets above it.

Documents are cut into terms once per block of items and kept as short postings (terms of the
block only) in the shared folder. Frequencies come from the postings; each task then scores its
own documents for all items of the block and keeps the best of each, so documents are never
shuffled and no pair of item and document is written down.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shared_dir, ship

K = 10  # fixed value
PAIRS = 32_768  # (item, term) pairs of a block of items, about
MINED = 1_024  # nodes whose pairs are mined together
CELLS = 2_000_000  # accumulators held at a time: nodes times documents of a slice
CHUNK = 1 << 20  # bytes of a text that are cut into terms at a time
SALTS = 16

# fixed values: bytes of terms are digits, letters and all bytes from 0x80 on; A-Z in lower case
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded number of bytes at a time."""
    data = text.encode().translate(TERM_BYTES)
    start = 0
    while len(data) - start > CHUNK:
        end = data.rfind(b" ", start, start + CHUNK)
        if end < 0:  # one term longer than a chunk
            end = data.find(b" ", start)
            if end < 0:
                break
        yield data[start:end].split()
        start = end + 1
    yield data[start:].split()


class Graph:
    """Items as sums over a graph of shared term sets.

    `sets[j]` has the children of node n_terms + j; children are terms or earlier nodes.
    `items[i]` has the children of an item. Every term of an item is below it exactly once.
    """

    def __init__(self, items: list[set[int]], n_terms: int):
        self.n_terms, self.sets = n_terms, []
        holders: dict[int, int] = {}
        for i, own in enumerate(items):
            for term in own:
                holders[term] = holders.get(term, 0) | 1 << i
        # Terms of the same items are one set.
        together: dict[int, list[int]] = {}
        for term, mask in holders.items():
            together.setdefault(mask, []).append(term)
        self.items: list[list[int]] = [[] for _ in items]
        masks: dict[int, int] = {}
        for mask, terms in together.items():
            if mask.bit_count() == 1:
                self.items[mask.bit_length() - 1] += terms
            else:
                masks[terms[0] if len(terms) == 1 else self._node(terms)] = mask
        nodes = sorted(masks)
        for at in range(0, len(nodes), MINED):
            self._mine({n: masks[n] for n in nodes[at : at + MINED]})

    def _node(self, children: list[int]) -> int:
        self.sets.append(children)
        return self.n_terms + len(self.sets) - 1

    def _mine(self, masks: dict[int, int]) -> None:
        """Join the pair of nodes that most items hold, again and again, until no two items share
        a pair. A pair's items only become fewer, so a queue with old numbers is enough."""
        queue = []

        def offer(a: int, b: int) -> None:
            common = (masks[a] & masks[b]).bit_count()
            if common > 1:
                heapq.heappush(queue, (-common, a, b))

        nodes = list(masks)
        for i, a in enumerate(nodes):
            for b in nodes[i + 1 :]:
                offer(a, b)
        while queue:
            common, a, b = heapq.heappop(queue)
            both = masks.get(a, 0) & masks.get(b, 0)
            if both.bit_count() != -common:
                if both.bit_count() > 1:
                    offer(a, b)
                continue
            joint = self._node([a, b])
            for old in (a, b):
                masks[old] &= ~both
                if not masks[old]:
                    del masks[old]
            others = list(masks)
            masks[joint] = both
            for other in others:
                offer(other, joint)
        for node, mask in masks.items():
            while mask:
                low = mask & -mask
                self.items[low.bit_length() - 1].append(node)
                mask ^= low

    def additions(self) -> int:
        return sum(len(c) - 1 for c in (*self.sets, *self.items) if c)

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """[item, document] from [term, document]."""
        held = np.zeros((self.n_terms + len(self.sets), impacts.shape[1]), np.int64)
        held[: self.n_terms] = impacts
        for j, children in enumerate(self.sets):
            np.add.reduce(held[children], axis=0, out=held[self.n_terms + j])
        out = np.zeros((len(self.items), impacts.shape[1]), np.int64)
        for i, children in enumerate(self.items):
            if children:
                np.add.reduce(held[children], axis=0, out=out[i])
        return out


class Best:
    """The k best documents of every item so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.scores = [np.empty(0, np.int64) for _ in range(n_items)]
        self.ids = [np.empty(0, np.int64) for _ in range(n_items)]
        self.blank = [np.empty(0, bool) for _ in range(n_items)]

    def add(self, scores: np.ndarray, ids: np.ndarray, blank: np.ndarray) -> None:
        for i, row in enumerate(scores):
            full = len(self.scores[i]) == self.k
            fit = np.flatnonzero(row >= max(1, self.scores[i][-1] if full else 1))
            if not len(fit):
                continue
            found = np.concatenate([self.scores[i], row[fit]])
            own, none = np.concatenate([self.ids[i], ids[fit]]), np.concatenate([self.blank[i], blank[fit]])
            order = np.lexsort((own, none, -found))[: self.k]
            self.scores[i], self.ids[i], self.blank[i] = found[order], own[order], none[order]


def _item_terms(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for at, text in enumerate(batch.column(1).to_pylist()):
            own = sorted({t for part in terms_of(text or "") for t in part})
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[at].as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())],
                ["item_id", "term"],
            )


def _postings(vocabulary: dict[bytes, int]):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            sizes, terms, counts = [], [], []
            for value in batch.column(1):
                size, found = 0, Counter()
                for part in terms_of(value.as_py() or ""):
                    size += len(part)
                    found.update(filter(vocabulary.__contains__, part))
                sizes.append(size)
                terms.append([vocabulary[t] for t in found])
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return batches


def impacts(sizes: list[int], lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, n: int, total: int) -> np.ndarray:
    """[term, document]: what a term adds to the score of a document."""
    out = np.zeros((len(weights), len(sizes)), np.int64)
    if len(terms):
        # Plain integers: the product of a very long text and very many documents needs them.
        norm = np.array([100 - 90 + 90 * size * n // total for size in sizes], np.int64)
        doc = np.repeat(np.arange(len(sizes)), lengths)
        out[terms, doc] = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * norm[doc]))
    return out


def _scored(graph: Graph, item_ids: list, weights: np.ndarray, n: int, total: int, k: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(item_ids), k)
        step = max(1, CELLS // max(1, graph.n_terms + len(graph.sets) + len(item_ids)))
        for batch in stream:
            for at in range(0, batch.num_rows, step):
                own = batch.slice(at, step)
                ids = own.column(0).fill_null(0).to_numpy()
                blank = own.column(0).is_null().to_numpy(zero_copy_only=False)
                lengths = own.column(2).value_lengths().to_numpy()
                added = impacts(
                    own.column(1).to_pylist(),
                    lengths,
                    own.column(2).flatten().to_numpy(),
                    own.column(3).flatten().to_numpy(),
                    weights,
                    n,
                    total,
                )
                best.add(graph.scores(added), ids, blank)
        of_item = np.repeat(np.arange(len(item_ids)), [len(s) for s in best.scores])
        if len(of_item):
            ids, blank = np.concatenate(best.ids), np.concatenate(best.blank)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item_ids[i] for i in of_item], pa.int64()),
                    pa.array(ids, pa.int64(), mask=blank),
                    pa.array(np.concatenate(best.scores), pa.int64()),
                ],
                ["item_id", "doc_id", "score"],
            )

    return batches


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _block_best(docs: DataFrame, pairs: list, folder: str, k: int) -> DataFrame:
    """The best documents of the items of one block, k for each task and item at most."""
    spark = docs.sparkSession
    item_ids = list(dict.fromkeys(p.item_id for p in pairs))
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(p.term) for p in pairs}))}
    place = {item: i for i, item in enumerate(item_ids)}
    held: list[set[int]] = [set() for _ in item_ids]
    for p in pairs:
        held[place[p.item_id]].add(vocabulary[bytes(p.term)])
    docs.mapInArrow(
        _postings(vocabulary), "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, counts ARRAY<BIGINT>"
    ).write.parquet(folder)
    postings = spark.read.parquet(folder)
    n, total = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(n, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    graph = Graph(held, len(vocabulary))
    some = postings.where(F.size("terms") > 0)
    return some.mapInArrow(
        _scored(graph, item_ids, weights, n, total, k), "item_id BIGINT, doc_id BIGINT, score BIGINT"
    )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    k: int = K,
    pairs: int = PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, fewer where fewer score.

    A null or empty text has no terms: such a document is found by no item and not counted, such an
    item finds nothing. Items of one id (null is one) are one item with the terms of all of them.
    Repeated documents rank each on its own; ties go to the smaller id, null ids last. Texts of any
    length are cut into terms a bounded portion at a time. Empty tables give no rows; columns but
    text and id are not read.

    Items are worked on in blocks of about `pairs` (item, term) pairs, by a digest of the id; the
    driver and each task hold the terms and the graph of one block.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
    items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).mapInArrow(
        _item_terms, "item_id BIGINT, term BINARY"
    ).distinct().write.parquet(f"{folder}/items")
    asked = spark.read.parquet(f"{folder}/items")
    blocks = max(1, -(-asked.count() // pairs))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        part = _block_best(rows, own, f"{folder}/postings-{block}", k)
        found = part if found is None else found.unionByName(part)
    # First among the tasks of a salt, then among all: no item's candidates stand in one task.
    best = Window.orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(best.partitionBy("item_id", "salt"))).where(
        F.col("rank") <= k
    )
    return (
        few.withColumn("rank", F.row_number().over(best.partitionBy("item_id")))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
