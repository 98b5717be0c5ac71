"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are integers. A block of vectors is indexed once, by component: for every component and
quantised level a posting list of the vectors whose value lies in it. For a query, the posting
segments of all components are taken by descending impact (how far a segment's level lies above the
component's lowest, times the query's component), a few at a time. A vector's accumulated impacts
bound its score from below; what the best segment still waiting in each component can add, and the
width of a level, bound it from above. After every few segments the vectors whose upper bound lies
below the k-th best lower bound leave; work on the block ends when to score the others exactly takes
less than the postings that wait, and that is done then.

Before that, every query is held against a bounded sample of the vectors. The k-th best score of the
sample is a proof that whatever stays below it is not among the k best, so a block whose best
possible score is lower is not opened at all, and in other blocks vectors leave sooner.

Vectors are shuffled once, to their blocks. Blocks hold vectors that are alike (by place and value of
their largest component, cut where the sample says), so that their bounds are narrow; many equal
vectors are cut by a hash of their row. The queries come to every block, as batches in a
stream, and each block sends on its k best per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut, ship

K = 5  # fixed value
SCALE = 256  # fixed value
QUERY_PARTS = 50  # fixed value: ids divisible by it are queries
BLOCK_VALUES = 500_000  # components of a block, about
LEVELS = 32  # segments of a component
GROUP = 64  # segments between two looks at the bounds
SAMPLE_VALUES = 200_000  # components of the sample that gives the first bound
CUTS = 256  # ranges of alike vectors at most; more blocks are made by hash
EXACT = 1 << 53  # sums below it are exact as doubles
FOUND = "query_row BIGINT, query_id BIGINT, vec_id BIGINT, score BIGINT"


def integers(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """vec_id and components floor(256 x). Vectors that are null, or hold null or non-finite
    components, are left out, as are those without id (they can neither ask nor be named)."""
    x = F.col("x")
    fit = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
        .where(x.isNotNull() & F.col("vec_id").isNotNull())
        .where(F.coalesce(fit, F.lit(False)))
        .select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE)).alias("x"))
    )


class Index:
    """The posting lists of a block of vectors of one width."""

    def __init__(self, rows: np.ndarray, levels: int = LEVELS):
        self.rows, self.levels = rows, levels
        self.low, self.high = rows.min(axis=0), rows.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // levels))  # values of a level
        level = (rows - self.low) // self.step
        self.top = level.max(axis=0)
        # One list of vectors for each component, by level; segment l is lists[j][at[j, l]:at[j, l + 1]].
        self.lists = np.argsort(level, axis=0, kind="stable").T.copy()
        bounds = np.arange(levels + 1)
        self.at = np.array([np.searchsorted(level[own, j], bounds) for j, own in enumerate(self.lists)])
        self.read = 0  # postings taken so far

    def best_possible(self, query: np.ndarray) -> int:
        return int(np.maximum(query * self.low, query * self.high).sum())

    def possible(self, query: np.ndarray, others: np.ndarray, k: int, least: int | None) -> np.ndarray:
        """The vectors that may be among the k best of a query, out of those marked in `others`.
        `least` is a score that k others are known to reach."""
        n, width = self.rows.shape
        levels = np.arange(self.levels)
        height = np.where((query > 0)[:, None], levels[None, :], self.top[:, None] - levels[None, :])
        impact = np.maximum(height, 0) * (np.abs(query) * self.step)[:, None]
        size = np.diff(self.at, axis=1)
        taken = np.flatnonzero(((size > 0) & (impact > 0)).ravel())
        order = taken[np.argsort(-impact.ravel()[taken], kind="stable")]
        # What every vector has at least, and how far a level may reach beyond its lowest value.
        floor = int(np.where(query > 0, query * self.low, query * (self.low + (self.top + 1) * self.step - 1)).sum())
        slack = int((np.abs(query) * (self.step - 1)).sum())
        waiting = np.where(size > 0, impact, 0)
        ahead = waiting.max(axis=1)
        known = np.zeros(n, np.int64)
        fit = others.copy()
        flat = self.at[:, :-1].ravel(), self.at[:, 1:].ravel()
        plain = int(impact.max(initial=0)) * width < EXACT
        left = int(size.ravel()[order].sum())
        for start in range(0, len(order), GROUP):
            own = order[start : start + GROUP]
            parts = [self.lists[s // self.levels][flat[0][s] : flat[1][s]] for s in own.tolist()]
            count = sum(map(len, parts))
            self.read += count
            left -= count
            if plain:
                added = np.repeat(impact.ravel()[own], [len(p) for p in parts])
                known += np.bincount(np.concatenate(parts), added, n).astype(np.int64)
            else:
                for s, part in zip(own.tolist(), parts):
                    known[part] += impact.ravel()[s]
            waiting.ravel()[own] = 0
            ahead = waiting.max(axis=1)
            count = int(fit.sum())
            bound = least
            if count > k:
                kth = int(np.partition(known[fit], count - k)[count - k]) + floor
                bound = kth if bound is None else max(bound, kth)
            if bound is not None:
                fit &= known + (floor + int(ahead.sum()) + slack) >= bound
            if fit.sum() * width <= left:
                break
        return np.flatnonzero(fit)


def _by_width(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch as matrices, one for each number of components, with the named columns;
    ``place`` names their place in the batch."""
    lengths = batch.column("x").value_lengths().to_numpy()
    flat = batch.column("x").flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    for width in np.unique(lengths[lengths > 0]).tolist():
        own = np.flatnonzero(lengths == width)
        rows = flat[starts[own][:, None] + np.arange(width)]
        columns = [own if n == "place" else np.array(batch.column(n).to_pylist(), object)[own] for n in names]
        yield width, rows.astype(np.int64), *columns


def _key(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Vectors that are alike have near keys: place of the largest component, its value, a hash."""
    at = np.abs(rows).argmax(axis=1)
    value = np.clip(rows[np.arange(len(rows)), at], -(1 << 22), (1 << 22) - 1) + (1 << 22)
    return ((at % (1 << 19)) << 43) + (value << 20) + hashes % (1 << 20)


class _Block:
    def __init__(self):
        self.parts: dict[int, list[tuple]] = {}
        self.indexes: dict[int, tuple] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        for width, *own in _by_width(batch, "row", "vec_id"):
            self.parts.setdefault(width, []).append(own)

    def index(self, width: int) -> tuple | None:
        if width not in self.indexes and width in self.parts:
            rows, numbers, ids = map(np.concatenate, zip(*self.parts.pop(width)))
            self.indexes[width] = (Index(rows), numbers.astype(np.int64), ids.astype(np.int64))
        return self.indexes.get(width)


def _blocks(k: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, _Block()
        for batch in stream:
            found: list[tuple] = []
            edges = batch.column("block").to_numpy()
            kinds = batch.column("asks").to_numpy(zero_copy_only=False)
            changes = np.flatnonzero((edges[1:] != edges[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, end in zip([0, *changes.tolist()], [*changes.tolist(), len(edges)]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if edges[start] != number:
                    number, block = edges[start], _Block()
                if not kinds[start]:
                    block.add(part)
                    continue
                for width, queries, rows, ids, least in _by_width(part, "row", "vec_id", "least"):
                    held = block.index(width)
                    if held is None:
                        continue
                    index, numbers, vec_ids = held
                    for query, row, query_id, bound in zip(queries, rows.tolist(), ids.tolist(), least.tolist()):
                        if bound is not None and index.best_possible(query) < bound:
                            continue
                        fit = index.possible(query, numbers != row, k, bound)
                        scores = index.rows[fit] @ query
                        order = np.lexsort((vec_ids[fit], -scores))[:k]
                        found += [(row, query_id, v, s) for v, s in zip(vec_ids[fit][order].tolist(), scores[order].tolist())]
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query_row", "query_id", "vec_id", "score"]
            )

    return batches


def _placed(sample, blocks: int):
    """The block of each vector: a range of keys between cuts of the sample, and a share of it."""
    cuts = min(blocks, CUTS)
    shares = -(-blocks // cuts)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_key(rows, hashes.astype(np.int64)) for part in sample.value for _, rows, hashes in _by_width(part, "hash")]
        keys = np.sort(np.concatenate(known)) if known else np.empty(0, np.int64)
        edges = keys[np.arange(1, cuts) * len(keys) // cuts] if len(keys) else keys
        for batch in stream:
            block = np.zeros(batch.num_rows, np.int64)
            for _, rows, place, hashes in _by_width(batch, "place", "hash"):
                hashes = hashes.astype(np.int64)
                block[place] = np.searchsorted(edges, _key(rows, hashes), "right") * shares + (hashes >> 20) % shares
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], ["block", *batch.schema.names])

    return batches


def _bounded(sample, k: int):
    """The k-th best score of each query in the sample; null where the sample has fewer others."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {w: (rows, numbers) for part in sample.value for w, rows, numbers in _by_width(part, "row")}
        for batch in stream:
            least: list = [None] * batch.num_rows
            for width, queries, numbers, places in _by_width(batch, "row", "place"):
                if width not in held:
                    continue
                rows, known = held[width]
                for query, number, place in zip(queries, numbers.tolist(), places.tolist()):
                    scores = (rows @ query)[known != number]
                    if len(scores) >= k:
                        least[place] = int(np.partition(scores, len(scores) - k)[len(scores) - k])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.int64())], [*batch.schema.names, "least"]
            )

    return batches


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    query_parts: int = QUERY_PARTS,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query, all if there are fewer.

    Queries are the rows whose id is divisible by query_parts, candidates all rows but the query's own;
    ties go to the smaller id. Repeated rows are rows like others: each copy has a rank, and each
    copy of a query a ranking. Vectors are held against vectors of as many components; empty ones have no
    score. Left out are null vectors, those with null or non-finite components, and those without
    id. Other columns are not read. An empty table gives no rows.

    A block holds about `block_values` components in its task, whatever the width.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(
        integers(vectors, id_col, vector)
        .where(F.size("x") > 0)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("hash", F.shiftrightunsigned(F.xxhash64("row"), 1))
    )
    n, widest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    blocks = max(1, -(-n * widest // block_values))
    few = rows.orderBy("hash").limit(max(k + 1, SAMPLE_VALUES // widest))
    sample = spark.sparkContext.broadcast(few.toArrow().to_batches())
    kind = "vec_id BIGINT, x ARRAY<BIGINT>, row BIGINT, hash BIGINT"
    placed = rows.mapInArrow(_placed(sample, blocks), f"block BIGINT, {kind}").drop("hash")
    labels = min(blocks, CUTS) * -(-blocks // min(blocks, CUTS))
    every = F.sequence(F.lit(0).cast("long"), F.lit(labels - 1).cast("long"))
    asked = (
        rows.where(F.col("vec_id") % query_parts == 0)
        .mapInArrow(_bounded(sample, k), f"{kind}, least BIGINT")
        .drop("hash")
        .withColumns({"block": F.explode(every), "asks": F.lit(True)})
    )
    local = (
        placed.withColumns({"asks": F.lit(False), "least": F.lit(None).cast("long")})
        .unionByName(asked)
        .repartition("block")
        .sortWithinPartitions("block", "asks")
        .mapInArrow(_blocks(k), FOUND)
    )
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
