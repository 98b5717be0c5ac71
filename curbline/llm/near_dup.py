"""Near duplicates by ProbMinHash signatures, banding and verification.

Shingles of five words weigh as often as they occur. Two texts agree in a register of their
signatures with the probability Jaccard similarity of their weighted shingles, and become
candidates where all registers of a band agree. Links are pairs whose exact similarity reaches the
threshold; a class is a connected component of links.

Equal texts are one vertex. In every bucket the member that shares most buckets (in a group of
edited copies, their common origin) is compared with all others, which is as many pairs as members.
Only buckets that still hold texts of several classes are worked through: members outside the
bucket's largest class against all members, in blocks of bounded size, each block pair in a task
that keeps the links and skips what it has connected already. No pair is left out for the size of
its bucket, and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, portions, ship
from .probsign import scramble, signatures, similarity, weighted_shingles

THRESHOLD = 0.8
REGISTERS = 128
BANDS, ROWS = 25, 5  # a pair at 0.8 shares a band with a probability of 0.99995
SEED = 41
BLOCK = 1024  # members of a block
FEW_KEYS = 1_000_000  # up to so many keys (16 bytes each) are broadcast
PORTION = 1 << 18  # characters whose texts are signed together


def _keyed(docs: DataFrame, text: str, id_col: str, *more: Column) -> DataFrame:
    """doc_id, a 128-bit key of the text, the text, and more columns; texts without words share the
    key of the empty one."""
    whole = F.coalesce(F.col(text), F.lit(""))
    blanks = F.lit(" \t\n\x0b\x0c\r")
    filled = F.when(F.btrim(whole, blanks) == "", F.lit("")).otherwise(whole)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(filled).alias("h1"),
        F.xxhash64(F.lit(SEED), filled).alias("h2"),
        filled.alias("text"),
        *more,
    )


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2 and the band keys of every text; none for a text without words."""
    salt = scramble(np.arange(ROWS, dtype=np.uint64)) | np.uint64(1)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in portions(batch, 3, PORTION):
                n = part.num_rows
                shingles, counts, owner, _ = weighted_shingles(part.column(3).to_pylist())
                kept = signatures(shingles, counts, owner, n, REGISTERS, SEED)
                rows = kept[:, : BANDS * ROWS].reshape(n, BANDS, ROWS)
                bands = scramble((rows * salt).sum(axis=2, dtype=np.uint64)).astype(np.int64)
                some = np.bincount(owner, minlength=n) > 0
                keys = [b if ok else b[:0] for b, ok in zip(bands, some)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(3)), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "h1", "h2", "bands"],
                )

    return docs.mapInArrow(batches, "doc_id BIGINT, h1 BIGINT, h2 BIGINT, bands ARRAY<BIGINT>")


def _contents(texts: DataFrame) -> DataFrame:
    """vid with its sorted shingle codes and their counts as bytes."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in portions(batch, 1, PORTION):
                shingles, counts, owner, _ = weighted_shingles(part.column(1).to_pylist())
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                codes, weights = [], []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    codes.append(shingles[a:b].tobytes())
                    plain = counts[a:b].max(initial=1) == 1
                    weights.append(b"" if plain else counts[a:b].astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(codes, pa.binary()), pa.array(weights, pa.binary())],
                    ["vid", "codes", "weights"],
                )

    return texts.select("vid", "text").mapInArrow(batches, "vid BIGINT, codes BINARY, weights BINARY")


def _set(codes: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(codes, np.uint64)
    return own, np.frombuffer(weights, np.int32) if weights else np.ones(len(own), np.int32)


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a stored table of keys when it is known to be small."""
    return F.broadcast(df) if df.count() <= FEW_KEYS else df


def _verified(pairs: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    left = contents.select(F.col("vid").alias("a"), F.col("codes").alias("x"), F.col("weights").alias("xw"))
    right = contents.select(F.col("vid").alias("b"), F.col("codes").alias("y"), F.col("weights").alias("yw"))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            columns = [batch.column(n).to_pylist() for n in ("x", "xw", "y", "yw")]
            fine = [similarity(*_set(x, xw), *_set(y, yw)) >= threshold for x, xw, y, yw in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "x", "xw", "y", "yw")
        .mapInArrow(batches, "a BIGINT, b BIGINT")
    )


def components(links: DataFrame) -> DataFrame:
    """(vid, comp): comp is the smallest vertex connected with vid. Labels pass along links and
    jump to the label's own label until nothing changes; every round is stored."""
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("vid")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        heard = (
            both.join(labels, both.b == labels.vid).groupBy("a").agg(F.min("comp").alias("heard"))
        )
        nearer = labels.join(heard, labels.vid == heard.a).select(
            "vid", F.col("comp").alias("old"), F.least("comp", "heard").alias("near")
        )
        jump = labels.select(F.col("vid").alias("near"), F.col("comp").alias("far"))
        stepped = cut(
            nearer.join(jump, "near", "left").select(
                "vid", "old", F.least("near", F.coalesce("far", "near")).alias("comp")
            )
        )
        moved = stepped.where("comp < old").isEmpty()
        labels = stepped.select("vid", "comp")
        if moved:
            return labels


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.get(x, x) != x:
            self.up[x] = x = self.up.get(self.up[x], self.up[x])
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def _block_links(seekers: list[tuple], targets: list[tuple], threshold: float) -> list[tuple[int, int]]:
    """Links between seekers and targets of different classes that connect what is not connected
    yet. Rows are (vid, comp, codes, counts). Common shingles are counted over postings of the
    targets; a pair can only reach the threshold if either side has that share in common."""
    sizes = [len(t[2]) for t in targets]
    if not sum(sizes):
        return []
    codes = np.concatenate([t[2] for t in targets])
    weights = np.concatenate([t[3] for t in targets])
    owner = np.repeat(np.arange(len(targets)), sizes)
    order = np.argsort(codes, kind="stable")
    codes, weights, owner = codes[order], weights[order], owner[order]
    totals = np.array([t[3].sum() for t in targets], np.float64)
    forest, found = _Forest(), []
    for vid, comp, own, counts in seekers:
        start, end = np.searchsorted(codes, own, "left"), np.searchsorted(codes, own, "right")
        hits = end - start
        at = np.repeat(start - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
        common = np.bincount(owner[at], weights[at], len(targets))
        mine = np.bincount(owner[at], np.repeat(counts, hits), len(targets))
        near = np.minimum(common / np.maximum(totals, 1), mine / max(1, counts.sum()))
        for k in np.flatnonzero(near >= threshold - 1e-9):
            other, other_comp, theirs, their_counts = targets[k]
            if forest.root(comp) == forest.root(other_comp):
                continue
            if similarity(own, counts, theirs, their_counts) >= threshold:
                forest.join(comp, other_comp)
                found.append((vid, other))
    return found


def _resolved(rows: DataFrame, threshold: float) -> DataFrame:
    """Links inside blocks; rows come sorted by block within their partition."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(seekers, targets):
            found = _block_links(seekers, targets, threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

        key, seekers, targets = None, [], []
        for batch in stream:
            own = batch.to_pydict()
            for *at, seeks, vid, comp, codes, weights in zip(
                *(own[n] for n in ("band", "key", "s", "t", "seeks", "vid", "comp", "codes", "weights"))
            ):
                if at != key:
                    if seekers and targets:
                        yield links(seekers, targets)
                    key, seekers, targets = at, [], []
                (seekers if seeks else targets).append((vid, comp, *_set(codes, weights)))
        if seekers and targets:
            yield links(seekers, targets)

    return rows.mapInArrow(batches, "a BIGINT, b BIGINT")


def _leftover(members: DataFrame, labels: DataFrame, contents: DataFrame, block: int) -> DataFrame:
    """The rows of the blocks to work through: buckets of three and more that hold several classes
    (in a bucket of two the only pair has been compared)."""
    bucket = ["band", "key"]
    known = members.where("size > 2").join(labels, "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))
    shares = known.groupBy(*bucket, "comp").count()
    open_buckets = (
        shares.groupBy(*bucket)
        .agg(
            F.count(F.lit(1)).alias("comps"),
            F.sum("count").alias("size"),
            F.max(F.struct("count", "comp")).alias("most"),
        )
        .where("comps > 1")
        .select(
            *bucket,
            F.col("most.comp").alias("main"),
            F.expr(f"(size + {block - 1}) div {block}").alias("t_blocks"),
            F.expr(f"(size - most.count + {block - 1}) div {block}").alias("s_blocks"),
        )
    )
    rows = cut(known.drop("size").join(open_buckets, bucket))
    mine = lambda parts: F.pmod(F.xxhash64("vid", "band"), F.col(parts))
    seekers = rows.where("comp <> main").select(
        *bucket, mine("s_blocks").alias("s"), F.explode(F.expr("sequence(0L, t_blocks - 1)")).alias("t"),
        F.lit(True).alias("seeks"), "vid", "comp",
    )
    targets = rows.select(
        *bucket, F.explode(F.expr("sequence(0L, s_blocks - 1)")).alias("s"), mine("t_blocks").alias("t"),
        F.lit(False).alias("seeks"), "vid", "comp",
    )
    block_key = [*bucket, "s", "t"]
    return (
        seekers.union(targets)
        .join(contents, "vid")
        .repartition(*block_key)
        .sortWithinPartitions(*block_key)
        .select(*block_key, "seeks", "vid", "comp", "codes", "weights")
    )


def _links(signed: DataFrame, docs: DataFrame, threshold: float, block: int):
    """(vertices: vid, h1, h2; labels: vid, comp of all vertices with links)."""
    distinct = signed.groupBy("h1", "h2").agg(F.first("bands").alias("bands"))
    vertices = cut(distinct.withColumn("vid", F.monotonically_increasing_id()))
    placed = vertices.select("vid", F.posexplode("bands").alias("band", "key"))
    sizes = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(placed.join(sizes, ["band", "key"]))
    degree = members.groupBy("vid").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "vid")
    pivots = ranked.groupBy("band", "key").agg(F.max(F.struct("degree", "vid")).alias("pivot"))
    pairs = (
        members.join(pivots.select("band", "key", F.col("pivot.vid").alias("a")), ["band", "key"])
        .where("a <> vid")
        .select("a", F.col("vid").alias("b"))
        .distinct()
    )
    wanted = cut(vertices.join(members.select("vid").distinct(), "vid").select("vid", "h1", "h2"))
    texts = docs.join(_small(wanted), ["h1", "h2"])
    contents = cut(_contents(texts).dropDuplicates(["vid"]))
    star = cut(_verified(pairs, contents, threshold))
    more = cut(_resolved(_leftover(members, components(star), contents, block), threshold))
    return vertices.select("vid", "h1", "h2"), components(star.union(more))


def near_classes(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: doc_id, class_id (smallest id in its class), class_size, exact_size (documents
    with the same text), and the keys of text (h1, h2) and class (comp).

    Null counts as empty; texts without words are equal to each other and near to nothing else;
    texts of one to four words have a single shingle. Words are lower-cased. A null id is larger
    than any other, so a class of null ids only has a null class_id. Repeated rows repeat. No rows
    give no rows; columns but text and id are not read.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs, text, id_col)
    signed = cut(_signed(keyed))
    vertices, labels = _links(signed, keyed.select("h1", "h2", "text"), threshold, block)
    copies = signed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("exact_size")
    )
    grouped = cut(
        copies.join(vertices, ["h1", "h2"])
        .join(labels, "vid", "left")
        .withColumn("comp", F.coalesce("comp", "vid"))
    )
    classes = grouped.groupBy("comp").agg(
        F.min("first_id").alias("class_id"), F.sum("exact_size").alias("class_size")
    )
    of_text = grouped.join(classes, "comp").select("h1", "h2", "class_id", "class_size", "exact_size", "comp")
    return signed.select("doc_id", "h1", "h2").join(of_text, ["h1", "h2"]).select(
        "doc_id", "class_id", "class_size", "exact_size", "h1", "h2", "comp"
    )


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that stay, with all their columns: of every class the one with the smallest
    id. Rows alike in id and text are one. A class without ids keeps one of its texts."""
    found = near_classes(docs, text, id_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    stay = found.groupBy("comp").agg(F.min(order).alias("one")).select("one.doc_id", "one.h1", "one.h2")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    rows = _keyed(docs, text, id_col, whole).drop("text").dropDuplicates(["h1", "h2", "doc_id"])
    same = (rows.h1 == stay.h1) & (rows.h2 == stay.h2) & rows.doc_id.eqNullSafe(stay.doc_id)
    return rows.join(stay, same, "left_semi").select("whole.*")
