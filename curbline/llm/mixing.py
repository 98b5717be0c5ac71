"""Mixing sources to target weights, block by block, with DataFrame operations only.

The words of a source stand on one line, its documents in the order of a hash, and
are cut into blocks of a fixed number of words. The mix is a row of slots, dealt to output shards.
Every slot draws its source at random by the targets (so a shard's counts per source are
multinomial); what a source draws beyond its quota passes to sources below theirs. The slots of a
source walk a pseudorandom permutation of its block indexes, a new one in every pass, and blocks
are joined to slots by index. The last slot of a source may be cut short, so that the words taken
meet the target.

Nothing is gathered by source: running sums go over hash buckets of documents (about as many as
the square root of the rows) and over counts per shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, cut

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
MOST_PASSES = 3  # a target stops at so many times the source's size
ROUNDS = 24  # of the permutation
SEED = 20250
SMALL_SOURCES = 100_000  # up to so many sources their table is broadcast


def _attach(rows: DataFrame, sources: DataFrame, on: str, n_sources: int) -> DataFrame:
    """Join the table with one row per source; broadcast where its size is known to be small."""
    return rows.join(F.broadcast(sources) if n_sources <= SMALL_SOURCES else sources, on)


def sized(docs: DataFrame, text: str, id_col: str, source: str) -> DataFrame:
    """row, doc_id, source, size and a digest of the text, stored: all later steps read this."""
    return cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.col(source).alias("source"),
            F.xxhash64(text).alias("text_hash"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )


def targets(rows: DataFrame) -> DataFrame:
    """source, source_no, source_size, weight and target, one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share all words by weight; a
    target stops at three times its source's size and the excess is shared again by weight. The
    common level at which the shares stop comes from the order in which sources reach their limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sums = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", 1 + (F.col("source_no") - 1) % 3)
        .withColumn("limit", MOST_PASSES * F.col("source_size"))
        .withColumn("reach", F.col("limit") / F.col("weight"))
    )
    first = Window.orderBy("reach", "source_no")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    onward = first.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / F.sum("weight").over(onward)
    return (
        sums.withColumn("level", level)
        .withColumn("stop", F.max(F.expr("CASE WHEN reach > level THEN level END")).over(everything))
        .select(
            "source",
            "source_no",
            "source_size",
            "weight",
            F.expr(
                "CASE WHEN stop IS NULL OR reach <= stop THEN CAST(limit AS DOUBLE)"
                " ELSE weight * stop END"
            ).alias("target"),
        )
    )


def quotas(sources: DataFrame, block: int) -> DataFrame:
    """Blocks, whole passes and slots of every source. The words of the last pass fill whole
    blocks and, in the last slot, a part of one."""
    return (
        sources.withColumn("full_blocks", F.expr(f"source_size div {block}"))
        .withColumn("tail", F.expr(f"source_size % {block}"))
        .withColumn("blocks", F.expr("full_blocks + IF(tail > 0, 1, 0)"))
        .withColumn("wanted", F.least(F.round("target").cast("long"), MOST_PASSES * F.col("source_size")))
        .withColumn("passes", F.expr("IF(source_size > 0, wanted div source_size, 0)"))
        .withColumn("rest", F.expr("wanted - passes * source_size"))
        .withColumn("rest_slots", F.expr(f"(rest + {block - 1}) div {block}"))
        .withColumn("slots", F.expr("passes * blocks + rest_slots"))
    )


def draw_shards(sources: DataFrame, shard_slots: int, seed: int, n_sources: int) -> DataFrame:
    """(source_no, shard, first, n): how many slots of a shard a source gets, and the number of the
    first of them among the source's slots. The counts of a source add up to its quota.

    A draw is a number below the sum of all quotas, on which every source has a range. Ranges and
    draws meet by cells of equal width, as many as there are sources, so that a draw is compared
    with the few sources of its cell.
    """
    everything = Window.partitionBy()
    ranges = (
        sources.where("slots > 0")
        .withColumn("upto", F.sum("slots").over(Window.orderBy("source_no")))
        .withColumn("from", F.col("upto") - F.col("slots"))
        .withColumn("total", F.sum("slots").over(everything))
        .withColumn("width", F.expr("greatest(1L, total div count(1) OVER ())"))
    )
    cells = ranges.select(
        "source_no", "from", "upto", F.explode(F.expr("sequence(`from` div width, (upto - 1) div width)")).alias("cell")
    )
    table = ranges.agg(F.max("total").alias("total"), F.max("width").alias("width"))
    shards = table.where("total > 0").select(
        "total", "width", F.explode(F.expr(f"sequence(0L, (total - 1) div {shard_slots})")).alias("shard")
    )
    slot = F.explode(
        F.expr(f"sequence(shard * {shard_slots}, least(total, (shard + 1) * {shard_slots}) - 1)")
    )
    draws = (
        shards.repartition("shard")
        .select("total", "width", "shard", slot.alias("slot"))
        .withColumn("draw", F.expr(f"pmod(xxhash64(slot, {seed}L), total)"))
        .select("shard", "draw", F.expr("draw div width").alias("cell"))
    )
    drawn = (
        _attach(draws, cells, "cell", n_sources)
        .where("draw >= `from` AND draw < upto")
        .groupBy("source_no", "shard")
        .count()
    )
    order = Window.partitionBy("source_no").orderBy("shard")
    dealt = cut(
        drawn.withColumn("first", F.sum("count").over(order) - F.col("count"))
    )
    quota = sources.select("source_no", "slots")
    kept = (
        dealt.join(quota, "source_no")
        .select(
            "source_no", "shard", "first",
            F.expr("least(count, greatest(slots - first, 0))").alias("n"),
            F.expr("count - least(count, greatest(slots - first, 0))").alias("over"),
        )
    )
    # Slots beyond a quota, and the missing slots of other sources, are numbered alike.
    spare = (
        kept.where("over > 0")
        .groupBy("shard").agg(F.sum("over").alias("over"))
        .withColumn("from", F.sum("over").over(Window.orderBy("shard")) - F.col("over"))
        .select("shard", F.explode(F.expr("sequence(from, from + over - 1)")).alias("k"))
    )
    got = dealt.groupBy("source_no").agg(F.sum("count").alias("got"))
    missing = (
        quota.join(got, "source_no", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where("got < slots")
        .withColumn("lacks", F.expr("slots - got"))
        .withColumn("from", F.sum("lacks").over(Window.orderBy("source_no")) - F.col("lacks"))
        .select(
            "source_no", "got", "from", F.explode(F.expr("sequence(from, from + lacks - 1)")).alias("k")
        )
    )
    passed = spare.join(missing, "k").select(
        "source_no", "shard", F.expr("got + k - from").alias("first"), F.lit(1).cast("long").alias("n")
    )
    return kept.where("n > 0").select("source_no", "shard", "first", "n").unionByName(passed)


def permuted(index: Column, size: Column, keys: Column, seed: int, rounds: int = ROUNDS) -> Column:
    """A permutation of 0..size-1 for every key: a swap-or-not shuffle. Each round pairs x with
    k - x and swaps the pair or not by a bit of the larger of both, so it is one to one for any
    size."""

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(keys, r, F.lit(seed)), size) - x, size)
        bit = F.xxhash64(F.greatest(x, partner), keys, r, F.lit(seed + 1)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)


def slots(sources: DataFrame, block: int, shard_slots: int, seed: int, n_sources: int) -> DataFrame:
    """The mix as a list: (source_no, shard, ordinal, block, words): slot `ordinal` of a source takes
    the first `words` words of its block `block`."""
    # A row stands for up to a shard's worth of slots, so rows are spread before they are expanded.
    spread = max(
        int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        (sources.agg(F.sum("slots")).first()[0] or 0) >> 20,
    )
    dealt = draw_shards(sources, shard_slots, seed, n_sources).repartition(spread, "source_no", "shard").select(
        "source_no", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("ordinal")
    )
    info = sources.select("source_no", "blocks", "full_blocks", "tail", "passes", "rest", "slots")
    rows = _attach(dealt, info, "source_no", n_sources)
    spin = F.expr("struct(source_no, ordinal div blocks)")
    return (
        rows.withColumn("at", F.expr("ordinal % blocks"))
        .withColumn(
            "block",
            F.when(F.col("at") >= F.col("full_blocks"), F.col("at")).otherwise(
                permuted(F.col("at"), F.col("full_blocks"), spin, seed)
            ),
        )
        .withColumn("length", F.expr(f"IF(block >= full_blocks, tail, {block})"))
        .withColumn(
            "words",
            F.expr(
                f"IF(ordinal div blocks < passes, length, least(length, rest - at * {block}))"
            ),
        )
        .select("source_no", "shard", "ordinal", "block", "length", "words")
    )


def placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """rows with `offset`, the words of the source before the document. Documents of a source go
    by hash bucket of id, size and text, and by id; about sqrt(n) buckets of sqrt(n) documents, also
    where many documents have one id or none."""
    buckets = max(1, round(n_rows**0.5))
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_hash"), F.lit(buckets)))
    key = ["source_no", "bucket"]
    before = (
        bucketed.groupBy(*key)
        .agg(F.sum("size").alias("words"))
        .withColumn(
            "bucket_offset",
            F.sum("words").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("words"),
        )
        .drop("words")
    )
    order = Window.partitionBy(*key).orderBy("doc_id", "size", "text_hash", "row")
    inside = bucketed.withColumn("inside", F.sum("size").over(order) - F.col("size"))
    return inside.join(before, key).withColumn("offset", F.col("bucket_offset") + F.col("inside"))


def pieces(rows: DataFrame, block: int) -> DataFrame:
    """A row for each block a document reaches into: block, start in the block, words. A document
    without words gives one row without block."""
    spans = F.expr(
        f"IF(size > 0, sequence(offset div {block}, (offset + size - 1) div {block}), null)"
    )
    return (
        rows.withColumn("block", F.explode_outer(spans))
        .withColumn("start", F.expr(f"greatest(offset - block * {block}, 0L)"))
        .withColumn("words", F.expr(f"least(offset + size - block * {block}, {block}L) - start"))
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with taken words, sources with targets, slots of the mix).

    Per document: doc_id, size (words; 0 for null), source_size, target and taken, next to row,
    source and text_hash. A null source is a source of its own, a null id an ordinary one. Rows
    without words take none. Repeated rows count each. No rows give no rows. The draw depends on
    seed, ids, sizes and texts only, so reruns agree.
    """
    sized_rows = sized(docs, text, id_col, source)
    n_rows = sized_rows.count()
    sources = cut(quotas(targets(sized_rows), block_words))
    n_sources = sources.count()
    of_source = sources.select(
        F.col("source").alias("name"), "source_no", "source_size", "target"
    )
    small = F.broadcast(of_source) if n_sources <= SMALL_SOURCES else of_source
    numbered = sized_rows.join(small, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    plan = slots(sources, block_words, shard_slots, seed, n_sources)
    drawn = plan.groupBy("source_no", "block").agg(
        F.sum(F.expr("IF(words >= length, 1L, 0L)")).alias("whole"),
        F.max(F.expr("IF(words < length, words, 0L)")).alias("part"),
    )
    cols = ["row", "doc_id", "source", "text_hash", "size", "source_size", "target"]
    taken = (
        pieces(placed(numbered, n_rows), block_words)
        .join(drawn, ["source_no", "block"], "left")
        .groupBy(*cols)
        .agg(
            F.coalesce(
                F.sum(
                    F.expr("whole * words + greatest(0L, least(part, start + words) - start)")
                ),
                F.lit(0),
            ).cast("long").alias("taken")
        )
    )
    return taken, sources, plan


def mixed_documents(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it.

    A document taken k and a fraction times its size comes k times, and once more with the
    fraction as probability, by a hash of its id and text. Rows alike in id, text and source are taken
    together: what the mix takes of them is added up and dealt to them in turn. Documents that the
    mix leaves out, and texts without words, go. Columns that no order can be put on (maps) take no
    part in the order of such rows.
    """
    taken, _, _ = mix(docs, text, id_col, source, **options)
    luck = F.expr(f"pmod(xxhash64(doc_id, text_hash, {options.get('seed', SEED) + 2}L), 1000000007)")
    part = F.when(luck * F.col("size") < F.expr("(words % size) * 1000000007D"), 1).otherwise(0)
    copies = cut(
        taken.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("name"), "size")
        .agg(F.sum("taken").alias("words"), F.count(F.lit(1)).alias("alike"))
        .where("words > 0")
        .withColumns({"doc_id": F.col("id"), "text_hash": F.col("hash")})
        .withColumn("copies", F.expr("words div size") + part)
        .where("copies > 0")
        .select("id", "hash", "name", "alike", "copies")
    )
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
        F.xxhash64(*plain).alias("tie"),
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(source).alias("source"),
    )
    same = (
        (F.col("text_hash") == F.col("hash"))
        & F.col("doc_id").eqNullSafe(F.col("id"))
        & F.col("source").eqNullSafe(F.col("name"))
    )
    turn = F.row_number().over(Window.partitionBy("id", "hash", "name").orderBy("tie"))
    once = keyed.join(copies.where("alike = 1"), same).select("whole", "copies")
    several = (
        keyed.join(copies.where("alike > 1"), same)
        .withColumn("turn", turn)
        .select("whole", F.expr("copies div alike + IF(turn <= copies % alike, 1, 0)").alias("copies"))
        .where("copies > 0")
    )
    return (
        once.unionByName(several)
        .select("whole", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
        .select("whole.*")
    )
