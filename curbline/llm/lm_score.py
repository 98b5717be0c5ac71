"""Language-model scores: a gated recurrent network with a class-factored output.

A token's probability is that of its class, given all tokens of the text before it, times its own
within the class. Both come from the state of a recurrent network (gru.py). Within a class the
network tells its frequent words and the rest apart; a word of the rest has its share of the rest, by
the counts of all words in all learning texts. So the network stays small whatever the vocabulary,
while every word of the corpus counts.

Classes: the most frequent tokens, one each, and groups of words with similar letters, found by
clustering the frequent words by their letter pairs; any word, also one never seen, belongs to
the nearest group. An unseen word has the share (0 + 1) / (counts + words + 1) of its group's rest.

Spark counts the words, joins them with the documents that hold them, and trains: in every round the
partitions walk through a part of the learning texts from the same parameters, and their results
are averaged by the number of tokens. Only the frequent words (a fixed number), the counts per
unit and the parameters of the network come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import gru
from .common import cut, held_out, portions, remainder, ship
from .grams import Stream

PARTS, REST = 7, 2  # fixed values: rows whose crc32 modulo 7 is 2 are held out
END = b" "  # stands for the end of a text; no word has a blank
FREQUENT = 131_072  # at most so many words have their counts broadcast; all others are joined
PORTION = 1 << 20  # characters whose words are held at once
CLUSTERED = 16_384  # of these, the words whose letters make the groups
ALONE = 32  # tokens that are classes of their own
GROUPS = 32
CELLS = 16  # units of a group: its most frequent words, and one for the rest
LAYOUT = gru.Layout(ALONE, GROUPS, CELLS)
PAIR_BITS = 8
ROUNDS = 4  # every learning text is walked once, in one of the rounds
FLUSH = 4_000_000  # words that a task holds before it passes their counts on
SEED = 11


@dataclass
class Units:
    """The frequent words with counts and units, and the centres of the groups."""

    words: list[bytes]
    counts: np.ndarray
    units: np.ndarray
    centres: np.ndarray


def rest_of(group: np.ndarray) -> np.ndarray:
    """The unit of the words of a group that have none of their own."""
    return ALONE + group * CELLS + CELLS - 1


def is_rest(units: np.ndarray) -> np.ndarray:
    return (units >= ALONE) & ((units - ALONE) % CELLS == CELLS - 1)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts with A-Z in lower case, and how many each text has. Words are cut at
    the white space of the contract; the end of a text is not among them."""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = pieces.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    owner = pc.list_parent_indices(pieces).filter(full)
    return flat.filter(full).cast(pa.binary()), np.bincount(owner.to_numpy(), minlength=len(texts))


def letter_pairs(words: list[bytes]) -> np.ndarray:
    """[word, bucket]: shares of the letter pairs (with the ends) of every word, of length one."""
    stream = Stream([w.decode("utf-8", "replace") for w in words], "word")
    bucket, owner = stream.grams(2, PAIR_BITS, True)
    flat = np.bincount(owner * (1 << PAIR_BITS) + bucket, minlength=len(words) << PAIR_BITS)
    found = flat.reshape(len(words), 1 << PAIR_BITS).astype(np.float32)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-6)


def group_of(words: list[bytes], centres: np.ndarray) -> np.ndarray:
    """Number of the group of every word."""
    if not words:
        return np.zeros(0, np.int64)
    parts = [
        (letter_pairs(words[i : i + 8192]) @ centres.T).argmax(axis=1)
        for i in range(0, len(words), 8192)
    ]
    return np.concatenate(parts)


def make_units(words: list[bytes], counts: list[int]) -> Units:
    """From the frequent words, most frequent first. The end is always a class of its own."""
    ends = sum(c for w, c in zip(words, counts) if w == END)
    rest = [(w, c) for w, c in zip(words, counts) if w != END]
    words = [END, *(w for w, _ in rest)]
    counts = np.array([ends, *(c for _, c in rest)], np.int64)
    shape = letter_pairs(words[ALONE : ALONE + CLUSTERED])
    centres = np.zeros((GROUPS, 1 << PAIR_BITS), np.float32)
    if len(shape):
        weight = np.sqrt(counts[ALONE : ALONE + CLUSTERED]).astype(np.float32)
        centres = shape[:: max(1, len(shape) // GROUPS)][:GROUPS].copy()
        for _ in range(12):
            nearest = (shape @ centres.T).argmax(axis=1)
            pull = np.zeros((len(shape), len(centres)), np.float32)
            pull[np.arange(len(shape)), nearest] = weight
            sums = pull.T @ shape
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norm > 0, sums / np.maximum(norm, 1e-6), centres)
    group = group_of(words[ALONE:], centres)
    order = np.argsort(group, kind="stable")  # of each group the most frequent first
    sizes = np.bincount(group, minlength=GROUPS)
    cell = np.empty(len(group), np.int64)
    cell[order] = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grouped = ALONE + group * CELLS + np.minimum(cell, CELLS - 1)
    return Units(words, counts, np.concatenate([np.arange(min(ALONE, len(words))), grouped]), centres)


def count_words(learning: DataFrame) -> DataFrame:
    """(word, n) over all learning texts, the end included."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        ends = 0

        def out() -> pa.RecordBatch:
            found = pa.concat_arrays(held).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

        for batch in stream:
            for part in portions(batch, 0, PORTION):
                held.append(words_of(part.column(0))[0])
                ends += len(part)
                if sum(map(len, held)) >= FLUSH:
                    yield out()
        held.append(pa.array([END] if ends else [], pa.binary()))
        last = out()
        n = [ends if w == END else c for w, c in zip(last["word"].to_pylist(), last["n"].to_pylist())]
        yield pa.RecordBatch.from_arrays([last["word"], pa.array(n, pa.int64())], ["word", "n"])

    return (
        learning.select("text").mapInArrow(batches, "word BINARY, n BIGINT")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def frequent_words(vocabulary: DataFrame, most: int) -> tuple[list[bytes], list[int]]:
    """All words above the lowest count that leaves at most `most` of them, most frequent first, and
    the end whatever its count."""
    by_count = vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    upto = F.sum("words").over(Window.orderBy(F.col("n").desc()))
    cutoff = by_count.withColumn("upto", upto).where(F.col("upto") > most).agg(F.max("n")).first()[0]
    rows = vocabulary if cutoff is None else vocabulary.where((F.col("n") > cutoff) | (F.col("word") == F.lit(END)))
    found = rows.select("word", "n").toArrow()
    words, counts = found.column("word").to_pylist(), found.column("n").to_pylist()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return [words[i] for i in order], [counts[i] for i in order]


def unit_sums(vocabulary: DataFrame, known: Units) -> tuple[np.ndarray, np.ndarray]:
    """Counts and number of words of every unit, over the whole vocabulary."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = sent.value
        table = pa.array(units.words, pa.binary())
        for batch in stream:
            at = pc.index_in(batch.column(0), value_set=table).fill_null(-1).to_numpy()
            own = units.units[at]
            new = np.flatnonzero(at < 0)
            own[new] = rest_of(group_of(batch.column(0).take(pa.array(new)).to_pylist(), units.centres))
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column(1)], ["unit", "n"])

    sent = vocabulary.sparkSession.sparkContext.broadcast(known)
    found = (
        vocabulary.mapInArrow(batches, "unit BIGINT, n BIGINT")
        .groupBy("unit").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    )
    counts, words = np.zeros(LAYOUT.units, np.int64), np.zeros(LAYOUT.units, np.int64)
    for row in found:
        counts[row["unit"]], words[row["unit"]] = row["n"], row["words"]
    return counts, words


def unit_room(known: Units, sums) -> np.ndarray:
    """What the shares start from: the count of a unit's words, each once more, and in a rest one
    unseen word. A unit that no word has taken has none."""
    counts, words = sums
    room = (counts + words).astype(np.float64)
    room[0] = counts[0] + 1  # the end, also where nothing is learned
    room[rest_of(np.arange(GROUPS))] += 1
    return room


READ = (
    "row BIGINT, doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, units BINARY, n_seen BIGINT,"
    " base DOUBLE, share DOUBLE, rare ARRAY<BINARY>, rare_groups BINARY"
)


def read_tokens(docs: DataFrame, known: Units, total: int, distinct: int, room: np.ndarray) -> DataFrame:
    """Every document as a sequence of units, with the parts of its scores that follow from
    frequent words, and the list of its other words."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        table = pa.array(known.words, pa.binary())
        base = np.log10((known.counts + 1) / (total + distinct + 1))
        share = np.where(is_rest(known.units), np.log10((known.counts + 1) / room[known.units]), 0.0)
        seen = known.counts > 0
        end = known.words.index(END)
        names = ["n_tokens", "units", "n_seen", "base", "share", "rare", "rare_groups"]
        for batch in stream:
            for part in portions(batch, 3, PORTION):
                words, sizes = words_of(part.column(3))
                at = pc.index_in(words, value_set=table).fill_null(-1).to_numpy()
                new = np.flatnonzero(at < 0)
                coded = words.take(pa.array(new)).dictionary_encode()
                group = group_of(coded.dictionary.to_pylist(), known.centres)[coded.indices.to_numpy()]
                stops = np.cumsum(sizes)
                at = np.insert(at, stops, end)
                units = known.units[at]
                few = at < 0
                units[few] = rest_of(group)
                stops = np.cumsum(sizes + 1)
                starts = stops - sizes - 1
                rare_ends = np.cumsum(few)[stops - 1] if len(stops) else stops
                rare_bounds = np.concatenate([[0], rare_ends])

                def sums(values: np.ndarray) -> pa.Array:
                    values = np.where(few, 0, values[at])
                    return pa.array(np.add.reduceat(values, starts) if len(starts) else values[:0])

                def cut_up(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
                    data = values.tobytes()
                    bounds = (bounds * values.itemsize).tolist()
                    return pa.array([data[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary())

                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(3)), pa.array(sizes + 1),
                     cut_up(units.astype("<u2"), np.concatenate([[0], stops])),
                     sums(seen.astype(np.int64)), sums(base), sums(share),
                     pa.ListArray.from_arrays(pa.array(rare_bounds, pa.int32()), words.take(pa.array(new))),
                     cut_up(group.astype(np.uint8), rare_bounds)],
                    ["row", "doc_id", "held_out", *names],
                )

    return docs.mapInArrow(batches, READ)


def fit_network(sequences: DataFrame, shares: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after all learning texts; in each round the partitions' results are averaged."""
    flat = gru.initial(LAYOUT, SEED, shares)
    for turn in range(rounds):
        sent = sequences.sparkSession.sparkContext.broadcast(flat)

        def batches(stream: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, weight = sent.value, 0
            for batch in stream:
                texts = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(0)]
                own = gru.train(own, texts, LAYOUT)
                weight += sum(map(len, texts))
            if weight:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(own))), pa.array(own.astype(np.float64) * weight),
                     pa.array(np.full(len(own), weight, np.int64))],
                    ["place", "value", "weight"],
                )

        part = sequences.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn).select("units")
        means = (
            part.mapInArrow(batches, "place BIGINT, value DOUBLE, weight BIGINT")
            .groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("mean")).collect()
        )
        if means:
            flat = np.array([r["mean"] for r in sorted(means, key=lambda r: r["place"])], np.float32)
    return flat


def _network_scores(sequences: DataFrame, flat: np.ndarray) -> DataFrame:
    sent = sequences.sparkSession.sparkContext.broadcast(flat)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(0)]
            scores = gru.log_chances(sent.value, texts, LAYOUT) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(1, batch.num_columns)), pa.array(scores)],
                [*batch.schema.names[1:], "network"],
            )

    return sequences.select(
        "units", "row", "doc_id", "held_out", "n_tokens", "n_seen", "base", "share"
    ).mapInArrow(
        batches,
        "row BIGINT, doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_seen BIGINT, base DOUBLE,"
        " share DOUBLE, network DOUBLE",
    )


def _rare_sums(sequences: DataFrame, vocabulary: DataFrame, total: int, distinct: int, room: np.ndarray) -> DataFrame:
    """Per row the parts of its scores that follow from words outside the frequent ones."""
    rests = F.array(*(F.lit(float(x)) for x in room[rest_of(np.arange(GROUPS))]))
    each = (
        sequences.select("row", F.posexplode("rare").alias("pos", "word"), "rare_groups")
        .select(
            "row", "word",
            F.conv(F.hex(F.substring("rare_groups", F.col("pos") + 1, F.lit(1))), 16, 10).cast("int").alias("group"),
        )
    )
    own = F.coalesce("n", F.lit(0)) + 1
    return (
        each.join(vocabulary, "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("n_rare"),
            F.sum(F.log10(own / (total + distinct + 1))).alias("rare_base"),
            F.sum(F.log10(own / F.get(rests, F.col("group")))).alias("rare_share"),
        )
    )


def scores(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null counts as empty: its only token is the end. A null id counts as held out. Repeated rows
    repeat, and count in learning as often as they stand. Without learning rows every word is
    unseen; the end and all groups are equally likely. A text of any length is one sequence: its words
    are cut a text at a time, and the state is carried to its end. An empty table gives none; columns
    but text and id are not read.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col, PARTS, REST).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    learning = docs.where(remainder(id_col, PARTS) != REST).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    vocabulary = cut(count_words(learning))
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known = make_units(*frequent_words(vocabulary, FREQUENT))
    room = unit_room(known, unit_sums(vocabulary, known))
    sequences = cut(read_tokens(rows, known, total, distinct, room))
    flat = fit_network(sequences.where("NOT held_out"), room / room.sum())
    rare = _rare_sums(sequences, vocabulary, total, distinct, room)
    return (
        _network_scores(sequences, flat)
        .join(rare, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_seen") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
            (F.col("network") + F.col("share") + F.coalesce("rare_share", F.lit(0.0))).alias("score"),
        )
    )
