"""Repair of the structure of conversations: the cheapest edits, the least of equals, and their audit.

A repaired conversation may open with a system turn and goes on in pairs of user and assistant. The
cheapest edits that get there are a shortest path over four states (nothing yet, after system,
after user, after assistant); among equally cheap paths the one with the smallest audit, the string
of its edits, is taken.

Audits are kept as linked nodes: a path is its last piece and the node before it, so paths that
begin alike share their beginning. Every node knows its ancestors at distances of powers of two and
a rolling hash of the whole string down to it. A tie between two paths is settled at the end of
their longest common prefix, which is searched by those hashes; equal hashes are checked against
the pieces themselves.

Conversations are sorted over all tasks and cut into segments of a bounded number of rows, wherever
tasks end. A segment gives the best path for each pair of first and last state, whatever the rest
holds; a conversation then adds up its segments in order. So a conversation of any length
is worked on by many tasks, and only one string per segment and state meets in one. The digest of a
repaired text is a chain over its rows; the task of a conversation streams them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared_dir, ship

# fixed values: what edits cost
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
DAMAGES = 20  # fixed value: remainders of the checksum, of which five are damages
SEGMENT_BITS = 11  # a segment lies within 2 ** 11 rows
SALTS = 8
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {  # state and role initial -> state
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
PAIRS = ("su", "ua", "au")  # fixed value: initials that may stand beside each other
INITIALS = "suax"  # x: any other role
FAULTS = ("", "blank", "duplicate", "truncated")
FULL_NAME = {"u": "user", "a": "assistant"}
SEGMENTS = (
    "conv_id BIGINT, block BIGINT, symbols STRING, low BIGINT, high BIGINT, turns BIGINT,"
    " costs ARRAY<BIGINT>, audits ARRAY<STRING>"
)
TOTALS = "gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT"
PATHS = f"conv_id BIGINT, block BIGINT, state INT, edits STRING, {TOTALS}"
REPAIRED = "conv_id BIGINT, place BIGINT, edit STRING, role STRING, text STRING"


def added(state: int) -> str:
    """The initial that an inserted or renamed row must have after a state."""
    return "a" if state == USER else "u"


class Trails:
    """Strings as linked pieces."""

    def __init__(self, base: int = 1_000_003, modulus: int = (1 << 61) - 1):
        self.base, self.modulus = base, modulus
        self.pieces, self.depths, self.hashes = [""], [0], [0]
        self.ups: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... nodes above
        self.checked: dict[tuple[int, int, int], bool] = {}

    def _hash(self, value: int, piece: str) -> int:
        for char in piece:
            value = (value * self.base + ord(char)) % self.modulus
        return value

    def extend(self, node: int, piece: str) -> int:
        if not piece:
            return node
        self.pieces.append(piece)
        self.depths.append(self.depths[node] + len(piece))
        self.hashes.append(self._hash(self.hashes[node], piece))
        own, above = [node], node
        while len(self.ups[above]) >= len(own):
            above = self.ups[above][len(own) - 1]
            own.append(above)
        self.ups.append(own)
        return len(self.pieces) - 1

    def over(self, node: int, place: int) -> int:
        """The node on the way to `node` in whose piece character number `place` (from 1) stands."""
        step = len(self.ups[node])
        while step:
            step -= 1
            if step < len(self.ups[node]) and self.depths[self.ups[node][step]] >= place:
                node = self.ups[node][step]
        return node

    def prefix(self, node: int, length: int) -> int:
        """The hash of the first characters."""
        if not length:
            return 0
        node = self.over(node, length)
        if self.depths[node] == length:
            return self.hashes[node]
        parent = self.ups[node][0]
        return self._hash(self.hashes[parent], self.pieces[node][: length - self.depths[parent]])

    def char(self, node: int, place: int) -> str:
        node = self.over(node, place)
        return self.pieces[node][place - self.depths[self.ups[node][0]] - 1]

    def nodes(self, node: int) -> list[int]:
        """From the first piece to the last."""
        found = []
        while node:
            found.append(node)
            node = self.ups[node][0]
        return found[::-1]

    def spelled(self, node: int) -> str:
        return "".join([self.pieces[n] for n in self.nodes(node)])

    def equal(self, a: int, b: int, length: int) -> bool:
        """Whether the first characters are really the same. Each pair of places is looked at once,
        and only down to where the two ways part."""
        if not length:
            return True
        a, b = self.over(a, length), self.over(b, length)
        key = (min(a, b), max(a, b), length)
        if key not in self.checked:
            left, right = [], []
            while a != b:
                if self.depths[a] >= self.depths[b]:
                    left.append(self.pieces[a])
                    a = self.ups[a][0]
                else:
                    right.append(self.pieces[b])
                    b = self.ups[b][0]
            keep = length - self.depths[a]
            self.checked[key] = "".join(left[::-1])[:keep] == "".join(right[::-1])[:keep]
        return self.checked[key]

    def less(self, a: int, b: int) -> bool:
        """Whether the string of a stands before that of b."""
        if a == b:
            return False
        low, high = 0, min(self.depths[a], self.depths[b])
        while low < high:
            middle = (low + high + 1) // 2
            if self.prefix(a, middle) == self.prefix(b, middle):
                low = middle
            else:
                high = middle - 1
        if not self.equal(a, b, low):  # two strings under one hash
            return self.spelled(a) < self.spelled(b)
        if low == min(self.depths[a], self.depths[b]):
            return self.depths[a] < self.depths[b]
        return self.char(a, low + 1) < self.char(b, low + 1)


def symbol(initial: str, fault: str) -> str:
    return chr(ord("a") + len(FAULTS) * INITIALS.index(initial) + FAULTS.index(fault))


def _steps(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """For every state after a row: the states before it, each with its cheapest edits."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in STATES:
        state, cost, inserts = before, 0, ""
        for _ in range(3):  # more inserts come back to a state that fewer reach
            ways = [(state, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                ways.append((NEXT[state, added(state)], REROLE + extra, "R"))
                if (state, initial) in NEXT:
                    ways.append((NEXT[state, initial], extra, "K"))
            for after, more, edit in ways:
                found = (cost + more, inserts + edit)
                best[after, before] = min(found, best.get((after, before), found))
            state, cost, inserts = NEXT[state, added(state)], cost + INSERT, inserts + "I"
    return [[(b, *best[a, b]) for b in STATES if (a, b) in best] for a in STATES]


STEPS = {symbol(i, f): _steps(i, f) for i, f in product(INITIALS, FAULTS)}
ENDS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # what closes a conversation


class Front:
    """The best path to each state so far."""

    def __init__(self, trails: Trails, first: int):
        self.trails = trails
        self.costs: dict[int, int] = {first: 0}
        self.ends: dict[int, int] = {first: 0}

    def best(self, ways: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        """Cost and node of the best of some ways on (state, cost, piece)."""
        known = [(self.costs[s] + c, s, piece) for s, c, piece in ways if s in self.costs]
        if not known:
            return None
        least = min(k[0] for k in known)
        found = None
        for cost, state, piece in known:
            if cost == least:
                node = self.trails.extend(self.ends[state], piece)
                if found is None or self.trails.less(node, found):
                    found = node
        return least, found

    def step(self, ways_to: list[list[tuple[int, int, str]]]) -> None:
        found = {state: self.best(ways) for state, ways in enumerate(ways_to)}
        self.costs = {s: f[0] for s, f in found.items() if f}
        self.ends = {s: f[1] for s, f in found.items() if f}

    def close(self) -> tuple[int, int]:
        return self.best([(s, INSERT * len(e), e) for s, e in ENDS.items()])


def segment_paths(symbols: str, firsts: list[int]) -> tuple[list[int | None], list[str | None]]:
    """Cost and audit for each pair (first state, last state), in rows of four."""
    costs, audits = [None] * 16, [None] * 16
    for first in firsts:
        front = Front(Trails(), first)
        for one in symbols:
            front.step(STEPS[one])
        for last, node in front.ends.items():
            costs[4 * first + last] = front.costs[last]
            audits[4 * first + last] = front.trails.spelled(node)
    return costs, audits


def initials(symbols: str) -> str:
    return "".join([INITIALS[(ord(c) - ord("a")) // len(FAULTS)] for c in symbols])


def _solved(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        found = [
            segment_paths(symbols, [START] if opens else list(STATES))
            for symbols, opens in zip(batch.column("symbols").to_pylist(), batch.column("opens").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in ("conv_id", "block", "symbols", "low", "high", "turns")),
                pa.array([f[0] for f in found], pa.list_(pa.int64())),
                pa.array([f[1] for f in found], pa.list_(pa.string())),
            ],
            ["conv_id", "block", "symbols", "low", "high", "turns", "costs", "audits"],
        )


class _Conversation:
    """The segments of one conversation, added up in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.front = Front(Trails(), START)
        self.blocks: list[int] = []
        self.states: dict[int, int] = {}
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal, self.turns, self.last = 0, 0, ""
        self.low = self.high = None

    def add(self, row: dict) -> None:
        costs, audits = row["costs"], row["audits"]
        self.front.step(
            [[(f, costs[4 * f + t], audits[4 * f + t]) for f in STATES if costs[4 * f + t] is not None] for t in STATES]
        )
        self.blocks.append(row["block"])
        self.states.update((node, state) for state, node in self.front.ends.items())
        for name, place in zip(FAULTS, range(len(FAULTS))):
            self.faults[name] += sum(row["symbols"].count(chr(ord("a") + len(FAULTS) * i + place)) for i in range(4))
        roles = self.last + initials(row["symbols"])
        self.illegal += sum(roles[i : i + 2] not in PAIRS for i in range(len(roles) - 1))
        self.last = roles[-1]
        if row["turns"]:
            self.turns += row["turns"] - (row["low"] == self.high)  # rows are in order of turns
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def rows(self) -> Iterator[tuple]:
        trails = self.front.trails
        cost, node = self.front.close()
        way = trails.nodes(node)
        pieces = [trails.pieces[n] for n in way]
        if len(way) > len(self.blocks):  # the inserts that close the conversation
            pieces[-2:] = ["".join(pieces[-2:])]
        states = [START, *(self.states[n] for n in way[: len(self.blocks) - 1])]
        for block, state, edits in zip(self.blocks, states, pieces):
            yield (self.conv_id, block, state, edits, *(None,) * 6)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [self.faults[n] for n in ("blank", "duplicate", "truncated")]
        yield (self.conv_id, None, None, "".join(pieces), gaps, *counts, self.illegal, cost)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _combined(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6]
    current = None
    for batch in stream:
        done: list[tuple] = []
        for row in batch.to_pylist():
            if current is None or row["conv_id"] != current.conv_id:
                if current is not None:
                    done += current.rows()
                current = _Conversation(row["conv_id"])
            current.add(row)
        yield _batch(done, _names(PATHS), kinds)
    if current is not None:
        yield _batch(list(current.rows()), _names(PATHS), kinds)


class _Editor:
    """Applies the edits of a conversation to its rows as they pass."""

    def __init__(self, conv_id):
        self.conv_id, self.place, self.totals = conv_id, 0, None
        self.edits, self.at, self.last, self.state = "", 0, 0, START

    def take(self, state: int, edits: str) -> None:
        self.state, self.edits, self.at, self.last = state, edits, 0, len(edits.rstrip("I"))

    def _put(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        self.state = NEXT[self.state, role[0]]
        return (self.conv_id, self.place - 1, edit, role, text)

    def _inserts(self) -> Iterator[tuple]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._put("I", FULL_NAME[added(self.state)], "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(edit, role if edit == "K" else FULL_NAME[added(self.state)], text)
        if self.at == self.last:
            yield from self._inserts()


def _edited(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Editor, list[tuple], bool]]:
    """Each conversation's editor with the next repaired rows, and whether these are its last."""
    editor = None
    for batch in stream:
        for row in batch.to_pylist():
            if editor is None or row["conv_id"] != editor.conv_id:
                if editor is not None:
                    yield editor, [], True
                editor = _Editor(row["conv_id"])
            if row["kind"] == PATH:
                editor.take(row["state"], row["edits"])
            elif row["kind"] == ROW:
                yield editor, list(editor.row(row["role"], row["text"])), False
            elif row["kind"] == TOTAL:
                editor.totals = (*(row[n] for n in _names(TOTALS)), row["edits"])
    if editor is not None:
        yield editor, [], True


ID, PATH, ROW, TOTAL = range(4)  # kinds of the rows that meet in a conversation, in this order
BATCH = 2_000


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *_names(TOTALS), "audit", "repaired_sha256"]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    found, digest = [], hashlib.sha256()
    for editor, rows, over in _edited(stream):
        for _, place, _, role, text in rows:
            digest.update(f"{'\n' if place else ''}{role}:{text}".encode())
        if over:
            found.append((editor.conv_id, *(editor.totals or (*(0,) * 6, "")), digest.hexdigest()))
            digest = hashlib.sha256()
            if len(found) == BATCH:
                yield _batch(found, names, kinds)
                found = []
    yield _batch(found, names, kinds)


def _rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    found = []
    for _, rows, _ in _edited(stream):
        found += rows
        if len(found) >= BATCH:
            yield _batch(found, _names(REPAIRED), kinds)
            found = []
    yield _batch(found, _names(REPAIRED), kinds)


def whole(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, with one space for a null role or text."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the checksum of conversation and turn picks for each."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    pick = F.crc32(F.concat_ws(":", *named).cast("binary")) % DAMAGES
    return (
        whole(conversations)
        .withColumn("pick", pick)
        .where(F.col("pick") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("pick") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("pick") == 1, "")
            .when(F.col("pick") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def _placed(rows: DataFrame, folder: str) -> DataFrame:
    """All rows in order of conversation, turn, role and text, numbered, in the shared folder. The
    number of an equal row is in the order too, so that copies may lie in several tasks."""
    order = ["conv_id", "turn", "role", "digest", "copy"]
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    full = rows.withColumns(
        {
            "digest": F.unhex(F.sha2("text", 256)),
            "copy": F.monotonically_increasing_id(),
            "blank": bare == "",
            "truncated": ~F.substring(bare, -1, 1).isin(".", "!", "?"),
        }
    )
    full.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "pos", F.monotonically_increasing_id()
    ).drop("copy").write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _segments(placed: DataFrame, bits: int) -> DataFrame:
    """The symbols (role and first fault of each row) of every piece of a conversation."""
    light = placed.drop("text").withColumn("salt", F.pmod("pos", F.lit(SALTS)))
    seen = (
        light.where(~F.col("blank"))
        .groupBy(*(F.col(c).alias(f"seen_{c}") for c in ("conv_id", "role", "digest")))
        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .withColumn("seen_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    )
    same = [F.col(c) == F.col(f"seen_{c}") for c in ("role", "digest", "salt")]
    marked = light.join(seen, [F.col("conv_id").eqNullSafe(F.col("seen_conv_id")), *same], "left").withColumn(
        "duplicate", F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    )
    fault = F.when(F.col("blank"), 1).when(F.col("duplicate"), 2).when(F.col("truncated"), 3).otherwise(0)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS[:3])) - 1
    known = F.when((F.col("role") == "") | (initial < 0), len(INITIALS) - 1).otherwise(initial)
    one = F.char(F.lit(ord("a")) + known * len(FAULTS) + fault)
    return (
        marked.groupBy("conv_id", F.shiftright("pos", bits).alias("block"))
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", one.alias("one")))).alias("ones"),
            F.min("turn").alias("low"),
            F.max("turn").alias("high"),
            F.size(F.collect_set("turn")).cast("long").alias("turns"),
        )
        .select("conv_id", "block", F.array_join("ones.one", "").alias("symbols"), "low", "high", "turns")
    )


def _joined(rows: DataFrame, conversations: DataFrame, bits: int) -> DataFrame:
    """What belongs to a conversation in the order in which it is needed: its id, then for each
    segment the edits and the rows, then the totals."""
    spark = rows.sparkSession
    ship(spark)
    folder = f"{shared_dir(spark)}/repair-{uuid.uuid4().hex}"
    placed = _placed(rows, f"{folder}/rows")
    _segments(placed, bits).write.parquet(f"{folder}/segments")
    segments = spark.read.parquet(f"{folder}/segments")
    # Only conversations that lie in several segments have one that may begin in any state.
    several = (
        segments.groupBy(F.col("conv_id").alias("long_id"))
        .agg(F.min("block").alias("head"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    solved = (
        segments.join(several, F.col("conv_id").eqNullSafe(F.col("long_id")), "left")
        .select(*segments.columns, F.coalesce(F.col("block") == F.col("head"), F.lit(True)).alias("opens"))
        .mapInArrow(_solved, SEGMENTS)
    )
    paths = (
        solved.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_combined, PATHS)
    )
    end = F.lit((1 << 63) - 1)
    parts = [
        conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
            "conv_id", F.lit(-1).cast("long").alias("place"), F.lit(ID).alias("kind")
        ),
        paths.select(
            "conv_id",
            F.coalesce(F.shiftleft("block", bits), end).alias("place"),
            F.when(F.col("block").isNull(), TOTAL).otherwise(PATH).alias("kind"),
            "state",
            "edits",
            *_names(TOTALS),
        ),
        placed.select("conv_id", F.col("pos").alias("place"), F.lit(ROW).alias("kind"), "role", "text"),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")


def audits(rows: DataFrame, conversations: DataFrame | None = None, bits: int = SEGMENT_BITS) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256, the digest of its repaired rows.

    `rows` has conv_id, turn, role and text; other columns are not read. Rows of a conversation are
    taken by turn, null turns first, and equal turns by role and by the digest of the text. A null
    conv_id is a conversation; a null role or text is one space, and a role that begins with none
    of s, u, a cannot be kept. Repeated rows are duplicates, or blank. Texts and conversations may
    be of any length. `conversations` names ids to report besides those of `rows`: one without any
    row has zeros, an empty audit and the digest of nothing. An empty table gives no rows.
    """
    named = rows if conversations is None else conversations.select("conv_id").unionByName(rows.select("conv_id"))
    schema = f"conv_id BIGINT, {TOTALS}, audit STRING, repaired_sha256 STRING"
    return _joined(whole(rows), named, bits).mapInArrow(_digests, schema)


def repaired(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (K, R or I), role, text. The cases of
    `audits` hold; a conversation without rows after the repair has none."""
    return _joined(whole(rows), rows, bits).mapInArrow(_rows, REPAIRED)
