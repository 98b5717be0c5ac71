"""Secret scans by rules, each rule tried only on documents that can match it.

From every rule's regular expression follows a Boolean query over trigrams that any match must
contain. Documents are indexed segment by segment inside the Arrow batches: for each trigram that
some rule asks for, the list of documents that have it. Postings are intersected and joined as the
query says, and the rule's expression runs over the remaining documents. A rule from whose
expression no trigram follows runs over all of them. Segments hold a bounded number of bytes (or
one document), and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as C, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

SEGMENT_BYTES = 4 << 20
MOST_STRINGS = 64  # alternatives followed as whole strings
MOST_CHARS = 4  # of a character set that is followed letter by letter


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping, whose `group` has `least` characters. The
    span begins with the group `first`."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    first: int = 0


# The three kinds asked for. The shorter repeats of hexadecimal digits and of key ids
# are left to the expression, as a match always takes the whole run.
BASE = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # A run of token letters is looked at from its beginning and once: if its first "eyJ" begins no
    # token, no later one does.
    Rule(
        "jwt",
        r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))"
        r"(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)",
        first=1,
    ),
    Rule("host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"://[^\s/:@]+:[^\s/@]+@"),
)

# A query is True (any document), a trigram, or ("and" | "or", queries).


def _all(queries) -> object:
    wanted = [q for q in queries if q is not True]
    return True if not wanted else wanted[0] if len(wanted) == 1 else ("and", tuple(wanted))


def _any(queries) -> object:
    queries = tuple(queries)
    if not queries or any(q is True for q in queries):
        return True
    return queries[0] if len(queries) == 1 else ("or", queries)


def _of_strings(strings) -> object:
    return _any(
        _all(s[i : i + 3] for i in range(len(s) - 2)) if len(s) > 2 else True for s in strings
    )


def _set_chars(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            found.add(chr(value))
        elif op is C.RANGE and value[1] - value[0] < MOST_CHARS:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return {c.lower() for c in found} if len(found) <= MOST_CHARS else None


def _folds(flags: int) -> bool:
    """Whether letters outside ASCII may stand for ASCII ones."""
    return bool(flags & re.IGNORECASE) and not flags & re.ASCII


def _alternatives(op, value) -> tuple[set[str] | None, object]:
    """All strings an element can match, lower-cased, or None and the query of the element."""
    if op is C.LITERAL:
        return {chr(value).lower()}, True
    if op is C.IN:
        return _set_chars(value), True
    if op is C.AT:
        return {""}, True
    if op is C.SUBPATTERN:
        return (None, True) if _folds(value[1]) else _sequence(value[3])
    if op is C.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        strings = [s for s, _ in parts]
        if all(s is not None for s in strings) and sum(map(len, strings)) <= MOST_STRINGS:
            return set().union(*strings), True
        return None, _any(q if s is None else _of_strings(s) for s, q in parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, True
        if least == 0:
            return None, True
        return None, query if strings is None else _of_strings(strings)
    return None, True


def _sequence(parsed) -> tuple[set[str] | None, object]:
    open_end, queries, whole = {""}, [], True
    for op, value in parsed:
        strings, query = _alternatives(op, value)
        if strings is not None and len(strings) * len(open_end) <= MOST_STRINGS:
            open_end = {a + b for a, b in product(open_end, strings)}
            continue
        whole = False
        queries += [_of_strings(open_end), query if strings is None else _of_strings(strings)]
        open_end = {""}
    if whole:
        return open_end, True
    return None, _all([*queries, _of_strings(open_end)])


def trigram_query(pattern: str) -> object:
    """What every match contains, over lower-cased ASCII letters; True where nothing is certain.
    Parts that only non-ASCII letters can spell give no trigrams."""
    parsed = _parser.parse(pattern)
    if _folds(parsed.state.flags):
        return True
    strings, query = _sequence(parsed)
    return _ascii(query if strings is None else _of_strings(strings))


def _ascii(query) -> object:
    if query is True:
        return True
    if isinstance(query, str):
        return query if query.isascii() else True
    kind, parts = query
    return (_all if kind == "and" else _any)(_ascii(p) for p in parts)


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


class Scanner:
    """The rules, their queries, and the index of a segment at a time."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.expressions = [re.compile(r.pattern) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.terms = sorted(set().union(*(trigrams(q) for q in self.queries)))
        self.number = {t: i + 1 for i, t in enumerate(self.terms)}
        self.term_at = np.zeros(1 << 24, np.uint16)
        for term, number in self.number.items():
            a, b, c = term.encode()
            self.term_at[a << 16 | b << 8 | c] = number

    def postings(self, texts: list[str]) -> dict[int, np.ndarray]:
        """Term number -> the documents of the segment that have it, in order."""
        data = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        code = np.frombuffer(b"\x00".join(data) + b"\x00\x00", np.uint8).astype(np.uint32)
        terms = self.term_at[code[:-2] << 16 | code[1:-1] << 8 | code[2:]]
        at = np.flatnonzero(terms)
        starts = np.cumsum([0] + [len(d) + 1 for d in data])
        document = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(terms[at].astype(np.int64) * len(texts) + document)
        number, document = np.divmod(pairs, max(1, len(texts)))
        bounds = np.searchsorted(number, np.arange(len(self.terms) + 2))
        return {n: document[bounds[n] : bounds[n + 1]] for n in range(1, len(self.terms) + 1)}

    def candidates(self, query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if isinstance(query, str):
            return postings[self.number[query]]
        join = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(join, (self.candidates(q, postings, n) for q in query[1]))

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) for each document, in order."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings(texts)
        for k, (rule, expression, query) in enumerate(
            zip(self.rules, self.expressions, self.queries)
        ):
            for document in self.candidates(query, postings, len(texts)).tolist():
                for match in expression.finditer(texts[document]):
                    start, end = match.span(rule.group)
                    if end - start >= rule.least:
                        found[document].append((match.start(rule.first), k, match.end()))
        for spans in found:
            spans.sort()
        return found


def _segments(texts: Iterator[str], most: int) -> Iterator[list[str]]:
    own, size = [], 0
    for text in texts:
        if own and size + len(text) > most:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    if own:
        yield own


def _line(rules, spans) -> str:
    return ",".join(f"{rules[k].kind}:{start}:{end}" for start, k, end in spans)


def secret_spans(
    docs: DataFrame,
    rules: tuple[Rule, ...] = MORE,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    The base rules always run; `rules` add spans beside theirs. Offsets are code points, ends
    exclusive. Null counts as empty, without spans; null ids stay null, repeated rows repeat, an
    empty table gives none; other columns are not read. A text of any length is scanned whole; the
    rules' expressions look at a character a bounded number of times, so time grows with the length.
    """
    ship(docs.sparkSession)
    every, base = (*BASE, *rules), len(BASE)
    names = ["doc_id", *(f"n_{r.kind}" for r in BASE), "base_sha256", "spans"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(every)
        for batch in stream:
            counts, digests, lines = [[] for _ in BASE], [], []
            for segment in _segments((x.as_py() for x in batch.column(1)), SEGMENT_BYTES):
                for spans in scanner.spans(segment):
                    own = [s for s in spans if s[1] < base]
                    for k, column in enumerate(counts):
                        column.append(sum(s[1] == k for s in own))
                    digests.append(hashlib.sha256(_line(every, own).encode()).hexdigest())
                    lines.append(_line(every, spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests, pa.string()),
                    pa.array(lines, pa.string()),
                ],
                names,
            )

    schema = ", ".join(
        f"{n} {'STRING' if n in ('base_sha256', 'spans') else 'BIGINT'}" for n in names
    )
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).mapInArrow(batches, schema)
