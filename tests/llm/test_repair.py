"""Repair of conversations against plain paths with whole strings, and against all edits."""

import hashlib
import itertools
import random
import zlib

import pytest

from curbline.llm import repair

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, cost INT, kind STRING"
BLANKS = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256().hexdigest()


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        pick = zlib.crc32(key.encode()) % 20
        if pick == 1:
            text = ""
        if pick == 2:
            text = "".join(c for c in text if c not in ".!?")
        if pick == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def good(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def cheapest(rows, kinds):
    """Whole strings over prefixes of the grammar."""
    def after(roles):  # only the last initial and whether there is one matter
        return roles[-1:] or "-"

    fit = {("-", "s"), ("-", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    front = {"-": (0, "", ())}

    def grow(front):
        for _ in range(2):
            more = dict(front)
            for last, (cost, audit, done) in front.items():
                new = "a" if last == "u" else "u"
                found = (cost + 3, audit + "I", (*done, (new, None)))
                more[new] = min(found, more.get(new, found), key=lambda f: f[:2])
            front = more
        return front

    for i, ((_, _, role, _), kind) in enumerate(zip(rows, kinds)):
        found = {}

        def offer(last, way):
            if last not in found or way[:2] < found[last][:2]:
                found[last] = way

        starts = {}
        for last, (cost, audit, done) in front.items():
            ways = [(last, cost, audit, done)]
            for _ in range(2):
                at, c, s, d = ways[-1]
                new = "a" if at == "u" else "u"
                ways.append((new, c + 3, s + "I", (*d, (new, None))))
            starts[last] = ways
        for ways in starts.values():
            for at, c, s, d in ways:
                offer(at, (c + 4, s + "D", d))
                if kind not in ("blank", "duplicate"):
                    extra = 3 if kind == "truncated" else 0
                    new = "a" if at == "u" else "u"
                    offer(new, (c + 3 + extra, s + "R", (*d, (new, i))))
                    if (at, role[:1]) in fit:
                        offer(role[0], (c + extra, s + "K", (*d, (role[0], i))))
        front = found
    last = grow(front)
    best = min((last[s] for s in ("-", "a") if s in last), key=lambda f: f[:2])
    return best


def by_hand(original, rows):
    convs, out = {}, []
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    for conv in dict.fromkeys(r[0] for r in original):
        own = convs.get(conv, [])
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        kinds = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, done = cheapest(own, kinds) if own else (0, "", ())
        full, edits, lines = {"u": "user", "a": "assistant"}, [e for e in audit if e != "D"], []
        for (initial, i), edit in zip(done, edits):
            role = own[i][2] if edit == "K" else full[initial]
            lines.append(f"{role}:{'' if i is None else own[i][3]}")
        assert good("".join(line[0] for line in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def told(rng, conv, n, roles=("user", "assistant", "system", "tool", "")):
    texts = ["Yes.", "no", "Why?  \n", "", " \t", "a\nb.", "Well!", "x . y", "é中."]
    return [(conv, rng.choice([t, t, t + 1, t * 2]), rng.choice(roles), rng.choice(texts)) for t in range(n)]


@pytest.mark.parametrize("bits", [repair.SEGMENT_BITS, 2])
def test_against_plain_paths(spark, bits):
    rng = random.Random(5)
    rows = [r for conv in range(60) for r in told(rng, conv, rng.randrange(1, 12))]
    rows += told(rng, 500, 150) + told(rng, 501, 90, ("user", "assistant"))
    rows += [(None, None, None, None), (None, 3, "user", "Hm."), (None, 3, "user", "Hm."), (70, None, "user", "A."), (70, None, None, "B.")]
    rows += [(71, 1, "user", None)] + [(72, 4, "assistant", "Same.")] * 30
    rows += rows[:9]
    frame = table(spark, rows)
    expected = by_hand(rows, damage(rows))
    assert got(repair.audits(repair.damaged(frame), frame, bits=bits)) == expected


def test_all_edits_of_short_conversations():
    """The grammar of edits by itself: every string of edits, tried out."""
    for initials in itertools.product("suax", repeat=3):
        for kinds in itertools.product(("", "blank", "truncated"), repeat=3):
            best = None
            for edits in itertools.product(("", "I", "II"), "KRD", repeat=3):
                for tail in ("", "I", "II"):
                    audit, cost, state, fit = "".join(edits) + tail, 0, "", True
                    row = 0
                    for e in audit:
                        if e == "D":
                            cost += 4
                        elif e == "I":
                            state, cost = state + ("a" if state[-1:] == "u" else "u"), cost + 3
                        else:
                            fit &= kinds[row] != "blank"
                            cost += 3 * (kinds[row] == "truncated") + 3 * (e == "R")
                            state += initials[row] if e == "K" else "a" if state[-1:] == "u" else "u"
                        row += e != "I"
                    if fit and good(state) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
            symbols = "".join(map(repair.symbol, initials, kinds))
            front = repair.Front(repair.Trails(), repair.START)
            for s in symbols:
                front.step(repair.STEPS[s])
            cost, node = front.close()
            assert (cost, front.trails.spelled(node)) == best
        if initials > ("s", "u", "u"):
            break


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3, 1])
def test_order_of_linked_strings_whatever_the_hash(modulus):
    rng = random.Random(3)
    trails, strings = repair.Trails(modulus=modulus), {0: ""}
    for _ in range(400):
        node, piece = rng.choice(list(strings)), "".join(rng.choices("DIKR", [6, 1, 1, 1], k=rng.randrange(1, 5)))
        strings[trails.extend(node, piece)] = strings[node] + piece
    assert all(trails.spelled(n) == s for n, s in strings.items())
    for _ in range(3000):
        a, b = rng.choice(list(strings)), rng.choice(list(strings))
        assert trails.less(a, b) == (strings[a] < strings[b]) or strings[a] == strings[b]


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "user", "Hi."), (1, 2, "user", "There?"), (2, 0, "tool", "x."), (3, 5, "user", "")]
    out = repair.repaired(table(spark, rows))
    assert sorted(map(tuple, out.collect())) == [
        (1, 0, "K", "system", "Be."),
        (1, 1, "K", "user", "Hi."),
        (1, 2, "R", "assistant", "There?"),
    ]


def test_empty_table_and_conversations_without_rows(spark):
    none = table(spark, [])
    assert got(repair.audits(none)) == []
    named = table(spark, [(9, 0, "user", "x"), (None, 0, "user", "x")])
    empty = [(c, 0, 0, 0, 0, 0, 0, "", EMPTY) for c in (9, None)]
    assert got(repair.audits(none, named)) == sorted(empty, key=str)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*SCHEMA.replace(",", "").split()[0:8:2]).collect()]
    from curbline.llm.queries import QUERIES

    assert got(QUERIES["op13_repair"](spark, sf_dir)) == by_hand(rows, damage(rows))
