import hashlib
import itertools
import random
import re
import zlib

import pytest

from oracle_compare import connect
from tradeloom.llm import repair
from tradeloom.llm.queries import op12_repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """(cost, audit, kept (role, text)) of turns (initial, goes, breaks off) by trying all edits; inserts by twos at most."""
    best = (2 * len(turns), "D" * len(turns))

    def go(i, cost, audit, made):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(turns) and GRAMMAR.fullmatch(made) and (cost, audit) < best:
            best = (cost, audit)
        if not audit.endswith("II"):
            for x in "ua":
                go(i, cost + 5, audit + "I", made + x)
        if i < len(turns):
            initial, goes, off = turns[i]
            go(i + 1, cost + 2, audit + "D", made)
            if not goes:
                go(i + 1, cost + 5 * off, audit + "K", made + initial)
                for x in "ua":
                    go(i + 1, cost + 1 + 5 * off, audit + "R", made + x)

    go(0, 0, "", "")
    return best


def code(turn):
    initial, goes, off = turn
    return "suax".index(initial) + repair.GOES * goes + repair.OPEN * off


@pytest.mark.parametrize("n", range(5))
def test_all_short_sequences(n):
    kinds = [(i, g, o) for i in "suax" for g, o in ((0, 0), (1, 0), (0, 1))]
    every = list(itertools.product(kinds, repeat=n))
    for turns in every if n < 3 else random.Random(n).sample(every, 200):
        assert repair.repair(bytes(map(code, turns))) == cheapest(turns), turns


def test_longer_sequences():
    rng = random.Random(1)
    for _ in range(60):
        turns = [(rng.choice("suuaax"), rng.random() < 0.1, rng.random() < 0.15) for _ in range(rng.randrange(4, 7))]
        turns = [(i, g, o and not g) for i, g, o in turns]
        assert repair.repair(bytes(map(code, turns))) == cheapest(turns), turns


def by_states(codes):
    """(cost, audit) by the least (cost, audit) for each state of the grammar, turn by turn."""
    best = {"": (0, "")}
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def put(into, state, value):
        into[state] = min(into.get(state, value), value)

    def inserted(held):
        for _ in range(2):
            for state, (cost, audit) in list(held.items()):
                for x in "ua":
                    if x in step[state]:
                        put(held, step[state][x], (cost + 5, audit + "I"))
        return held

    for c in codes:
        new = {}
        for state, (cost, audit) in inserted(best).items():
            put(new, state, (cost + 2, audit + "D"))
            if not c & repair.GOES:
                off = 5 if c & repair.OPEN else 0
                for x, to in step[state].items():
                    if "suax"[c & 3] == x:
                        put(new, to, (cost + off, audit + "K"))
                    elif x != "s":
                        put(new, to, (cost + off + 1, audit + "R"))
        best = new
    return min(v for state, v in inserted(best).items() if state in ("", "a"))


def test_a_long_conversation_keeps_a_narrow_band():
    rng = random.Random(4)
    codes = bytes(code((rng.choice("uuaas"), rng.random() < 0.1, 0)) for _ in range(20_000))
    bounds, most = repair.reach(codes)
    assert max(len(costs) for _, costs in repair.table(codes, bounds, most)) < len(codes) / 20
    assert repair.repair(codes) == by_states(codes)


def plain(rows):
    """Expected rows, from (conv, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        space = lambda x: " " if x is None else str(x)
        role, text = space(role), space(text)
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        own.extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    out = []
    for conv, own in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            blank = not VISIBLE.search(text)
            again = not blank and (role, text) in seen
            off = not blank and not again and VISIBLE.findall(text)[-1] not in ".!?"
            seen.add((role, text))
            counts = [c + x for c, x in zip(counts, (blank, again, off))]
            turns.append((role[:1] if role[:1] in "sua" and role else "x", int(blank or again), int(off)))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[0], b[0]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(turns, turns[1:]))
        cost, audit = by_states(bytes(map(code, turns)))
        made, left, n, at = [], iter(own), len(audit) - audit.count("D"), 0
        for edit in audit:
            target = "user" if (at - n % 2) % 2 == 0 else "assistant"
            _, role, text = (None, target, "") if edit == "I" else next(left)
            if edit != "D":
                made.append(f"{target if edit == 'R' else role}:{text}")
                at += 1
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "usr", "S"]),
             rng.choice(["Fine.", "no end", "Same.", "Same.", "", " \n", None, "tail. \t\n", "x" * 50_000 + "!"]))
            for c in [None, *range(40)] for t in [*range(rng.randrange(9)), *([None, None, 3] if c == 5 else [])]]
    rows += [(50, None, "user", "Only nulls.")] + [(51, 2, "user", "Tie."), (51, 2, "assistant", "Tie."), (51, 2, "user", "Tie.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS cost", "2 AS conv", "'x' AS digest")
    assert got(repair.repair_conversations(df, "conv_id", "turn", "role", "text")) == plain(rows)
    assert got(repair.repair_conversations(df.where("false"), "conv_id", "turn", "role", "text")) == []


def test_a_conversation_with_most_rows(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Turn {t}.") for t in range(6000)] + [(2, 0, "user", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(repair.repair_conversations(df, "conv_id", "turn", "role", "text")) == plain(rows)


def test_query_against_states(spark, sf):
    rows = connect(sf).sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got(op12_repair(spark, sf)) == plain(rows)
