"""Repair of conversations by aligning their turns with the grammar of roles.

A conversation is right when the initials of its roles are ``(s?(ua)+)?``. The strings of that grammar have one form for
each feasible length: none, ``uaua...`` of even length, the same after an ``s`` of odd length. Turns are aligned with them
by the Wagner-Fischer table of edits. All of these targets end alike, so one table over (turns left, target left) holds the
alignment with every length. It is filled from the end, within a band as Ukkonen's: a linear pass over the states of the
grammar gives the cost of an incumbent and the least cost of reaching a cell, and cells beyond the incumbent's cost are
left out. The audits of all lengths that reach it are traced back, and the least one is taken.

Two passes over the rows: faults and edits need a byte a turn and no texts, which come once more, as a sorted stream, to
be repaired by the finished audit. So a long conversation costs a task its codes and its band, not its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tradeloom.llm.frames import bounded_batches, keep

DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5  # costs; a kept turn that breaks off costs the last one more
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = {"u": "user", "a": "assistant"}
#: A turn's code: its initial as two bits, then whether it must go, whether it breaks off.
INITIALS = "sua"
GOES, OPEN = 4, 8
NONE = -1  # the code of a turn that is not there any more
NEVER = 1 << 40
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reach(codes: bytes) -> tuple[list[tuple[int, int]], int]:
    """For each number of turns read, the least cost at which a ``u``, and an ``a``, may come next; and the least of all."""
    start, after_s, wants_a, wants_u = 0, NEVER, INSERT, 2 * INSERT  # nothing yet, s, ...u, ...a
    bounds = [(min(start, after_s, wants_u), wants_a)]
    for code in codes:
        initial, stay = code & 3, NEVER if code & GOES else UNFINISHED if code & OPEN else 0
        u, a = (stay + (0 if initial == i else REROLE) for i in (1, 2))
        open_u = min(start, after_s, wants_u)
        s = start + stay if initial == 0 else NEVER
        start, after_s = start + DELETE, min(after_s + DELETE, s)
        wants_u, wants_a = min(wants_u + DELETE, wants_a + a), min(wants_a + DELETE, open_u + u)
        wants_a = min(wants_a, min(start, after_s, wants_u) + INSERT)
        wants_u = min(wants_u, wants_a + INSERT)
        bounds.append((min(start, after_s, wants_u), wants_a))
    return bounds, min(start, wants_u)


def table(codes: bytes, bounds: list[tuple[int, int]], most: int) -> list[tuple[int, np.ndarray]]:
    """For each turn, (first, costs): the least cost of aligning it and those after it with the last ``first``, ``first + 1``,
    ... letters of the target; NEVER where no repair of cost ``most`` leads through."""

    def banded(i: int, low: int, costs: np.ndarray) -> tuple[int, np.ndarray]:
        bound = np.array(bounds[i])[(low + np.arange(len(costs))) & 1]
        costs[costs + bound > most] = NEVER
        inside = np.flatnonzero(costs < NEVER)
        if not len(inside):
            return low, costs[:0]
        return low + int(inside[0]), costs[inside[0]:inside[-1] + 1]

    last = max(0, most - min(bounds[-1])) // INSERT
    rows = [banded(len(codes), 0, INSERT * np.arange(last + 1, dtype=np.int64))]
    for i in range(len(codes) - 1, -1, -1):
        low, below = rows[-1]
        code = codes[i]
        room = max(0, most - min(bounds[i]) - int(below.min())) // INSERT if len(below) else 0
        costs = np.full(len(below) + 1 + room, NEVER, np.int64)
        costs[:len(below)] = below + DELETE
        if not code & GOES:
            letter = np.where((low + 1 + np.arange(len(below))) & 1, 2, 1)  # of the target: a before an odd rest, u before an even
            step = below + (letter != (code & 3)) * REROLE + (UNFINISHED if code & OPEN else 0)
            costs[1:len(below) + 1] = np.minimum(costs[1:len(below) + 1], step)
        ramp = INSERT * np.arange(len(costs))
        costs = np.minimum.accumulate(costs - ramp) + ramp
        rows.append(banded(i, low, costs))
    return rows[::-1]


def _at(rows: list[tuple[int, np.ndarray]], i: int, rest: int) -> int:
    low, costs = rows[i]
    return int(costs[rest - low]) if low <= rest < low + len(costs) else NEVER


def trace(codes: bytes, rows: list[tuple[int, np.ndarray]], i: int, rest: int) -> str:
    """The least audit of the turns from ``i`` on against ``rest`` letters, of those at the table's cost."""
    out = []
    while i < len(codes) or rest:
        here = _at(rows, i, rest)
        if i < len(codes) and _at(rows, i + 1, rest) + DELETE == here:
            out.append("D")
            i += 1
        elif rest and _at(rows, i, rest - 1) + INSERT == here:
            out.append("I")
            rest -= 1
        else:
            out.append("K" if codes[i] & 3 == (2 if rest & 1 else 1) else "R")
            i, rest = i + 1, rest - 1
    return "".join(out)


def _cheapest(codes: bytes) -> tuple[int, str]:
    bounds, most = reach(codes)
    rows = table(codes, bounds, most)
    starts = [("", 0, most)]  # what comes before the repeated pair, the turns it takes, what is left to pay
    begun = [i for i, code in enumerate(codes) if not code & 3 and not code & GOES
             and 0 <= most - DELETE * i - (UNFINISHED if code & OPEN else 0)]
    starts += [("D" * i + "K", i + 1, most - DELETE * i - (UNFINISHED if codes[i] & OPEN else 0)) for i in reversed(begun)]
    audits = []
    for before, i, left in starts:
        low, costs = rows[i]
        ends = [low + int(k) for k in np.flatnonzero(costs == left) if (low + k) % 2 == 0 and (low + k > 0 or not before)]
        audits += [before + trace(codes, rows, i, rest) for rest in ends]
        if before and ends:
            break  # a later s leaves more to delete in front, which is less as text
    return most, min(audits)


_remembered = lru_cache(maxsize=50_000)(_cheapest)


def repair(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the least audit of those. Those of short conversations are remembered."""
    return _remembered(codes) if len(codes) <= 64 else _cheapest(codes)


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest, there): the rows after damage; a dropped row stays as one that is not there."""
    def or_space(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat(or_space(F.col(conv)), F.lit(":"), or_space(F.col(turn))), "UTF-8")) % 20
    own = or_space(F.col(text))
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(fault == 4, "user").otherwise(or_space(F.col(role))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(own, "[.!?]", "")).otherwise(own).alias("text"),
        (fault != 0).alias("there"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
    return rows.withColumn("digest", row_digest("role", "text"))


def row_digest(role: str, text: str) -> Column:
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def turn_codes(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest, again, code, kind) of damaged rows: kind is 0 blank, 1 duplicate, 2 truncated, 3 without fault."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    again = F.row_number().over(Window.partitionBy("conv", "digest", "there").orderBy(F.asc_nulls_first("turn"))) > 1
    kind = F.when(F.octet_length(trimmed) == 0, 0).when(F.col("again"), 1).when(
        ~F.right(trimmed, F.lit(1)).isin(*ENDS), 2).otherwise(3)
    initial = F.left("role", F.lit(1))
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = letter + F.when(F.col("kind") < 2, GOES).when(F.col("kind") == 2, OPEN).otherwise(0)
    light = rows.withColumns({"kind": F.lit(0), "again": again}).withColumn("kind", kind)
    return light.select("conv", "turn", "digest", "again", F.when(F.col("there"), code).otherwise(NONE).cast("int").alias("code"), "kind")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, its rows) of sorted batches; each run is to be read before the next."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    held = next(rows, None)
    while held is not None:
        conv, following = held[0], []

        def own() -> Iterator[tuple]:
            row = held
            while row is not None and row[0] == conv:
                yield row[1:]
                row = next(rows, None)
            following.append(row)

        yield conv, own()
        held = following[0]


def audits(codes: DataFrame, conv_type: T.DataType) -> DataFrame:
    """(conv, counts, audit) of every conversation, from the codes of its turns."""
    schema = T.StructType([T.StructField("conv", conv_type), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType())])
    legal = {(0, 1), (1, 2), (2, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def batch() -> pa.RecordBatch:
            types = [pa.int64()] * len(COUNTS) + [pa.string()]
            convs, *rest = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), *[pa.array(c, t) for c, t in zip(rest, types)]], names=schema.names)

        first = next(batches, None)
        if first is None:
            return
        kind = first.column(0).type
        for conv, rows in _runs(_chained(first, batches)):
            own, kinds, illegal = bytearray(), [0] * 4, 0
            low = high = None
            distinct = 0
            for turn, code, fault in rows:
                if code == NONE:
                    continue
                if turn is not None:
                    distinct += turn != high
                    low, high = turn if low is None else low, turn
                illegal += bool(own) and (own[-1] & 3, code & 3) not in legal
                kinds[fault] += 1
                own.append(code)
            cost, audit = repair(bytes(own))
            gaps = 0 if low is None else high - low + 1 - distinct
            held.append((conv, gaps, *kinds[:3], illegal, cost, audit))
            if len(held) >= 1000:
                yield batch()
                held = []
        if held:
            yield batch()

    ordered = codes.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "digest", "again")
    return ordered.select("conv", "turn", "code", "kind").mapInArrow(run, schema)


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from its turns in order."""
    length = len(audit) - audit.count("D")
    place = 0
    for edit in audit:
        target = ROLES["ua"[(place - length % 2) % 2]]
        role, text = (target, "") if edit == "I" else next(rows)
        if edit != "D":
            yield (target if edit == "R" else role), text
            place += 1


def repair_conversations(df: DataFrame, conv: str, turn: str, role: str, text: str, damage=damaged) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``df``.

    ``damage`` makes the rows to repair, (conv, turn, role, text, digest, there). A conversation's rows are taken by turn,
    nulls first, rows of one turn by a hash of role and text. Null roles and texts are one space, rows of a null id are one
    conversation, and one without rows left has zeros, an empty audit and the hash of nothing. Rows that repeat are
    duplicates, an empty frame gives no conversation, other columns are not carried on. Very long texts pass through one
    by one; of a conversation of many turns a task holds a byte a turn and the band. ``turn`` is an integer.
    """
    bounded_batches(df.sparkSession)
    rows = damage(df, conv, turn, role, text)
    conv_type = df.schema[conv].dataType
    found = keep(audits(turn_codes(rows), conv_type))
    texts = rows.where("there").select("conv", F.lit(1).alias("part"), "turn", "digest", "role", "text")
    heads = found.select("conv", F.lit(0).alias("part"), F.lit(None).cast(df.schema[turn].dataType).alias("turn"),
                         F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), "audit", *COUNTS)
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv").sortWithinPartitions(
        "conv", "part", F.asc_nulls_first("turn"), "digest")
    names = [*COUNTS, "audit", "repaired_sha256"]
    schema = T.StructType([T.StructField("conv", conv_type), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def batch() -> pa.RecordBatch:
            convs, *rest = zip(*held)
            types = [pa.int64()] * len(COUNTS) + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), *[pa.array(c, t) for c, t in zip(rest, types)]], names=schema.names)

        first = next(batches, None)
        if first is None:
            return
        kind = first.column(0).type
        for name, own in _runs(_chained(first, batches)):
            _, _, audit, *counts = next(own)
            digest, joint = hashlib.sha256(), b""
            for role_, text_ in repaired_rows(audit, (r[:2] for r in own)):
                digest.update(joint + f"{role_}:{text_}".encode())
                joint = b"\n"
            for _ in own:  # to the end of the run
                pass
            held.append((name, *counts, audit, digest.hexdigest()))
            if len(held) >= 1000:
                yield batch()
                held = []
        if held:
            yield batch()

    done = both.select("conv", "role", "text", "audit", *COUNTS).mapInArrow(run, schema)
    return done.select(F.col("conv").alias(conv), *[F.col(c).alias(c if c.lower() != conv.lower() else c + "_") for c in names])
