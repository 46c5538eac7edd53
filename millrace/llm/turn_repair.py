"""Conversation repair: turns aligned to the grammar of a conversation, with an audit of the edits.

A sound conversation's role initials read ``(s?(ua)+)?``. That language has one string for each length,
so repairing a conversation means aligning its turns to each feasible length: Wagner-Fischer tables of the
cheapest way from a cell to the end, limited to the diagonals (Ukkonen's band) that the cheapest repair found
so far allows, lengths taken from the number of turns outwards. Every table that reaches the least cost is
traced back, smallest letter first, and the smallest of these audits is the result.

Letters of an audit: K keeps a turn, R gives it the role the grammar asks for, D deletes it, I inserts an empty
turn. Blank turns and repeats of an earlier turn must go; a truncated turn that stays adds to the cost.

From LONG turns on, the tables of all lengths are folded into one: a cell's future depends only on the place in
the grammar (six of them), so a conversation costs six numbers a turn, with the same audit.

Two shuffles by conversation: the plan reads a turn's number, initial, faults and digest, the repair reads the
texts as a stream behind their plan. Texts are never held together; a task holds a digest for each different
turn of one conversation, six numbers a turn, and its audit. The digest of a repaired conversation and its audit
are each one value over all its turns in order, so a conversation isn't split over tasks, however long it is.

Nulls count as one space: a null text is blank and a null role is no role of the grammar; a null turn comes
first, and rows with a null ``conv_id`` are one conversation. Turns with the same number are ordered by their
digest. Repeated rows are duplicates. A row with ``present`` false names its conversation and nothing else. A
conversation without turns gives zeros, an empty audit and the digest of the empty string; an empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import remainder

#: Turns from which the tables of all lengths are folded into one.
LONG = 48
#: Most plans a task remembers; conversations with the same initials and faults have the same plan.
REMEMBERED = 100_000
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 60
NAMES = {"u": "user", "a": "assistant", "s": "system"}
BLANK = " \t\n\x0b\x0c\r"
KINDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# ---------------------------------------------------------------- alignment


def target(length: int) -> str:
    """The grammar's only string of a length other than one."""
    return "s" * (length % 2) + "ua" * (length // 2)


def off_diagonal(d: int) -> int:
    """Least cost of d more deletions than insertions."""
    return DELETE * d if d >= 0 else -INSERT * d


def change(turn: str, wanted: str) -> int:
    """Cost of keeping a turn as ``wanted``; capital letters are truncated turns, x has to go."""
    if turn == "x":
        return NEVER
    extra = TRUNCATED if turn.isupper() else 0
    if turn.lower() == wanted:
        return extra
    return NEVER if wanted == "s" else REROLE + extra


def align(turns: str, wanted: str, limit: int) -> tuple[int, str] | None:
    """Cost and smallest audit of the cheapest edits of ``turns`` into ``wanted``; None if they cost more than ``limit``."""
    n, m = len(turns), len(wanted)
    beyond = limit - off_diagonal(n - m)
    if beyond < 0:
        return None
    slack = beyond // (DELETE + INSERT)
    low, high = min(0, n - m) - slack, max(0, n - m) + slack  # deletions less insertions, at a cell of use
    rows: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = rows[i], rows[i + 1] if i < n else {}
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            best = 0 if i == n and j == m else NEVER
            if i < n:
                best = min(best, below.get(j, NEVER) + DELETE)
                if j < m:
                    best = min(best, below.get(j + 1, NEVER) + change(turns[i], wanted[j]))
            if j < m and wanted[j] != "s":
                best = min(best, row.get(j + 1, NEVER) + INSERT)
            row[j] = best
    if rows[0].get(0, NEVER) > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        cost = rows[i][j]
        if i < n and rows[i + 1].get(j, NEVER) + DELETE == cost:
            audit.append("D")
            i += 1
        elif j < m and wanted[j] != "s" and rows[i].get(j + 1, NEVER) + INSERT == cost:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == wanted[j] else "R")
            i, j = i + 1, j + 1
    return rows[0][0], "".join(audit)


def over_lengths(turns: str) -> tuple[int, str]:
    """The least (cost, audit) over all lengths of the grammar, nearest to the number of turns first."""
    n = len(turns)
    best = DELETE * n, "D" * n  # length 0
    lengths = sorted((k for k in range(2, n + DELETE * n // INSERT + 1)), key=lambda k: (off_diagonal(n - k), k))
    for length in lengths:
        if off_diagonal(n - length) > best[0]:
            break
        found = align(turns, target(length), best[0])
        if found:
            best = min(best, found)
    return best


# Places in the grammar: even and odd without a system turn; before and after a system turn, then odd and even.
EVEN, ODD, SYSTEM, FIRST, USER, PAIR = range(6)
ASKS = "uasuau"
NEXT = (ODD, EVEN, FIRST, USER, PAIR, USER)
ENDS = (EVEN, PAIR)


def folded(turns: str) -> tuple[int, str]:
    """The same as ``over_lengths`` in one table: a row of turns by place in the grammar."""
    n, table = len(turns), array("q")
    below = [0 if q in ENDS else NEVER for q in range(6)]
    for turn in ["", *reversed(turns)]:
        row = below if not turn else [
            min(below[q] + DELETE, below[NEXT[q]] + change(turn, ASKS[q]), NEVER) for q in range(6)
        ]
        for q in (EVEN, ODD, USER, PAIR, FIRST, EVEN, ODD, USER):  # at most two insertions in a row are of use
            row[q] = min(row[q], row[NEXT[q]] + INSERT)
        table.extend(row)
        below = row

    def ahead(i: int, q: int) -> int:
        return table[6 * (n - i) + q]

    cost = min(ahead(0, EVEN), ahead(0, SYSTEM))
    at = [q for q in (EVEN, SYSTEM) if ahead(0, q) == cost]  # places reached by the audit so far
    audit, i = bytearray(), 0
    while i < n or cost:
        steps = []
        for q in at:
            if i < n and ahead(i + 1, q) + DELETE == cost:
                steps.append((b"D", q, cost - DELETE))
            if ASKS[q] != "s" and ahead(i, NEXT[q]) + INSERT == cost:
                steps.append((b"I", NEXT[q], cost - INSERT))
            if i < n and ahead(i + 1, NEXT[q]) + change(turns[i], ASKS[q]) == cost:
                same = turns[i].lower() == ASKS[q]
                steps.append((b"K" if same else b"R", NEXT[q], cost - change(turns[i], ASKS[q])))
        letter = min(steps)[0]
        audit += letter
        at = sorted({q for x, q, _ in steps if x == letter})
        cost = next(c for x, _, c in steps if x == letter)
        i += letter != b"I"
    return min(ahead(0, EVEN), ahead(0, SYSTEM)), audit.decode()


_PLANS: dict[str, tuple[int, str]] = {}


def cheapest(turns: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; of those that cost the same, the smallest audit."""
    if len(turns) >= LONG:
        return folded(turns)
    if turns not in _PLANS:
        if len(_PLANS) >= REMEMBERED:
            _PLANS.clear()
        _PLANS[turns] = over_lengths(turns)
    return _PLANS[turns]


# ---------------------------------------------------------------- tables


def damage(turns: DataFrame) -> DataFrame:
    """The turns with faults told by crc32 of ``conv_id:turn``: dropped, emptied, without sentence ends, repeated, as user.

    Returns conv_id, turn, role, text and ``present``; a dropped turn stays as a row that isn't present.
    """
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    code = remainder(F.concat_ws(":", spaced["conv_id"], spaced["turn"]), 20)
    rows = turns.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), code.alias("_code"))
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("_code") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_code") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present and the digest that orders turns of one number."""
    present = F.coalesce("present", F.lit(True)) if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"),
    )
    return rows.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def _together(rows: DataFrame, *first: Column | str) -> DataFrame:
    """Every conversation in one task, its rows in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "digest")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _judged(rows: Iterable[tuple]) -> tuple:
    """The plan's columns of one conversation's (conv_id, turn, digest, initial, blank, truncated, present)."""
    seen: set[bytes] = set()
    code, faults = [], [0, 0, 0]
    illegal = distinct = 0
    first = last = before = None
    for _, turn, digest, initial, blank, truncated, present in rows:
        if not present:
            continue
        if turn is not None and turn != last:
            distinct += 1
            first, last = turn if first is None else first, turn
        if before is not None and before + initial not in ("su", "ua", "au"):
            illegal += 1
        before = initial
        fault = 0 if blank else 1 if digest in seen else 2 if truncated else None
        seen.add(digest)
        if fault is not None:
            faults[fault] += 1
        letter = initial if initial in ("s", "u", "a") else "o"
        code.append("x" if fault in (0, 1) else letter.upper() if fault == 2 else letter)
    cost, audit = cheapest("".join(code))
    return (last - first + 1 - distinct if distinct else 0, *faults, illegal, cost, audit)


def plan(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: gaps, blank, duplicate, truncated, illegal, cost and audit."""
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANK)), F.lit(1))
    rows = _ordered(turns).select(
        "conv_id", "turn", "digest", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("truncated"), "present",
    )
    kind = rows.schema[0].dataType.simpleString()
    names = ["conv_id", *(k.split()[0] for k in KINDS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        types = [head.schema.field(0).type, *[pa.int64()] * 6, pa.string()]
        made: list[tuple] = []
        size = 0
        for conv, group in groupby(_rows(_after(head, batches)), key=itemgetter(0)):
            made.append((conv, *_judged(group)))
            size += 100 + len(made[-1][-1])
            if size > 1 << 20:
                yield _batch(made, names, types)
                made, size = [], 0
        if made:
            yield _batch(made, names, types)

    return _together(rows).mapInArrow(run, f"conv_id {kind}, {KINDS}")


def _after(head: pa.RecordBatch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield head
    yield from batches


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def edited(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every turn of a repaired conversation, from its audit and its turns in order."""
    given = iter(turns)
    place = SYSTEM if (len(audit) - audit.count("D")) % 2 else EVEN
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(given)
        if letter == "D":
            continue
        yield letter, role if letter == "K" else NAMES[ASKS[place]], text
        place = NEXT[place]


def _planned(turns: DataFrame) -> DataFrame:
    """Every conversation in one task: its plan, then its turns in order."""
    plans = plan(turns)
    fields = [f for f in plans.columns if f != "conv_id"]
    heads = plans.select("conv_id", F.struct(*fields).alias("plan"), F.lit(0).alias("kind"))
    rows = _ordered(turns).where("present").drop("present").withColumn("kind", F.lit(1))
    both = heads.unionByName(rows, allowMissingColumns=True)
    return _together(both, "kind").select("conv_id", "kind", "plan", "role", "text")


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, dict, Iterator[tuple[str, str, str]]]]:
    for conv, group in groupby(_rows(batches), key=itemgetter(0)):
        told = next(group)[2]
        yield conv, told, edited(told["audit"], (row[3:] for row in group))


def repair(turns: DataFrame) -> DataFrame:
    """The plan of every conversation and ``repaired_sha256``, the digest of its repaired ``role:text`` lines."""
    rows = _planned(turns)
    kind = rows.schema[0].dataType.simpleString()
    names = ["conv_id", *rows.schema["plan"].dataType.names, "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(batches, None)
        if head is None:
            return
        types = [head.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
        made: list[tuple] = []
        size = 0
        for conv, told, turns_of in _conversations(_after(head, batches)):
            digest = hashlib.sha256()
            for i, (_, role, text) in enumerate(turns_of):
                digest.update(f"\n{role}:{text}".encode() if i else f"{role}:{text}".encode())
            made.append((conv, *told.values(), digest.hexdigest()))
            size += 200 + len(told["audit"])
            if size > 1 << 20:
                yield _batch(made, names, types)
                made, size = [], 0
        if made:
            yield _batch(made, names, types)

    return rows.mapInArrow(run, f"conv_id {kind}, {KINDS}, repaired_sha256 string")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of all repaired conversations: conv_id, position (from 0), role, text and the edit that gave each."""
    rows = _planned(turns)
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(batches, None)
        if head is None:
            return
        types = [head.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        made: list[tuple] = []
        size = 0
        for conv, _, turns_of in _conversations(_after(head, batches)):
            for i, (edit, role, text) in enumerate(turns_of):
                made.append((conv, i, role, text, edit))
                size += 100 + len(text)
                if size > 4 << 20:
                    yield _batch(made, ["conv_id", "position", "role", "text", "edit"], types)
                    made, size = [], 0
        if made:
            yield _batch(made, ["conv_id", "position", "role", "text", "edit"], types)

    return rows.mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")
