"""Conversation structure repair: cheapest edits that give well-formed turns.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``.  A row may be kept (0), given the role user or assistant (1)
or deleted (2, a must for blank and duplicate rows); a truncated row that
stays costs 5 more; an empty turn may be inserted anywhere (5).  Each row is
one of nine symbols (its role's initial and its fault).  Equal consecutive
symbols are a run; a run of n rows advances the costs of the four states (at
the start, after system, user, assistant) by a min-plus product with the n-th
power of the symbol's transition, put together from cached binary powers.

Conversations of any length are spread: rows are range-partitioned by
conversation and turn, each task cuts its rows into segments of at most
``SEGMENT_ROWS`` and sums a segment up as one transition; costs to go are
taken back over the segments' transitions, exits forward over their end
states, and then all segments unroll their rows' edits on their own.

Defined results: a row is blank if its text has nothing but white space,
duplicate if an earlier row of the conversation has its role and text,
truncated if its last character that is no white space is none of ``.!?``; the
first of these counts.  Rows are ordered by turn (nulls first), then role, then
md5 of the text; repeated rows follow each other.  Null roles and texts are one
space; a null conversation is one of its own.  Of equally cheap edits those
with the least initials (Delete, Insert, Keep, Rerole) are taken.  An empty
table gives empty tables; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work

SPACE = " \t\n\x0b\f\r"
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
SEGMENT_ROWS = 50_000
#: Symbols: initial (s, u, a, other), four more if truncated, or one for rows that must go.
LETTERS, TRUNCATED, MUST_GO = "sua", 4, 8
#: States: at the start, after system, after user, after assistant.
STATES, START, ENDS = range(4), 0, (0, 3)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE = {"u": "user", "a": "assistant"}
NEVER = 1 << 60
Vector = tuple[int, ...]


def unit(state: int) -> Vector:
    return tuple(0 if q == state else NEVER for q in STATES)


def filled(state: int) -> tuple[str, int]:
    """Initial and next state of the only turn that may be inserted after a state."""
    return next((c, q) for c, q in NEXT[state].items() if c != "s")


def inserted(rest: Vector) -> Vector:
    """Costs with turns inserted first where that is cheaper."""
    now = list(rest)
    for _ in STATES:
        now = [min(now[q], INSERT + now[filled(q)[1]]) for q in STATES]
    return tuple(min(v, NEVER) for v in now)


def moves(symbol: int, state: int) -> list[tuple[str, int, int, str]]:
    """(edit, cost, next state, new role) that a row allows, without insertions; the role is empty if it stays."""
    out = [("D", DELETE, state, "")]
    if symbol == MUST_GO:
        return out
    letter = LETTERS[symbol % 4:symbol % 4 + 1]
    more = CUT_OFF if symbol >= TRUNCATED else 0
    if letter in NEXT[state]:
        out.append(("K", more, NEXT[state][letter], ""))
    c, q = filled(state)
    return [*out, ("R", more + RENAME, q, ROLE[c])]


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> tuple[Vector, ...]:
    """Transition of 2 ** bit rows: [state before][state after]."""
    if not bit:
        columns = [inserted(tuple(min(cost + unit(to)[q] for _, cost, q, _ in moves(symbol, s)) for s in STATES))
                   for to in STATES]
        return tuple(zip(*columns))
    half = power(symbol, bit - 1)
    return tuple(tuple(min(NEVER, *(half[s][m] + half[m][to] for m in STATES)) for to in STATES) for s in STATES)


@lru_cache(maxsize=1 << 16)
def _back(symbol: int, bit: int, rest: Vector) -> tuple[Vector, int]:
    now = [min(NEVER, *(row[q] + rest[q] for q in STATES)) for row in power(symbol, bit)]
    least = min(now)
    return tuple(NEVER if v >= NEVER else v - least for v in now), least


def back(symbol: int, count: int, rest: Vector) -> tuple[Vector, int]:
    """Costs to go before ``count`` equal rows, less their least, and that least; ``rest`` has the least 0."""
    least, bit = 0, 0
    while count:
        if count & 1:
            rest, more = _back(symbol, bit, rest)
            least += more
        count >>= 1
        bit += 1
    return rest, least


def transition(runs: list[tuple[int, int]]) -> list[int]:
    """Transition of a segment, 16 costs by state before, then state after."""
    columns = []
    for to in STATES:
        rest, least = unit(to), 0
        for symbol, count in reversed(runs):
            rest, more = back(symbol, count, rest)
            least += more
        columns.append([NEVER if v >= NEVER else v + least for v in rest])
    return [columns[to][s] for s in STATES for to in STATES]


def at_end() -> Vector:
    return tuple(0 if q in ENDS else NEVER for q in STATES)


@lru_cache(maxsize=1 << 16)
def choice(symbol: int, rest: Vector, state: int) -> tuple[str, str, str, int]:
    """(initials of turns inserted before, edit, new role, state after): the cheapest with the least initials."""
    now, least = back(symbol, 1, rest)
    before = ""
    while True:
        for edit, cost, q, role in moves(symbol, state):
            if edit != "D" and INSERT + now[filled(state)[1]] == now[state]:
                break
            if cost + rest[q] - least == now[state]:
                return before, edit, role, q
        c, state = filled(state)
        before += c


def unroll(runs: list[tuple[int, int]], rest: Vector, state: int) -> tuple[list[tuple[str, str, str]], int]:
    """(inserted before, edit, new role) of each row of the runs, and the state after; ``rest`` are costs to go."""
    after = []
    for symbol, count in reversed(runs):
        after.append(rest)
        rest, _ = back(symbol, count, rest)
    out = []
    for (symbol, count), rest in zip(runs, reversed(after)):
        steps = [rest]
        for _ in range(count - 1):
            steps.append(back(symbol, 1, steps[-1])[0])
        for rest in reversed(steps):
            *edit, state = choice(symbol, rest, state)
            out.append(tuple(edit))
    return out, state


def trailing(state: int) -> str:
    """Initials of the turns inserted after the last row."""
    out = ""
    while state not in ENDS:
        c, state = filled(state)
        out += c
    return out


def legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def normal(costs: list[int]) -> Vector:
    least = min(costs)
    return tuple(NEVER if v >= NEVER else v - least for v in costs)


def marked(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with id, letter, blank, truncated and digest, written once."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").alias("turn"),
                     F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    initial, last = F.substring("role", 1, 1), F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    letter = F.lit(len(LETTERS))
    for i, c in enumerate(LETTERS):
        letter = F.when(initial == c, i).otherwise(letter)
    return work.save(rows.select(
        "*", F.monotonically_increasing_id().alias("id"), letter.alias("letter"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"), F.md5("text").alias("digest")), "turns")[0]


def faults(rows: DataFrame) -> DataFrame:
    """(key, turn, role, digest, id, letter, fault) of marked rows; fault is blank, duplicate, truncated or null.

    The first row of each role and text is found by its id, so that no key of the join repeats.
    """
    held = rows.select("key", "turn", "role", "digest", "id", "letter", "blank", "truncated")
    firsts = held.filter(~F.col("blank")).groupBy("key", "role", "digest").agg(
        F.min(F.struct("turn", "id"))["id"].alias("id")).select("id", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    found = held.join(firsts, "id", "left").select("key", "turn", "role", "digest", "id", "letter", fault.alias("fault"))
    return work.save(found, "turn-faults")[0]


def segments(found: DataFrame) -> DataFrame:
    """(key, part, seg, symbols, counts, ids, matrix, first, last, illegal): runs of rows in order, cut into segments."""
    names = ["key", "part", "seg", "symbols", "counts", "ids", "matrix", "first", "last", "illegal"]
    kind = found.schema["key"].dataType.simpleString()
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).otherwise(
        F.col("letter") + F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0))
    order = [F.col(c).asc_nulls_first() for c in ("key", "turn", "role", "digest", "id")]

    def run(batches):
        part, seg, now, none = TaskContext.get().partitionId(), 0, [], object()
        key, kind_of = none, None

        def row():
            ids, letters, symbols = zip(*now)
            runs: list[list[int]] = []
            for s in symbols:
                if runs and runs[-1][0] == s:
                    runs[-1][1] += 1
                else:
                    runs.append([s, 1])
            bad = sum(not legal(a, b) for a, b in zip(letters, letters[1:]))
            return (key, part, seg, *map(list, zip(*runs)), list(ids), transition(runs), letters[0], letters[-1], bad)

        def batch(rows):
            cols = list(zip(*rows)) or [()] * len(names)
            long, many = pa.int64(), pa.list_(pa.int64())
            kinds = (kind_of, long, long, many, many, many, many, long, long, long)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            kind_of, out = b.schema.field(0).type, []
            for k, *what in zip(*(b.column(i).to_pylist() for i in range(4))):
                if now and (k != key or len(now) == SEGMENT_ROWS):
                    out.append(row())
                    now, seg = [], seg + 1
                key = k
                now.append(what)
            yield batch(out)
        if now:
            yield batch([row()])

    rows = found.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "key", "id", F.col("letter").cast("long"), symbol.cast("long").alias("symbol"))
    return work.save(rows.mapInArrow(
        run, f"key {kind}, part bigint, seg bigint, symbols array<bigint>, counts array<bigint>, ids array<bigint>, "
             "matrix array<bigint>, first bigint, last bigint, illegal bigint"), "turn-segments")[0]


def backward(cut: DataFrame) -> DataFrame:
    """(key, part, seg, rest, starts, ends, cost, illegal) of each segment.

    ``rest`` are the costs to go after it; ``starts`` and ``ends`` tell whether
    it is the conversation's first and last, ``cost`` and ``illegal`` sum up
    the conversation from it on.  Segments stream in descending order.
    """
    names = ["key", "part", "seg", "rest", "starts", "ends", "cost", "illegal"]
    kind = cut.schema["key"].dataType.simpleString()

    def run(batches):
        pending, rest, letter, bad, kind_of = None, None, None, 0, None

        def batch(rows):
            cols = list(zip(*rows)) or [()] * len(names)
            long, flag = pa.int64(), pa.bool_()
            kinds = (kind_of, long, long, pa.list_(long), flag, flag, long, long)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            kind_of, out = b.schema.field(0).type, []
            for key, part, seg, matrix, first, last, illegal in zip(*(b.column(i).to_pylist() for i in range(7))):
                ends = pending is None or pending[0] != key
                if pending:
                    out.append((*pending[:4], ends, *pending[5:]))
                if ends:
                    rest, bad = inserted(at_end()), 0
                else:
                    bad += not legal(last, letter)
                after = rest
                rest = tuple(min(NEVER, *(matrix[4 * s + q] + after[q] for q in STATES)) for s in STATES)
                letter, bad = first, bad + illegal
                pending = (key, part, seg, list(after), True, ends, rest[START], bad)
            yield batch(out)
        if pending:
            yield batch([pending])

    rows = cut.select("key", "part", "seg", "matrix", "first", "last", "illegal").repartition("key") \
        .sortWithinPartitions(F.col("key"), F.col("part").desc(), F.col("seg").desc())
    return work.save(rows.mapInArrow(
        run, f"key {kind}, part bigint, seg bigint, rest array<bigint>, starts boolean, ends boolean, cost bigint, "
             "illegal bigint"), "turn-costs")[0]


def forward(cut: DataFrame, costs: DataFrame) -> DataFrame:
    """(part, seg, entry): the state before each segment of the conversations that have several."""
    several = costs.filter(~(F.col("starts") & F.col("ends"))).select("part", "seg", "rest")

    def exits(batches):
        for b in batches:
            out = []
            for symbols, counts, rest in zip(*(b.column(i).to_pylist() for i in range(3, 6))):
                runs = list(zip(symbols, counts))
                out.append([unroll(runs, normal(rest), s)[1] for s in STATES])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.list_(pa.int64()))],
                                             ["key", "part", "seg", "exits"])

    def entries(batches):
        none = object()
        key, state = none, START
        for b in batches:
            out = []
            for k, exit_of in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                state = state if k == key else START
                out.append(state)
                key, state = k, exit_of[state]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.int64())],
                                             ["part", "seg", "entry"])

    kind = cut.schema["key"].dataType.simpleString()
    found = cut.join(several, ["part", "seg"]).select("key", "part", "seg", "symbols", "counts", "rest") \
        .mapInArrow(exits, f"key {kind}, part bigint, seg bigint, exits array<bigint>")
    return found.repartition("key").sortWithinPartitions("key", "part", "seg").mapInArrow(
        entries, "part bigint, seg bigint, entry bigint")


def edits(cut: DataFrame, costs: DataFrame) -> DataFrame:
    """(key, part, seg, at, id, before, edit, new_role, audit): one row per row, and one per end with turns inserted.

    ``before`` are the initials of turns inserted before the row; at an end id,
    edit and new_role are null.  A segment's first row has the segment's audit.
    """
    names = ["key", "part", "seg", "at", "id", "before", "edit", "new_role", "audit"]
    kind = cut.schema["key"].dataType.simpleString()

    def run(batches):
        for b in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            out = []
            for key, part, seg, symbols, counts, ids, rest, ends, entry in zip(*(c.to_pylist() for c in b.columns)):
                found, state = unroll(list(zip(symbols, counts)), normal(rest), entry)
                more = trailing(state) if ends else ""
                audit = "".join("I" * len(before) + edit for before, edit, _ in found) + "I" * len(more)
                out += [(key, part, seg, at, i, *edit, None if at else audit)
                        for at, (i, edit) in enumerate(zip(ids, found))]
                if more:
                    out.append((key, part, seg, len(ids), None, more, None, None, None))
            cols = list(zip(*out)) or [()] * len(names)
            long, text = pa.int64(), pa.string()
            kinds = (b.schema.field(0).type, long, long, long, long, text, text, text, text)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    rows = cut.join(costs.select("part", "seg", "rest", "ends"), ["part", "seg"]) \
        .join(forward(cut, costs), ["part", "seg"], "left") \
        .select("key", "part", "seg", "symbols", "counts", "ids", "rest", "ends", F.coalesce("entry", F.lit(START)))
    return work.save(rows.mapInArrow(
        run, f"key {kind}, part bigint, seg bigint, at bigint, id bigint, before string, edit string, new_role string, "
             "audit string"), "turn-edits")[0]


@dataclass(frozen=True)
class Repair:
    """What ``repair`` found; gaps stop at the greatest long.

    ``report``: key, gaps, blank, duplicate, truncated, illegal, cost per
    conversation with rows.  ``audits``: key, pos, audit (initials of the edits
    of up to ``SEGMENT_ROWS`` rows).  ``turns``: key, pos, role, text of the
    repaired conversations.  ``pos`` orders both within a conversation.
    """

    report: DataFrame
    audits: DataFrame
    turns: DataFrame


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    rows = marked(df, key, turn, role, text)
    found = faults(rows)
    cut = segments(found)
    costs = backward(cut)
    done = edits(cut, costs)
    wide = F.col("turn").cast("decimal(20,0)")
    gaps = F.coalesce(F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn"), F.lit(0)).cast("decimal(38,0)")
    gaps = F.least(gaps, F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    report = found.groupBy("key").agg(gaps.alias("gaps"), *[
        F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    total = costs.filter("starts").select(F.col("key").alias("of"), "illegal", "cost")
    report = report.join(total, F.col("key").eqNullSafe(F.col("of"))).drop("of")
    audits = done.filter("audit IS NOT NULL").select("key", F.struct("part", "seg").alias("pos"), "audit")
    new = F.transform(F.filter(F.split("before", ""), lambda c: c != ""), lambda c: F.struct(
        F.when(c == "u", ROLE["u"]).otherwise(ROLE["a"]).alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("edit").isin("K", "R"), F.array(F.struct(
        F.when(F.col("edit") == "R", F.col("new_role")).otherwise(F.col("role")).alias("role"), F.col("text")))) \
        .otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    turns = done.filter("edit IS NULL OR edit != 'D' OR before != ''") \
        .join(rows.select("id", "role", "text"), "id", "left") \
        .select("key", "part", "seg", "at", F.posexplode(F.concat(new, own)).alias("nth", "turn")) \
        .select("key", F.struct("part", "seg", "at", "nth").alias("pos"), "turn.role", "turn.text")
    return Repair(report, audits, turns)


def digests(turns: DataFrame) -> DataFrame:
    """(key, sha): sha256 of each conversation's ``role:text``, joined by newlines.

    Rows are dealt by key, sorted and streamed; the state is one running digest.
    """
    kind = turns.schema["key"].dataType.simpleString()

    def run(batches):
        none = object()
        key, sha, kind_of = none, None, None

        def batch(rows):
            cols = list(zip(*rows)) or [()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind_of, pa.string()))], ["key", "sha"])

        for b in batches:
            kind_of, out = b.schema.field(0).type, []
            for k, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if k != key or key is none:
                    if key is not none:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield batch(out)
        if key is not none:
            yield batch([(key, sha.hexdigest())])

    rows = turns.repartition("key").sortWithinPartitions("key", "pos").select("key", "role", "text")
    return rows.mapInArrow(run, f"key {kind}, sha string")
