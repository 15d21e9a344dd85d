"""Chat formatting: heterogeneous records to canonical turns to marked text.

A record's schema fingerprint is a hash of its nested field paths
(``messages[].role`` and so on).  The fingerprint selects a declarative
mapping that says where the turns are; records of any registered layout become
rows (id, pos, role, text).  A template then marks each turn and escapes
control strings inside texts, and ``read_back`` recovers turns and loss text
from the formatted pieces alone.

A conversation is never gathered into one row: each turn is one formatted
piece, a conversation's text is its pieces in order, and reading back streams
sorted rows, so a conversation of any length needs the memory of one batch.

Defined results: null role or text is empty; a null id is an id of its own;
turns with equal position are ordered by role, then text; repeated rows are
repeated turns; fields that an item of a list lacks are empty.  A record that
can't be read gives one row with null layout, role and text, and the record
itself in ``record``, so that nothing is lost (``unread`` selects them): its
fingerprint is not registered, it is not JSON, an item is no object, a position
is no 64-bit integer, or a text holds half a surrogate pair.  An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``fields``: (role, path) per turn for records with one field per turn;
    fields named in ``optional`` may be absent.  ``each``: the list of turns,
    with ``role`` and ``text`` inside; for a record that is one turn itself,
    ``each`` is empty and ``pos`` names its position.  ``roles`` renames roles.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    pos: str = ""
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def fingerprints(self) -> Iterator[str]:
        if self.each:
            yield fingerprint({f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"})
            yield fingerprint({f"{self.each}[]"})
        elif self.text:
            yield fingerprint({self.role, self.text, self.pos})
        else:
            fixed = {p for _, p in self.fields} - set(self.optional)
            for n in range(len(self.optional) + 1):
                for some in itertools.combinations(self.optional, n):
                    yield fingerprint(fixed | set(some))


#: Layouts in common use.
MAPPINGS = (
    Mapping("turn rows", role="role", text="text", pos="turn"),
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("from/value", each="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt/response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
            optional=("system",)),
    Mapping("prompt/completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question/answer", fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", fields=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
            optional=("input",)),
)


def paths_of(value, prefix: str = "") -> set[str]:
    """Nested field paths; dots and brackets inside names are escaped."""
    if isinstance(value, dict):
        found = set()
        for k, v in value.items():
            name = re.sub(r"([\\.\[])", r"\\\1", k)
            found |= paths_of(v, f"{prefix}.{name}" if prefix else name)
        return found or {prefix + "{}"}
    if isinstance(value, list):
        found = set()
        for v in value:
            found |= paths_of(v, prefix + "[]")
        return found or {prefix + "[]"}
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"))


def turns_of(record, mapping: Mapping) -> list[tuple[int, str, str]] | None:
    """(position, role, text) of a record by its mapping; None if it can't be read."""
    def text(x) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    if mapping.each:
        items = record[mapping.each]
        if not isinstance(items, list) or not all(isinstance(t, dict) for t in items):
            return None
        rows = [(i, text(t.get(mapping.role)), text(t.get(mapping.text))) for i, t in enumerate(items)]
    elif mapping.text:
        rows = [(record[mapping.pos], text(record[mapping.role]), text(record[mapping.text]))]
        if not (rows[0][0] is None or type(rows[0][0]) is int and -(1 << 63) <= rows[0][0] < 1 << 63):
            return None
    else:
        rows = [(i, role, text(record[p])) for i, (role, p) in enumerate(
            (role, p) for role, p in mapping.fields if p in record)]
    if any("\ud800" <= c <= "\udfff" for _, *both in rows for x in both if not x.isascii() for c in x):
        return None
    return [(i, mapping.roles.get(role, role), t) for i, role, t in rows]


def canonical_turns(df: DataFrame, key: str, record: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """JSON records (one per row) as turn rows: id, pos, role, text, layout, record (of those that can't be read)."""
    registry = {f: m for m in mappings for f in m.fingerprints()}

    def run(batches):
        for b in batches:
            out = []
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    value = json.loads(raw) if raw is not None else None
                    m = registry.get(fingerprint(paths_of(value))) if isinstance(value, dict) else None
                    turns = turns_of(value, m) if m else None
                except (ValueError, RecursionError):
                    turns = None
                out += [(k, 0, None, None, None, raw)] if turns is None else [(k, *t, m.name, None) for t in turns]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (b.schema.field(0).type, pa.int64(), *[pa.string()] * 4))],
                ["id", "pos", "role", "text", "layout", "record"])

    kind = df.schema[key].dataType.simpleString()
    return (df.select(f"`{key}`", f"`{record}`")
            .mapInArrow(run, f"id {kind}, pos bigint, role string, text string, layout string, record string"))


def unread(turns: DataFrame) -> DataFrame:
    """(id, record) of the records that gave no turns."""
    return turns.filter("layout IS NULL").select("id", "record")


#: The template's control strings.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
#: A control string with any number of escapes behind its first character.
ESCAPED = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
PIECE = re.compile(r"<s>(?:\[INST\](?P<role>[^\n]*)\n(?P<text>.*)\[/INST\]|(?P<reply>.*)</s>)", re.S)


def escape(text: str) -> str:
    """No control string is left; one more backslash stands behind its first character."""
    return ESCAPED.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's piece and the span of its loss text in it (empty unless the assistant speaks)."""
    if role == "assistant":
        body = escape(text)
        return f"{BEGIN}{body}{END}", len(BEGIN), len(BEGIN) + len(body)
    return f"{BEGIN}{OPEN}{escape_role(role)}\n{escape(text)}{CLOSE}", 0, 0


def parse(piece: str) -> tuple[str, str]:
    """(role, text) of a piece."""
    m = PIECE.fullmatch(piece)
    if not m:
        raise ValueError("not a piece of this template")
    if m["reply"] is not None:
        return "assistant", unescape(m["reply"])
    return unescape_role(m["role"]), unescape(m["text"])


def format_turns(turns: DataFrame) -> DataFrame:
    """Turn rows (id, pos, role, text) as pieces: id, pos, nth, piece, loss_start, loss_end.

    Narrow.  ``nth`` keeps the order of turns with equal position.
    """
    def run(batches):
        for b in batches:
            out = [render(r or "", t or "") for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            piece, start, end = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.array(piece, pa.string()),
                 pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                ["id", "pos", "role", "text", "piece", "loss_start", "loss_end"])

    kind = turns.schema["id"].dataType.simpleString()
    return turns.select("id", "pos", "role", "text").mapInArrow(
        run, f"id {kind}, pos bigint, role string, text string, piece string, loss_start bigint, loss_end bigint")


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, from its pieces alone: id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Rows are dealt by id and sorted (by id, pos, role, text), then streamed; the
    state is two running digests, whatever the conversation's length.
    """
    kind = pieces.schema["id"].dataType.simpleString()
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        none = object()
        now, n, chars, loss_chars, turns, loss = none, 0, 0, 0, None, None
        key_type = None

        def closed():
            return (now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        def batch(rows):
            cols = list(zip(*rows)) or [()] * 6
            kinds = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            key_type, out = b.schema.field(0).type, []
            for k, piece, start, end in zip(*(b.column(i).to_pylist() for i in range(4))):
                if now is none or k != now:
                    if now is not none:
                        out.append(closed())
                    now, n, chars, loss_chars, turns, loss = k, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, text = parse(piece)
                turns.update(f"{role}\n{text}\n".encode())
                masked = unescape(piece[start:end])
                loss.update(masked.encode())
                n, chars, loss_chars = n + 1, chars + len(piece), loss_chars + len(masked)
            yield batch(out)
        if now is not none:
            yield batch([closed()])

    order = pieces.repartition("id").sortWithinPartitions("id", "pos", "role", "text")
    return order.select("id", "piece", "loss_start", "loss_end").mapInArrow(
        run, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")
