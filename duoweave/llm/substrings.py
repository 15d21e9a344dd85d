"""Substring dedup: a count-min prefilter, then exact groups of what may repeat.

A window is ``WINDOW`` consecutive words of one text.  Each window has an
anchor, the least-hashed of its 8-word grams, so equal windows have equal
anchors at equal places and the number of an anchor's places bounds its
windows' counts from above; consecutive windows share an anchor, so there are
about seven times fewer anchors than windows.

1. Each scan task sketches its anchors: counters by shard and cell, saturating
   at two.  A counter that the task alone raised to two travels without its
   places, which are candidates already; a counter of one carries its place.
2. Per shard the tasks' sketches are added up to a count-min sketch of two
   rows; places whose estimate is two or more are candidates.  The estimate
   never falls below the count, so no repeated window is lost.
3. Texts with candidates are read again.  Candidate windows are grouped by the
   128-bit hash of their words: within a task first, so that each task sends
   the earliest place of a window only and knows its later ones removed, then
   over all tasks.  A window that starts earlier elsewhere is removed, and the
   words that removed windows cover with it.

Places are kept by text: equal texts (by two 64-bit hashes) count once, and all
but the first of them lose every window without further work.

A passage in a third of all documents is thus at most one row per task in
every shuffle, and counters of a shard grow with the tasks, not with copies.

Defined results: a null text has no words; texts shorter than a window lose
nothing; a null key sorts before all others; rows that repeat key and text are
one document, as are rows that share a key (the same key and start is not
earlier); an empty table gives an empty table; other columns are not carried
by ``removed`` and are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work

WINDOW, GRAM = 20, 8
#: Anchors that a task sketches at once, and windows that it groups at once.
SKETCH_ANCHORS, GROUP_WINDOWS = 1_000_000, 500_000
#: Bytes of text whose anchors one shard counts.
SHARD_BYTES = 32 << 20
#: Bytes of text that are hashed at once.
SLICE_BYTES = 1 << 20
NO_KEY = -(1 << 63)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20)
BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
ODD = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1, 1 << 63, 8, dtype=np.uint64)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD[0]
    h = (h ^ (h >> np.uint64(29))) * ODD[1]
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Anchors of texts, hashed many texts at a time."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, anchor hash, first window start, number of windows) of every anchor."""
        none = np.zeros(0, np.int64)
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, np.uint8)
        if len(buf) > len(self.up):
            self.up, self.down = _powers(STEP, len(buf) + 1), _powers(STEP_INVERSE, len(buf) + 1)
        gap = SPACE[buf]
        edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
        start, end = edge[0::2], edge[1::2]
        n = len(start)
        if n < WINDOW:
            return none, none.astype(np.uint64), none, none
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[buf] * self.up[:len(buf)], dtype=np.uint64)])
        word = _mix((total[end] - total[start]) * self.down[start])
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        owner = np.searchsorted(first, start, "right") - 1
        gram, width = word, 1
        while width < GRAM:
            gram = gram[:-width] * ODD[2 + width.bit_length()] + gram[width:]
            width *= 2
        gram = _mix(gram)
        # The leftmost least gram of each window, by doubling.
        at, span, grams = np.arange(len(gram)), 1, WINDOW - GRAM + 1
        while span < grams:
            step = min(span, grams - span)
            a, b = at[:-step], at[step:]
            at = np.where(gram[a] <= gram[b], a, b)
            span += step
        ok = owner[:len(at)] == owner[WINDOW - 1:WINDOW - 1 + len(at)]
        win = np.flatnonzero(ok)
        if not len(win):
            return none, none.astype(np.uint64), none, none
        p, own = at[win], owner[win]
        new = np.ones(len(win), bool)
        new[1:] = (p[1:] != p[:-1]) | (own[1:] != own[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(win)))
        text = own[head]
        words_before = np.searchsorted(start, first[:-1])
        return text, gram[p[head]], win[head] - words_before[text], count


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(blobs, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(zstandard.decompress(x), dtype) for x in blobs]])


def _sketches(docs: DataFrame, shards: int) -> DataFrame:
    """Rows of partition sketches (shard >= 0) and of places known to repeat (shard -1: v1, ranges).

    A place is a text's hash and the starts of the windows that share the anchor.
    """
    names = ["shard", "once", "more", "texts", "starts", "counts", "v1", "ranges"]
    kinds = [pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.list_(pa.int64())]

    def run(batches):
        anchors = Anchors()
        held: list[tuple] = []
        size = 0

        def sketch() -> Iterator[pa.RecordBatch]:
            text, cell, start, count = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((start, text, cell))
            c, t, s = cell[order], text[order], start[order]
            again = np.zeros(len(c), bool)
            again[1:] = (c[1:] == c[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])
            order = order[~again]
            c = cell[order]
            new = np.ones(len(c), bool)
            new[1:] = c[1:] != c[:-1]
            head = np.flatnonzero(new)
            times = np.diff(np.append(head, len(c)))
            once, more = np.sort(order[head[times == 1]]), order[head[times > 1]]
            shard = (cell % np.uint64(shards)).astype(np.int64)
            low = ((cell // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            by_1, by_2 = (x[np.argsort(shard[x], kind="stable")] for x in (once, more))
            cut_1, cut_2 = (np.searchsorted(shard[x], np.arange(shards + 1)) for x in (by_1, by_2))
            rows: list[tuple] = []
            for n in range(shards):
                i, j = by_1[cut_1[n]:cut_1[n + 1]], by_2[cut_2[n]:cut_2[n + 1]]
                if len(i) or len(j):
                    rows.append((n, _pack(low[i]), _pack(low[j]), _pack(text[i]), _pack(start[i].astype(np.int32)),
                                 _pack(count[i].astype(np.uint8)), None, None))
            at = order[np.repeat(times > 1, times)]
            at = at[np.lexsort((start[at], text[at]))]
            rows += [(-1, *[None] * 5, int(text[at[x]]), start[at[x:y]] * 32 + count[at[x:y]])
                     for x, y in runs(text[at])]
            for x in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[x:x + 2000]), kinds)], names)

        for b in batches:
            hashes = b.column(0).to_numpy(zero_copy_only=False)
            at = 0
            while at < b.num_rows:
                texts, held_bytes, first = [], 0, at
                while at < b.num_rows and held_bytes < SLICE_BYTES:
                    texts.append((b.column(1)[at].as_py() or "").encode("utf-8", "surrogatepass"))
                    held_bytes += len(texts[-1])
                    at += 1
                owner, cell, start, count = anchors(texts)
                held.append((hashes[first + owner], cell, start, count))
                size += len(cell)
                if size >= SKETCH_ANCHORS:
                    yield from sketch()
                    held, size = [], 0
        if size:
            yield from sketch()

    return docs.select("v1", "text").mapInArrow(
        run, "shard int, once binary, more binary, texts binary, starts binary, counts binary, v1 bigint, "
             "ranges array<bigint>")


def runs(x: np.ndarray, *more: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal values (in all of the arrays)."""
    if len(x):
        new = np.ones(len(x), bool)
        new[1:] = x[1:] != x[:-1]
        for y in more:
            new[1:] |= y[1:] != y[:-1]
        head = np.flatnonzero(new)
        yield from zip(head.tolist(), [*head[1:].tolist(), len(x)])


def estimates(cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Count-min estimates: each entry's least counter over two rows of counters."""
    width = 1 << max(10, (2 * len(cells)).bit_length())
    rows = [cells & np.uint32(width - 1), (cells * np.uint32(0x9E3779B1)) >> np.uint32(max(0, 33 - width.bit_length()))]
    return np.minimum(*[np.bincount(r, weights, width)[r] for r in rows])


def _repeated(table: pa.Table) -> pa.Table:
    """Places whose estimate is at least two, of one shard."""
    col = lambda name, dtype: _unpack(table.column(name).to_pylist(), dtype)
    cell, more, text, start = (col("once", np.uint32), col("more", np.uint32), col("texts", np.int64),
                               col("starts", np.int32))
    # The same place of an equal text counts once.
    order = np.lexsort((start, text, cell))
    c, t, s = cell[order], text[order], start[order]
    again = np.zeros(len(c), bool)
    again[1:] = (c[1:] == c[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])
    at = order[~again]
    estimate = estimates(np.concatenate([cell[at], more]), np.append(np.ones(len(at)), np.full(len(more), 2.0)))
    at = at[estimate[:len(at)] >= 2]
    return pa.table({"v1": text[at], "range": start[at].astype(np.int64) * 32 + col("counts", np.uint8)[at]})


def _packed(docs: DataFrame) -> DataFrame:
    """(key, v1, v2, body): texts compressed for the way."""
    def run(batches):
        for b in batches:
            body = [zstandard.compress((t.as_py() or "").encode("utf-8", "surrogatepass"), 3) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(body, pa.binary())], ["key", "v1", "v2", "body"])

    return docs.select("key", "v1", "v2", "text").mapInArrow(run, "key bigint, v1 bigint, v2 bigint, body binary")


def _windows(docs: DataFrame, shards: int) -> DataFrame:
    """Candidate windows grouped within the task.

    kind 0: a text that is done (n_words, n_removed, sha); 1: the earliest
    places in this task of a shard's windows; 2: places of later ones of a
    text; 3: a text with candidates.
    """
    schema = ("kind int, key bigint, v1 bigint, v2 bigint, n_words bigint, n_removed bigint, sha string, body binary, "
              "starts array<int>, shard int, digests binary, keys binary, firsts binary, seconds binary, places binary")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.list_(pa.int32()), pa.int32(),
             *[pa.binary()] * 5]

    def run(batches):
        held: list[tuple[int, int, int, np.ndarray, bytes]] = []
        size = 0

        def rows_of(rows):
            for x in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[x:x + 1000]), kinds)], names)

        def grouped() -> Iterator[pa.RecordBatch]:
            n = [len(h[3]) for h in held]
            key, v1, v2 = (np.repeat(np.array([h[i] for h in held], np.int64), n) for i in range(3))
            start = np.concatenate([h[3] for h in held])
            digest = np.frombuffer(b"".join(h[4] for h in held), "<u8").reshape(-1, 2)
            first = earliest(digest, key, start)
            later = np.flatnonzero(~first)
            later = later[np.lexsort((start[later], v2[later], v1[later], key[later]))]
            rows = [(2, int(key[later[x]]), int(v1[later[x]]), int(v2[later[x]]), *[None] * 4, start[later[x:y]],
                     *[None] * 6) for x, y in runs(key[later], v1[later], v2[later])]
            own = np.flatnonzero(first)
            shard = (digest[own, 0] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            for x, y in runs(shard[order]):
                i = own[order[x:y]]
                rows.append((1, *[None] * 8, int(shard[order[x]]), digest[i].tobytes(), _pack(key[i]), _pack(v1[i]),
                             _pack(v2[i]), _pack(start[i])))
            yield from rows_of(rows)

        for b in batches:
            rows = []
            for key, v1, v2, body, ranges, first in zip(*(b.column(i) for i in range(6))):
                key, v1, v2, body, first = key.as_py(), v1.as_py(), v2.as_py(), body.as_py(), first.as_py()
                words = zstandard.decompress(body).split()
                if first is not None and first < key and len(words) >= WINDOW:
                    rows.append((0, key, v1, v2, len(words), len(words), hashlib.sha256(b"").hexdigest(), *[None] * 8))
                    continue
                joined = b" ".join(words)
                if not ranges.is_valid:
                    rows.append((0, key, v1, v2, len(words), 0, hashlib.sha256(joined).hexdigest(), *[None] * 8))
                    continue
                rows.append((3, key, v1, v2, *[None] * 3, body, *[None] * 7))
                edge = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).tolist()
                places = np.unique(np.array(ranges.as_py(), np.int64))
                begin, count = places // 32, places % 32
                starts = np.unique(np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                                   + np.arange(count.sum()))
                starts = starts[starts <= len(words) - WINDOW]
                held.append((key, v1, v2, starts.astype(np.int32), b"".join(
                    xxhash.xxh3_128_digest(joined[edge[s]:edge[s + WINDOW] - 1]) for s in starts.tolist())))
                size += len(starts)
                if size >= GROUP_WINDOWS:
                    yield from grouped()
                    held, size = [], 0
            yield from rows_of(rows)
        if held:
            yield from grouped()

    return docs.select("key", "v1", "v2", "body", "ranges", "first").mapInArrow(run, schema)


def earliest(digest: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each window's (key, start) is the least of its digest's."""
    order = np.lexsort((start, key, digest[:, 1], digest[:, 0]))
    d, k, s = digest[order], key[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]).any(1)
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    out = np.zeros(len(order), bool)
    out[order] = (k == k[head]) & (s == s[head])
    return out


def _later(table: pa.Table) -> pa.Table:
    """(key, v1, v2, starts) of a shard's windows that start earlier elsewhere."""
    col = lambda name, dtype: _unpack(table.column(name).to_pylist(), dtype)
    digest = np.frombuffer(b"".join(table.column("digests").to_pylist()), "<u8").reshape(-1, 2)
    key, v1, v2, start = (col("keys", np.int64), col("firsts", np.int64), col("seconds", np.int64),
                          col("places", np.int32))
    at = np.flatnonzero(~earliest(digest, key, start))
    at = at[np.lexsort((start[at], v2[at], v1[at], key[at]))]
    parts = list(runs(key[at], v1[at], v2[at]))
    head = at[[x for x, _ in parts]] if parts else at
    return pa.table({"key": key[head], "v1": v1[head], "v2": v2[head],
                     "starts": pa.array([start[at[x:y]] for x, y in parts], pa.list_(pa.int32()))})


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words a window at one of ``starts`` covers."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(steps[:-1]) > 0


def _cut(docs: DataFrame, with_text: bool) -> DataFrame:
    """(key, v1, v2, n_words, n_removed, sha, text) of texts and their removed starts."""
    names = ["key", "v1", "v2", "n_words", "n_removed", "sha", "text"]

    def run(batches):
        for b in batches:
            out = []
            for key, v1, v2, body, lists in zip(*(b.column(i) for i in range(5))):
                words = zstandard.decompress(body.as_py()).split()
                gone = covered(np.unique([s for x in lists.as_py() or [] for s in x]).astype(np.int64), len(words))
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((key.as_py(), v1.as_py(), v2.as_py(), len(words), int(gone.sum()),
                            hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "surrogatepass") if with_text else None))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, [pa.int64()] * 5 + [pa.string()] * 2)], names)

    return docs.mapInArrow(run, "key bigint, v1 bigint, v2 bigint, n_words bigint, n_removed bigint, sha string, "
                                "text string")


def hashes(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that tell texts apart."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def removed(df: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``df``: key, v1, v2, n_words, n_removed, sha (of the kept words), text (if asked for).

    ``key`` is an integer; v1 and v2 are hashes of the text that tell rows with equal keys apart.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    v1, v2 = hashes(F.col(f"`{text}`"))
    docs = df.select(F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(NO_KEY)).alias("key"), v1.alias("v1"),
                     v2.alias("v2"), F.col(f"`{text}`").alias("text"))
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    sketch, sketch_path = work.save(_sketches(docs, shards), "anchors")
    merged = sketch.filter("shard >= 0").select("shard", "once", "more", "texts", "starts", "counts") \
        .groupBy("shard").applyInArrow(_repeated, "v1 bigint, range bigint")
    places = merged.groupBy("v1").agg(F.collect_list("range").alias("ranges")).union(
        sketch.filter("shard < 0").select("v1", "ranges"))
    places = places.groupBy("v1").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    copies = docs.groupBy("v1", "v2").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .groupBy("v1").agg(F.collect_list(F.struct("v2", "first")).alias("copied"))
    known, known_path = work.save(places.join(copies, "v1", "full_outer"), "places")
    work.drop(spark, sketch_path)
    first = F.filter(F.col("copied"), lambda c: c["v2"] == F.col("v2"))
    found, _ = work.save(_windows(_packed(docs).join(known, "v1", "left").select(
        "key", "v1", "v2", "body", "ranges", F.get(first, 0)["first"].alias("first")), shards), "windows")
    work.drop(spark, known_path)
    shared = found.filter("kind = 1").select("shard", "digests", "keys", "firsts", "seconds", "places") \
        .groupBy("shard").applyInArrow(_later, "key bigint, v1 bigint, v2 bigint, starts array<int>")
    later = shared.union(found.filter("kind = 2").select("key", "v1", "v2", "starts")) \
        .groupBy("key", "v1", "v2").agg(F.collect_list("starts").alias("lists"))
    cut = _cut(found.filter("kind = 3").select("key", "v1", "v2", "body")
               .join(later, ["key", "v1", "v2"], "left").select("key", "v1", "v2", "body", "lists"), with_text)
    whole = found.filter("kind = 0").select("key", "v1", "v2", "n_words", "n_removed", "sha",
                                            F.when(F.col("n_removed") > 0, "").alias("text"))
    named = F.when(F.col("key") != NO_KEY, F.col("key")).cast(kind).alias("key")
    return cut.union(whole).select(named, "v1", "v2", "n_words", "n_removed", "sha", "text")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with its repeated passages removed; texts that lose nothing stay as they are."""
    gone = (removed(df, key, text, with_text=True).filter("n_removed > 0").dropDuplicates(["key", "v1", "v2"])
            .select(F.col("key").alias("__key"), F.col("v1").alias("__v1"), F.col("v2").alias("__v2"),
                    F.col("text").alias("__kept")))
    v1, v2 = hashes(F.col(f"`{text}`"))
    on = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (v1 == F.col("__v1")) & (v2 == F.col("__v2"))
    cols = [F.coalesce("__kept", F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    return df.join(gone, on, "left").select(*cols)
