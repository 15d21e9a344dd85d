"""Line dedup by pairwise alignment.

Documents that share a rare line (held by at most ``RARE`` documents) are
paired, each with every earlier holder; a line with more holders first pairs
each of them with its earliest holder.  What frequent lines leave in place is
then tried further, until no pair of documents is left that could delete it:
a pair can delete a run of lines only if both documents hold the run and the
alignment has a start, which is an equal first or last line or a line that is
unique in both (``starts``).  Holders of an undeleted run are paired by run and
start, first with ``PIVOTS`` early holders, then, for runs that are still
there, with the earliest document of every signature (its shared lines in
order, see ``signature``), since documents of one signature delete the same.
The result is that of aligning every document with every earlier one; pairs
grow with the documents and the number of signatures that share a run and a
start.  Documents with equal lines are aligned whole with the earliest of them
and take no further part.
Each pair is aligned by patience diff over line hashes: common ends, then the
longest increasing run of lines that are unique on both sides, then the gaps.
Aligned blocks of at least ``MIN_WORDS`` words are deleted from the later
document.

Only hashes and word counts of lines move; texts are read again once, with
the lines to delete.

Defined results: lines end at ``\\n`` and are compared without white space at
their ends; a null text has no lines; blank lines never pair documents; the
earlier document has the smaller key (null before all), then the smaller hash
of its text; rows that repeat key and text are one document; an empty table
gives an empty table; other columns are kept by ``remove_blocks``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work

RARE, MIN_WORDS = 8, 5
#: Early holders that an undeleted run is tried with before all.
PIVOTS = 8
BLANK = 0
#: Stands for lines that no other document holds, in a document's signature.
GAP = 1
#: Rows that a task holds as Python objects at once.
SLICE_ROWS = 500
NO_KEY = -(1 << 63)
#: Rolling hash of runs; equal hashes only make pairs, so a collision costs an alignment and no more.
HASH_BASE, HASH_MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Signed 64-bit hash (0: blank) and number of words of each line."""
    if not text:
        return [], []
    hashes, words = [], []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        line = line.strip()
        n = len(line.split())
        h = xxhash.xxh3_64_intdigest(line) if n else BLANK
        hashes.append(h - (1 << 64) if h >> 63 else h)
        words.append(n)
    return hashes, words


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (ordered by first) with increasing second."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[at], piles[at] = j, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned line numbers of two documents by patience diff, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {h: n for n, h in enumerate(b[j:j_end], j) if in_b[h] == 1 and h != BLANK}
        anchors = increasing([(n, place[h]) for n, h in enumerate(a[i:i_end], i) if in_a[h] == 1 and h in place])
        if not anchors:
            continue
        out += anchors
        for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)]):
            if p + 1 < r and q + 1 < s:
                todo.append((p + 1, r, q + 1, s))
    return sorted(out)


def blocks(a: list[int], b: list[int], words: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(start, end) lines of ``b`` in aligned blocks with at least ``min_words`` words."""
    out, pairs = [], aligned(a, b)
    at = 0
    while at < len(pairs):
        end = at + 1
        while end < len(pairs) and pairs[end] == (pairs[end - 1][0] + 1, pairs[end - 1][1] + 1):
            end += 1
        j, j_end = pairs[at][1], pairs[end - 1][1] + 1
        if sum(words[j:j_end]) >= min_words:
            out.append((j, j_end))
        at = end
    return out


def runs(lines: list[int], words: list[int], frequent: set[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(hash, start, end) of the shortest runs with ``min_words`` words from and up to each line.

    Any block of so many words holds, for each of its lines, one of these runs
    with that line.  Runs with a line that is neither frequent nor blank are
    left out.
    """
    sums, others, prefix, power = [0], [0], [0], [1]
    for h, w in zip(lines, words):
        sums.append(sums[-1] + w)
        others.append(others[-1] + (h != BLANK and h not in frequent))
        prefix.append((prefix[-1] * HASH_BASE + h) & HASH_MASK)
        power.append(power[-1] * HASH_BASE & HASH_MASK)
    found = set()
    for i in range(len(lines)):
        end = bisect_left(sums, sums[i] + min_words)
        if end <= len(lines):
            found.add((i, end))
        start = bisect_right(sums, sums[i + 1] - min_words) - 1
        if start >= 0:
            found.add((start, i + 1))
    out = []
    for i, end in sorted(found):
        if others[i] == others[end]:
            h = (prefix[end] - prefix[i] * power[end - i]) & HASH_MASK
            out.append((h - (1 << 64) if h >> 63 else h, i, end))
    return out


def starts(lines: list[int], known: set[int]) -> list[int]:
    """Hashes of what an alignment can start from: lines (of ``known``) that are unique, the first and the last line."""
    count = Counter(lines)
    ends = [xxhash.xxh3_64_intdigest(b"%d %d" % x) for x in ((0, lines[0]), (1, lines[-1]))] if lines else []
    return [h for h in lines if count[h] == 1 and h in known] + [h - (1 << 64) if h >> 63 else h for h in ends]


def signature(lines: list[int], known: set[int]) -> bytes:
    """Digest of a document's lines that others hold too, with gaps where there are others.

    Lines that no other document holds align with nothing, and one of them parts
    its neighbours as well as many do.  So documents of equal signature delete
    the same lines from any later document, and the earliest stands for all.
    """
    out = []
    for h in lines:
        h = h if h == BLANK or h in known else GAP
        if h != GAP or not out or out[-1] != GAP:
            out.append(h)
    return xxhash.xxh3_128_digest(np.array(out, "<i8").tobytes())


def _hashed(docs: DataFrame) -> DataFrame:
    """(key, version, hi, lo, lines, words): hashes of the lines and a 128-bit digest of their sequence."""
    names = ["key", "version", "hi", "lo", "lines", "words"]

    def run(batches):
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            lines, words, digest = [], [], []
            for t in b.column(2):
                h, w = line_hashes(t.as_py())
                lines.append(h)
                words.append(w)
                digest.append(xxhash.xxh3_128_digest(np.array(h, "<i8").tobytes()))
            seq = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(seq[:, 0]), pa.array(seq[:, 1]),
                 pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))], names)

    return docs.mapInArrow(run, "key bigint, version bigint, hi bigint, lo bigint, lines array<bigint>, "
                                "words array<int>")


def _shared(first: DataFrame) -> DataFrame:
    """(doc, line, n, early): each document's distinct lines with two holders or more, with their number and the earliest."""
    held = first.select(F.struct("key", "version").alias("doc"), F.explode(F.array_distinct("lines")).alias("line")) \
        .filter(F.col("line") != BLANK)
    lines, _ = work.save(held.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("early"))
                         .filter("n > 1"), "shared-lines")
    return held.join(lines, "line")


def _pairs(shared: DataFrame) -> DataFrame:
    """(early, late) documents, as struct(key, version): all holders of rare lines, and each holder with the earliest."""
    with_first = shared.filter(F.col("doc") > F.col("early")).select("early", F.col("doc").alias("late"))
    rare = shared.filter((F.col("n") > 2) & (F.col("n") <= RARE)).groupBy("line").agg(
        F.sort_array(F.collect_list("doc")).alias("docs"))
    later = rare.select("docs", F.posexplode("docs").alias("at", "late"))
    among = later.select(F.explode(F.slice("docs", 1, F.col("at"))).alias("early"), "late")
    return with_first.union(among).distinct()


def _frequent(first: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, version, runs, from, to, starts, sign) of the documents with runs of frequent lines."""
    marks = shared.groupBy("doc").agg(
        F.collect_list("line").alias("known"),
        F.collect_list(F.when(F.col("n") > RARE, F.col("line"))).alias("frequent")) \
        .filter(F.size("frequent") > 0).select("doc.key", "doc.version", "known", "frequent")
    names = ["key", "version", "runs", "from", "to", "starts", "sign"]

    def run(batches):
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            out = []
            for key, version, lines, words, known, frequent in zip(*(b.column(i).to_pylist() for i in range(6))):
                found = runs(lines, words, set(frequent))
                if found:
                    known = set(known)
                    out.append((key, version, *map(list, zip(*found)), starts(lines, known), signature(lines, known)))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                pa.list_(pa.int64()), pa.binary()))], names)

    return first.join(marks, ["key", "version"]).select("key", "version", "lines", "words", "known", "frequent") \
        .mapInArrow(run, "key bigint, version bigint, runs array<bigint>, from array<int>, to array<int>, "
                         "starts array<bigint>, sign binary")


def _undeleted(held: DataFrame, found: DataFrame) -> DataFrame:
    """(key, version, run): runs of ``held`` that an earlier document holds too and that ``found`` leaves a line of."""
    spans = found.groupBy("key", "version").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    names = ["key", "version", "run"]

    def run(batches):
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            out = []
            for key, version, hashes, at, to, cuts in zip(*(b.column(i).to_pylist() for i in range(6))):
                gone = {n for i in range(0, len(cuts or []), 2) for n in range(cuts[i], cuts[i + 1])}
                left = {h for h, i, end in zip(hashes, at, to) if not gone.issuperset(range(i, end))}
                out += [(key, version, h) for h in left]
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    left = held.join(spans, ["key", "version"], "left").select("key", "version", "runs", "from", "to", "spans") \
        .mapInArrow(run, "key bigint, version bigint, run bigint")
    earliest = held.select(F.struct("key", "version").alias("doc"), F.explode("runs").alias("run")) \
        .groupBy("run").agg(F.min("doc").alias("early"))
    return left.join(earliest, "run").filter(F.struct("key", "version") > F.col("early")).select("key", "version", "run")


def _more_pairs(held: DataFrame, left: DataFrame, pivots: int | None) -> DataFrame:
    """(early, late) documents that hold a run of ``left``, undeleted in the later one, and a start.

    With ``pivots``, early documents are so many of each run and start: the
    earliest ones by a hash of the document.  Without, the earliest document of
    each signature stands for all of that signature.
    """
    doc = F.struct("key", "version")
    meets = F.xxhash64("run", "start").alias("meet")
    begin = held.select("key", "version", F.explode(F.array_distinct("starts")).alias("start"))
    late = left.join(begin, ["key", "version"]).select(meets, doc.alias("late"))
    early = held.select("key", "version", "sign", F.explode(F.array_distinct("runs")).alias("run")) \
        .join(left.select("run").distinct(), "run", "left_semi") \
        .join(begin, ["key", "version"]).select(meets, "sign", doc.alias("early"))
    if pivots:
        part = F.pmod(F.xxhash64("early"), F.lit(pivots))
        early = early.groupBy("meet").agg(*[F.min(F.when(part == i, F.col("early"))).alias(f"p{i}") for i in range(pivots)]) \
            .select("meet", F.explode(F.array(*[f"p{i}" for i in range(pivots)])).alias("early")).filter("early IS NOT NULL")
    else:
        early = early.groupBy("meet", "sign").agg(F.min("early").alias("early"))
    return early.join(late, "meet").filter(F.col("early") < F.col("late")).select("early", "late").distinct()


def _deleted(pairs: DataFrame) -> DataFrame:
    """(key, version, spans) of the later document of each pair (early lines, key, version, lines, words)."""
    names = ["key", "version", "spans"]

    def run(batches):
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            out = []
            for early, key, version, lines, words in zip(*(b.column(i).to_pylist() for i in range(5))):
                spans = [x for s in blocks(early, lines, words) for x in s]
                if spans:
                    out.append((key, version, spans))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.list_(pa.int32())))], names)

    return pairs.mapInArrow(run, "key bigint, version bigint, spans array<int>")


def deletions(docs: DataFrame) -> DataFrame:
    """(key, version, whole, spans): which lines of which documents go; documents that lose nothing are left out."""
    rows, _ = work.save(_hashed(docs).dropDuplicates(["key", "version"]), "line-hashes")
    order = F.struct("key", "version")
    firsts, _ = work.save(rows.groupBy("hi", "lo").agg(F.min(order).alias("doc"), F.count(F.lit(1)).alias("n")),
                          "line-classes")
    named = firsts.select("doc.key", "doc.version")
    first = rows.join(named, ["key", "version"])
    copies = rows.join(firsts.filter("n > 1"), ["hi", "lo"]).filter(order > F.col("doc")) \
        .filter(F.aggregate("words", F.lit(0), lambda n, w: n + w) >= MIN_WORDS) \
        .select("key", "version", F.lit(True).alias("whole"), F.array().cast("array<array<int>>").alias("spans"))
    lines = first.select(F.struct("key", "version").alias("doc"), "lines", "words")

    def by(pairs: DataFrame) -> DataFrame:
        both = pairs.join(lines.select(F.col("doc").alias("early"), F.col("lines").alias("early_lines")), "early") \
            .join(lines.withColumnRenamed("doc", "late"), "late") \
            .select("early_lines", "late.key", "late.version", "lines", "words")
        return work.save(_deleted(both), "line-spans")[0]

    shared = _shared(first)
    found = by(_pairs(shared))
    held, _ = work.save(_frequent(first, shared), "line-runs")
    for pivots in (PIVOTS, None):
        left, _ = work.save(_undeleted(held, found), "line-runs-left")
        if left.isEmpty():
            break
        found = found.union(by(_more_pairs(held, left, pivots)))
    spans = found.groupBy("key", "version").agg(F.collect_list("spans").alias("spans")) \
        .select("key", "version", F.lit(False).alias("whole"), "spans")
    found, _ = work.save(spans.union(copies), "line-deletions")
    return found


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(NO_KEY)).alias("key"),
                     F.xxhash64(F.col(f"`{text}`")).alias("version"), F.col(f"`{text}`").alias("text"))


def cut(text: str | None, whole: bool, spans: list[list[int]]) -> tuple[str, int, int]:
    """(kept text, number of lines, number of deleted lines)."""
    lines = text.split("\n") if text else []
    if whole:
        return "", len(lines), len(lines)
    gone = {n for s in spans for i in range(0, len(s), 2) for n in range(s[i], s[i + 1])}
    return "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), len(gone)


def kept(df: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``df``: key, version, n_lines, n_deleted, sha (of the kept text), text (if asked for)."""
    kind = df.schema[key].dataType.simpleString()
    docs = keyed(df, key, text)
    names = ["key", "version", "n_lines", "n_deleted", "sha", "text"]

    def run(batches):
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            out = []
            for k, v, t, whole, spans in zip(*(b.column(i) for i in range(5))):
                t = t.as_py()
                new, n, gone = cut(t, bool(whole.as_py()), spans.as_py() or [])
                out.append((k.as_py(), v.as_py(), n, gone, hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                            new if with_text and gone else None))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, [pa.int64()] * 4 + [pa.string()] * 2)], names)

    out = docs.join(deletions(docs), ["key", "version"], "left").select("key", "version", "text", "whole", "spans") \
        .mapInArrow(run, "key bigint, version bigint, n_lines bigint, n_deleted bigint, sha string, text string")
    return out.withColumn("key", F.when(F.col("key") != NO_KEY, F.col("key")).cast(kind))


def remove_blocks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the blocks deleted from its texts."""
    cols = df.columns
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"),
                    F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(NO_KEY)).alias("key"),
                    F.xxhash64(F.col(f"`{text}`")).alias("version"))
    found = deletions(keyed(df, key, text))

    @F.pandas_udf("string")
    def kept_text(t, whole, spans):
        import pandas as pd

        return pd.Series([cut(x, bool(w), s)[0] for x, w, s in zip(t, whole, spans)])

    row = row.join(found, ["key", "version"], "left")
    body = F.col("__row")[text]
    new = F.when(F.col("whole").isNull(), body).otherwise(kept_text(body, F.coalesce("whole", F.lit(False)), F.coalesce(
        "spans", F.array().cast("array<array<int>>"))))
    return row.select(*[new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in cols])
