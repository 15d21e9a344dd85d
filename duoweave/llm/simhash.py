"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are computed in the scan's tasks.  Distinct fingerprints are
linked when they differ in at most ``distance`` bits: the 64 bits are grouped
into partitions of correlated bits, thresholds T with sum distance - parts + 1
are allotted to the partitions by dynamic programming on estimated candidate
counts, and two fingerprints within the distance then agree within T bits in
some partition.  A fingerprint is stored under its own bits of each partition
and probes the neighbouring values within T; fingerprints that meet are
verified on all 64 bits.  A value under which many meet is cut into chunks
whose pairs are separate tasks, and a task returns a spanning forest of the
links it finds, never all pairs.  Components of the links are the classes.

Defined results: null or empty text has fingerprint zero; texts shorter than a
shingle are one shingle; null keys never name a class unless all of its rows
have null keys; repeated rows are members like others; an empty table gives an
empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work
from duoweave.llm.components import components

#: The seed that the fingerprints are defined with.
SEED = 42
#: Fingerprints under one partition value beyond which the value is cut into chunks.
CHUNK = 2048
#: Relative cost of comparing a candidate pair and of one more probe row.
PAIR_COST, ROW_COST = 0.01, 1.0


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of word shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        end = list(itertools.accumulate([len(w) + 1 for w in words]))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(itertools.chain([0], end), end[shingle - 1:])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.add.reduce(bits, axis=0, dtype=np.int32) * 2 > len(hashes)
    return int(np.packbits(votes, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp): one row per row of ``df``; fp is the fingerprint as a signed long."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["key", "fp"])

    return df.select(f"`{key}`", f"`{text}`").mapInArrow(run, f"key {kind}, fp bigint")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, over all of them."""
    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
            both += x.T @ x
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64 * 64 + 1)), pa.array(np.append(both.ravel(), n))],
                                         ["cell", "n"])

    rows = nodes.select("fp").mapInArrow(run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(64 * 64 + 1)
    for r in rows:
        both[r["cell"]] = r["n"]
    return int(both[-1]), both[:-1].reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal width, the most correlated together."""
    f = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(f * (1 - f), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(f, f)) / np.outer(sd, sd))
    np.fill_diagonal(corr, -1)
    left, groups = set(range(64)), []
    for p in range(parts):
        width = (64 - sum(map(len, groups))) // (parts - p)
        at = sorted(left)
        sub = corr[np.ix_(at, at)]
        group = sorted({at[i] for i in np.unravel_index(np.argmax(sub), sub.shape)}) if len(at) > 1 else at
        left -= set(group)
        while len(group) < width:
            best = max(sorted(left), key=lambda b: corr[b, group].mean())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def allot(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions with the least estimated cost.

    Pairs within t bits in a partition are estimated from the share of set
    bits; thresholds (-1: not probed) are allotted by dynamic programming.
    """
    f = np.diag(both) / max(n, 1)
    differ = 2 * f * (1 - f)
    best = (math.inf, [])
    for parts in range(min(2, distance + 1), distance + 2):
        groups = group_bits(n, both, parts)
        total = distance - parts + 1
        table = {0: (0.0, [])}  # sum of (threshold + 1) so far -> cost, thresholds
        for g in groups:
            within = np.zeros(distance + 2)
            within[0] = 1.0
            for b in g:
                within[1:] = within[1:] * (1 - differ[b]) + within[:-1] * differ[b]
                within[0] *= 1 - differ[b]
            cost = [0.0]
            for t in range(distance + 1):
                probes = (1 + sum(math.comb(len(g), i) for i in range(t + 1))) / 2
                cost.append(n * probes * ROW_COST + n * n / 2 * within[:t + 1].sum() * PAIR_COST)
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in table.items():
                for t in range(-1, distance + 1):
                    k = used + t + 1
                    if k <= total + parts and (k not in new or c + cost[t + 1] < new[k][0]):
                        new[k] = (c + cost[t + 1], [*ts, t])
            table = new
        c, ts = table[total + parts]
        if c < best[0]:
            best = (c, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def meeting_rows(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, probe, fp): each fingerprint under its own value and under lower values within the threshold."""
    def spots(part: int, bits: list[int], t: int):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        yield F.array(F.struct(F.lit(part).alias("part"), own.alias("value"), F.lit(False).alias("probe")))
        flips = [_signed(sum(1 << b for b in some)) for i in range(1, t + 1) for some in itertools.combinations(bits, i)]
        if flips:
            near = F.filter(F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: own.bitwiseXOR(x)),
                            lambda v: v < own)
            yield F.transform(near, lambda v: F.struct(F.lit(part).alias("part"), v.alias("value"),
                                                       F.lit(True).alias("probe")))

    every = [s for p, (bits, t) in enumerate(plan) for s in spots(p, bits, t)]
    return nodes.select("fp", F.explode(F.concat(*every)).alias("s")).select("s.*", "fp")


def forest(fp: np.ndarray, probe: np.ndarray, lo: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Spanning links among fingerprints that meet; probes meet only members; with chunks, one chunk meets the other.

    ``lo``: True for rows of the first chunk; all True where a chunk meets itself.
    """
    cross = not lo.all()
    left = np.flatnonzero(lo)
    right = np.flatnonzero(~lo) if cross else left
    root = np.arange(len(fp))
    for i in left:
        near = right[np.bitwise_count(fp[right] ^ fp[i]) <= distance]
        if probe[i]:
            near = near[~probe[near]]
        if not cross:
            near = near[near > i] if not probe[i] else near
        if not len(near):
            continue
        roots = np.unique(np.append(root[near], root[i]))
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
    for i in np.flatnonzero(root != np.arange(len(fp))):
        if fp[i] != fp[root[i]]:
            yield int(fp[i]), int(fp[root[i]])


def links(nodes: DataFrame, plan: list[tuple[list[int], int]], distance: int) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``distance``."""
    rows = meeting_rows(nodes, plan)
    many = (rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > CHUNK).select("part", "value", F.ceil(F.col("n") / CHUNK).alias("chunks")))
    rows = rows.join(many, ["part", "value"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
                        lambda j: F.struct(F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi"),
                                           (own <= j).alias("first")))
    alone = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"),
                             F.lit(True).alias("first")))
    rows = rows.select("part", "value", "probe", "fp", F.explode(F.coalesce(pairs, alone)).alias("c")) \
        .select("part", "value", "c.lo", "c.hi", "c.first", "probe", "fp")
    dealt = rows.repartition("part", "value", "lo", "hi").sortWithinPartitions("part", "value", "lo", "hi")

    def run(batches):
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
                held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if held is None or not len(held[0]):
                continue
            new = np.ones(len(held[0]), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in held[:4]])
            first = np.flatnonzero(new)
            done = len(new) if b is None else first[-1]
            ends = np.append(first[1:], len(new))
            _, _, _, _, lo, probe, fp = held
            fp = fp.view(np.uint64)
            run_of = np.cumsum(new) - 1
            out_a, out_b = [], []
            size = ends - first
            short = (size <= 32)[run_of]
            short[done:] = False
            at = np.flatnonzero(short)
            f, p, r = fp[at], probe[at], run_of[at]
            for s in range(1, 32):
                same = r[s:] == r[:-s] if len(r) > s else np.zeros(0, bool)
                if not same.any():
                    break
                hit = same & ~(p[s:] & p[:-s]) & (np.bitwise_count(f[s:] ^ f[:-s]) <= distance)
                out_a.append(f[s:][hit])
                out_b.append(f[:-s][hit])
            for i in np.flatnonzero((size > 32) & (ends <= done)):
                part = slice(first[i], ends[i])
                found = list(forest(fp[part], probe[part], lo[part], distance))
                if found:
                    x = np.array(found, np.uint64)
                    out_a.append(x[:, 0])
                    out_b.append(x[:, 1])
            held = [c[done:] for c in held]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).view(np.int64)) for o in (out_a, out_b)],
                                                 ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _classes(df: DataFrame, key: str, text: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(key, fp) of every row, and (fp, component, component_id) of every fingerprint."""
    spark = df.sparkSession
    prints, _ = work.save(fingerprints(df, key, text, shingle), "simhash")
    nodes, nodes_path = work.save(prints.groupBy("fp").agg(F.min("key").alias("least")), "simhash-nodes")
    n, both = bit_counts(nodes)
    found = components(links(nodes, allot(n, both, distance), distance))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named, _ = work.save(named.join(least, "component").select("fp", "component", "component_id"), "simhash-classes")
    work.drop(spark, nodes_path)
    return prints, named


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """(key, fingerprint, component_id): one row per row of ``df``; component_id is the least key reachable by links."""
    prints, named = _classes(df, key, text, shingle, distance)
    return prints.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``df`` with one row of each class: of the rows with its least key the one with the least fingerprint.

    Any one of rows that repeat key and fingerprint.  Where a key has several
    rows, rows are told apart by key and fingerprint, which are derived once
    more for that.
    """
    prints, named = _classes(df, key, text, shingle, distance)
    chosen = prints.join(named, "fp").filter(F.col("key").eqNullSafe(F.col("component_id"))) \
        .groupBy("component").agg(F.first("key").alias("__key"), F.min("fp").alias("__fp")).select("__key", "__fp")
    same = F.col(f"`{key}`").eqNullSafe(F.col("__key"))
    if prints.groupBy("key").count().filter("count > 1").isEmpty():
        return df.join(chosen, same, "left_semi")

    @F.pandas_udf("bigint")
    def print_of(texts):
        import pandas as pd

        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(f"`{key}`").alias("__k"),
                     print_of(F.col(f"`{text}`")).alias("__f"))
    kept = rows.join(chosen, F.col("__k").eqNullSafe(F.col("__key")) & (F.col("__f") == F.col("__fp")), "left_semi")
    return kept.dropDuplicates(["__k", "__f"]).select("__row.*")
