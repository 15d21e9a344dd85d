"""Pairwise ranking, Merkle manifest and turn repair against plain versions."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoweave.llm import merkle, queries, ranking, repair
from tests.conftest import SF_SMALL


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity=3):
    """(root, siblings of each leaf level by level from left to right)."""
    below, proof = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at:at + arity]
            for j in range(len(run)):
                for i in below[at + j]:
                    proof[i].append((run[:j], run[j + 1:]))
            up.append(h(*run))
            held.append([i for b in below[at:at + arity] for i in b])
        nodes, below = up, held
    return nodes[0], proof


def manifest(rows, key, group):
    """Sorted (leaf, subroot, root, proof) of rows given as (values, key, group)."""
    groups = {}
    for r in rows:
        groups.setdefault(group(r), []).append((key(r) is not None, key(r) or 0, leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [([x[2] for x in sorted(groups[g])], *tree([x[2] for x in sorted(groups[g])])) for g in order]
    root, high = tree([t[1] for t in trees])
    return sorted((x, t[1], root, h(*[s for a, b in [*p, *high[i]] for s in (*a, *b)]))
                  for i, t in enumerate(trees) for x, p in zip(t[0], t[2]))


def found_manifest(df, **options):
    rows = merkle.manifest(df, **options).withColumn("folded", merkle.folded(F.col("leaf"), F.col("witness"))).withColumn(
        "proof", F.sha2(F.encode(merkle.siblings(F.col("witness")), "UTF-8"), 256)).collect()
    assert all(r["folded"] == r["root"] for r in rows)
    return sorted((r["leaf"], r["subroot"], r["root"], r["proof"]) for r in rows)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_brute_force(spark, height):
    cols = ("doc_id", "source", "lang", "n_chars", "text")
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r[c] for c in cols) for r in df.collect()]
    assert found_manifest(df, height=height) == manifest(rows, lambda r: r[0], lambda r: r[1])


def test_manifest_edges(spark, edge, empty):
    cols = ("doc_id", "source", "text", "size", "key", "target")
    rows = [tuple(r[c] for c in cols) for r in edge.collect()]
    got = found_manifest(edge, columns=cols, keep=("doc_id", "key"), height=1)
    assert got == manifest(rows, lambda r: r[0], lambda r: r[1])
    assert merkle.manifest(empty, columns=cols).collect() == []
    one = spark.createDataFrame([(1, None, None, "leaf")], "doc_id int, source string, text string, leaf string")
    row = merkle.manifest(one, columns=("doc_id", "text"), keep=("doc_id", "leaf")).first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf((1, None)) and row["witness"] == ""


def test_manifest_hot_source_and_tampering(spark):
    rows = [(i // 2, "hot" if i % 3 else f"s{i % 30:02}", "en", 3, f"a\nb{i // 5}" if i % 2 else "c") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert found_manifest(df, height=2) == manifest(rows, lambda r: r[0], lambda r: r[1])


def test_manifest_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op12_merkle_manifest(spark, SF_SMALL).collect():
        bent = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (docs[r["doc_id"]] or "")
        assert r["verified"] != bent and (r["folded_root"] == r["root"]) != bent


def test_appender_keeps_few_open():
    held = merkle.Appender()
    for i in range(1000):
        held.append(merkle.digest(str(i)))
        assert all(len(run) < 3 for run in held.open) and len(held.open) < 9


# Turn repair

def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired turns) by trying edits row by row, with the least audit of the cheapest."""
    nexts = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    role = {"u": "user", "a": "assistant"}

    def fill(best):
        for _ in range(3):
            for q, (c, a, t) in list(best.items()):
                x = next(k for k in nexts[q] if k != "s")
                new = (c + 5, a + "I", [*t, (role[x], "")])
                best[x] = min(best.get(x, new), new)
        return best

    best = {"": (0, "", [])}
    for (r, text), fault in zip(rows, faults(rows)):
        new = {}

        def put(q, *x):
            new[q] = min(new.get(q, x), x)

        for q, (c, a, t) in fill(best).items():
            put(q, c + 2, a + "D", t)
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if r[:1] in nexts[q]:
                put(r[0], c + more, a + "K", [*t, (r, text)])
            for x in "ua":
                if x in nexts[q]:
                    put(x, c + 1 + more, a + "R", [*t, (role[x], text)])
        best = new
    best = fill(best)
    return min(best[q] for q in ("", "a") if q in best)


def expected(rows):
    fault = faults(rows)
    bad = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, turns = cheapest(rows)
    return (*[fault.count(f) for f in ("blank", "duplicate", "truncated")], bad, cost, audit,
            h("\n".join(f"{r}:{t}" for r, t in turns)))


def repaired(df, **names):
    found = repair.repair(df, **names)
    audits = {}
    for r in sorted(found.audits.collect(), key=lambda r: (str(r["key"]), r["pos"])):
        audits[r["key"]] = audits.get(r["key"], "") + r["audit"]
    sha = {r["key"]: r["sha"] for r in repair.digests(found.turns).collect()}
    return {r["key"]: (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], audits[r["key"]],
                       sha.get(r["key"], h(""))) for r in found.report.collect()}


def order(rows):
    """(key, turn, role, text) rows as conversations in the operator's order."""
    out = {}
    for k, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out.setdefault(k, []).append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    return {k: [(role, text) for _, role, _, text in sorted(v)] for k, v in out.items()}


def test_edits_are_cheapest_and_least():
    texts = ("x.", "y", "", "x.")
    for n in range(5):
        for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=n):
            rng = random.Random(str(roles))
            rows = [(r, f"{i % 3}{rng.choice(texts)}" if i % 4 else rng.choice(texts)) for i, r in enumerate(roles)]
            fault = faults(rows)
            symbols = [repair.MUST_GO if f in ("blank", "duplicate") else ("suat".index(r[0]) + 4 * bool(f))
                       for (r, _), f in zip(rows, fault)]
            runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
            edits, state = repair.unroll(runs, repair.inserted(repair.at_end()), repair.START)
            audit = "".join("I" * len(b) + e for b, e, _ in edits) + "I" * len(repair.trailing(state))
            assert audit == cheapest(rows)[1], rows


def test_runs_advance_by_powers():
    for symbol in range(9):
        rest = repair.inserted(repair.at_end())
        total = 0
        for n in range(1, 40):
            rest, more = repair.back(symbol, 1, rest)
            total += more
            assert repair.back(symbol, n, repair.inserted(repair.at_end())) == (rest, total)


@pytest.mark.parametrize("size", [1, 3, 50_000])
def test_repair_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", size)
    rng = random.Random(5)
    rows = [(rng.randrange(25) if rng.random() < .6 else 7, rng.randrange(12) if rng.random() < .9 else None,
             rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "no", "", " \n", None, "What?", "é!  ", f"t{rng.randrange(40)}."])) for _ in range(400)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert repaired(df) == {k: expected(v) for k, v in order(rows).items()}


def test_repair_edges(spark, edge, empty):
    rows = [tuple(r) for r in edge.select("source", "doc_id", "key", "text").collect()]
    got = repaired(edge.withColumn("pos", F.lit(1)), key="source", turn="doc_id", role="key")
    assert got == {k: expected(v) for k, v in order(rows).items()}
    none = repair.repair(empty, key="source", turn="doc_id", role="key")
    assert not none.report.collect() and not none.audits.collect() and not none.turns.collect()
    hot = spark.range(3000).select(F.lit(1).alias("c"), F.lit(2).alias("t"), F.lit("user").alias("r"), F.lit("Hi.").alias("x"))
    assert repaired(hot, key="c", turn="t", role="r", text="x")[1] == expected([("user", "Hi.")] * 3000)


def test_repair_gaps(spark):
    df = spark.createDataFrame([(1, 3, "user", "a."), (1, 7, "user", "b."), (1, None, "user", "c."), (2, None, "user", "d."),
                                (3, -(1 << 63), "user", "e."), (3, 5, "user", "f.")],
                               "conv_id long, turn long, role string, text string")
    got = {r["key"]: r["gaps"] for r in repair.repair(df).report.collect()}
    assert got == {1: 3, 2: 0, 3: (1 << 63) - 1}


# Pairwise ranking

def test_ranking_held_out(spark):
    d = SF_SMALL.replace("sf0.001", "sf0.01")
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = queries.op11_pairwise_quality(spark, d).collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and label.get(r["doc_id"]) is not None]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_ranking_fit_equals_plain_descent():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(.7, 1, (40, 4)), rng.normal(0, 1, (30, 4))
    w = ranking.fit_weights(good, bad)
    scale = np.concatenate([good, bad]).std(0)
    x, v = ranking.pairs(good, bad) / scale, np.zeros(4)
    for _ in range(4000):
        v += 0.5 * (x.T @ (1 / (1 + np.exp(x @ v))) / len(x) - ranking.PENALTY * v)
    assert np.allclose(w * scale, v, atol=1e-4)


def test_ranking_cut_parts_the_labelled_rows(spark):
    rows = [(i, [float(i)]) for i in range(50)] + [(None, [1.0])]
    found = spark.createDataFrame(rows, "key long, f array<float>")
    labels = spark.createDataFrame([(i, int(i >= 20)) for i in range(50)] + [(3, None), (99, 1)], "doc_id long, quality int")
    got = {r["key"]: r["score"] for r in ranking.score(found, ranking.fit(found, labels, F.lit(True))).collect()}
    assert all((got[i] >= 0.7) == (i >= 20) for i in range(50))
    assert ranking.fit(found, labels.filter("quality = 1"), F.lit(True)) == ranking.Model(share=1.0)
    assert ranking.fit(found, labels.limit(0), F.lit(True)).share == 0.5


def test_ranking_edges(edge, empty):
    found = ranking.statistics(edge, "doc_id", "text")
    rows = found.collect()
    assert len(rows) == edge.count() and all(np.isfinite(r["f"]).all() for r in rows)
    assert ranking.statistics(empty, "doc_id", "text").collect() == []
    assert ranking.score(found, ranking.Model()).filter("score = 0.5").count() == len(rows)
