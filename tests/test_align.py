import math

from pyspark.sql import functions as F

from duoweave.operators import align as A
from duoweave.operators.encode import GivenVectors, NgramEncoder
from duoweave.plans.fixtures import sides
from tests.conftest import SF_SMALL
from tests.models import turns_hold, unit_model

EN = [(1.0, 0.0), (0.0, 1.0), (1.0, 1.0), (-1.0, 0.0)]
CASES = [
    ([(2.0, 1.0), (0.0, 3.0)], [(2, 0.9487, 0, 1.0), (1, 1.0, 3, 0.7071)]),
    ([(2.0, 1.0), (0.0, 3.0), (3.0, 1.0)], [(2, 0.9487, 3, 0.4472), (1, 1.0, -1, 1.0), (0, 0.9487, -1, 0.9487)]),
    ([(1.0, 0.0), (0.0, 1.0), (-1.0, 0.5)], [(0, 1.0, 2, 0.8944), (1, 1.0, -1, 1.0), (3, 0.8944, -1, 0.8944)]),
]


def test_greedy_merge_in_the_plane(spark):
    rows = []
    for page, (km, _) in enumerate(CASES):
        rows += [(page, "en", i, list(v)) for i, v in enumerate(EN)]
        rows += [(page, "km", j, list(v)) for j, v in enumerate(km)]
    sent = spark.createDataFrame(rows, "page_id long, side string, idx int, vec array<double>")
    picks = A.align_steps(sent, GivenVectors("vec", dims=2))["picks"]
    got = {}
    for r in picks.collect():
        got.setdefault(r["page_id"], []).append((r["j"], r["b"], round(r["base_score"], 4), r["u"],
                                                 round(r["score"], 4)))
    for page, (_, want) in enumerate(CASES):
        assert [g[1:] for g in sorted(got[page])] == want


def _cos(a, b):
    d = sum(x * y for x, y in zip(a, b))
    n = math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    return 0.0 if n == 0 else d / n


def test_alignment_matches_brute_force_on_embeddings(spark):
    s = sides(spark, SF_SMALL)
    steps = A.align_steps(s.select("page_id", "side", "idx", "vec"), GivenVectors("vec"))
    got = {}
    for r in steps["picks"].collect():
        got.setdefault(r["page_id"], {})[r["j"]] = (r["b"], r["u"])
    data = {}
    for r in s.collect():
        data.setdefault(r["page_id"], {"en": {}, "km": {}})[r["side"]][r["idx"]] = r["vec"]
    assert set(got) == {p for p, d in data.items() if d["km"]}
    for page, picks in got.items():
        en, km = data[page]["en"], data[page]["km"]
        assert set(picks) == set(km)
        for j, (b, _) in picks.items():
            assert all((_cos(km[j], en[b]), -b) >= (_cos(km[j], en[i]), -i) for i in en)
        pool = set(en) - {b for b, _ in picks.values()}
        scores = {(j, u): _cos([x + y for x, y in zip(en[picks[j][0]], en[u])], km[j]) for j in km for u in pool}
        assert turns_hold([picks[j][1] for j in sorted(km)], scores, pool)


def test_ngram_merge_vector_equals_reencoding(spark):
    """vec(a + ' ' + b) == vec(a) + vec(b) + junction, via candidate scores."""
    enc = NgramEncoder()
    en = ["The quick brown fox", "jumps over", "a lazy dog", "xy"]
    km = ["ខ្មែរ quick fox", "lazy"]
    rows = [(0, "en", i, t) for i, t in enumerate(en)] + [(0, "km", j, t) for j, t in enumerate(km)]
    sent = spark.createDataFrame(rows, "page_id long, side string, idx int, text string")
    steps = A.align_steps(sent, enc)
    cands = {(r["j"], r["u"]): r["score"] for r in steps["candidates"].collect()}
    best = {r["j"]: r["i"] for r in steps["best"].collect()}
    merged = []
    for (j, u) in cands:
        merged.append((0, "m", len(merged), en[best[j]] + " " + en[u]))
    texts = spark.createDataFrame(merged + [(0, "km", j, t) for j, t in enumerate(km)],
                                  "page_id long, side string, idx int, text string")
    vec = {(r["side"], r["idx"]): {} for r in texts.collect()}
    for r in enc.sparse(texts, ["page_id", "side", "idx"]).collect():
        vec[(r["side"], r["idx"])][r["bucket"]] = r["val"]
    for n, (j, u) in enumerate(cands):
        a, b = vec[("m", n)], vec[("km", j)]
        d = sum(v * b.get(k, 0) for k, v in a.items())
        nn = math.sqrt(float(sum(v * v for v in a.values())) * float(sum(v * v for v in b.values())))
        want = 0.0 if nn == 0 else d / nn
        assert abs(cands[(j, u)] - want) < 1e-12


def test_alignment_output_shape(spark):
    content = spark.createDataFrame(
        [(1, ["aaa bbb", "ccc ddd", "eee fff"], ["ខខខ", "គគគ"], True)],
        "page_id long, english array<string>, khmer array<string>, needs_align boolean")
    out = A.align(content).collect()[0]
    assert len(out["english"]) == len(out["khmer"]) == 2
    words = " ".join(out["english"]).split()
    assert sorted(set(words)) <= sorted({"aaa", "bbb", "ccc", "ddd", "eee", "fff"})


def test_blocks_and_turns_give_same_alignment(spark, monkeypatch):
    """A page cut into many blocks, its pairs taking turns in many rows."""
    s = sides(spark, SF_SMALL).select("page_id", "side", "idx", "vec")
    plain = sorted(tuple(r) for r in A.align_steps(s, GivenVectors("vec"), checkpoint=False)["picks"]
                   .select("page_id", "j", "b", "u").collect())
    monkeypatch.setattr(A, "BLOCK", 2)
    monkeypatch.setattr(A, "TURNS", 3)
    v = A.Vectors(s, GivenVectors("vec"))
    both = A.block_join(v.side("km", "j", "kv", "n_en", "n_km").drop("kv"), v.side("en", "i", "ev", "n_en", "n_km").drop("ev"),
                        "page_id", ("j", "n_km"), ("i", "n_en"))
    assert both.count() == both.distinct().count() == s.filter("side = 'km'").alias("a").join(
        s.filter("side = 'en'").alias("b"), "page_id").count()
    cut = sorted(tuple(r) for r in A.align_steps(s, GivenVectors("vec"))["picks"]
                 .select("page_id", "j", "b", "u").collect())
    assert cut == plain and max(r[1] for r in cut) >= 6


def test_large_page_takes_turns_over_rows(spark, monkeypatch):
    """One page of 1,000 sentences: candidates from many join keys, picks in passes, each turn the best that is left."""
    import random

    monkeypatch.setattr(A, "BLOCK", 64)
    monkeypatch.setattr(A, "TURNS", 50)
    rng = random.Random(2)
    rows = [(1, side, i, [float(rng.randrange(4)) for _ in range(3)]) for side, n in (("en", 700), ("km", 300)) for i in range(n)]
    rows += [(2, "en", 0, [1.0, 0.0, 0.0]), (2, "en", 1, [0.0, 1.0, 0.0]), (2, "km", 0, [1.0, 1.0, 0.0])]
    sent = spark.createDataFrame(rows, "page_id long, side string, idx int, vec array<double>")
    steps = A.align_steps(sent, GivenVectors("vec"))
    scores = {(r["j"], r["u"]): r["score"] for r in steps["candidates"].filter("page_id = 1").collect()}
    picks = {(r["page_id"], r["j"]): r["u"] for r in steps["picks"].collect()}
    pool = {u for _, u in scores}
    assert len(picks) == 301 and picks[(2, 0)] == 1 and len(scores) == 300 * len(pool)
    assert turns_hold([picks[(1, j)] for j in range(300)], scores, pool)


def test_ngram_counts_match_plain_hash(spark):
    texts = ["", "ab", "abc", "abcabcabc", "ខ្មែរ and é", "😀😀😀😀 x", "a" * 3000, "line\nbreak\tand\u00a0space", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: r["vec"] for r in NgramEncoder().vectors(rows, ["i"]).collect()}
    for i, t in enumerate(texts):
        want = [0.0] * 64
        for at in range(len(t or "") - 2):
            h = 0
            for c in t[at:at + 3]:
                h = (h * 1000003 + ord(c)) % 2147483647
            want[h % 64] += 1
        assert got[i] == want, t


def test_alignment_explodes_no_text(spark):
    """Vectors stay in the row of their sentence: nothing is generated but list places and blocks."""
    content = spark.createDataFrame([(1, ["aaa bbb", "ccc ddd", "eee fff"], ["ខខខ", "គគគ"])],
                                    "page_id long, english array<string>, khmer array<string>")
    steps = A.align_steps(A.sentences(content), NgramEncoder(), checkpoint=False)
    plan = steps["candidates"]._jdf.queryExecution().optimizedPlan().toString()
    made = {line.split("Generate ")[1].split("(")[0] for line in plan.splitlines() if "Generate " in line}
    assert made <= {"posexplode", "explode"} and "bucket" not in plan and "BatchEvalPython" not in plan


def test_input_check(spark):
    import pytest

    bad = spark.createDataFrame([(1, ["a"])], "page_id long, english array<string>")
    with pytest.raises(KeyError):
        A.align_pages(bad)


def test_model_merge_encodes_the_merged_text(spark):
    """With a model whose vectors are not additive, scores are those of the merged texts (shapes 7 x 5, 2 x 1)."""
    from duoweave.operators.encode import ModelEncoder

    pages = {0: (["ab a", "bcd", "ee d", "cab", "dab", "ace", "bead"], ["abc", "dde", "a b", "cc", "ebb"]),
             1: (["ab c", "dd e"], ["abd"])}
    rows = [(p, side, i, t) for p, (en, km) in pages.items() for side, ts in (("en", en), ("km", km))
            for i, t in enumerate(ts)]
    sent = spark.createDataFrame(rows, "page_id long, side string, idx int, text string")
    steps = A.align_steps(sent, ModelEncoder(unit_model, dims=5))
    model = unit_model()
    best = {(r["page_id"], r["j"]): r["i"] for r in steps["best"].collect()}
    cands = {(r["page_id"], r["j"], r["u"]): r["score"] for r in steps["candidates"].collect()}
    picks = {(r["page_id"], r["j"]): r["u"] for r in steps["picks"].collect()}
    for p, (en, km) in pages.items():
        pool = set(range(len(en))) - {best[(p, j)] for j in range(len(km))}
        scores = {(j, u): _cos(*model([en[best[(p, j)]] + " " + en[u], km[j]])) for j in range(len(km)) for u in pool}
        for (j, u), want in scores.items():
            assert abs(cands[(p, j, u)] - want) < 1e-9
        assert turns_hold([picks[(p, j)] for j in range(len(km))], {k: cands[(p, *k)] for k in scores}, pool)


def test_vectors_sort_primitive_buckets(spark):
    """Characters come from a split, not from a regex match each, and the sort is a column of its own without nulls."""
    enc = NgramEncoder()
    rows = spark.createDataFrame([(0, "abcab"), (1, ""), (2, "ab"), (3, None), (4, "កខគ😀កខគ")], "i int, text string")
    vecs = enc.vectors(rows, ["i"])
    assert "regexp_extract_all" not in vecs._jdf.queryExecution().optimizedPlan().toString()
    got = {r["i"]: r["vec"] for r in vecs.collect()}
    assert [sum(got[i]) for i in range(5)] == [3.0, 0.0, 0.0, 0.0, 5.0]
    assert all(len(v) == enc.dims for v in got.values())
    runs = rows.select(enc.runs(enc.buckets(F.coalesce("text", F.lit("")))).alias("r"))
    assert not runs.schema["r"].dataType.containsNull
