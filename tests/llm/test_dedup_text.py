import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from duoweave.llm import linealign, queries, substrings
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_substrings_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in queries.op10_substring_dedup(spark, SF_SMALL).collect()}
    assert got == brute.window_dedup(docs)


def passages(seed, n):
    """Documents that share passages with each other and with themselves, and copies."""
    rng = random.Random(seed)
    stock = [" ".join(f"{rng.choice('abcde')}{rng.randrange(30)}" for _ in range(rng.randrange(15, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rng.choice(stock) if rng.random() < 0.5 else
                 "\n".join(" ".join(f"u{rng.randrange(200)}" for _ in range(rng.randrange(1, 30))) for _ in range(3))
                 for _ in range(rng.randrange(1, 7))]
        out.append((i, "\n".join(parts)))
    return out + [(n, out[3][1]), (n + 1, out[3][1]), (n + 2, "a b " * 40)]


def test_substrings_small_blocks(spark, monkeypatch):
    """Many sketches, shards and groups give the same rows as one."""
    monkeypatch.setattr(substrings, "SKETCH_ANCHORS", 30)
    monkeypatch.setattr(substrings, "GROUP_WINDOWS", 50)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 2000)
    monkeypatch.setattr(substrings, "SLICE_BYTES", 500)
    data = passages(1, 60)
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    got = {r["key"]: (r["n_words"], r["n_removed"], r["sha"]) for r in substrings.removed(df).collect()}
    assert got == brute.window_dedup(data)
    kept = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(df).collect()}
    assert all(brute.sha(" ".join(brute.words(kept[d]))) == got[d][2] for d in got)


@given(st.lists(st.lists(st.sampled_from("a b c d e".split()), max_size=60), max_size=5))
@settings(max_examples=60, deadline=None)
def test_equal_windows_have_equal_anchors(texts):
    text, cell, start, count = substrings.Anchors()([" ".join(t).encode() for t in texts])
    by = {}
    for t, c, s, n in zip(text, cell, start, count):
        for k in range(s, s + n):
            by.setdefault(tuple(texts[t][k:k + 20]), set()).add((c, ))
    assert all(len(x) == 1 for x in by.values())
    assert sum(count) == sum(max(0, len(t) - 19) for t in texts)


def test_count_min_never_underestimates():
    rng = np.random.default_rng(3)
    cells = rng.integers(0, 500, 4000).astype(np.uint32) * np.uint32(7919)
    got = substrings.estimates(cells, np.ones(len(cells)))
    _, inverse, true = np.unique(cells, return_inverse=True, return_counts=True)
    assert (got >= true[inverse]).all()


def test_lines_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["kept_sha256"])
           for r in queries.op2_line_align(spark, SF_SMALL).collect()}
    assert got == brute.line_dedup(docs)


def test_lines_hot_and_rare(spark, monkeypatch):
    data = passages(2, 50)
    for rare in (2, 8):
        monkeypatch.setattr(linealign, "RARE", rare)
        df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
        got = {r["key"]: (r["n_lines"], r["n_deleted"], r["sha"]) for r in linealign.kept(df).collect()}
        assert got == brute.line_dedup(data)


@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
@settings(max_examples=200, deadline=None)
def test_alignment(a, b):
    got = linealign.aligned(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    name = lambda xs: [str(x) if x else "" for x in xs]
    assert got == sorted(brute.patience(name(a), name(b), 0, 0))
    assert linealign.aligned(a, a) == [(i, i) for i in range(len(a))]


def test_edges(spark, edge, empty):
    rows = substrings.removed(edge).collect()
    assert len(rows) == edge.count()
    n = {r["key"]: (r["n_words"], r["n_removed"]) for r in rows}
    assert n[0] == n[1] == n[2] == (0, 0) and n[6] == (22, 0) and n[7] == (22, 22)
    assert n[8] == (150, 145) and n[9][1] == 30_000 - 997 - 19 + 19
    out = substrings.remove_repeats(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    out = linealign.remove_blocks(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[0] is None and text[1] == "" and text[6].startswith("A b") and text[7] == ""
    assert linealign.kept(edge).count() == edge.count()
    for f in (substrings.removed, substrings.remove_repeats, linealign.kept, linealign.remove_blocks):
        assert f(empty).count() == 0


def test_lines_frequent_lose_nothing(spark):
    """Frequent lines delete what aligning every document with every earlier one deletes."""
    block = "\n".join(f"p{i} of the passage that many hold" for i in range(5))
    again = [(0, f"x0\n{block}\ny0\n{block}\nz0")] + [(i, f"x{i}\n{block}\nz{i}") for i in range(1, 15)]
    blank = [(100 + i, f"u{i}\n" + ("\n" if i in (3, 9) else "") + "one line of five words" + ("\n" if i % 4 else "") + f"\nv{i}")
             for i in range(20)]
    rng = random.Random(5)
    stock = [" ".join(f"m{j}w{k}" for k in range(rng.choice((1, 2, 3, 6)))) for j in range(8)]
    mixed = [(200 + i, "\n".join(rng.choice(stock + ["", f"own{i} {j}"]) for j in range(rng.randrange(3, 14)))) for i in range(60)]
    for data in (again, blank, mixed, passages(2, 50), again + blank + mixed):
        df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
        got = {r["key"]: (r["n_lines"], r["n_deleted"], r["sha"]) for r in linealign.kept(df).collect()}
        assert got == brute.line_dedup(data, rare=len(data))
    assert all(got[i][1] == 5 for i in range(2, 15))


def test_lines_query_equals_alignment_of_all_pairs(spark, docs):
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["kept_sha256"])
           for r in queries.op2_line_align(spark, SF_SMALL).collect()}
    assert got == brute.line_dedup(docs, rare=len(docs))


def test_lines_of_boilerplate_pair_by_signature(spark, monkeypatch):
    """Pages with an equal first line and one link text four times: pairs grow with the pages, not with their square."""
    pairs, real = [], linealign._more_pairs

    def counted(*args):
        out = real(*args)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(linealign, "_more_pairs", counted)
    link = "read more of this one story here"
    for n in (40, 80):
        data = [(i, "\n".join(["Site of the daily news for all"] + [x for k in range(4) for x in (f"own words {k} of page {i}", link)]
                              + [f"end {i}"] * (1 + i % 3))) for i in range(n)]
        df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
        got = {r["key"]: (r["n_lines"], r["n_deleted"], r["sha"]) for r in linealign.kept(df).collect()}
        assert got == brute.line_dedup(data)
        assert sum(pairs) <= (linealign.PIVOTS + 6) * n
        pairs.clear()


def test_equal_signatures_delete_alike():
    rng = random.Random(8)
    for _ in range(300):
        late = [rng.randrange(0, 7) for _ in range(rng.randrange(1, 12))]
        early = [rng.randrange(0, 12) for _ in range(rng.randrange(1, 14))]
        known = {2, 3, 4, 5, 6}
        late = [h if h in known else 0 if h == 0 else 50 for h in late]
        other, last = [], None
        for h in early:
            own = h != 0 and h not in known
            if not (own and last):
                other += [rng.randrange(100, 999)] * rng.randrange(1, 3) if own else [h]
            last = own
        early = [h if h == 0 or h in known else 70 + n for n, h in enumerate(early)]
        assert linealign.signature(early, known) == linealign.signature(other, known)
        words = [3] * len(late)
        assert linealign.blocks(early, late, words) == linealign.blocks(other, late, words)
