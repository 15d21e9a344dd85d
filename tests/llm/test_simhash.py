import random

import numpy as np
import pytest

from duoweave.llm import components as cc
from duoweave.llm import queries, simhash
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op1_simhash(spark, SF_SMALL).collect()}
    assert got == brute.simhash_classes(docs)


def near_prints(seed, n):
    """Random fingerprints with chains and balls of near ones."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for base in list(out)[:20]:
        x = base
        for _ in range(8):
            for _ in range(rng.choice([1, 2, 3, 4, 5])):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def least_reachable(prints, distance):
    linked = {a: [b for b in prints if (a ^ b).bit_count() <= distance] for a in prints}
    return brute.components(prints, linked)


@pytest.mark.parametrize("distance,plan", [
    (3, None), (2, None), (0, None),
    (3, [(list(range(0, 32)), 1), (list(range(32, 64)), 1)]),
    (3, [(list(range(0, 30)), 2), (list(range(30, 64)), 0)]),
    (3, [(list(range(0, 21)), 0), (list(range(21, 42)), 0), (list(range(42, 64)), 1)]),
])
def test_links_find_every_component(spark, distance, plan):
    prints = near_prints(distance, 300)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    if plan is None:
        plan = simhash.allot(*simhash.bit_counts(nodes), distance)
        assert sum(t + 1 for _, t in plan) >= distance + 1
        assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)
    found = {r["node"]: r["component"] for r in cc.components(simhash.links(nodes, plan, distance)).collect()}
    want = least_reachable(prints, distance)
    groups = {}
    for s, p in zip(signed, prints):
        groups.setdefault(want[p], set()).add(found.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_crowded_values_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 40)
    rng = random.Random(5)
    base = rng.getrandbits(63)
    prints = sorted({base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(300)})
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    plan = simhash.allot(*simhash.bit_counts(nodes), 3)
    links = simhash.links(nodes, plan, 3)
    found = {r["node"]: r["component"] for r in cc.components(links).collect()}
    want = least_reachable(prints, 3)
    assert {p: found.get(p, p) for p in prints} == {p: want[p] for p in prints}


def test_forest_spans_without_all_pairs():
    fp = np.array([1 << i for i in range(40)], np.uint64)
    out = list(simhash.forest(fp, np.zeros(40, bool), np.ones(40, bool), 2))
    assert len(out) == 39


def test_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (None, 3), (1000, 999)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in cc.components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 999, 999: 999}


def test_edges(spark, edge, empty):
    rows = simhash.classes(edge).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[0] == by[1] == by[2] == {("0" * 16, 0)} == {("0" * 16, 0)}
    assert by[6] == by[7] and next(iter(by[6]))[1] == 6
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(6) == 1 and 7 not in ids and 1 not in ids and ids.count(None) == 0 + ids.count(None)
    assert simhash.classes(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_repeated_keys_lose_no_text(spark):
    """One row of each class stays, also where a key has several texts."""
    a, b, c = ("the first text about one thing", "another text about a second thing", "no more than some third words")
    schema = "doc_id bigint, text string"
    for rows, want in ([(2, b), (2, c)], [(2, b), (2, c)]), ([(1, a), (2, a), (2, c)], [(1, a), (2, c)]), \
            ([(None, a), (None, b), (3, b), (3, b)], [(None, a), (3, b)]), ([(1, a), (1, a), (1, c)], [(1, a), (1, c)]):
        kept = simhash.keep_first(spark.createDataFrame(rows, schema)).collect()
        assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))
