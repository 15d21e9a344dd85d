import zlib

import duckdb
import numpy as np
import pytest

from duoweave.llm import mixing, packing, queries, sharding
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_shards(spark, docs):
    rows = queries.op3_jump_shards(spark, SF_SMALL).collect()
    texts = dict(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        t = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 16, zlib.crc32(t), "key")
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_equals_published_loop():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for n in (1, 2, 7, 40, 1000):
        assert sharding.jump(keys, n).tolist() == [brute.jump(int(k), n) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_numbering_in_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    monkeypatch.setattr(sharding, "COPY_ROWS", 5)
    df = spark.range(200).selectExpr("id % 60 AS k", "cast(id % 3 AS int) AS shard")
    df = df.union(df.filter("k = 6").limit(1).selectExpr("k", "shard").crossJoin(spark.range(33)).select("k", "shard"))
    rows = sharding.number(df).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == 233 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mix_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.execute(queries.OP4_SQL).fetchall())
    assert sorted(tuple(r) for r in queries.op4_source_mix(spark, SF_SMALL).collect()) == want


def level(sizes, weights, share, most):
    """Resharing the excess by weight until no target is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            return {**fixed, **{s: left * w[s] / total for s in open_}}
        for s in over:
            fixed[s] = most * sizes[s]
            left -= most * sizes[s]


def test_targets_are_the_fixed_point(spark):
    sizes = {"b": 100, "a": 10, None: 5, "ä": 40, "zz": 0, "c": 300, "d": 1}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = level(sizes, (3, 1, 2), 1.5, 2.0)
    assert got == pytest.approx(want)


def test_mixed_rows_follow_their_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 9 AS int)) AS text",
                                        "concat('s', cast(id % 4 AS string)) AS source", "id AS n_chars")
    taken = mixing.with_copies(docs).groupBy("source").agg({"source_size": "max", "target": "max"}).collect()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(
        mixing.F.sum(mixing.n_words(mixing.F.col("text"))).alias("n")).collect()}
    for r in taken:
        assert words[r["source"]] == pytest.approx(r["max(target)"], rel=0.05)
    assert sorted(mixing.mix(docs).collect()) == sorted(mixed.collect())
    assert mixed.groupBy("doc_id").count().filter("count > 2").count() == 0


def pieces_are_whole(rows, ids):
    by_doc, by_seq = {}, {}
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts, total in [(p, len(ids[d])) for d, p in by_doc.items()] + [(p, None) for p in by_seq.values()]:
        at = 0
        for s, n in sorted(parts):
            assert s == at and n > 0
            at += n
        assert at == total if total is not None else at <= 1024
    return [sum(n for _, n in p) for p in by_seq.values()], set(by_doc)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary()[0])
    ids = {d: t.encode(x or "", add_special_tokens=False).ids + [0] for d, x in docs}
    sizes, seen = pieces_are_whole(queries.op5_bm25_packing(spark, SF_SMALL).collect(), ids)
    assert seen == set(ids)
    assert all(n & (n - 1) == 0 for n in sizes) and sum(n < 1024 for n in sizes) <= 20 * 8


def test_index_is_bm25():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, rng.integers(0, 50)).astype(np.uint32) for _ in range(30)]
    index = packing.Index(docs)
    mean = sum(map(len, docs)) / len(docs)
    for q in range(len(docs)):
        for d in range(len(docs)):
            want = 0.0
            for term in set(docs[q].tolist()):
                df = sum(term in x for x in docs)
                tf = docs[d].tolist().count(term)
                want += np.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)) if tf else 0
            assert index.scores(q)[d] == pytest.approx(want)


def test_seed_takes_its_best_neighbour_first():
    a, b = np.arange(1, 601, dtype=np.uint32), np.arange(2000, 2600, dtype=np.uint32)
    docs = [np.append(a, 0), np.append(b, 0), np.append(a[100:], 0), np.append(b[50:], 0)]
    out = list(packing.pack_block([d.astype(np.uint32) for d in docs]))
    first = [d for d, _, _, seq, _ in out if seq == 0]
    assert first[:2] == [0, 2]


def test_edges(spark, edge, empty):
    n = edge.count()
    sharded = sharding.assign(edge, edge["doc_id"], 5)
    assert sharded.columns == [*edge.columns, "shard"] and sharded.filter("shard between 0 and 4").count() == n
    assert sharding.number(sharded).count() == n
    assert sharding.number(sharding.assign(empty, empty["doc_id"], 5)).count() == 0
    mixed = mixing.with_copies(edge)
    assert mixed.count() == n and mixed.filter("copies * size > 2 * size").count() == 0
    assert mixing.mix(edge).columns == edge.columns and mixing.mix(empty).count() == 0
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary()[0])
    once = edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ids = {r["doc_id"]: t.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in once.collect()}
    assert pieces_are_whole(packing.pack(once).collect(), ids)[1] == set(ids)
    rows = packing.pack(edge, with_ids=True).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 6) == 3 * len(ids[6])
    assert all(r["length"] == len(r["ids"]) for r in rows)
    assert packing.pack(empty).count() == 0


def test_numbering_bears_any_column(spark):
    """A column named slot, a name with a dot, maps, and rows that repeat."""
    df = spark.sql("SELECT id % 3 AS shard, id % 4 AS slot, id % 2 AS `a.b`, map('k', id % 5) AS m, array(1.5) AS l FROM range(40)")
    out = sharding.number(df)
    assert out.columns == ["shard", "a.b", "m", "l", "slot"]
    slots = {}
    for r in out.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert {k: sorted(v) for k, v in slots.items()} == {0: list(range(14)), 1: list(range(13)), 2: list(range(13))}
    again = sharding.assign(df, df["slot"], 5)
    assert again.columns == df.columns and again.filter("shard BETWEEN 0 AND 4").count() == 40
