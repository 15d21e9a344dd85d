import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from duoweave.llm import chat, queries, rules, sketches, toxicity
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute

SF_LARGE = "/root/testdata/sf0.1"

PIECE = re.compile("(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,32}")


def pieces(text):
    return {m.rstrip(" \t\x0b\f\r") for m in PIECE.findall(text)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_sketch_query_equals_brute_force(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op6_iblt_fingerprint(spark, SF_SMALL).collect()}
    order = sorted(docs)
    assert len(rows) == len(order)
    prints = {}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        quarter = len(t) // 4
        edited = t[:len(t) - quarter] + nxt[:quarter]
        r = rows[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), brute.sha(edited))
        assert r["near_edited"] == pytest.approx(jaccard(pieces(t), pieces(edited)))
        assert r["near_next"] == pytest.approx(jaccard(pieces(t), pieces(nxt)))
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (pieces(t) == pieces(edited))


def test_large_differences_are_retried(spark):
    long = "\n".join(f"line {i} of this text" for i in range(400))
    other = "\n".join(f"line {i} of this text" for i in range(150, 700))
    df = spark.createDataFrame([(1, long, other), (2, long, long), (3, "", ""), (4, "a b", "")],
                               "id int, a string, b string")
    df = df.select("id", sketches.digests(F.col("a")).alias("a"), sketches.digests(F.col("b")).alias("b"))
    got = {r["id"]: r["near"] for r in sketches.likenesses(df, {"near": ("a", "b")}).collect()}
    assert got == pytest.approx({1: 250 / 700, 2: 1.0, 3: 1.0, 4: 0.0})


def test_peeling_recovers_the_digests(spark):
    df = spark.createDataFrame([(list(range(10, 20)), list(range(15, 22)))], "a array<bigint>, b array<bigint>")
    both = df.select(sketches.peel(sketches.subtract(sketches.sketch(F.col("a")), sketches.sketch(F.col("b")))).alias("p"))
    p = both.first()["p"]
    assert p["left"] == [] and {(q["c"], q["k"]) for q in p["found"]} == {
        *((1, k) for k in range(10, 15)), *((-1, k) for k in range(20, 22))}


def test_sketch_plan_has_no_python(spark):
    plan = queries.op6_iblt_fingerprint(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_query(spark, docs):
    found = queries.op8_decision_list(spark, SF_SMALL)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    texts = dict(docs)
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute.quality_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == want
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_learned_list_separates_labels(spark):
    rows = {r["doc_id"]: r for r in queries.op8_decision_list(spark, SF_MID).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()]
    open_ = [(rows[d], q) for d, q in labels if not rows[d]["base_failed"]]
    assert sum(r["kept"] for r, q in open_ if q == 1) >= 0.97 * sum(q == 1 for _, q in open_)
    assert sum(not r["kept"] for r, q in open_ if q == 0) >= 0.9 * sum(q == 0 for _, q in open_)


def test_list_is_ordered_and_learned_from_statistics(spark):
    rows = spark.range(3000).selectExpr(
        "id AS k", "cast(CASE WHEN id % 10 < 2 OR id % 7 = 0 THEN 0 ELSE 1 END AS int) AS y",
        "concat(repeat('word ', 60), CASE WHEN id % 10 < 2 THEN repeat('# ', 30) ELSE '' END, "
        "CASE WHEN id % 7 = 0 THEN repeat('12345 ', 20) ELSE '' END) AS text")
    learned = rules.learn(rules.statistics(rows), key="k", label="y")
    assert {c.feature for r in learned for c in r} <= set(rules.features(F.col("stats"))) and learned
    out = rules.statistics(rows).select("y", rules.verdict(learned, F.col("stats")).alias("rule"))
    assert out.filter("(y = 0) != (rule IS NOT NULL)").count() == 0


def test_toxicity_on_held_out_rows(spark):
    found = {r["doc_id"]: r for r in queries.op7_compression_toxicity(spark, SF_LARGE).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").collect()}
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    pos = [found[d]["score"] for d, y in labels.items() if y and found[d]["held_out"]]
    neg = [found[d]["score"] for d, y in labels.items() if not y and found[d]["held_out"]]
    above = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert above > 0.85, above


def test_toxicity_without_labels():
    assert toxicity.train([], []).scores(["a", None], None).tolist() == [0, 0]
    assert toxicity.train(["x"], ["y"] * 3).scores(["a"], None).tolist() == [0.25]


def test_toxicity_bears_ordinary_texts_that_quote():
    """Ordinary texts that hold every toxic word do not take the words from the toxic dictionary."""
    import random

    rng = random.Random(4)
    marks = [f"{a}{b}grim" for a in "bdfgklm" for b in "aeiou"]

    def text(bad):
        w = [f"plain{rng.randrange(400)}" for _ in range(40)]
        for _ in range(4 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(marks))
        return " ".join(w)

    toxic, ordinary = [text(True) for _ in range(200)], [text(False) for _ in range(1500)]
    model = toxicity.train(toxic, ordinary[:-3] + [" ".join(marks)] * 3)
    assert sum(m.encode() in model.toxic for m in marks) > len(marks) / 2
    scores = model.scores([text(True) for _ in range(50)] + [text(False) for _ in range(50)], model.compressors())
    above = sum((p > n) + 0.5 * (p == n) for p in scores[:50] for n in scores[50:]) / 2500
    assert above > 0.9, above


def test_toxicity_samples_one_text_of_each_key(spark):
    rows = [(1, f"text {i % 40} of a key that many rows share") for i in range(80)] + [(k, f"alone {k}") for k in range(2, 9)]
    docs = spark.createDataFrame(rows, "key bigint, text string").repartition(4)
    marks = spark.createDataFrame([(k, int(k < 4)) for k in range(1, 9)], "key bigint, mark int")
    toxic, ordinary = toxicity.sample(docs, marks)
    assert sorted(toxic)[:2] == ["alone 2", "alone 3"] and len(toxic) == 3
    assert sorted(ordinary) == [f"alone {k}" for k in range(4, 9)]


def test_chat_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    by = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in table:
        by.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    rows = {r["conv_id"]: r for r in queries.op9_chat_format(spark, SF_SMALL).collect()}
    assert set(rows) == set(by)
    for k, turns in by.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = rows[k]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), brute.sha("".join(f"{x}\n{t}\n" for _, x, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))
        assert r["formatted_chars"] == sum(len(chat.render(x, t)[0]) for _, x, t in turns)


@given(st.text(alphabet="<>/[]INST s\\\n|a", max_size=30) | st.text(max_size=20), st.text(max_size=5) | st.just("assistant"))
@settings(max_examples=400, deadline=None)
def test_template_is_reversible(text, role):
    piece, a, b = chat.render(role, text)
    assert chat.parse(piece) == (role, text)
    inner = piece[a:b] if role == "assistant" else ""
    assert not any(c in chat.escape(text) for c in (chat.BEGIN, chat.END, chat.OPEN, chat.CLOSE))
    assert chat.unescape(inner) == (text if role == "assistant" else "")


def test_layouts(spark):
    records = {
        1: ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
            [("user", "hi"), ("assistant", "yo")]),
        2: ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]},
            [("user", "q"), ("assistant", "")]),
        3: ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
        4: ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        5: ({"instruction": "i", "input": "x", "output": "o"}, [("system", "i"), ("user", "x"), ("assistant", "o")]),
        6: ({"instruction": "i", "output": "o"}, [("system", "i"), ("assistant", "o")]),
        7: ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
        8: ({"messages": []}, []),
        9: ({"other": {"deep": 1}}, [(None, None)]),
    }
    rows = [(k, json.dumps(r)) for k, (r, _) in records.items()] + [(10, "not json"), (11, None)]
    df = spark.createDataFrame(rows, "id bigint, record string")
    got = {}
    for r in chat.canonical_turns(df, "id", "record").orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append((r["role"], r["text"]))
    want = {k: t for k, (_, t) in records.items() if t}
    assert got == {**want, 10: [(None, None)], 11: [(None, None)]}


def test_records_that_cannot_be_read(spark):
    """No record ends the job, and none is lost."""
    bad = ['{"messages": [null]}', '{"messages": ["x", {"role": "user", "content": "y"}]}', '{"turn": "a", "role": "user", "text": "x"}',
           '{"turn": 99999999999999999999, "role": "user", "text": "x"}', '{"turn": true, "role": "user", "text": "x"}',
           '{"prompt": "\\ud800", "response": "r"}', '{"\\udfff": 1}', '{"turn": 1, "role": "user", "text": "kept", "name": "n"}',
           "[1, 2]", "3", '"messages"', "", "{" * 5000, "[" * 100_000]
    good = ['{"messages": [{"role": "user", "content": "q"}, {"role": "assistant"}]}', '{"turn": null, "role": null, "text": null}']
    df = spark.createDataFrame(list(enumerate(bad + good)), "id bigint, record string")
    turns = chat.canonical_turns(df, "id", "record")
    assert sorted(map(tuple, chat.unread(turns).collect())) == list(enumerate(bad))
    n = len(bad)
    got = sorted((r["id"], r["role"], r["text"]) for r in turns.filter("layout IS NOT NULL").collect())
    assert got == [(n, "assistant", ""), (n, "user", "q"), (n + 1, "", "")]


def test_chat_edges(spark):
    schema = "id bigint, pos bigint, role string, text string"
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "assistant", "a\nb"), (1, 0, "assistant", "a\nb"),
            (2, 5, "tool\n", "t" * 100_000)]
    out = {r["id"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, schema))).collect()}
    assert out[None]["n_turns"] == 1 and out[1]["n_turns"] == 3 and out[1]["loss_chars"] == 6
    assert out[1]["turns_sha256"] == hashlib.sha256(b"\n\n" + b"assistant\na\nb\n" * 2).hexdigest()
    assert out[2]["turns_sha256"] == hashlib.sha256(b"tool\n\n" + b"t" * 100_000 + b"\n").hexdigest()
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).count() == 0


def test_edges(spark, edge, empty):
    n = edge.count()
    v = sketches.versions(edge)
    assert v.count() == n
    near = sketches.likenesses(v, {"near": ("digests", "digests")})
    assert near.filter("near = 1").count() == n
    assert sketches.likenesses(sketches.versions(empty), {"near": ("digests", "edited")}).count() == 0
    labels = spark.createDataFrame([(6, 0, 1), (6, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    found, learned = rules.judged(edge, labels)
    assert found.count() == n and found.filter("kept IS NULL OR base_failed IS NULL").count() == 0
    assert rules.keep(edge, labels).columns == edge.columns and learned is not None
    assert rules.judged(empty, labels)[0].count() == 0 and rules.judged(edge, labels.limit(0))[1] == []
    model = toxicity.fit(edge, labels, F.lit(True))
    assert toxicity.score(edge, model).filter("score BETWEEN 0 AND 1").count() == n
    assert toxicity.score(empty, model).count() == 0


def test_sketches_of_many_pieces(spark):
    """Texts of many thousand lines, with few and with many lines changed."""
    n = 6000
    rows = [(1, "\n".join(f"line {i}" for i in range(n))), (2, "\n".join(f"line {i if i % 100 else -i}" for i in range(n))),
            (3, "\n".join(f"other {i}" for i in range(n // 2)))]
    d = spark.createDataFrame(rows, "k int, text string").select("k", sketches.digests(F.col("text")).alias("d"))
    both = d.alias("a").crossJoin(d.alias("b")).selectExpr("a.k AS k", "b.k AS l", "a.d AS x", "b.d AS y")
    got = {(r["k"], r["l"]): r["near"] for r in sketches.likenesses(both, {"near": ("x", "y")}).collect()}
    assert got[1, 1] == got[2, 2] == 1.0 and got[1, 3] == got[3, 2] == 0.0
    assert got[1, 2] == got[2, 1] == pytest.approx((n - 59) / (n + 59))
