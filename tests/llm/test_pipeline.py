import numpy as np

import corpus_pipeline as pipeline
from duoweave.llm import packing, rules, work
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_shards_mix_pack import pieces_are_whole

FEATURE_OF = {
    "n_words": lambda s: s["n_words"],
    "chars_per_word": lambda s: s["word_chars"] / s["n_words"] if s["n_words"] else 0,
    "symbols_per_word": lambda s: s["n_symbols"] / s["n_words"] if s["n_words"] else 0,
    "calls_per_word": lambda s: s["n_calls"] / s["n_words"] if s["n_words"] else 0,
    "upper_per_char": lambda s: s["n_upper"] / s["word_chars"] if s["word_chars"] else 0,
    "digits_per_char": lambda s: s["n_digits"] / s["word_chars"] if s["word_chars"] else 0,
    "repeat_share": lambda s: s["n_repeat_words"] / s["n_words"] if s["n_words"] else 0,
    "distinct_share": lambda s: s["n_distinct_words"] / s["n_words"] if s["n_words"] else 0,
    "dup_line_share": lambda s: s["n_dup_lines"] / s["n_lines"] if s["n_lines"] else 0,
    "words_per_line": lambda s: s["n_words"] / s["n_lines"] if s["n_lines"] else 0,
}


def stats_of(text):
    n, chars, symbols, dup, repeat, _ = brute.quality_counts(text)
    w = brute.words(text)
    import unicodedata
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat,
            "n_lines": sum(bool(brute.words(x)) for x in text.split("\n")), "n_distinct_words": len(set(w)),
            "n_calls": sum(c in "!?" for c in text), "n_digits": sum(c in "0123456789" for c in text),
            "n_upper": sum(unicodedata.category(c) == "Lu" for c in text)}


def rejected(text, learned):
    s = stats_of(text)
    holds = lambda c: (FEATURE_OF[c.feature](s) > c.threshold) == c.above
    return brute.quality_counts(text)[5] or any(all(holds(c) for c in rule) for rule in learned)


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    learned = rules.judged(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))[1]
    texts = {d: r["text"] for d, r in rows.items()}
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_dedup", "mix_sources", "pack_windows"]
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        found = docs.collect()
        if name == "quality_rules":
            texts = {d: t for d, t in texts.items() if not rejected(t, learned)}
            assert len(texts) > 100
        elif name == "line_dedup":
            cut = brute.line_dedup(sorted(texts.items()))
            got = {r["doc_id"]: r["text"] for r in found}
            assert {d: brute.sha(t) for d, t in got.items()} == {d: c[2] for d, c in cut.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in found)
            texts = got
        elif name == "simhash_dedup":
            named = brute.simhash_classes(sorted(texts.items()))
            texts = {d: t for d, t in texts.items() if named[d][1] == d}
        else:
            size = {}
            for d, t in texts.items():
                size[rows[d]["source"]] = size.get(rows[d]["source"], 0) + len(brute.words(t))
            taken = {}
            for r in found:
                taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
            assert set(taken) <= set(texts) and max(taken.values()) <= 2
            total = sum(len(brute.words(texts[d])) * n for d, n in taken.items())
            assert 1.3 * sum(size.values()) < total < 1.7 * sum(size.values())
        if name != "mix_sources":
            assert {r["doc_id"]: r["text"] for r in found} == texts
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary()[0])
    ids = {d: t.encode(x, add_special_tokens=False).ids + [0] for d, x in texts.items()}
    packed = pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert sum(r["length"] for r in packed) == sum(len(ids[r["doc_id"]]) for r in found)
    sizes = {}
    for r in packed:
        sizes.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == brute.zlib.crc32(part.tobytes())
    for parts in sizes.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()


def test_run(spark):
    assert pipeline.run(spark, SF_SMALL).count() > 0


def test_stages_bear_odd_tables(spark, edge, empty):
    named = ["doc_id", "text", "lang", "source", "n_chars", "key", "stats", "__n"]
    odd = edge.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "source", "cast(null AS bigint) AS n_chars",
                          "key", "1 AS stats", "2 AS __n")
    for table in (odd, odd.limit(0)):
        docs = table
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == named
            docs = work.save(out, f"test-{name}")[0]
        assert pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= 0
