import csv
import glob
import io

from pyspark.sql import Window
from pyspark.sql import functions as F

from duoweave.operators.pairs import numbered_pairs, run_summary, running_sums
from duoweave.sources.sinks import append_pairs, read_csv, write_csv


def _content(spark, sizes):
    rows = [(p, [f"e{p}-{i}" for i in range(ne)], [f"k{p}-{i}" for i in range(nk)])
            for p, (ne, nk) in enumerate(sizes)]
    return spark.createDataFrame(rows, "page_id long, english array<string>, khmer array<string>")


def test_numbering_vector(spark):
    pairs = numbered_pairs(_content(spark, [(2, 1), (0, 0), (1, 3)])).orderBy("id").collect()
    assert [r["id"] for r in pairs] == [1, 2, 3, 4, 5, 6]
    assert [r["page_id"] for r in pairs] == [0, 0, 1, 2, 2, 2]
    assert (pairs[2]["english_text"], pairs[2]["khmer_text"]) == ("", "")
    assert (pairs[1]["english_text"], pairs[1]["khmer_text"]) == ("e0-1", "")
    s = run_summary(_content(spark, [(2, 1), (0, 0), (1, 3)])).collect()[0]
    assert (s["pages"], s["english_texts"], s["khmer_texts"]) == (3, 3, 4)


def test_prefix_sum_over_many_partitions_equals_global_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 3).alias("pos"), (F.col("id") % 7).alias("v"))
    got = running_sums(df, "pos", {"before": "v"}, partitions=37)
    w = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("want", F.coalesce(F.sum("v").over(w), F.lit(0)))
    bad = got.join(want, "pos").filter(F.col("before") != F.col("want")).count()
    assert bad == 0 and got.count() == 5000


def test_numbering_takes_any_key(spark):
    """Hashed, null and repeated keys: every row is numbered, without gaps."""
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 500 == 0, None).otherwise(F.xxhash64(F.floor(F.col("id") / 2))).alias("page_id"),
        F.transform(F.sequence(F.lit(0), (F.col("id") % 4).cast("int")), lambda x: x.cast("string")).alias("english"),
        F.array().cast("array<string>").alias("khmer"))
    out = numbered_pairs(df)
    ids = [r["id"] for r in out.collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and len(ids) == sum(i % 4 + 1 for i in range(3000))
    by = out.groupBy("page_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    assert by.filter("hi - lo + 1 != n").count() == 0
    parts = running_sums(df.withColumn("v", F.lit(1)), "page_id", {"o": "v"}, partitions=20)
    assert parts.filter("page_id IS NULL").agg(F.max("o")).first()[0] == 5


def test_csv_matches_python_csv(spark, tmp_dir):
    """The parts, one after another, are the bytes that Python's csv module writes."""
    rows = [(1, "", "K"), (2, 'a "q", b', "x\ny"), (3, " lead", "trail "), (4, "plain", ""), (5, "cr\rlf\r\n", '"'),
            (6, "#x;\t'y'", "ខ្មែរ, 😀"), (7, "\n", ",")] + [(n, f"e{n}", f"k,{n}") for n in range(8, 200)]
    pairs = spark.createDataFrame(rows, "id long, english_text string, khmer_text string").repartition(5)
    buf = io.StringIO(newline="")
    w = csv.writer(buf)
    w.writerow(["ID", "English_Text", "Khmer_Text"])
    for r in rows:
        w.writerow(r)
    for parts in (None, 1, 4):
        write_csv(pairs, tmp_dir + "/out", parts=parts)
        files = sorted(glob.glob(tmp_dir + "/out/part-*"))
        assert parts is None or len(files) == parts
        assert b"".join(open(f, "rb").read() for f in files) == buf.getvalue().encode()
    back = sorted(tuple(r) for r in read_csv(spark, tmp_dir + "/out").collect())
    assert [r[0] for r in back] == list(range(1, 200))
    assert [r for r in back if "\r" not in r[1] and r[0] != 5] == [r for r in rows if r[0] != 5]
    write_csv(pairs.limit(0), tmp_dir + "/none")
    assert b"".join(open(f, "rb").read() for f in glob.glob(tmp_dir + "/none/part-*")) == b"ID,English_Text,Khmer_Text\r\n"


def test_append_continues_ids(spark, tmp_dir):
    path = tmp_dir + "/table"
    assert append_pairs(_content(spark, [(2, 1), (0, 0)]), path) == 1
    assert append_pairs(_content(spark, [(1, 3)]), path) == 4
    ids = sorted(r[0] for r in spark.read.parquet(path).select("id").collect())
    assert ids == [1, 2, 3, 4, 5, 6]


def test_append_uses_the_ledger_and_raises_on_unreadable_tables(spark, tmp_dir):
    import os

    import pytest

    path = tmp_dir + "/pairs"
    append_pairs(_content(spark, [(2, 1)]), path)
    assert [tuple(r) for r in spark.read.parquet(path + "_ledger").collect()] == [(2, 2)]
    assert append_pairs(_content(spark, []), path) == 3
    assert append_pairs(_content(spark, [(0, 0)]), path) == 3
    broken = tmp_dir + "/broken"
    os.makedirs(broken)
    with open(broken + "/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        append_pairs(_content(spark, [(1, 1)]), broken)


def test_run_path_names_one_folder_per_run():
    import re

    from duoweave.sources.sinks import run_path

    assert run_path("/x", "r1") == "/x/run=r1"
    assert re.fullmatch(r"/x/run=\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ", run_path("/x"))


def test_aligned_content_is_written_once(spark, monkeypatch):
    """Queries that read the aligned pages several times find a table, not the last steps of the alignment."""
    from duoweave.plans import catalog
    from tests.conftest import SF_SMALL

    pages, read = spark.range(6).select(
        F.col("id").alias("page_id"), F.array(F.lit("e")).alias("english"), F.array(F.lit("k")).alias("khmer")), []
    monkeypatch.setattr(catalog, "bi_content", lambda *a, **k: pages.groupBy("page_id", "english", "khmer").agg(F.count("*").alias("n")))
    monkeypatch.setattr(catalog, "numbered_pairs", lambda content, *a, **k: read.append(content) or numbered_pairs(content, *a, **k))
    for query in (catalog.pair_ids, catalog.append_ids):
        assert query(spark, SF_SMALL).count() == 6
    assert len(read) == 3
    assert not any("Aggregate" in c._jdf.queryExecution().optimizedPlan().toString() for c in read)
