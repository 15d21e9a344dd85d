import glob
import os

from pyspark.sql import functions as F

from duoweave.operators import align as A
from duoweave.operators.encode import GivenVectors, ModelEncoder
from duoweave.plans import fixtures as X
from duoweave.plans.corpus import aligned_content, page_content
from duoweave.sources.sinks import write_item_urls, write_links
from tests.conftest import SF_SMALL
from tests.models import letters_model


def test_model_encoder_plugin_equals_given_vectors(spark):
    texts = ["abc abd", "ddd eee", "bad cab", "a", "ace", "bead"]
    rows = [(0, "en", i, t) for i, t in enumerate(texts[:4])] + [(0, "km", j, t) for j, t in enumerate(texts[4:])]
    sent = spark.createDataFrame(rows, "page_id long, side string, idx int, text string")
    model = ModelEncoder(letters_model, dims=5)
    got = sorted(tuple(r) for r in A.align_steps(sent, model, checkpoint=False)["picks"]
                 .select("j", "b", "u").collect())
    enc = letters_model()
    with_vec = spark.createDataFrame([(p, s, i, enc([t])[0]) for p, s, i, t in rows],
                                     "page_id long, side string, idx int, vec array<double>")
    want = sorted(tuple(r) for r in A.align_steps(with_vec, GivenVectors("vec", 5), checkpoint=False)["picks"]
                  .select("j", "b", "u").collect())
    assert got == want


def test_link_and_item_url_sinks(spark, tmp_dir):
    snaps = X.snapshots(spark, SF_SMALL)
    write_links(snaps, os.path.join(tmp_dir, "links"))
    lines = []
    for f in sorted(glob.glob(os.path.join(tmp_dir, "links", "part-*"))):
        lines += open(f, encoding="utf-8").read().splitlines()
    assert lines == sorted(set(r[0] for r in snaps.select("href").collect()))
    urls = spark.createDataFrame([(1, 1, "u/b"), (1, 0, "u/a"), (2, 0, "u/a")], "page int, pos int, url string")
    write_item_urls(urls, os.path.join(tmp_dir, "items"))
    got = []
    for f in sorted(glob.glob(os.path.join(tmp_dir, "items", "part-*"))):
        got += open(f, encoding="utf-8").read().splitlines()
    assert got == ["u/a", "u/b", "u/a"]


def test_corpus_plan_shape(spark):
    """No Python evaluation anywhere; the only single-partition exchange is the bucket table."""
    pages = X.main_pages(spark, SF_SMALL)
    routed = page_content(pages)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    aligned = aligned_content(pages)
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    from duoweave.operators.pairs import numbered_pairs
    numbered = numbered_pairs(aligned)
    numbered.count()
    final = numbered._jdf.queryExecution().executedPlan().toString()
    assert final.count("SinglePartition") <= 1


def test_result_does_not_depend_on_partition_count(spark):
    from duoweave.plans.corpus import corpus_pairs

    cols = ["id", "page_id", "i", "english_text", "khmer_text"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(map(tuple, corpus_pairs(X.main_pages(spark, SF_SMALL).repartition(1)).select(cols).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = sorted(map(tuple, corpus_pairs(X.main_pages(spark, SF_SMALL).repartition(7)).select(cols).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_encoder_failure_leaves_page_unaligned(spark):
    from tests.models import flaky_model

    content = spark.createDataFrame(
        [(1, ["abc", "bad", "cab"], ["ace", "bead"], True),
         (2, ["boom one", "boom two", "boom three"], ["aaa", "bbb"], True)],
        "page_id long, english array<string>, khmer array<string>, needs_align boolean")
    out = {r["page_id"]: r for r in A.align(content.coalesce(1), ModelEncoder(flaky_model, dims=5)).collect()}
    assert len(out[1]["english"]) == 2
    assert out[2]["english"] == ["boom one", "boom two", "boom three"]


def test_model_that_cannot_load_fails_the_job(spark):
    import pytest

    def broken():
        raise OSError("no weights")

    content = spark.createDataFrame([(1, ["abc", "bad", "cab"], ["ace", "bead"], True)],
                                    "page_id long, english array<string>, khmer array<string>, needs_align boolean")
    with pytest.raises(Exception, match="no weights"):
        A.align(content, ModelEncoder(broken, dims=5)).collect()


def test_fetch_log_keeps_rows_without_a_status(spark):
    from duoweave.operators.fetch import fetched_content

    log = spark.createDataFrame([(1, "https://a.kh/1", None, "text/html", "<p>x</p>"), (2, "https://a.kh/2", 200, None, None),
                                 (3, None, 200, "text/html", "<p>y</p>")],
                                "pos long, url string, status int, content_type string, html string")
    got = {r["pos"]: r["usable"] for r in fetched_content(log).collect()}
    assert got == {1: False, 2: False, 3: False}


def test_checkpoint_folder_is_asked_for_on_a_cluster(monkeypatch):
    import pytest

    from duoweave import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
