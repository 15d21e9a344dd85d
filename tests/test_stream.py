import os

from pyspark.sql import functions as F

from duoweave.plans import fixtures as X
from duoweave.plans.corpus import corpus_pairs
from duoweave.streaming.streams import links_stream, pairs_stream
from tests.conftest import SF_SMALL


def test_pairs_stream_equals_batch(spark, tmp_dir):
    pages = X.main_pages(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "src")
    for k in range(3):
        pages.filter(F.col("page_id") % 3 == k).write.mode("append").parquet(src)
    sink = os.path.join(tmp_dir, "sink")
    q = pairs_stream(spark, src, sink, os.path.join(tmp_dir, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    ids = sorted(r[0] for r in got.select("id").collect())
    assert ids == list(range(1, len(ids) + 1))
    cols = ["page_id", "i", "english_text", "khmer_text"]
    batch = corpus_pairs(pages)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_links_stream_equals_batch(spark, tmp_dir):
    snaps = X.snapshots(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "links")
    snaps.write.parquet(src)
    sink = os.path.join(tmp_dir, "uniq")
    q = links_stream(spark, src, sink, os.path.join(tmp_dir, "ckpt2"))
    q.awaitTermination(300)
    got = sorted(r[0] for r in spark.read.parquet(sink).select("href").collect())
    want = sorted(r[0] for r in snaps.select(F.regexp_replace("href", "/+$", "").alias("h")).distinct().collect())
    assert got == want


def test_pairs_stream_bears_an_empty_first_batch_and_leaves_no_tables(spark, tmp_dir):
    from duoweave.session import table_mark

    pages = X.main_pages(spark, SF_SMALL).filter("page_id < 12")
    src, sink = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "sink")
    pages.limit(0).coalesce(1).write.parquet(src)
    mark = table_mark()
    args = (spark, src, sink, os.path.join(tmp_dir, "ckpt"))
    pairs_stream(*args).awaitTermination(300)
    pages.write.mode("append").parquet(src)
    pairs_stream(*args).awaitTermination(300)
    ids = sorted(r[0] for r in spark.read.parquet(sink).select("id").collect())
    assert ids == list(range(1, len(ids) + 1)) and ids
    assert table_mark() == mark
