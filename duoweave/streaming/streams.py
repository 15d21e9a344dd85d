"""File streams of fetched pages and of link snapshots.

* ``pairs_stream``: new page files -> extract, route, align, number per
  micro-batch (``foreachBatch``, since alignment aggregates per page).
  Output is partitioned by ``batch_id``; ids continue after the highest id
  of earlier batches.  A replayed batch (after a failure) overwrites its own
  partition and gets the same ids, so the sink is exactly-once.
  Tables written on the way are deleted when the batch is done.
* ``links_stream``: new link snapshot files -> normalised links ->
  ``dropDuplicates(href)`` (state: one entry per distinct link), or, with an
  event-time column and a watermark, ``dropDuplicatesWithinWatermark`` (state:
  the links of that time span).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duoweave.functions.urls import normalize_link
from duoweave.operators.layout import NEWS_LAYOUT, PageLayout
from duoweave.plans.corpus import corpus_pairs
from duoweave.session import release, table_mark
from duoweave.sources.sinks import last_id, note_last_id, write_counted

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
LINKS_SCHEMA = T.StructType([
    T.StructField("snapshot", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("href", T.StringType()),
    T.StructField("height", T.LongType()),
])


def pairs_stream(spark: SparkSession, source: str, sink: str, checkpoint_location: str,
                 layout: PageLayout = NEWS_LAYOUT, encoder=None, schema: T.StructType = PAGES_SCHEMA,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Page files -> numbered pairs, partitioned by batch_id, ids continuing across batches.

    Next to the sink a ledger holds one row per batch (batch_id, last_id), so
    finding where a batch starts never scans the pairs written so far.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.parquet(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mark = table_mark()
        start = last_id(session, sink, batch_id) + 1
        pairs = corpus_pairs(batch, layout, encoder, start=start).withColumn("batch_id", F.lit(batch_id))
        last = write_counted(pairs, start, lambda df: (
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink)))
        note_last_id(session, sink, batch_id, last)
        release(session, mark)

    writer = pages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def links_stream(spark: SparkSession, source: str, sink: str, checkpoint_location: str,
                 schema: T.StructType = LINKS_SCHEMA, available_now: bool = True,
                 event_time: str | None = None, watermark: str = "1 day") -> StreamingQuery:
    links = spark.readStream.schema(schema).parquet(source).withColumn("href", normalize_link(F.col("href")))
    if event_time:
        unique = links.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(["href"])
    else:
        unique = links.dropDuplicates(["href"])
    writer = (unique.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint_location).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
