"""Sinks: CSV pair files, appendable pair tables, sorted link lists, run folders.

All writers are distributed: part files are written by the tasks that hold
the rows; no output passes through the driver or a single task.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duoweave.session import read_if_present
from duoweave.sources import commits

# CSV header of the pair file and Python csv defaults.
CSV_COLUMNS = ("ID", "English_Text", "Khmer_Text")
CSV_LINE_SEP = "\r\n"


def run_path(base: str, run_id: str | None = None) -> str:
    """One output folder per run, named by a UTC timestamp by default."""
    rid = run_id or time.strftime("%Y-%m-%dT%H-%M-%SZ", time.gmtime())
    return os.path.join(base, f"run={rid}")


def csv_frame(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("id").cast("bigint").alias(CSV_COLUMNS[0]),
                        F.coalesce("english_text", F.lit("")).alias(CSV_COLUMNS[1]),
                        F.coalesce("khmer_text", F.lit("")).alias(CSV_COLUMNS[2]))


def csv_field(c: Column) -> Column:
    """A field as Python's ``csv`` writes it: in quotes, doubled inside, only where a mark of the format is in it."""
    return F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def write_csv(pairs: DataFrame, path: str, mode: str = "overwrite", parts: int | None = None) -> None:
    """CSV as Python's ``csv`` module writes it: one header, minimal quoting, doubled quotes, '' for empty text,
    CRLF after each row, line breaks inside fields as they are.

    Rows are range-partitioned by id and sorted inside each part; the part
    files read one after another in name order are that one file, byte by
    byte.  The header is the first row of the first part.  Lines are put
    together by expressions and written as text, whose commit protocol leaves
    no part of a task that failed.
    """
    frame = csv_frame(pairs)
    cells = [F.coalesce(F.col(CSV_COLUMNS[0]).cast("string"), F.lit("")), *[csv_field(F.col(c)) for c in CSV_COLUMNS[1:]]]
    rows = frame.select(F.lit(1).alias("kind"), F.col(CSV_COLUMNS[0]).alias("id"), F.concat_ws(",", *cells).alias("value"))
    header = pairs.sparkSession.range(1).select(
        F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"), F.lit(",".join(CSV_COLUMNS)).alias("value"))
    rows = header.unionByName(rows)
    rows = rows.repartitionByRange(parts, "kind", "id") if parts else rows.repartitionByRange("kind", "id")
    (rows.sortWithinPartitions("kind", "id").select("value").write.mode(mode)
     .option("lineSep", CSV_LINE_SEP).text(path))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read pair CSV files back; empty fields are '' (the format has no nulls), the header row is left out.

    Spark's reader gives a CRLF inside a field as LF.
    """
    raw = (spark.read.option("header", False).option("quote", '"').option("escape", '"')
           .option("multiLine", True).option("ignoreLeadingWhiteSpace", False)
           .option("ignoreTrailingWhiteSpace", False)
           .schema("ID string, English_Text string, Khmer_Text string").csv(path))
    return raw.filter(F.col("ID").isNull() | (F.col("ID") != CSV_COLUMNS[0])).select(
        F.col("ID").try_cast("bigint").alias("ID"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CSV_COLUMNS[1:]])


LEDGER_SCHEMA = "batch_id bigint, last_id bigint"


def ledger_path(sink: str) -> str:
    return sink.rstrip("/") + "_ledger"


def last_id(spark: SparkSession, sink: str, before_batch: int | None = None) -> int:
    """Highest id of earlier writes, from the ledger (one row per write); 0 where nothing was written.

    A table without a ledger, written by other means, is asked for its highest
    id once.  An unreadable ledger or table raises.
    """
    ledger = read_if_present(spark, ledger_path(sink), LEDGER_SCHEMA)
    if ledger is None:
        table = read_if_present(spark, sink, "id bigint")
        return 0 if table is None else int(table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
    if before_batch is not None:
        ledger = ledger.filter(F.col("batch_id") < before_batch)
    return int(ledger.agg(F.coalesce(F.max("last_id"), F.lit(0))).first()[0])


def note_last_id(spark: SparkSession, sink: str, batch_id: int, last: int) -> None:
    """Write the ledger row of a write; the row of a repeated batch is replaced."""
    spark.range(1).select(F.lit(last).cast("bigint").alias("last_id"), F.lit(batch_id).cast("bigint").alias("batch_id")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id") \
        .parquet(ledger_path(sink))


def write_counted(pairs: DataFrame, start: int, write) -> int:
    """``write`` the frame; the highest id in it, observed by the write itself (start - 1 if it has no rows)."""
    seen = Observation()
    write(pairs.observe(seen, F.max("id").alias("last_id")))
    return int(seen.get["last_id"] or start - 1)


def append_pairs(content: DataFrame, path: str, order: str = "page_id", key: str = "page_id", run: str = "") -> int:
    """Append numbered pairs after the highest id already in the table.

    The table is Parquet (id, key, i, english_text, khmer_text).  The rows of
    one call are one transaction (``sources.commits``); a ``run`` name makes a
    repeated call append once.  The ledger beside the table repeats the highest
    id for those who read it; ids follow the commits, never the ledger alone.
    Returns the first id used.
    """
    spark = content.sparkSession
    known = 0 if commits.log(spark, path) else last_id(spark, path)
    done = commits.append(content, path, order, key, run, known)
    if done.last_id >= done.first_id:
        note_last_id(spark, path, done.last_id, done.last_id)
    return done.first_id


def write_jdbc(pairs: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               batch_rows: int = 10_000) -> None:
    """Append pairs to a database table (id, english_text, khmer_text) by Spark's JDBC writer.

    Needs a driver on the class path; each task writes its own partition.
    """
    rows = pairs.select("id", "english_text", "khmer_text")
    rows.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=properties or {})


def write_links(links: DataFrame, path: str, href: str = "href", mode: str = "overwrite") -> None:
    """Unique links in sort order as a text file set (range-partitioned sort)."""
    links.select(F.col(href).alias("value")).distinct().orderBy("value").write.mode(mode).text(path)


def write_item_urls(urls: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Item URLs in listing order (page, pos), duplicates kept."""
    urls.orderBy("page", "pos").select(F.col("url").alias("value")).write.mode(mode).text(path)
