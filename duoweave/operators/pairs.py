"""Pair rows, global numbering and the run summary.

Numbers over a global order come from a two-level running sum: rows are
range-partitioned by the order key and written once with their partition
number; partition totals (one row per partition) get a running sum, and a
window per partition gives each row's offset.  Any sortable key will do, dense
or hashed; NULL keys come first and rows with equal keys follow each other in
the order of a hash of the row.  The only single-task step holds one row per
partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duoweave.session import materialize

def row_count(english="english", khmer="khmer"):
    """Rows a page gives: the longer list, at least one (the empty row)."""
    return F.greatest(F.size(english), F.size(khmer), F.lit(1))


def running_sums(df: DataFrame, order: str, sums: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Add each ``out`` of ``sums`` (out -> value column): the values' sum over the rows before, by ``order``.

    The frame is written once to the session's shared folder, range-partitioned.
    """
    spread = df.repartitionByRange(partitions, F.col(order)) if partitions else df.repartitionByRange(F.col(order))
    rows = materialize(spread.withColumn("_part", F.spark_partition_id()))
    parts = rows.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{o}") for o, v in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", *[F.coalesce(F.sum(f"_sum_{o}").over(before), F.lit(0)).cast("bigint")
                                     .alias(f"_start_{o}") for o in sums])
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    inside = Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_first(), tie) \
        .rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({f"_in_{o}": F.coalesce(F.sum(v).over(inside), F.lit(0)).cast("bigint")
                            for o, v in sums.items()}).join(starts, "_part")
    return out.select(*df.columns, *[(F.col(f"_start_{o}") + F.col(f"_in_{o}")).alias(o) for o in sums])


def exclusive_prefix_sum(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows before, by ``order``."""
    return running_sums(df, order, {out: value})


def with_first_ids(content: DataFrame, order: str = "page_id", start: int | object = 1) -> DataFrame:
    """Add ``first_id``: id of the page's first pair row (ids contiguous from ``start``)."""
    counted = content.withColumn("_rows", row_count())
    out = exclusive_prefix_sum(counted, order, "_rows", "_offset")
    start_col = start if not isinstance(start, int) else F.lit(start).cast("bigint")
    return out.withColumn("first_id", F.col("_offset") + start_col).drop("_rows", "_offset")


def to_pairs(content: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Zip the two lists of each page, the short side padded with ''.

    A page without any text gives one ('', '') row.  Output:
    keep..., i, english_text, khmer_text.
    """
    n = row_count()
    rows = content.select(*keep, "english", "khmer", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    return rows.select(
        *keep, "i",
        F.coalesce(F.get(F.col("english"), F.col("i")), F.lit("")).alias("english_text"),
        F.coalesce(F.get(F.col("khmer"), F.col("i")), F.lit("")).alias("khmer_text"),
    )


def numbered_pairs(content: DataFrame, order: str = "page_id", start: int | object = 1,
                   keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Pairs with a global id contiguous over page order, then position."""
    firsts = with_first_ids(content, order, start)
    n = row_count()
    rows = firsts.select(*keep, "first_id", "english", "khmer",
                         F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    return rows.select(
        (F.col("first_id") + F.col("i")).alias("id"), *keep, "i",
        F.coalesce(F.get(F.col("english"), F.col("i")), F.lit("")).alias("english_text"),
        F.coalesce(F.get(F.col("khmer"), F.col("i")), F.lit("")).alias("khmer_text"),
    )


def run_summary(content: DataFrame) -> DataFrame:
    """Pages, English texts and Khmer texts over the run (one row)."""
    return content.agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum(F.size("english")), F.lit(0)).cast("bigint").alias("english_texts"),
        F.coalesce(F.sum(F.size("khmer")), F.lit(0)).cast("bigint").alias("khmer_texts"),
    )
