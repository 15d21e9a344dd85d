"""From raw documents to packed sequences: one operator after another.

Each stage takes the documents that the stage before it kept, whole, and
returns documents with the same columns; the last returns packed pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoweave.llm import linealign, mixing, packing, rules, simhash, work
from duoweave.llm.work import table
from duoweave.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the list learned from ``labels.quality`` rejects."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks that they share, aligned, with an earlier one; n_chars follows the text."""
    out = linealign.remove_blocks(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in out.columns else out


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near-duplicates."""
    return simhash.keep_first(docs, shingle=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of 1024 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Hashes of shingles and token ids are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table.

    Each stage's result is written and read again; tables that a stage wrote
    on the way are deleted when its result is there.
    """
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = work.mark()
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        work.release(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
