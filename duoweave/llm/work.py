"""Intermediate tables in the shared checkpoint folder.

A table that is read more than once, or that ends a long lineage, is written
as Parquet under ``spark.checkpoint.dir`` and read back: a lost executor never
repeats what came before it.  Tables that are no longer needed are deleted by
the operator that wrote them; those that a returned frame still reads stay
until ``release``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from duoweave.session import ensure_checkpoint_dir

# Paths that save() wrote in this process.
_WRITTEN: list[str] = []


def save(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; return the table read back and its path."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``save`` wrote."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mark() -> int:
    """Number of tables written so far."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables written after ``mark`` gave ``since``; frames that read them end here."""
    drop(spark, *_WRITTEN[since:])
    del _WRITTEN[since:]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
