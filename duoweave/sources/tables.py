"""Table reads.

Splits are Spark's own (``spark.sql.files.maxPartitionBytes``).  A file with
one row group is one split however large the cluster; where that is known to
be so, as for the small test tables, the caller asks for partitions with the
session setting ``duoweave.input.partitions``.  Unset, as on a cluster, no
row is moved.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

PARTITIONS_CONF = "duoweave.input.partitions"

# Keys that rows are dealt by where partitions are asked for (hash
# partitioning is deterministic, so a retried task sees the same rows).
TABLE_KEYS = {
    "documents": "doc_id", "pages": "page_id", "orders": "o_orderkey", "embeddings": "vec_id",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    asked = int(spark.conf.get(PARTITIONS_CONF, "0"))
    return df.repartition(asked, TABLE_KEYS[name]) if asked and name in TABLE_KEYS else df
