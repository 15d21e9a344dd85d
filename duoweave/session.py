"""Session helpers.

The library never creates its own cluster settings on a real cluster: it
reads what the session already has.  ``local_session`` is for tests, the
bench and the examples only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "duoweave") -> SparkSession:
    """A local[N] session with the settings the tests and bench use."""
    if shuffle_partitions is None:
        shuffle_partitions = int(cores) if str(cores).isdigit() else 8
    parts = shuffle_partitions
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.conf.set("duoweave.input.partitions", str(parts))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it a RuntimeError is raised, since executors could not see
    each other's files.  Only a local master (one machine, as in tests) gets a
    private folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="duoweave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Folders of the tables that materialize() wrote and nobody released yet.
_TABLES: list[str] = []


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that ``materialize`` wrote after the first ``since`` (see ``table_mark``).

    For callers that have written their result: frames that read those tables end here.
    """
    while len(_TABLES) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_mark() -> int:
    return len(_TABLES)


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, None where no such path is; other read errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def materialize(df, eager: bool = True):
    """Cut lineage of an expensive frame that is read more than once.

    The frame is written as a Parquet table under the session's shared
    checkpoint folder and read back: a lost executor never forces
    recomputation of upstream stages, the columnar copy is compact, and the
    read-back plan carries real size statistics for AQE's join choices.
    ``eager=False`` falls back to a lazy reliable RDD checkpoint.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not eager:
        return df.checkpoint(eager=False)
    path = os.path.join(base, "tables", uuid.uuid4().hex)
    df.write.parquet(path)
    _TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
