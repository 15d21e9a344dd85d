"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone: no ring
table, no state, no shuffle.  With one more shard a row either stays or moves
into the new shard.

Defined results: a null key is a key like any other; a null text has no bytes;
rows with equal keys share a shard; an empty table gives an empty table; other
columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the published jump consistent hash.
JUMP_MULTIPLIER = 2862933555777941757
JUMP_SCALE = float(1 << 31)

#: Rows that one numbering task handles.
SLOT_ROWS = 100_000
#: Copies of one row that one numbering row stands for.
COPY_ROWS = 100_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, 0 to shards - 1."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = keys.astype(np.uint64, copy=True)
    out = np.zeros(len(key), np.int64)
    at = np.arange(len(key))
    while len(at):
        with np.errstate(over="ignore"):
            key[at] = key[at] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        step = JUMP_SCALE / ((key[at] >> np.uint64(33)).astype(np.float64) + 1.0)
        nxt = ((out[at] + 1) * step).astype(np.int64)
        inside = nxt < shards
        out[at[inside]] = nxt[inside]
        at = at[inside]
    return out


def jump_udf(shards: int):
    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(jump(key.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))
    return shard_of


def stable_key(col: Column) -> Column:
    """64-bit key that does not depend on the column's integer width."""
    return F.xxhash64(col.cast("string"))


def assign(df: DataFrame, key: Column, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with column ``name``: the row's shard; a column of that name gives way.  Narrow; nothing is shuffled."""
    return df.withColumn(name, jump_udf(shards)(stable_key(key)))


def number(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Gapless slots from 0 within each shard, in two levels; a column named ``slot`` gives way.

    Equal rows are counted first (map-side combined), so a row repeated
    without end is one row here.  Each shard is cut into hashed cells of about
    ``SLOT_ROWS`` rows, numbered on their own; the cells' offsets are a running
    sum over one row per cell.  Values that can't be compared (maps) are
    compared by their JSON.
    """
    from duoweave.llm import work

    names = [c for c in df.columns if c != slot]
    kept = [f"c{i}" for i in range(len(names))]
    inner = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)], F.col(f"`{shard}`").alias("__shard"))
    odd = [k for k, c in zip(kept, names) if any(x in df.schema[c].dataType.simpleString() for x in ("map<", "variant"))]
    cols = [f"j{k}" if k in odd else k for k in kept]
    inner = inner.withColumns({f"j{k}": F.to_json(F.struct(k)) for k in odd}) if odd else inner
    counted = inner.groupBy("__shard", *cols).agg(F.count(F.lit(1)).alias("__n"), *[F.first(k).alias(k) for k in odd])
    rows, _ = work.save(counted, "shard-rows")
    cells = max(1, -(-rows.count() // SLOT_ROWS))
    rows = rows.withColumn("__cell", F.pmod(F.xxhash64(*cols), F.lit(cells)))
    upto = Window.partitionBy("__shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    base = (rows.groupBy("__shard", "__cell").agg(F.sum("__n").alias("__sum"))
            .withColumn("__base", F.sum("__sum").over(upto) - F.col("__sum")).drop("__sum"))
    base = base.withColumnsRenamed({"__shard": "__s", "__cell": "__c"})
    upto = Window.partitionBy("__shard", "__cell").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    first = rows.withColumn("__at", F.sum("__n").over(upto) - F.col("__n")).join(
        base, F.col("__shard").eqNullSafe(F.col("__s")) & (F.col("__cell") == F.col("__c")))
    parts = first.select(*kept, (F.col("__at") + F.col("__base")).alias("__at"), "__n",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPY_ROWS))).alias("__p"))
    low = F.col("__at") + F.col("__p") * COPY_ROWS
    high = F.least(F.col("__at") + F.col("__n"), low + COPY_ROWS) - 1
    return parts.select(*[F.col(k).alias(c) for k, c in zip(kept, names)], F.explode(F.sequence(low, high)).alias(slot))


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; each task writes the shards of its own rows, so a large shard has many files."""
    df.write.partitionBy(shard).parquet(path)
