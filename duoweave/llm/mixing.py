"""Mixing sources to target weights.

Words per source are one aggregation; a source's repetition rate is its target
over its words; each document is taken floor(rate) times and once more when a
hash of its key and the seed falls under the rate's fraction.

Defined results: a null text has no words; a null source is a source (the
last); rows with equal keys are decided alike; sources without words have
target 0; an empty table gives an empty table; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoweave.llm import work

#: White space that ends a word, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def n_words(text: Column) -> Column:
    """Number of words (runs without white space); null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) from the md5 of the columns' text."""
    joined = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target.

    ``sizes``: source, size per document.  Sources in code-point order (null
    last) weigh ``weights``, repeating.  The targets share ``share`` times all
    words; no target is above ``most`` times its source, and what is cut off is
    shared again by weight.  That fixed point is a level L with target =
    min(most * size, L * weight), found by one running sum over the sources
    ordered by most * size / weight.  One row per source is all that ever
    meets in one task here.
    """
    if share > most:
        raise ValueError("share above most can't be reached")
    per, _ = work.save(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.lit(float(most)) * F.col("source_size")
    rows = per.withColumn("weight", weight).withColumn("cap", cap).withColumn("full", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    found = F.min(F.when(F.col("full") >= F.col("level"), F.struct("full", "level"))).over(everything)["level"]
    rows = rows.withColumn("found", found)
    return rows.select("source", "source_size",
                       F.when(F.col("found").isNull(), F.col("cap"))
                       .otherwise(F.least(F.col("cap"), F.col("found") * F.col("weight"))).alias("target"))


def with_copies(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7,
                **options) -> DataFrame:
    """``df`` with size, source_size, target and copies (how often the mix takes the row).

    Columns of ``df`` with those names give way.
    """
    df = df.drop("size", "source_size", "target", "copies")
    goal, _ = work.save(targets(df.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size")),
                                **options), "mix-targets")
    goal = goal.withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (unit_hash(F.lit(seed), F.col(key)) < rate - F.floor(rate)).cast("long")
    return (df.withColumn("size", n_words(F.col(text)))
            .join(goal, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")
            .withColumn("copies", F.floor(rate) + extra))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed documents: the columns of ``df``, each row as often as it is taken."""
    cols = list(df.columns)
    name = {k: options.pop(k, v) for k, v in (("key", "doc_id"), ("text", "text"), ("source", "source"))}
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"),
                      *[F.col(f"`{v}`").alias(f"__in_{k}") for k, v in name.items()])
    taken = with_copies(inner, key="__in_key", text="__in_text", source="__in_source", **options)
    return (taken.filter(F.col("copies") > 0)
            .select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("__row.*"))
