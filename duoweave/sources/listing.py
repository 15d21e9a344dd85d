"""Paged JSON listing responses (explicit schema, no inference).

A response is ``{"data": {"publicNewsList": {"data": [item...],
"pagination": {"total": N}}}}`` or ``{"errors": [...]}``.  Stored responses
are JSON lines ``{"page": p, "body": {...}}`` (``read_listing``) or a
string column holding the raw body (``parse_listing``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("name_en", T.StringType()),
])
ITEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("title_en", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("description_en", T.StringType()),
    T.StructField("thumbnail", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("summary_en", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("published_date", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("category", CATEGORY),
])
ENVELOPE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("publicNewsList", T.StructType([
            T.StructField("data", T.ArrayType(ITEM)),
            T.StructField("pagination", T.StructType([T.StructField("total", T.LongType())])),
        ])),
    ])),
])
FILE = T.StructType([T.StructField("page", T.LongType()), T.StructField("body", T.StringType())])


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of stored responses -> (page, body struct, failed)."""
    return parse_listing(spark.read.schema(FILE).json(path))


def parse_listing(raw: DataFrame, body: str = "body") -> DataFrame:
    """(page, body string) -> (page, body struct, failed).

    ``failed``: the response has a key ``errors``, whatever it holds, or is no JSON object.
    """
    keys = F.json_object_keys(F.col(body))
    return raw.withColumn("failed", F.coalesce(F.array_contains(keys, "errors"), F.lit(True))) \
        .withColumn(body, F.from_json(F.col(body), ENVELOPE))


def write_listing(parsed: DataFrame, path: str, mode: str = "overwrite") -> None:
    body = F.when(F.col("failed"), F.lit('{"errors": true}')).otherwise(F.to_json("body"))
    parsed.select("page", body.alias("body")).write.mode(mode).json(path)


def write_items(items: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store parsed listing items as Parquet (flat columns), so later row
    filters (status, category) are pushed into the scan."""
    items.select("*", F.col("category.id").alias("category_id")).write.mode(mode).parquet(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
