"""Paged listing audit: items, expected pages, missing pages, item URLs.

Every function takes parsed responses ``(page, body struct)``.  A page with
``errors`` contributes nothing; when page 1 failed the total is unknown and
the item list is empty (a scalar "page 1 is fine" flag, no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.session import materialize

PAGE_SIZE = 100


def usable(responses: DataFrame) -> DataFrame:
    """Responses without an ``errors`` key that carry data."""
    return responses.filter(~F.col("failed") & F.col("body.data").isNotNull())


def _page_one_ok(responses: DataFrame):
    return usable(responses).filter(F.col("page") == 1).agg(F.count(F.lit(1)) > 0).scalar()


def listing_items(responses: DataFrame) -> DataFrame:
    """(page, pos, item columns...) for every item of every usable page."""
    items = usable(responses).select(
        "page", F.posexplode("body.data.publicNewsList.data").alias("pos", "item"))
    return items.filter(_page_one_ok(responses)).select("page", "pos", "item.*")


def filter_items(items: DataFrame, status: str | None = None, category_id: int | None = None,
                 website_id: int | None = None) -> DataFrame:
    """Row filter of the listing request (status, category, website; 0/None = any).

    The website is a request parameter: stored listings of several sites carry
    it as a column ``website_id``.
    """
    out = items
    if website_id:
        out = out.filter(F.col("website_id") == website_id)
    if status is not None:
        out = out.filter(F.col("status") == status)
    if category_id:
        cat = F.col("category_id") if "category_id" in items.columns else F.col("category.id")
        out = out.filter(cat == category_id)
    return out


def reported_total(responses: DataFrame) -> DataFrame:
    """(total) from page 1: one row, or none when page 1 failed."""
    return usable(responses).filter(F.col("page") == 1).select(
        F.col("body.data.publicNewsList.pagination.total").alias("total"))


def _pages_of(total, page_size: int):
    return F.greatest(F.ceil(total / F.lit(page_size)).cast("bigint"), F.lit(1).cast("bigint"))


# Page numbers that one row is opened into.
PAGE_CHUNK = 10_000


def expected_pages(responses: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(page) for 1..ceil(total / page_size), at least page 1.

    Opened in two steps, so that no row holds the whole range.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    n = reported_total(responses).select(_pages_of(F.col("total"), page_size).alias("n"))
    chunks = n.select("n", F.explode(F.sequence(zero, F.floor((F.col("n") - 1) / PAGE_CHUNK))).alias("c"))
    low = F.col("c") * PAGE_CHUNK
    return chunks.select(F.explode(F.sequence(low + one, F.least(low + PAGE_CHUNK, F.col("n")))).alias("page"))


def missing_pages(responses: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Expected pages without a usable response: (page)."""
    return expected_pages(responses, page_size).join(usable(responses).select("page"), "page", "left_anti")


def audit(responses: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row: total reported, items got, pages expected, pages missing.

    Responses are read and parsed once, into a small table of one row per page.
    """
    news = F.col("body.data.publicNewsList")
    pages = materialize(usable(responses).groupBy("page").agg(
        F.sum(F.coalesce(F.size(news["data"]), F.lit(0))).alias("items"),
        F.max(news["pagination"]["total"]).alias("total")))
    first = pages.filter("page = 1")
    ok = first.agg(F.count(F.lit(1)) > 0).scalar()
    total = first.agg(F.max("total")).scalar()
    expected = F.when(ok, _pages_of(total, page_size)).otherwise(F.lit(0).cast("bigint"))
    counted = pages.select("items", (ok & F.col("page").between(1, expected)).alias("present")).agg(
        F.sum("items").alias("items"), F.count(F.when(F.col("present"), 1)).alias("present"))
    return counted.select(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        F.when(ok, F.coalesce("items", F.lit(0))).otherwise(0).cast("bigint").alias("items_got"),
        expected.alias("pages_expected"),
        (expected - F.col("present")).cast("bigint").alias("pages_missing"))


def item_urls(items: DataFrame, base: str) -> DataFrame:
    """(page, pos, id, url) with url = base + '/' + id; no dedup, listing order."""
    return items.select("page", "pos", "id",
                        F.concat_ws("/", F.lit(base.rstrip("/")), F.col("id").cast("string")).alias("url"))
