"""Fetch results: usable responses and one content row per input URL.

Every input URL keeps its row and its 1-based position as id: invalid URLs,
failed fetches and non-HTML answers get two empty lists.  Usable rows go
through extraction and routing, the others get empty lists; the two
branches are filters of the same scan, put together with a union (no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.functions.text import KHMER, LanguageRule
from duoweave.functions.urls import is_valid_url
from duoweave.operators.layout import NEWS_LAYOUT, PageLayout, extract
from duoweave.operators.route import route


def _empty() -> Column:
    return F.array().cast("array<string>")


def usable_response(status="status", content_type="content_type") -> Column:
    """Status 200 and an HTML type; a missing status or type is not usable (never null)."""
    st = F.col(status) if isinstance(status, str) else status
    ct = F.col(content_type) if isinstance(content_type, str) else content_type
    return F.coalesce(st == 200, F.lit(False)) & F.lower(F.coalesce(ct, F.lit(""))).contains("html")


def fetched_content(fetches: DataFrame, layout: PageLayout = NEWS_LAYOUT, rule: LanguageRule = KHMER,
                    keep: tuple[str, ...] = ("pos", "url")) -> DataFrame:
    """fetches(pos, url, status, content_type, html) -> (keep..., valid, usable, english, khmer, needs_align)."""
    flagged = fetches.select("*", is_valid_url(F.col("url")).alias("valid")) \
        .withColumn("usable", F.coalesce(F.col("valid"), F.lit(False)) & usable_response())
    good = flagged.filter(F.col("usable"))
    content = route(extract(good, layout, keep=(*keep, "valid", "usable")), rule,
                    keep=(*keep, "valid", "usable"))
    failed = flagged.filter(~F.col("usable")).select(
        *keep, "valid", "usable", _empty().alias("english"), _empty().alias("khmer"),
        F.lit(False).alias("needs_align"))
    return content.unionByName(failed)
