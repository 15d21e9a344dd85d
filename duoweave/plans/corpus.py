"""End-to-end plans: fetched pages -> numbered sentence pairs.

Shuffles of the corpus plan: extraction and routing are one narrow
projection per page; alignment shuffles by page (joins, per-pair and
per-page aggregations) only for the pages that need it; numbering
aggregates bucket totals.  Routed and aligned content are checkpointed
because each is read by more than one branch (align / pass-through,
bucket totals / rows), so a lost executor never re-runs the extraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duoweave.functions.text import KHMER, LanguageRule
from duoweave.operators.align import align
from duoweave.operators.encode import NgramEncoder
from duoweave.operators.fetch import fetched_content
from duoweave.operators.layout import NEWS_LAYOUT, PageLayout, extract
from duoweave.operators.pairs import numbered_pairs
from duoweave.operators.route import route
from duoweave.plans import fixtures as X
from duoweave.session import materialize


def page_content(pages: DataFrame, layout: PageLayout = NEWS_LAYOUT, rule: LanguageRule = KHMER,
                 key: str = "page_id") -> DataFrame:
    """pages(key, html) -> content(key, english, khmer, needs_align)."""
    return route(extract(pages, layout, keep=(key,)), rule, keep=(key,))


def aligned_content(pages: DataFrame, layout: PageLayout = NEWS_LAYOUT, encoder=None,
                    rule: LanguageRule = KHMER, key: str = "page_id", checkpoint: bool = True) -> DataFrame:
    routed = page_content(pages, layout, rule, key)
    if checkpoint:
        routed = materialize(routed)
    return align(routed, encoder or NgramEncoder(), key)


def corpus_pairs(pages: DataFrame, layout: PageLayout = NEWS_LAYOUT, encoder=None,
                 rule: LanguageRule = KHMER, key: str = "page_id", order: str | None = None,
                 start=1, checkpoint: bool = True) -> DataFrame:
    """pages -> (id, key, i, english_text, khmer_text), ids contiguous from ``start``."""
    content = aligned_content(pages, layout, encoder, rule, key, checkpoint)
    if checkpoint:
        content = materialize(content)
    return numbered_pairs(content, order or key, start, keep=(key,))


def fetch_pairs(fetches: DataFrame, layout: PageLayout = NEWS_LAYOUT, encoder=None, rule: LanguageRule = KHMER,
                order: str = "pos", start=1) -> DataFrame:
    """fetches(pos, url, status, content_type, html) -> (id, pos, i, english_text, khmer_text).

    Every input URL has rows: one that is invalid, failed or not HTML has one blank row.
    """
    content = materialize(fetched_content(fetches, layout, rule, keep=(order,)))
    return numbered_pairs(align(content, encoder or NgramEncoder(), order), order, start, keep=(order,))


def bi_content(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    """Content of the generated news-layout pages (routed, optionally aligned)."""
    pages = X.main_pages(spark, sf_dir)
    if aligned:
        return aligned_content(pages)
    return materialize(page_content(pages))
