"""Link collection: link blocks of hub pages, prefix links, dedup, discovery.

* ``container_links``: in the first container element, each cell's first
  anchor that has an href, in document order, no dedup (A2).
* ``expand_seeds``: seeds ending in a suffix are replaced by the links of
  their hub page, other seeds pass; order key (seed_pos, link_pos) (A1).
* ``prefix_links``: every anchor whose href starts with a prefix (A3),
  ``resolve``: absolute URL, trailing slashes dropped (A4, A5).
* ``first_seen``: global dedup, first pass and position wins, as a plain
  aggregation so a link on every page is combined map-side (A6).
* ``discovery`` / ``idle_streak``: per-pass report of new links and the
  scroll stop rule, with distributed prefix sums instead of a global window
  over link rows (A7, A8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoweave.functions.markup import Sel, attribute, content, elements, visible
from duoweave.functions.text import strip_ws
from duoweave.functions.urls import absolute_url, normalize_link
from duoweave.operators.pairs import running_sums
from duoweave.session import materialize

# Link prefix of news items, scroll stop limit, hub suffix.
NEWS_PREFIX = "/news/"
IDLE_LIMIT = 10
HUB_SUFFIX = ".kh"

BLOG_CONTAINER = Sel("div", id="blog-one-page")
BLOG_CELL = Sel("div", cls="tp-blog__link")


ANCHOR = Sel("a")


def container_links(pages: DataFrame, container: Sel = BLOG_CONTAINER, cell: Sel = BLOG_CELL,
                    key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, href): first anchor of each cell of the first container, where it has an href.

    Container and cells end at their own closing tags.
    """
    s0 = pages.select(F.col(key).alias("_key"), visible(F.coalesce(F.col(html), F.lit(""))).alias("_html"))
    s1 = s0.withColumn("_at", F.get(elements(F.col("_html"), container.tag, (container,)), 0)) \
        .withColumn("_region", content(F.col("_html"), F.col("_at"))) \
        .withColumn("_cells", elements(F.col("_region"), cell.tag, (cell,)))
    tags = F.transform("_cells", lambda x: F.regexp_extract(content(F.col("_region"), x), f"({ANCHOR.open()})", 1))
    hrefs = F.transform(tags, lambda t: attribute(t, "href"))
    # The outer form, so that no filter with a copy of the extraction is inferred (see layout.rows_of).
    return (s1.select("_key", F.posexplode_outer(hrefs).alias("pos", "href")).filter(F.col("href").isNotNull())
            .select(F.col("_key").alias(key), "pos", "href"))


def expand_seeds(seeds: DataFrame, pages: DataFrame, suffix: str = HUB_SUFFIX,
                 container: Sel = BLOG_CONTAINER, cell: Sel = BLOG_CELL, key: str = "url",
                 html: str = "html") -> DataFrame:
    """seeds(pos, url[, key]) -> (seed_pos, link_pos, url, from_hub).

    Seeds are stripped and blank ones dropped.  A hub seed's page is found by
    its URL, or by another column ``key`` of both tables; one without links
    adds nothing.
    """
    named = [] if key == "url" else [F.col(key).alias("_hub")]
    s = seeds.select(F.col("pos").alias("seed_pos"), strip_ws(F.col("url")).alias("url"), *named) \
        .filter(F.col("url") != "")
    is_hub = F.col("url").endswith(suffix)
    direct = s.filter(~is_hub).select("seed_pos", F.lit(0).alias("link_pos"), "url",
                                      F.lit(False).alias("from_hub"))
    hubs = s.filter(is_hub).select("seed_pos", F.col("url" if key == "url" else "_hub").alias("_hub"))
    found = pages.select(F.col(key).alias("_hub"), F.col(html).alias("_html_in")) \
        .join(hubs.select("_hub").distinct(), "_hub", "left_semi")
    links = container_links(found, container, cell, "_hub", "_html_in")
    expanded = hubs.join(links, "_hub").select(
        "seed_pos", F.col("pos").alias("link_pos"), F.col("href").alias("url"), F.lit(True).alias("from_hub"))
    return direct.unionByName(expanded)


def page_anchors(pages: DataFrame, key: str = "page_id", html: str = "html",
                 url: str = "url") -> DataFrame:
    """(key, url, pos, href): every anchor href of every page, document order, decoded."""
    tags = F.regexp_extract_all(visible(F.coalesce(F.col(html), F.lit(""))), F.lit(ANCHOR.open()), F.lit(0))
    hrefs = F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda h: h.isNotNull())
    return pages.select(key, url, F.posexplode_outer(hrefs).alias("pos", "href")).filter(F.col("pos").isNotNull())


def prefix_links(pages: DataFrame, prefix: str = NEWS_PREFIX, key: str = "page_id",
                 html: str = "html", url: str = "url") -> DataFrame:
    """Anchors whose href starts with ``prefix``."""
    return page_anchors(pages, key, html, url).filter(F.col("href").startswith(prefix))


def resolve(links: DataFrame, base: str = "url", href: str = "href", out: str = "link") -> DataFrame:
    """Absolute URL of each href against its page, trailing slashes dropped."""
    return links.withColumn(out, normalize_link(absolute_url(F.col(href), F.col(base))))


def first_seen(links: DataFrame, href: str = "href", order: tuple[str, ...] = ("snapshot", "pos")) -> DataFrame:
    """One row per link: the earliest (order...) occurrence."""
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    return links.groupBy(href).agg(first).select(href, *[F.col(f"_first.{c}").alias(c) for c in order])


def passes(snaps: DataFrame, href: str = "href") -> DataFrame:
    """(snapshot, height, new_links) per pass, written once: reports read this small table, not the pages.

    ``new_links`` counts the links whose first pass this is.
    """
    links = snaps.groupBy(href).agg(F.min("snapshot").alias("snapshot"))
    firsts = links.groupBy("snapshot").agg(F.count(F.lit(1)).alias("new_links"))
    every = snaps.groupBy("snapshot").agg(F.max("height").alias("height"))
    return materialize(every.join(firsts, "snapshot", "left").withColumn(
        "new_links", F.coalesce("new_links", F.lit(0)).cast("bigint")))


def discovery(snaps: DataFrame, href: str = "href") -> DataFrame:
    """(snapshot, new_links, total_links) per pass; links normalised first."""
    p = passes(snaps.withColumn(href, normalize_link(F.col(href))), href)
    out = running_sums(p, "snapshot", {"_before": "new_links"})
    return out.select("snapshot", "new_links",
                      (F.col("_before") + F.col("new_links")).cast("bigint").alias("total_links"))


def idle_streak(snaps: DataFrame, limit: int = IDLE_LIMIT, href: str = "href") -> DataFrame:
    """Scroll stop rule as a report over consecutively numbered passes.

    streak: +1 for a pass without new links, +1 when the page height did not
    change since the previous pass, reset to 0 by a pass with new links
    (that pass still counts its height flag).  ``stop`` marks the first pass
    whose streak reaches ``limit``; ``after_stop`` the passes a live scroll
    would not have made.
    """
    p = passes(snaps.withColumn(href, normalize_link(F.col(href))), href)
    prev = p.select((F.col("snapshot") + 1).alias("snapshot"), F.col("height").alias("_prev_h"))
    p = p.join(prev, "snapshot", "left").withColumn(
        "same_height", F.coalesce(F.col("height") == F.col("_prev_h"), F.lit(False)))
    p = p.withColumn("_inc", (F.when(F.col("new_links") == 0, 1).otherwise(0)
                              + F.when(F.col("same_height"), 1).otherwise(0)).cast("bigint"))
    p = p.withColumn("_reset", F.when(F.col("new_links") > 0, 1).otherwise(0).cast("bigint"))
    p = running_sums(p, "snapshot", {"_s_before": "_inc", "_r_before": "_reset"})
    p = p.withColumn("_s", F.col("_s_before") + F.col("_inc")) \
         .withColumn("_island", F.col("_r_before") + F.col("_reset"))
    bases = p.filter(F.col("_reset") == 1).select("_island", F.col("_s_before").alias("_base"))
    p = materialize(p.join(bases, "_island", "left").select(
        "snapshot", "new_links", "same_height",
        (F.col("_s") - F.coalesce(F.col("_base"), F.lit(0))).cast("bigint").alias("streak")))
    cut = p.filter(F.col("streak") >= limit).agg(F.min("snapshot")).scalar()
    return p.select(
        "snapshot", "new_links", "same_height", "streak",
        F.coalesce(F.col("snapshot") == cut, F.lit(False)).alias("stop"),
        F.coalesce(F.col("snapshot") > cut, F.lit(False)).alias("after_stop"))


def sorted_unique(links: DataFrame, href: str = "href") -> DataFrame:
    """Distinct links in sort order (for the text export)."""
    return links.select(href).distinct().orderBy(href)
