"""Page layout extraction (title, paragraph blocks, fallback layout).

Pages stay one row each; a layout turns the HTML string into a title and
an ordered ``array<string>`` of cleaned blocks with regex splits and
higher-order array functions.  That is a chain of narrow projections: no
shuffle, no Python worker, and the work per row is linear in the page size.
Each intermediate (region, raw paragraphs, texts) is its own column, so it
is computed once per page.

Comments, scripts and styles are taken out first.  One pass over the tags of
each name finds the elements that the layout asks for, as intervals of the
markup; all containers and all blocks count, and blocks may lie in each other.
The fallback's children are its direct children (see ``functions.markup``).
This is a layout matcher, not an HTML parser: selectors are a tag name with an
optional class token or id, and an opening ``<p>`` ends the previous paragraph.
See README "Layouts" for the limits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.functions.markup import Sel, children, closed, content, cut, elements, matching, outermost, visible, within
from duoweave.functions.text import MIN_BLOCK_LENGTH, clean_array, clean_text, text_of, texts_of


@dataclass(frozen=True)
class PageLayout:
    """Where title, blocks and the fallback text live in a page."""

    title: Sel | None
    scope: tuple[Sel, ...]
    block: Sel | None = None
    para: str = "p"
    fallback_scope: tuple[Sel, ...] = ()
    fallback_child: str = "div"
    min_length: int = MIN_BLOCK_LENGTH
    title_glue: str = ""
    block_glue: str = ""
    fallback_glue: str = " "


# The news layout of the bilingual site, and the article
# layout of the test pages (title h1, blocks p in article).
NEWS_LAYOUT = PageLayout(
    title=Sel("h2", cls="title-detail"),
    scope=(Sel("div", cls="article-content"), Sel("div", cls="page-description")),
    block=Sel("div", id="paragraphBlock"),
    fallback_scope=(Sel("div", cls="postbox__content"), Sel("div", cls="postbox__text")),
)
ARTICLE_LAYOUT = PageLayout(title=Sel("h1"), scope=(Sel("article"),))


def _empty() -> Column:
    return F.array().cast("array<string>")


def up_to(sel: Sel, end: str) -> str:
    """Regex whose group 1 is what follows the first opening tag of ``sel``, up to the tag ``end`` or all of it."""
    return rf"{sel.open()}((?:[^<]++|(?!{end})<)*+)"


def title_raw(html: Column, layout: PageLayout) -> Column:
    """Tag-stripped text of the first title element ('' when none)."""
    if layout.title is None:
        return F.lit("")
    return text_of(F.regexp_extract(html, up_to(layout.title, layout.title.close()), 1), layout.title_glue)


def title_column(html: Column, layout: PageLayout) -> Column:
    return clean_text(title_raw(html, layout))


def selectors(layout: PageLayout) -> list[Sel]:
    """All element selectors of a layout, each once."""
    return list(dict.fromkeys([*layout.scope, *([layout.block] if layout.block else []), *layout.fallback_scope]))


def _located(df: DataFrame, html: str, layout: PageLayout) -> tuple[DataFrame, dict[Sel, Column]]:
    """One pass over the tags of each name that the layout asks for; the elements of each selector."""
    found: dict[Sel, Column] = {}
    sels = selectors(layout)
    for n, tag in enumerate(dict.fromkeys(s.tag for s in sels)):
        named = tuple(s for s in sels if s.tag == tag)
        # Pages that hold none of the names or ids are not walked.
        marks = [s.cls or s.id for s in named]
        hit = F.lit(True)
        if all(marks):
            hit = F.lit(False)
            for m in marks:
                hit = hit | F.col(html).contains(m)
        df = df.withColumn(f"_el{n}", F.when(hit, elements(F.col(html), tag, named)).otherwise(
            F.array().cast("array<struct<o:int,s:int,e:int,m:int>>")))
        found |= {s: matching(F.col(f"_el{n}"), i) for i, s in enumerate(named)}
    return df, found


def _chained(df: DataFrame, found: dict[Sel, Column], chain: tuple[Sel, ...], out: str) -> DataFrame:
    """Add ``out``: the elements of the chain's last selector inside elements of the one before, and so on."""
    for n, sel in enumerate(chain):
        df = df.withColumn(out, found[sel] if not n else within(found[sel], F.col(out)))
    return df


def raw_paragraphs(html: Column, found: Column, layout: PageLayout) -> Column:
    """Inner HTML of the first paragraph of each block, or of each paragraph of the outermost scopes."""
    para = Sel(layout.para)
    end = rf"{para.close()}|{para.open()}"
    if layout.block is not None:
        # one pattern, compiled once; a split compiles its own for every block
        return F.transform(found, lambda x: F.regexp_extract(content(html, x), up_to(para, end), 1))
    pieces = F.transform(outermost(found), lambda x: F.split(content(html, x), para.open(), -1))
    first = F.flatten(F.transform(pieces, lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1)))))
    return F.transform(first, lambda p: F.get(F.split(p, end, 2), 0))


def _fallback_stage(df: DataFrame, layout: PageLayout, found: dict[Sel, Column], html: str, when_col: str) -> DataFrame:
    """Add ``fallback`` (computed only for rows where ``when_col`` is false).

    The container is the first inner element, in document order, whose parent
    is an outer one: the last outer element that holds it, with nothing left
    open between the two.
    """
    if not layout.fallback_scope:
        return df.withColumn("fallback", _empty())
    outer, inner = layout.fallback_scope
    s1 = df.withColumn("_fb_outer", F.when(~F.col(when_col), found[outer])) \
        .withColumn("_fb_pairs", F.transform(within(found[inner], F.col("_fb_outer")), lambda x: F.struct(
            x.alias("x"), F.array_max(F.transform(F.filter("_fb_outer", lambda a: (a["s"] <= x["o"]) & (x["o"] < a["e"])),
                                                  lambda a: a["s"])).alias("s"))))
    s2 = s1.withColumn("_fb_at", F.get(F.filter("_fb_pairs", lambda p: closed(
        cut(F.col(html), p["s"], p["x"]["o"]))), 0)["x"])
    s3 = s2.withColumn("_fb_region", content(F.col(html), F.col("_fb_at")))
    kind = "^" + Sel(layout.fallback_child).open()
    s4 = s3.withColumn("_fb_items", F.filter(children(F.col("_fb_region")), lambda c: c["tag"].rlike(kind)))
    s5 = s4.withColumn("_fb_children", F.transform("_fb_items", lambda c: content(F.col("_fb_region"), c)))
    s6 = s5.withColumn("_fb_texts", F.when(
        F.size("_fb_children") > 0,
        F.array_distinct(F.filter(clean_array(texts_of("_fb_children", layout.fallback_glue)),
                                  lambda t: t != "")))) \
        .withColumn("_fb_whole", F.when(F.size("_fb_children") == 0, text_of("_fb_region", layout.fallback_glue)))
    s7 = s6.withColumn("_fb_whole", clean_text(F.col("_fb_whole")))
    fb = (F.when(F.col("_fb_region").isNull(), _empty())
          .when(F.size("_fb_children") > 0, F.col("_fb_texts"))
          .when(F.col("_fb_whole") != "", F.array(F.col("_fb_whole")))
          .otherwise(_empty()))
    return s7.withColumn("fallback", fb).drop(*[f"_fb_{c}" for c in (
        "outer", "pairs", "at", "region", "items", "children", "texts", "whole")])


def extract(pages: DataFrame, layout: PageLayout = NEWS_LAYOUT, html_col: str = "html",
            keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """pages -> (keep..., title, blocks, has_blocks, fallback).

    ``blocks``: cleaned texts of at least ``min_length`` characters of the
    block paragraphs; ``fallback`` is only filled when the page has no block
    elements, as the fallback layout is only tried then.
    """
    s0 = pages.select(*[F.col(k) for k in keep], visible(F.coalesce(F.col(html_col), F.lit(""))).alias("_html"))
    s1, found = _located(s0, "_html", layout)
    chain = (*layout.scope, layout.block) if layout.block else layout.scope
    s1 = _chained(s1, found, chain, "_found")
    s2 = s1.select("*", title_raw(F.col("_html"), layout).alias("_title"),
                   raw_paragraphs(F.col("_html"), F.col("_found"), layout).alias("_paras"))
    s3 = s2.select("*", (F.size("_paras") > 0).alias("has_blocks"),
                   clean_array(texts_of("_paras", layout.block_glue)).alias("_texts"),
                   clean_text(F.col("_title")).alias("title"))
    s4 = s3.select("*", F.filter("_texts", lambda t: F.length(t) >= layout.min_length).alias("blocks"))
    s5 = _fallback_stage(s4, layout, found, "_html", "has_blocks")
    return s5.select(*[F.col(k) for k in keep], "title", "blocks", "has_blocks", "fallback")


def rows_of(extracted: DataFrame, texts: str, pos: str = "i", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(keep..., pos, text): one row per text of an array column of ``extract``.

    The outer form of explode lets Catalyst infer no filter on the array, which
    it would push below with a second copy of the whole extraction; rows of
    empty arrays are dropped after it.
    """
    return extracted.select(*keep, F.posexplode_outer(texts).alias(pos, "text")).filter(F.col(pos).isNotNull())
