"""Inputs in the reference's shapes, derived from the test tables.

The test tables hold no Khmer and no pages in the news layout, so these
views derive them, with the same rule in Spark (here) and in the DuckDB
oracle (``oracle.py``).  Every view reads whole tables; nothing is sampled.

* ``bi_docs``: each document is a page; its lines are blocks; the first
  half of the lines is made Khmer by mapping a..z onto U+1780..U+1799;
  where ``doc_id % 3 <> 0`` a '- - -' block separates the halves.
* ``main_pages`` / ``fallback_pages``: ``bi_docs`` written as HTML in the
  news layout and in its fallback layout.
* ``sides``: ``embeddings`` as alignment input: pages of 30 vectors
  (``vec_id div 30``), every third vector Khmer, the others English.
* ``fetch_log``, ``seeds``, ``page_links``, ``snapshots``, ``api_pages``:
  fetch results, seed lists, link snapshots and paged JSON listings built
  from ``pages`` and ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duoweave.functions.text import SEPARATOR_TOKENS
from duoweave.sources.tables import read_table

# Fixed values of the derived fixtures.
LATIN_LOWER = "abcdefghijklmnopqrstuvwxyz"
KHMER_26 = "".join(chr(0x1780 + k) for k in range(26))  # U+1780..U+1799
SIDES_PAGE = 30
SNAPSHOT_PAGES = 10
API_PAGE_SIZE = 100
API_ERROR_EVERY = 17
NEWS_BASE = "https://news.example.kh/news/"
HUB_SUFFIX = ".org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _esc(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n, pos, line): every line of every document."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    return d.select("doc_id", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))


def khmerize(c):
    return F.translate(F.lower(c), LATIN_LOWER, KHMER_26)


def bi_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n, pos, text): first half of each document's lines in Khmer letters."""
    lines = doc_lines(spark, sf_dir)
    half = F.floor(F.col("n") / 2)
    return lines.select("doc_id", "n", "pos",
                        F.when(F.col("pos") < half, khmerize(F.col("line")))
                        .otherwise(F.col("line")).alias("text"))


def bi_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, blocks array<string>): one row per document, no shuffle."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    n = F.size("lines")
    half = F.floor(n / 2).cast("int")
    # a column of its own, so that lines are mapped once
    b = d.select("doc_id", n.alias("n"), half.alias("half"), F.transform(
        "lines", lambda x, i: F.when(i < half, khmerize(x)).otherwise(x)).alias("blocks"))
    sep = F.concat(F.slice("blocks", 1, F.col("half")), F.array(F.lit(SEPARATOR_TOKENS[0])),
                   F.slice("blocks", F.col("half") + 1, F.col("n")))
    return b.select("doc_id", F.when(F.col("doc_id") % 3 != 0, sep).otherwise(F.col("blocks")).alias("blocks"))


def main_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html) in the news layout: block 0 is the title."""
    b = bi_docs(spark, sf_dir)
    body = F.array_join(F.transform(
        F.slice("blocks", 2, F.greatest(F.size("blocks"), F.lit(1))),
        lambda x: F.concat(F.lit('<div id="paragraphBlock"><p>'), _esc(x), F.lit("</p></div>"))), "")
    html = F.concat(
        F.lit('<html><body><div class="article-content"><h2 class="title-detail">'),
        _esc(F.get(F.col("blocks"), 0)),
        F.lit('</h2><div class="page-description">'), body,
        F.lit("</div></div></body></html>"))
    return b.select(F.col("doc_id").alias("page_id"),
                    F.concat(F.lit(NEWS_BASE), F.col("doc_id").cast("string")).alias("url"),
                    html.alias("html"))


def fallback_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html) in the fallback layout; every 4th page without child divs."""
    b = bi_docs(spark, sf_dir)
    children = F.array_join(F.transform(
        "blocks", lambda x: F.concat(F.lit("<div>"), _esc(x), F.lit("</div>"))), "")
    plain = F.array_join(F.transform(
        "blocks", lambda x: F.concat(F.lit("<p>"), _esc(x), F.lit("</p>"))), "")
    inner = F.when(F.col("doc_id") % 4 == 0, plain).otherwise(children)
    html = F.concat(F.lit('<html><body><div class="postbox__content"><div class="postbox__text">'),
                    inner, F.lit("</div></div></body></html>"))
    return b.select(F.col("doc_id").alias("page_id"),
                    F.concat(F.lit(NEWS_BASE), F.col("doc_id").cast("string")).alias("url"),
                    html.alias("html"))


def _hard(line, kinds: list[tuple[str, str]], at):
    """A line inside the ``at``-th of several markups (before, after), escaped by number and by name."""
    safe = F.replace(F.replace(line, F.lit("&"), F.lit("&#38;")), F.lit("<"), F.lit("&lt;"))
    out = None
    for n, (before, after) in enumerate(kinds):
        text = F.concat(F.lit(before), safe, F.lit(after))
        out = F.when(at == n, text) if out is None else out.when(at == n, text)
    return out


#: Markups of a main-layout block; the last one has no paragraph, so its line is no text of the page.
HARD_BLOCKS = [
    ('<div id="paragraphBlock"><p>', "</p></div>"),
    ("<DIV class='x' ID='paragraphBlock'><div><P title=\"a > b\">", "</P></div><p>second</p></DIV>"),
    ("<div id=paragraphBlock><!-- <p>hidden</p> --><p>", "<!-- a > b --></p></div>"),
    ('<div id="paragraphBlock"><script>var p = "<p>no</p>";</script><p>',
     '</p></div><div data-id="paragraphBlock"><p>not a block</p></div>'),
    ('<div id="paragraphBlock"><span>', "</span></div>"),
]
#: Markups in the fallback container; the last one is no direct child, so its line is no text of the page.
HARD_CHILDREN = [
    ("<div><b>", "</b><div></div></div>"),
    ("<DIV class='a > b'><div><div>", "</div></div><!-- x --></DIV>"),
    ("<ul><li><div>", "</div></li></ul><p>loose</p>"),
]


def hard_pages(spark: SparkSession, sf_dir: str, fallback: bool = False) -> DataFrame:
    """(page_id, html): each document's lines amid comments, scripts, asides, nested divs, other quotes and cases."""
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    kinds = HARD_CHILDREN if fallback else HARD_BLOCKS
    body = F.array_join(F.transform("lines", lambda x, i: _hard(x, kinds, i % len(kinds))), "")
    if fallback:
        before = ('<div class="lead postbox__content"><p>intro</p><!-- <div class="postbox__text"> -->'
                  "<DIV class='postbox__text x'>")
        after = '</DIV><div>after</div></div><div class="postbox__text"><div>outside</div></div>'
    else:
        before = ('<aside><div id="paragraphBlock"><p>aside text</p></div></aside>'
                  "<div class='lead article-content'><h2>no title</h2><div><DIV class=page-description>")
        after = ('</DIV><div id="paragraphBlock"><p>beside the scope</p></div></div></div>'
                 '<div id="paragraphBlock"><p>after the scope</p></div><footer><p>footer text</p></footer>')
    return d.select("page_id", F.concat(F.lit("<html><body>" + before), body, F.lit(after + "</body></html>")).alias("html"))


def _body(sf: DataFrame, parts: list) -> DataFrame:
    return sf.select("page_id", F.concat(F.lit("<html><body>"), *parts, F.lit("</body></html>")).alias("html"))


def _line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))


def multi_pages(spark: SparkSession, sf_dir: str, fallback: bool = False) -> DataFrame:
    """(page_id, html): a document's lines dealt to several containers by line number.

    Main layout: four scopes in two outer containers (one scope holds another
    outer container), and blocks outside of any.  Fallback: an outer container
    without a direct inner one before the one that has it.
    """
    d = _line_pages(spark, sf_dir)

    def lines(n: int, before: str, after: str):
        kept = F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda v: v["i"] % 4 == n)
        return F.array_join(F.transform(kept, lambda v: F.concat(F.lit(before), _esc(v["x"]), F.lit(after))), "")

    if fallback:
        return _body(d, [
            F.lit('<div class="postbox__content"><section><div class="postbox__text">'), lines(0, "<div>", "</div>"),
            F.lit('</div></section></div><div class="postbox__text"><div>no parent</div></div><div class="postbox__content">'
                  '<p>lead</p><div class="x"><div class="postbox__text"><div>too deep</div></div></div>'
                  '<div class="postbox__text">'), lines(1, "<div>", "</div>"), lines(2, "<div><i>", "</i></div>"),
            F.lit('</div><div class="postbox__text"><div>second</div></div></div>'), lines(3, "<p>", "</p>")])
    block = ('<div id="paragraphBlock"><p>', "</p></div>")
    return _body(d, [
        F.lit('<div class="article-content"><div class="page-description">'), lines(0, *block),
        F.lit('</div><div><div class="wide page-description">'), lines(1, *block),
        F.lit('<div class="article-content">'), lines(2, *block), F.lit('</div></div></div></div>'
              '<div class="page-description"><div id="paragraphBlock"><p>no outer container</p></div></div>'
              '<div class="article-content"><div class="other">'), F.lit(block[0] + "no scope" + block[1]),
        F.lit('</div><DIV class=page-description>'), lines(3, *block), F.lit("</DIV></div>")])


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html): blocks in blocks.

    Lines 0, 3, .. are blocks of their own, lines 1, 4, .. stand in an outer
    and an inner block each, lines 2, 5, .. only in the inner one of two.
    """
    d = _line_pages(spark, sf_dir)
    one, other = F.lit('<div id="paragraphBlock"><p>'), F.lit("</p></div>")

    def block(x, i):
        safe = _esc(x)
        return F.when(i % 3 == 0, F.concat(one, safe, other)) \
            .when(i % 3 == 1, F.concat(one, safe, F.lit("</p>"), one, safe, F.lit(" inner"), other, F.lit("</div>"))) \
            .otherwise(F.concat(F.lit('<div id="paragraphBlock"><span>none</span>'), one, safe, other, F.lit("</div>")))

    body = F.array_join(F.transform("lines", block), "")
    return _body(d, [F.lit('<div class="article-content"><div class="page-description">'), body, F.lit("</div></div>")])


def angle_pages(spark: SparkSession, sf_dir: str, fallback: bool = False) -> DataFrame:
    """(page_id, html): lines followed by a bare <, a > in a quoted attribute and a quote that is not closed."""
    d = _line_pages(spark, sf_dir)
    tail = F.lit(""" < two <b title="x > y">bold</b><i class='a>b' lang=don't>it</i>""")
    if fallback:
        body = F.array_join(F.transform("lines", lambda x: F.concat(F.lit("<div>"), _esc(x), tail, F.lit("</div>"))), "")
        return _body(d, [F.lit('<div class="postbox__content"><div class="postbox__text">'), body, F.lit("</div></div>")])
    body = F.array_join(F.transform("lines", lambda x: F.concat(
        F.lit('<div id="paragraphBlock"><p data-n="1 > 0">'), _esc(x), tail, F.lit("</p></div>"))), "")
    return _body(d, [F.lit('<div class="article-content"><div class="page-description">'), body, F.lit("</div></div>")])


def hub_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): hub pages made from ``pages``, with cells, a cell without link, and links elsewhere."""
    p = table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<a href='/before'>x</a><!-- <div id=\"blog-one-page\"> --><DIV ID='blog-one-page'>"
              "<div class='tp-blog__link'><a data-href='no' HREF='/n/"), n, F.lit("?a=1&amp;b=2'>x</a><a href='/second'>y</a></div>"
              '<div class="tp-blog__link"><div>none</div></div><a href="/between">z</a>'
              '<div class="wide tp-blog__link"><div><a class=q href=/m/'), n, F.lit(">w</a></div></div></DIV>"
              '<div class="tp-blog__link"><a href="/outside">o</a></div><footer><a href="/footer">f</a></footer>'))
    return p.select("page_id", F.concat(F.col("url"), F.lit(".kh")).alias("url"), html.alias("html"))


def hub_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, url): the hubs' URLs (padded) and the pages' own."""
    p = table(spark, sf_dir, "pages")
    hub = p.select((2 * F.col("page_id")).alias("pos"), F.concat(F.lit(" "), F.col("url"), F.lit(".kh ")).alias("url"))
    return hub.unionByName(p.select((2 * F.col("page_id") + 1).alias("pos"), F.concat("url", F.lit("#x")).alias("url")))


def hard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): four links per page in the writings that browsers accept."""
    p = table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    html = F.concat(
        F.lit('<a data-href="/news/no" href="/news/a/'), n, F.lit("/\">x</a><A HREF='/news/b?x=1&amp;y="), n,
        F.lit("'>y</A><!-- <a href='/news/hidden'> --><a href = /news/../news/c/./"), n,
        F.lit("/>z</a><a\nclass='q' href=\"/news/d&#47;"), n, F.lit('//">w</a><a name="/news/e">v</a>'))
    return p.select("page_id", "url", html.alias("html"))


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, side, idx, vec array<double>) from ``embeddings``."""
    e = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") / SIDES_PAGE).cast("bigint").alias("page_id"),
        F.when(F.col("vec_id") % 3 == 0, F.lit("km")).otherwise(F.lit("en")).alias("side"),
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    w = Window.partitionBy("page_id", "side").orderBy("vec_id")
    return e.select("page_id", "side", (F.row_number().over(w) - 1).alias("idx"), "vec")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, url, status, content_type, html): one fetch result per page; some broke off without a status."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        (F.col("page_id") + 1).alias("pos"), "url",
        F.when(F.col("page_id") % 13 == 5, F.lit(None)).when(F.col("page_id") % 11 == 0, F.lit(404))
        .otherwise(F.lit(200)).alias("status"),
        F.when(F.col("page_id") % 7 == 0, F.lit("application/pdf"))
        .otherwise(F.lit("Text/HTML; charset=utf-8")).alias("content_type"),
        "html")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, page_id, url): every 4th seed cut to scheme and host (a hub)."""
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    return p.select(F.col("page_id").alias("pos"), "page_id",
                    F.when(F.col("page_id") % 4 == 0, host).otherwise(F.col("url")).alias("url"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, pos, href): every anchor href of every page."""
    p = table(spark, sf_dir, "pages")
    hrefs = F.regexp_extract_all("html", F.lit(r'<a\b[^>]*\bhref="([^"]*)"'), F.lit(1))
    return p.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snapshot, pos, href, height): links seen per scroll pass."""
    links = page_links(spark, sf_dir)
    snap = (F.col("page_id") / SNAPSHOT_PAGES).cast("bigint")
    return links.select(
        snap.alias("snapshot"),
        (F.col("page_id") * 100000 + F.col("pos")).cast("bigint").alias("pos"),
        "href",
        (F.lit(1000) * (snap / 2).cast("bigint")).cast("bigint").alias("height"))


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, body): raw JSON responses of a paged listing made from ``orders``.

    One page per ``API_PAGE_SIZE`` order keys; every ``API_ERROR_EVERY``-th
    page answers with ``errors`` in place of ``data``.
    """
    o = table(spark, sf_dir, "orders")
    total = o.agg(F.count(F.lit(1))).scalar()
    page = (F.floor(F.col("o_orderkey") / API_PAGE_SIZE) + 1).cast("int")
    item = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title_en"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderpriority").alias("description_en"),
        F.lit(None).cast("string").alias("thumbnail"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("summary_en"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_date"),
        F.col("o_orderstatus").alias("status"),
        F.struct((F.col("o_custkey") % 5).alias("id"),
                 F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string")).alias("name"),
                 F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string")).alias("name_en"),
                 ).alias("category"),
    )
    grouped = o.select(page.alias("page"), F.col("o_orderkey"), item.alias("item")) \
        .groupBy("page").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "item"))).alias("rows"))
    ok = F.to_json(F.struct(F.struct(F.struct(
        F.transform("rows", lambda r: r["item"]).alias("data"),
        F.struct(total.alias("total")).alias("pagination"),
    ).alias("publicNewsList")).alias("data")))
    err = F.to_json(F.struct(F.array(F.struct(F.concat(
        F.lit("page "), F.col("page").cast("string"), F.lit(" failed")).alias("message"))).alias("errors")))
    return grouped.select(
        "page", F.when(F.col("page") % API_ERROR_EVERY == 0, err).otherwise(ok).alias("body"))
