"""Registered queries: one per operator group, each with a DuckDB oracle.

Every query reads whole test tables (or views Spark derives from them).
Integer outputs are bigint, scores are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duoweave.functions.text import SEPARATOR_TOKENS, clean_array, clean_text, is_script, language_label, script_counts
from duoweave.functions.urls import in_domain, is_valid_url
from duoweave.operators import align as A
from duoweave.operators import links as L
from duoweave.operators import listing as LS
from duoweave.operators.encode import GivenVectors, ModelEncoder, NgramEncoder
from duoweave.operators.fetch import fetched_content, usable_response
from duoweave.functions.markup import Sel
from duoweave.operators.layout import ARTICLE_LAYOUT, NEWS_LAYOUT, extract, rows_of
from duoweave.operators.pairs import numbered_pairs, run_summary, to_pairs
from duoweave.operators.route import dedup_blocks, route
from duoweave.plans import fixtures as X
from duoweave.plans import oracle as O
from duoweave.plans.corpus import bi_content, corpus_pairs, fetch_pairs
from duoweave.session import ensure_checkpoint_dir, materialize
from duoweave.sources import commits
from duoweave.sources.listing import parse_listing
from duoweave.sources.sinks import read_csv, run_path, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DOMAIN = "example.com"
API_BASE = "https://news.example.kh/kh/news"
API_STATUS = "F"
API_CATEGORY = 3


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _bigints(fn(spark, sf_dir))
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = sql
        return wrapped
    return deco


def _bigints(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _r(c) -> F.Column:
    return F.round(c, 6)


def _sides_rows(english: str, khmer: str) -> F.Column:
    """inline() of (side, i, text) rows of two lists, in one pass."""
    en = F.transform(english, lambda t, i: F.struct(F.lit("english").alias("side"), i.alias("i"), t.alias("text")))
    km = F.transform(khmer, lambda t, i: F.struct(F.lit("khmer").alias("side"), i.alias("i"), t.alias("text")))
    return F.inline(F.concat(en, km))


# ---------------------------------------------------------------- text

@register("clean_lines", O.with_ctes(O.DOC_LINES) + f"""
SELECT doc_id, pos, {O.clean('line')} AS text FROM doc_lines""")
def clean_lines(spark, sf):
    """Every line of every document, cleaned."""
    return X.doc_lines(spark, sf).select("doc_id", "pos", clean_text("line").alias("text"))


@register("script_counts", O.with_ctes(O.DOC_LINES, O.BI_BLOCKS) + f"""
SELECT doc_id, pos, {O.kcount('text')}::BIGINT AS k, {O.lcount('text')}::BIGINT AS l FROM bi_blocks""")
def q_script_counts(spark, sf):
    """Khmer and Latin letter counts per block."""
    b = X.bi_blocks(spark, sf)
    k, l_ = script_counts("text")
    return b.select("doc_id", "pos", k.alias("k"), l_.alias("l"))


@register("language_label", O.with_ctes(O.DOC_LINES, O.BI_BLOCKS) + f"""
SELECT doc_id, pos, {O.is_khmer('text')} AS is_khmer,
       CASE WHEN {O.is_khmer('text')} THEN 'khmer' ELSE 'english' END AS lang FROM bi_blocks""")
def q_language_label(spark, sf):
    """is_khmer (share > 0.6) and the language label per block."""
    b = X.bi_blocks(spark, sf)
    return b.select("doc_id", "pos", is_script("text").alias("is_khmer"), language_label("text").alias("lang"))


# ---------------------------------------------------------------- URLs (B1, B2)

_URL_VARIANTS_SQL = r"""url_variants AS (
  SELECT page_id, v.variant, v.u AS url FROM (
    SELECT page_id, url,
           regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1) AS scheme,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS host
    FROM pages) p,
  unnest([
    {'variant': 'raw', 'u': url},
    {'variant': 'no_scheme', 'u': regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*:', '')},
    {'variant': 'bare', 'u': regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://', '')},
    {'variant': 'empty_host', 'u': scheme || '://'},
    {'variant': 'mailto', 'u': 'mailto:news@' || host},
    {'variant': 'open_bracket', 'u': scheme || '://[' || host || '/x'},
    {'variant': 'spaced_host', 'u': scheme || '://a b.' || host || '/x'},
    {'variant': 'upper', 'u': upper(url)},
    {'variant': 'padded', 'u': ' ' || chr(9) || url}
  ]) AS t(v)
)"""


def _url_variants(spark, sf):
    p = X.table(spark, sf, "pages").select(
        "page_id", "url",
        F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1).alias("scheme"),
        F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1).alias("host"))
    s, h, u = F.col("scheme"), F.col("host"), F.col("url")
    variants = [
        ("raw", u),
        ("no_scheme", F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")),
        ("bare", F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")),
        ("empty_host", F.concat(s, F.lit("://"))),
        ("mailto", F.concat(F.lit("mailto:news@"), h)),
        ("open_bracket", F.concat(s, F.lit("://["), h, F.lit("/x"))),
        ("spaced_host", F.concat(s, F.lit("://a b."), h, F.lit("/x"))),
        ("upper", F.upper(u)),
        ("padded", F.concat(F.lit(" \t"), u)),
    ]
    arr = F.array(*[F.struct(F.lit(n).alias("variant"), c.alias("url")) for n, c in variants])
    return p.select("page_id", F.inline(arr))


@register("url_check", O.with_ctes(_URL_VARIANTS_SQL) + f"""
SELECT page_id, variant, url, {O.valid_url('url')} AS valid FROM url_variants""")
def url_check(spark, sf):
    """B1: URL validity (scheme and authority, balanced brackets) on page URLs and variants."""
    v = _url_variants(spark, sf)
    return v.select("page_id", "variant", "url", is_valid_url("url").alias("valid"))


#: Hosts made from a page's number, and whether the URL is valid.
HOSTS = (("[2001:db8::@]", True), ("[::@]:8080", True), ("[1:2:3:4:5:6:7:@]", True), ("[1:2:3:4:5:6:7:8:@]", False), ("[@::1::2]", False),
         ("[fe80::@%eth0]", True), ("[fe80::@%]", False), ("[::1.2.3.@]", None), ("[1.2.3.4]", False), ("[v1.@]", True), ("[vx.@]", False),
         ("a\u2100@", False), ("\u00e9@.example", True), ("[::@", False))


@register("url_hosts", """
SELECT page_id, v.i, CASE WHEN v.i = 7 THEN p.n < 256 ELSE v.ok END AS valid
FROM (SELECT page_id, page_id % 10000 AS n FROM pages) p, (VALUES """ + ", ".join(
    f"({i}::BIGINT, {str(bool(ok)).lower()})" for i, (_, ok) in enumerate(HOSTS)) + ") v(i, ok)")
def url_hosts(spark, sf):
    """B1: bracketed hosts, zones, future addresses and characters that normalise to marks, one of each per page."""
    n = F.pmod(F.col("page_id"), F.lit(10000)).cast("string")
    urls = F.array(*[F.concat(F.lit("http://"), F.replace(F.lit(h), F.lit("@"), n), F.lit("/x")) for h, _ in HOSTS])
    p = X.table(spark, sf, "pages").select("page_id", F.posexplode(urls).alias("i", "url"))
    return p.select("page_id", "i", is_valid_url("url").alias("valid"))


@register("domain_flag", f"""
SELECT page_id, url,
       contains(regexp_extract({O.prepared_url('url')}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1),
                {O.lit(DOMAIN)}) AS in_domain
FROM pages""")
def domain_flag(spark, sf):
    """B2: domain flag on the authority (never a filter)."""
    p = X.table(spark, sf, "pages")
    return p.select("page_id", "url", in_domain("url", DOMAIN).alias("in_domain"))


# ---------------------------------------------------------------- fetch

@register("usable_pages", O.with_ctes(O.FETCH_LOG) + """
SELECT pos, url, status::BIGINT AS status, (coalesce(status = 200, false) AND contains(lower(coalesce(content_type, '')), 'html')) AS usable
FROM fetch_log""")
def usable_pages(spark, sf):
    """Status 200 and an HTML content type."""
    f = X.fetch_log(spark, sf)
    return f.select("pos", "url", "status", usable_response().alias("usable"))


@register("keep_failed", O.with_ctes(O.FETCH_LOG) + f"""
SELECT pos AS id, url, valid, usable,
       CASE WHEN usable THEN len(english) ELSE 0 END::BIGINT AS n_english,
       CASE WHEN usable THEN len(khmer) ELSE 0 END::BIGINT AS n_khmer,
       CASE WHEN usable THEN array_to_string(english, '|') ELSE '' END AS english_texts,
       CASE WHEN usable THEN array_to_string(khmer, '|') ELSE '' END AS khmer_texts
FROM (
  SELECT *, CASE WHEN sep > 0 AND len(khmer) = len(english0) + 1 THEN list_concat([''], english0)
                 ELSE english0 END AS english
  FROM (
    SELECT pos, url, valid, valid AND ok AS usable, sep,
           CASE WHEN NOT has_blocks THEN []::VARCHAR[]
                WHEN sep > 0 THEN list_concat(title_k, list_filter(list_slice(blocks, 1, greatest(sep - 1, 0)), lambda b: {O.keep('b')}))
                ELSE list_concat(title_k, list_filter(blocks, lambda b: {O.keep('b')} AND {O.is_khmer('b')})) END AS khmer,
           CASE WHEN NOT has_blocks THEN []::VARCHAR[]
                WHEN sep > 0 THEN list_concat(title_e, list_filter(list_slice(blocks, sep + 1, len(blocks)), lambda b: {O.keep('b')}))
                ELSE list_concat(title_e, list_filter(blocks, lambda b: {O.keep('b')} AND NOT {O.is_khmer('b')})) END AS english0
    FROM (
      SELECT *, coalesce(list_position(list_transform(blocks, lambda b: b IN {O.TOKENS}), true), 0) AS sep,
             CASE WHEN title <> '' AND {O.is_khmer('title')} THEN [title] ELSE []::VARCHAR[] END AS title_k,
             CASE WHEN title <> '' AND NOT {O.is_khmer('title')} THEN [title] ELSE []::VARCHAR[] END AS title_e
      FROM (
        SELECT pos, url, {O.valid_url('url')} AS valid,
               (coalesce(status = 200, false) AND contains(lower(coalesce(content_type, '')), 'html')) AS ok,
               {O.article_title('html')} AS title, {O.article_blocks('html')} AS blocks,
               {O.article_has_blocks('html')} AS has_blocks
        FROM fetch_log))))""")
def keep_failed(spark, sf):
    """One row per input URL with its position as id; failed inputs get empty lists."""
    c = fetched_content(X.fetch_log(spark, sf), ARTICLE_LAYOUT)
    return c.select(F.col("pos").alias("id"), "url", "valid", "usable",
                    F.size("english").alias("n_english"), F.size("khmer").alias("n_khmer"),
                    F.array_join("english", "|").alias("english_texts"), F.array_join("khmer", "|").alias("khmer_texts"))


@register("fetch_pairs", O.with_ctes(O.FETCH_LOG) + f"""
SELECT row_number() OVER (ORDER BY pos, i)::BIGINT AS id, pos, i, english_text, khmer_text FROM (
  SELECT pos, (u.o - 1)::BIGINT AS i, u.t AS english_text, '' AS khmer_text
  FROM (
    SELECT pos, CASE WHEN len(texts) = 0 THEN [''] ELSE texts END AS texts FROM (
      SELECT pos, CASE WHEN usable THEN list_concat(CASE WHEN title <> '' AND len(blocks) > 0 THEN [title] ELSE []::VARCHAR[] END,
                                                     list_filter(blocks, lambda b: {O.keep('b')}))
                       ELSE []::VARCHAR[] END AS texts
      FROM (SELECT pos, {O.valid_url('url')} AND coalesce(status = 200, false)
                        AND contains(lower(coalesce(content_type, '')), 'html') AS usable,
                   {O.article_title('html')} AS title, {O.article_blocks('html')} AS blocks FROM fetch_log))) q,
    unnest(q.texts) WITH ORDINALITY AS u(t, o))""")
def q_fetch_pairs(spark, sf):
    """Fetch log to numbered pairs in one plan; failed inputs are one blank row each."""
    return fetch_pairs(X.fetch_log(spark, sf), ARTICLE_LAYOUT).select("id", "pos", "i", "english_text", "khmer_text")


# ---------------------------------------------------------------- layout

@register("hard_main_layout", O.with_ctes(O.DOC_LINES) + f"""
SELECT doc_id AS page_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::BIGINT AS i, text
FROM (SELECT doc_id, pos, {O.clean('line')} AS text FROM doc_lines WHERE pos % 5 <> 4)
WHERE length(text) >= 3""")
def hard_main_layout(spark, sf):
    """D2, D3 on pages with asides, comments, scripts, nested divs, other quotes and cases; the oracle reads the documents."""
    e = materialize(extract(X.hard_pages(spark, sf), NEWS_LAYOUT))
    return e.select("page_id", F.posexplode("blocks").alias("i", "text"))


@register("hard_fallback_layout", O.with_ctes(O.DOC_LINES) + f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::BIGINT AS i, text FROM (
  SELECT doc_id AS page_id, text, min(pos) AS pos
  FROM (SELECT doc_id, pos, {O.clean('line')} AS text FROM doc_lines WHERE pos % 3 <> 2)
  WHERE text <> '' GROUP BY doc_id, text)""")
def hard_fallback_layout(spark, sf):
    """D4 on pages whose container has other children and nested divs; the oracle reads the documents."""
    e = materialize(extract(X.hard_pages(spark, sf, fallback=True), NEWS_LAYOUT))
    return e.select("page_id", F.posexplode("fallback").alias("i", "text"))


@register("multi_container", O.with_ctes(O.DOC_LINES) + f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos % 4, pos) - 1)::BIGINT AS i, text
FROM (SELECT doc_id AS page_id, pos, {O.clean('line')} AS text FROM doc_lines) WHERE length(text) >= 3""")
def multi_container(spark, sf):
    """Blocks of all containers of a page, some inside each other; the oracle reads the documents."""
    return rows_of(extract(X.multi_pages(spark, sf), NEWS_LAYOUT), "blocks")


@register("multi_fallback", O.with_ctes(O.DOC_LINES) + f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY kind, pos) - 1)::BIGINT AS i, text FROM (
  SELECT doc_id AS page_id, text, min(pos % 4) AS kind, arg_min(pos, (pos % 4) * 1000000 + pos) AS pos
  FROM (SELECT doc_id, pos, {O.clean('line')} AS text FROM doc_lines WHERE pos % 4 IN (1, 2))
  WHERE text <> '' GROUP BY doc_id, text)""")
def multi_fallback(spark, sf):
    """The first inner container whose parent is an outer one, after others that are not; the oracle reads the documents."""
    return rows_of(extract(X.multi_pages(spark, sf, fallback=True), NEWS_LAYOUT), "fallback")


@register("nested_blocks", O.with_ctes(O.DOC_LINES) + f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos, nth) - 1)::BIGINT AS i, text FROM (
  SELECT doc_id AS page_id, pos, nth, {O.clean("CASE WHEN pos % 3 = 1 AND nth = 1 THEN line || ' inner' ELSE line END")} AS text
  FROM doc_lines, (SELECT unnest([0, 1]) AS nth) WHERE nth = 0 OR pos % 3 <> 0)
WHERE length(text) >= 3""")
def nested_blocks(spark, sf):
    """A block in a block gives its own first paragraph and is searched by the outer one; the oracle reads the documents."""
    return rows_of(extract(X.nested_pages(spark, sf), NEWS_LAYOUT), "blocks")


@register("bare_angle", O.with_ctes(O.DOC_LINES) + f"""
SELECT page_id, kind, (row_number() OVER (PARTITION BY page_id, kind ORDER BY pos) - 1)::BIGINT AS i, text FROM (
  SELECT doc_id AS page_id, 'main' AS kind, pos, {O.clean("line || ' < twoboldit'")} AS text FROM doc_lines
  UNION ALL
  SELECT doc_id, 'fallback', min(pos), text
  FROM (SELECT doc_id, pos, {O.clean("line || ' < two bold it'")} AS text FROM doc_lines) GROUP BY doc_id, text)""")
def bare_angle(spark, sf):
    """A bare < is text, a > in a quoted attribute is not the tag's end; the oracle reads the documents."""
    main = rows_of(extract(X.angle_pages(spark, sf), NEWS_LAYOUT), "blocks").withColumn("kind", F.lit("main"))
    rest = rows_of(extract(X.angle_pages(spark, sf, fallback=True), NEWS_LAYOUT), "fallback")
    return main.unionByName(rest.withColumn("kind", F.lit("fallback")))


@register("page_title", f"""
SELECT page_id, {O.article_title('html')} AS title FROM pages""")
def page_title(spark, sf):
    """First title element, tag-stripped, entities decoded, cleaned."""
    return extract(X.table(spark, sf, "pages"), ARTICLE_LAYOUT).select("page_id", "title")


@register("page_blocks", f"""
SELECT page_id, (u.o - 1)::BIGINT AS pos, u.t AS text
FROM (SELECT page_id, {O.article_blocks('html')} AS b FROM pages) q, unnest(q.b) WITH ORDINALITY AS u(t, o)""")
def page_blocks(spark, sf):
    """Paragraph blocks of the article layout, cleaned, at least 3 characters."""
    e = extract(X.table(spark, sf, "pages"), ARTICLE_LAYOUT)
    return rows_of(e, "blocks", "pos")


@register("main_layout", O.with_ctes(O.BI_DOCS, O.BI_EXTRACTED) + """
SELECT page_id, -1::BIGINT AS pos, title AS text, has_blocks FROM bi_extracted WHERE title <> ''
UNION ALL
SELECT page_id, (u.o - 1)::BIGINT AS pos, u.t AS text, has_blocks
FROM bi_extracted, unnest(blocks) WITH ORDINALITY AS u(t, o)""")
def main_layout(spark, sf):
    """D1-D3 on generated news-layout pages: title row (pos -1) and block rows."""
    e = extract(X.main_pages(spark, sf), NEWS_LAYOUT)
    title = F.when(F.col("title") != "", F.array(F.struct(F.lit(-1).alias("pos"), F.col("title").alias("text")))) \
        .otherwise(F.array().cast("array<struct<pos:int,text:string>>"))
    blocks = F.transform("blocks", lambda t, i: F.struct(i.alias("pos"), t.alias("text")))
    return e.select("page_id", "has_blocks", F.inline_outer(F.concat(title, blocks))).filter("pos IS NOT NULL") \
        .select("page_id", "pos", "text", "has_blocks")


_FALLBACK_EXPECTED = f"""fb_rows AS (
  SELECT page_id, x AS t, min(o) AS o FROM (
    SELECT doc_id AS page_id, u.x, u.o
    FROM bi_docs, unnest(list_transform(blocks, lambda b: {O.clean('b')})) WITH ORDINALITY AS u(x, o)
    WHERE doc_id % 4 <> 0)
  WHERE x <> '' GROUP BY page_id, x
  UNION ALL
  SELECT page_id, whole AS t, 1 AS o FROM (
    SELECT doc_id AS page_id,
           {O.clean("array_to_string(list_filter(list_transform(blocks, lambda b: " + O.strip('b') + "), lambda t: t <> ''), ' ')")} AS whole
    FROM bi_docs WHERE doc_id % 4 = 0)
  WHERE whole <> ''
)"""


@register("fallback_layout", O.with_ctes(O.BI_DOCS, _FALLBACK_EXPECTED) + f"""
SELECT page_id, CASE WHEN {O.is_khmer('t')} THEN 'khmer' ELSE 'english' END AS side,
       (row_number() OVER (PARTITION BY page_id, {O.is_khmer('t')} ORDER BY o) - 1)::BIGINT AS i, t AS text
FROM fb_rows""")
def fallback_layout(spark, sf):
    """Fallback container children (first-seen dedup) or its whole text, labelled."""
    c = materialize(route(extract(X.fallback_pages(spark, sf), NEWS_LAYOUT)))
    return c.select("page_id", _sides_rows("english", "khmer"))


@register("block_dedup", O.with_ctes(O.DOC_LINES) + f"""
SELECT doc_id, min(pos) AS pos, text FROM (SELECT doc_id, pos, {O.clean('line')} AS text FROM doc_lines)
WHERE text <> '' GROUP BY doc_id, text""")
def block_dedup(spark, sf):
    """First occurrence of each cleaned line per document."""
    lines = X.doc_lines(spark, sf).select("doc_id", "pos", clean_text("line").alias("text"))
    return dedup_blocks(lines, key="doc_id")


# ---------------------------------------------------------------- routing

_BI = (O.BI_DOCS, O.BI_EXTRACTED, O.BI_ROUTE_PARTS)


def _bi_routed(spark, sf):
    """Routed news-layout pages with details, checkpointed: every query below
    filters on routing results, and a checkpoint keeps the optimizer from
    inlining the whole extraction into those filters."""
    return materialize(route(extract(X.main_pages(spark, sf), NEWS_LAYOUT), detail=True))


@register("separator_split", O.with_ctes(*_BI) + """
SELECT page_id, 'khmer' AS side, (u.o - 1)::BIGINT AS i, u.t AS text
FROM bi_route_parts, unnest(k0) WITH ORDINALITY AS u(t, o) WHERE has_blocks AND sep > 0
UNION ALL
SELECT page_id, 'english' AS side, (u.o - 1)::BIGINT AS i, u.t AS text
FROM bi_route_parts, unnest(e0) WITH ORDINALITY AS u(t, o) WHERE has_blocks AND sep > 0""")
def separator_split(spark, sf):
    """Blocks before the first separator are Khmer, after it English."""
    c = _bi_routed(spark, sf).filter(F.col("has_blocks") & (F.col("separator") > 0))
    return c.select("page_id", _sides_rows("e0", "k0"))


@register("title_place", O.with_ctes(*_BI) + """
SELECT page_id, CASE WHEN len(title_k) > 0 THEN 'khmer' ELSE 'english' END AS side, sep > 0 AS with_separator
FROM bi_route_parts WHERE has_blocks AND title <> ''""")
def title_place(spark, sf):
    """Which list the title opens."""
    c = _bi_routed(spark, sf).filter(F.col("has_blocks") & F.col("title_side").isNotNull())
    return c.select("page_id", F.col("title_side").alias("side"), (F.col("separator") > 0).alias("with_separator"))


@register("language_route", O.with_ctes(*_BI, O.BI_ROUTED) + """
SELECT page_id, 'khmer' AS side, (u.o - 1)::BIGINT AS i, u.t AS text
FROM bi_routed, unnest(khmer) WITH ORDINALITY AS u(t, o) WHERE has_blocks AND sep = 0
UNION ALL
SELECT page_id, 'english' AS side, (u.o - 1)::BIGINT AS i, u.t AS text
FROM bi_routed, unnest(english) WITH ORDINALITY AS u(t, o) WHERE has_blocks AND sep = 0""")
def language_route(spark, sf):
    """Pages without separator: title first, then each block by its label."""
    c = _bi_routed(spark, sf).filter(F.col("has_blocks") & (F.col("separator") == 0))
    return c.select("page_id", _sides_rows("english", "khmer"))


@register("heading_placeholder", O.with_ctes(*_BI, O.BI_ROUTED) + """
SELECT page_id, len(english)::BIGINT AS n_english, len(khmer)::BIGINT AS n_khmer, english[1] AS first_english
FROM bi_routed WHERE placeholder""")
def heading_placeholder(spark, sf):
    """One more Khmer than English entry with a separator: '' opens the English list."""
    c = _bi_routed(spark, sf).filter("placeholder")
    return c.select("page_id", F.size("english").alias("n_english"), F.size("khmer").alias("n_khmer"),
                    F.get(F.col("english"), 0).alias("first_english"))


@register("heading_rows", O.with_ctes(O.DOC_LINES) + f"""
SELECT d.doc_id AS page_id, (coalesce(f.n, 0) // 2 + coalesce(f.n, 0) % 2)::BIGINT AS n_english,
       ((coalesce(f.n, 0) + 1) // 2)::BIGINT AS n_khmer, CASE WHEN f.n % 2 = 1 THEN '' ELSE f.first END AS first_english,
       false AS needs_align
FROM documents d LEFT JOIN (
  SELECT doc_id, n, max(CASE WHEN r = n // 2 + 1 THEN t END) AS first FROM (
    SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r, count(*) OVER (PARTITION BY doc_id) AS n
    FROM (SELECT doc_id, pos, {O.clean('line')} AS t FROM doc_lines)
    WHERE length(t) >= 3 AND t NOT IN ('...', {', '.join(O.lit(t) for t in SEPARATOR_TOKENS)}))
  GROUP BY doc_id, n) f ON f.doc_id = d.doc_id""")
def heading_rows(spark, sf):
    """Every document's lines halved by a separator; where the first half has one more, '' opens the English list."""
    d = X.table(spark, sf, "documents")
    kept = F.filter(clean_array(F.split(F.coalesce("text", F.lit("")), "\n", -1)),
                    lambda t: (F.length(t) >= 3) & ~t.isin("...", *SEPARATOR_TOKENS))
    d = d.select(F.col("doc_id").alias("page_id"), kept.alias("kept"))
    half = F.ceil(F.size("kept") / 2).cast("int")
    blocks = F.concat(F.slice("kept", F.lit(1), half), F.array(F.lit("***")), F.slice("kept", half + 1, F.size("kept")))
    none = F.array().cast("array<string>")
    c = materialize(route(d.select("page_id", F.lit("").alias("title"), blocks.alias("blocks"), F.lit(True).alias("has_blocks"),
                                   none.alias("fallback"))))
    return c.select("page_id", F.size("english").alias("n_english"), F.size("khmer").alias("n_khmer"),
                    F.get(F.col("english"), 0).alias("first_english"), "needs_align")


@register("align_trigger", O.with_ctes(*_BI, O.BI_ROUTED, O.BI_CONTENT) + """
SELECT page_id, len(english)::BIGINT AS n_english, len(khmer)::BIGINT AS n_khmer, needs_align FROM bi_content""")
def align_trigger(spark, sf):
    """Per-page list sizes and whether alignment runs."""
    c = _bi_routed(spark, sf)
    return c.select("page_id", F.size("english").alias("n_english"), F.size("khmer").alias("n_khmer"),
                    "needs_align")


# ---------------------------------------------------------------- alignment on vectors (E-3..E-9)

def _sides_steps(spark, sf):
    s = X.sides(spark, sf).select("page_id", "side", "idx", "vec")
    return A.align_steps(s, GivenVectors("vec"))


@register("best_match", O.with_ctes(O.SIDES, O.SIDES_ALIGN) + """
SELECT page_id, j::BIGINT AS j, b::BIGINT AS i, round(base_score, 6) AS score FROM sd_best""")
def best_match(spark, sf):
    """E-3, E-4: per Khmer vector the English vector of its page with the highest cosine."""
    b = _sides_steps(spark, sf)["best"]
    return b.select("page_id", "j", "i", _r(F.col("score")).alias("score"))


@register("unused_english", O.with_ctes(O.SIDES, O.SIDES_ALIGN) + """
SELECT page_id, u::BIGINT AS i FROM sd_unused""")
def unused_english(spark, sf):
    """E-5: English entries no Khmer entry matched."""
    return _sides_steps(spark, sf)["unused"].select("page_id", "i")


@register("merge_candidates", O.with_ctes(O.SIDES, O.SIDES_ALIGN) + """
SELECT page_id, j::BIGINT AS j, b::BIGINT AS b, u::BIGINT AS u, round(score, 6) AS score FROM sd_cands""")
def merge_candidates(spark, sf):
    """E-6: score of every (pair, unused entry) with the summed vector."""
    c = _sides_steps(spark, sf)["candidates"]
    return c.select("page_id", "j", "b", "u", _r(F.col("score")).alias("score"))


@register("greedy_merge", O.with_ctes(O.SIDES, O.SIDES_ALIGN) + """
SELECT page_id, j::BIGINT AS j, b::BIGINT AS b, u::BIGINT AS u, round(base_score, 6) AS base_score,
       round(score, 6) AS score FROM sd_picks""")
def greedy_merge(spark, sf):
    """E-7, E-9: sequential greedy pick per page and the updated score."""
    g = _sides_steps(spark, sf)["picks"]
    return g.select("page_id", "j", "b", "u", _r(F.col("base_score")).alias("base_score"),
                    _r(F.col("score")).alias("score"))


# ---------------------------------------------------------------- alignment on text, pairs (E-2, E-8, F1-F5)

_BI_ALL = (*_BI, O.BI_ROUTED, O.BI_CONTENT, O.BI_ALIGN)


@register("aligned_text", O.with_ctes(*_BI_ALL) + """
SELECT a.page_id, (u.o - 1)::BIGINT AS i, u.t AS english_text, a.khmer[u.o] AS khmer_text
FROM bi_aligned a, unnest(a.english) WITH ORDINALITY AS u(t, o)""")
def aligned_text(spark, sf):
    """E-2..E-8 with the native n-gram encoder on pages that need alignment."""
    content = bi_content(spark, sf)
    todo = content.filter("needs_align")
    done = A.align_pages(todo, NgramEncoder())
    return done.select("page_id", F.posexplode(F.arrays_zip("english", "khmer")).alias("i", "z")).select(
        "page_id", "i", F.col("z.english").alias("english_text"), F.col("z.khmer").alias("khmer_text"))


_PAIRS_SQL = """pairs AS (
  SELECT page_id, i::BIGINT AS i, coalesce(english[i + 1], '') AS english_text,
         coalesce(khmer[i + 1], '') AS khmer_text
  FROM bi_final, range(greatest(len(english), len(khmer), 1)) AS r(i)
)"""


@register("pair_rows", O.with_ctes(*_BI_ALL, _PAIRS_SQL) + """
SELECT page_id, i, english_text, khmer_text FROM pairs""")
def pair_rows(spark, sf):
    """zip-longest rows; a page without text gives one ('', '') row."""
    return to_pairs(bi_content(spark, sf, aligned=True))


@register("pair_ids", O.with_ctes(*_BI_ALL, _PAIRS_SQL) + """
SELECT row_number() OVER (ORDER BY page_id, i)::BIGINT AS id, page_id, i FROM pairs""")
def pair_ids(spark, sf):
    """contiguous ids from 1 over page order, then row position."""
    return numbered_pairs(materialize(bi_content(spark, sf, aligned=True))).select("id", "page_id", "i")


@register("append_ids", O.with_ctes(*_BI_ALL, _PAIRS_SQL) + """
SELECT page_id % 2 AS batch, page_id, i,
       (CASE WHEN page_id % 2 = 0 THEN 0
             ELSE (SELECT count(*) FROM pairs WHERE page_id % 2 = 0) END
        + row_number() OVER (PARTITION BY page_id % 2 ORDER BY page_id, i))::BIGINT AS id
FROM pairs""")
def append_ids(spark, sf):
    """a second run appends after the highest id of the first."""
    # read by every append: the last steps of the alignment run once
    content = materialize(bi_content(spark, sf, aligned=True))
    first = numbered_pairs(content.filter(F.col("page_id") % 2 == 0))
    offset = first.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    second = numbered_pairs(content.filter(F.col("page_id") % 2 == 1), start=offset + 1)
    return first.select(F.lit(0).alias("batch"), "page_id", "i", "id").unionByName(
        second.select(F.lit(1).alias("batch"), "page_id", "i", "id"))


@register("append_commit", O.with_ctes(*_BI_ALL, _PAIRS_SQL) + """
SELECT page_id % 3 AS batch, page_id, i,
       ((SELECT count(*) FROM pairs q WHERE q.page_id % 3 < p.page_id % 3)
        + row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id, i))::BIGINT AS id
FROM pairs p""")
def append_commit(spark, sf):
    """Appends as transactions, with a stage that is given up, two writers at once and a repeated run."""
    # read by every append: the last steps of the alignment run once
    content = materialize(bi_content(spark, sf, aligned=True))
    part = [content.filter(F.col("page_id") % 3 == b) for b in range(3)]
    table = f"{ensure_checkpoint_dir(spark)}/tables/commits-{uuid.uuid4().hex}"
    commits.append(part[0], table, run="first")
    commits.stage(part[1], table)
    one, two = commits.stage(part[1], table), commits.stage(part[2], table)
    commits.publish(spark, table, one)
    commits.publish(spark, table, two)
    commits.append(part[0], table, run="first")
    return commits.read(spark, table).select((F.col("page_id") % 3).alias("batch"), "page_id", "i", "id")


@register("align_failure", O.with_ctes(*_BI_ALL) + """
SELECT page_id, i::BIGINT AS i, coalesce(english[i + 1], '') AS english_text, coalesce(khmer[i + 1], '') AS khmer_text
FROM bi_content, range(greatest(len(english), len(khmer), 1)) AS r(i)""")
def align_failure(spark, sf):
    """Where the model fails for the texts of a page, the page keeps its unaligned lists."""
    def load():
        def encode(texts):
            raise ValueError("no text can be encoded")
        return encode

    return to_pairs(A.align(bi_content(spark, sf), ModelEncoder(load, dims=4)))


@register("csv_rows", O.with_ctes(O.DOC_LINES) + """
SELECT (doc_id * 1000000 + pos)::BIGINT AS id, line AS english_text, '"' || line || '", ' || chr(10) || pos AS khmer_text
FROM doc_lines""")
def csv_rows(spark, sf):
    """Every line written to a run's CSV folder, beside itself with quotes, commas and line breaks, and read back."""
    pairs = X.doc_lines(spark, sf).select(
        (F.col("doc_id") * 1000000 + F.col("pos")).alias("id"), F.col("line").alias("english_text"),
        F.concat(F.lit('"'), "line", F.lit('", \n'), F.col("pos").cast("string")).alias("khmer_text"))
    path = run_path(f"{ensure_checkpoint_dir(spark)}/tables/csv-{uuid.uuid4().hex}")
    write_csv(pairs, path)
    return read_csv(spark, path).toDF("id", "english_text", "khmer_text")


@register("run_summary", O.with_ctes(*_BI_ALL) + """
SELECT count(*)::BIGINT AS pages, coalesce(sum(len(english)), 0)::BIGINT AS english_texts,
       coalesce(sum(len(khmer)), 0)::BIGINT AS khmer_texts FROM bi_final""")
def q_run_summary(spark, sf):
    """pages and text counts per language (the '' placeholder counts)."""
    return run_summary(bi_content(spark, sf, aligned=True))


@register("corpus_pairs", O.with_ctes(*_BI_ALL, _PAIRS_SQL) + """
SELECT row_number() OVER (ORDER BY page_id, i)::BIGINT AS id, english_text, khmer_text FROM pairs""")
def q_corpus_pairs(spark, sf):
    """Flagship: news-layout pages -> extract -> route -> align -> numbered pairs."""
    return corpus_pairs(X.main_pages(spark, sf)).select("id", "english_text", "khmer_text")


# ---------------------------------------------------------------- links

_SEEDS_SQL = r"""seeds AS (
  SELECT page_id AS pos, page_id,
         CASE WHEN page_id % 4 = 0 THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)
              ELSE url END AS url
  FROM pages
)"""


def _nav_cells_sql(html: str) -> str:
    region = f"regexp_extract({html}, '(?s)<nav\\b[^>]*>(.*?)</nav\\s*>', 1)"
    pieces = f"string_split_regex({region}, '<li\\b[^>]*>')"
    return (f"list_transform(list_slice({pieces}, 2, len({pieces})), lambda p: "
            f"regexp_extract(split_part(p, '</li>', 1), '<a\\b([^>]*)>', 1))")


@register("seed_expand", O.with_ctes(_SEEDS_SQL) + f"""
SELECT s.seed_pos, 0::BIGINT AS link_pos, s.url, false AS from_hub
FROM (SELECT pos AS seed_pos, {O.strip('url')} AS url FROM seeds) s
WHERE s.url <> '' AND NOT ends_with(s.url, {O.lit(X.HUB_SUFFIX)})
UNION ALL
SELECT h.seed_pos, (u.o - 1)::BIGINT AS link_pos, regexp_extract(u.a, '\\bhref\\s*=\\s*"([^"]*)"', 1) AS url,
       true AS from_hub
FROM (SELECT s.pos AS seed_pos, p.html FROM seeds s JOIN pages p ON p.page_id = s.page_id
      WHERE {O.strip('s.url')} <> '' AND ends_with({O.strip('s.url')}, {O.lit(X.HUB_SUFFIX)})
        AND regexp_matches(p.html, '(?s)<nav\\b[^>]*>')) h,
     unnest({_nav_cells_sql('h.html')}) WITH ORDINALITY AS u(a, o)
WHERE regexp_matches(u.a, '\\bhref\\s*=')""")
def seed_expand(spark, sf):
    """A1, A2: hub seeds replaced by their page's link cells (nav > li), others kept."""
    pages = X.table(spark, sf, "pages")
    return L.expand_seeds(X.seeds(spark, sf), pages, suffix=X.HUB_SUFFIX, container=Sel("nav"),
                          cell=Sel("li"), key="page_id")


@register("hub_links", """
SELECT (2 * page_id + 1)::BIGINT AS seed_pos, 0::BIGINT AS link_pos, url || '#x' AS url, false AS from_hub FROM pages
UNION ALL
SELECT (2 * p.page_id)::BIGINT, h.link_pos, replace(h.link, '@', q.page_id::VARCHAR), true
FROM pages p JOIN pages q ON p.url = q.url, (VALUES (0::BIGINT, '/n/@?a=1&b=2'), (2::BIGINT, '/m/@')) h(link_pos, link)""")
def hub_links(spark, sf):
    """A1, A2: hubs found by URL; links of cells inside the container only."""
    return L.expand_seeds(X.hub_seeds(spark, sf), X.hub_pages(spark, sf))


@register("hard_links", r"""
SELECT page_id, l.pos, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || replace(l.link, '@', page_id::VARCHAR) AS link
FROM pages, (VALUES (0::BIGINT, '/news/a/@'), (1::BIGINT, '/news/b?x=1&y=@'), (2::BIGINT, '/news/c/@'),
                    (3::BIGINT, '/news/d/@')) l(pos, link)""")
def hard_links(spark, sf):
    """Links in any quotes and case, with references and dot segments; the oracle knows what was meant."""
    return L.resolve(L.prefix_links(X.hard_links(spark, sf))).select("page_id", "pos", "link")


_ANCHORS_SQL = """anchors AS (
  SELECT page_id, url, (u.o - 1)::BIGINT AS pos, u.h AS href
  FROM pages, unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref\\s*=\\s*"([^"]*)"', 1)) WITH ORDINALITY AS u(h, o)
)"""


@register("prefix_links", O.with_ctes(_ANCHORS_SQL) + """
SELECT page_id, pos, href FROM anchors WHERE starts_with(href, '/')""")
def prefix_links(spark, sf):
    """A3: every anchor whose href starts with the prefix."""
    return L.prefix_links(X.table(spark, sf, "pages"), "/").select("page_id", "pos", "href")


@register("link_norm", O.with_ctes(_ANCHORS_SQL) + r"""
SELECT page_id, pos,
       regexp_replace(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || href, '/+\z', '', 'g')
         AS link
FROM anchors WHERE starts_with(href, '/') AND NOT starts_with(href, '//')""")
def link_norm(spark, sf):
    """A4, A5: root-relative hrefs made absolute against their page, trailing slashes dropped."""
    links = L.prefix_links(X.table(spark, sf, "pages"), "/").filter(~F.col("href").startswith("//"))
    return L.resolve(links).select("page_id", "pos", "link")


_SNAPSHOTS_SQL = f"""snapshots AS (
  SELECT (page_id // {X.SNAPSHOT_PAGES})::BIGINT AS snapshot, (page_id * 100000 + (u.o - 1))::BIGINT AS pos,
         regexp_replace(u.h, '/+\\z', '', 'g') AS href,
         (1000 * ((page_id // {X.SNAPSHOT_PAGES}) // 2))::BIGINT AS height
  FROM pages, unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) WITH ORDINALITY AS u(h, o)
)"""
_FIRST_SQL = """firsts AS (
  SELECT href, arg_min(snapshot, (snapshot, pos)) AS snapshot, arg_min(pos, (snapshot, pos)) AS pos
  FROM snapshots GROUP BY href
),
passes AS (
  SELECT s.snapshot, max(s.height) AS height,
         coalesce((SELECT count(*) FROM firsts f WHERE f.snapshot = s.snapshot), 0)::BIGINT AS new_links
  FROM snapshots s GROUP BY s.snapshot
)"""


@register("link_dedup", O.with_ctes(_SNAPSHOTS_SQL, _FIRST_SQL) + """
SELECT href, snapshot, pos FROM firsts""")
def link_dedup(spark, sf):
    """Normalised links, first pass and position wins."""
    s = X.snapshots(spark, sf).withColumn("href", L.normalize_link(F.col("href")))
    return L.first_seen(s)


@register("links_sorted", O.with_ctes(_SNAPSHOTS_SQL) + """
SELECT DISTINCT href FROM snapshots""")
def links_sorted(spark, sf):
    """Unique links in sort order (export order)."""
    s = X.snapshots(spark, sf).withColumn("href", L.normalize_link(F.col("href")))
    return L.sorted_unique(s)


@register("discovery", O.with_ctes(_SNAPSHOTS_SQL, _FIRST_SQL) + """
SELECT snapshot, new_links, sum(new_links) OVER (ORDER BY snapshot)::BIGINT AS total_links FROM passes""")
def q_discovery(spark, sf):
    """New links per pass and the running total."""
    return L.discovery(X.snapshots(spark, sf))


@register("idle_streak", O.with_ctes(_SNAPSHOTS_SQL, _FIRST_SQL) + f"""
, flagged AS (
  SELECT snapshot, new_links, coalesce(height = lag(height) OVER (ORDER BY snapshot)
                                        AND lag(snapshot) OVER (ORDER BY snapshot) = snapshot - 1, false) AS same_height
  FROM passes
), islands AS (
  SELECT *, sum(CASE WHEN new_links > 0 THEN 1 ELSE 0 END) OVER (ORDER BY snapshot) AS island FROM flagged
), streaks AS (
  SELECT snapshot, new_links, same_height,
         sum((CASE WHEN new_links = 0 THEN 1 ELSE 0 END) + (CASE WHEN same_height THEN 1 ELSE 0 END))
             OVER (PARTITION BY island ORDER BY snapshot)::BIGINT AS streak
  FROM islands
)
SELECT snapshot, new_links, same_height, streak,
       coalesce(snapshot = (SELECT min(snapshot) FROM streaks WHERE streak >= {L.IDLE_LIMIT}), false) AS stop,
       coalesce(snapshot > (SELECT min(snapshot) FROM streaks WHERE streak >= {L.IDLE_LIMIT}), false) AS after_stop
FROM streaks""")
def q_idle_streak(spark, sf):
    """Scroll stop rule (idle passes and unchanged height) as a report."""
    return L.idle_streak(X.snapshots(spark, sf))


# ---------------------------------------------------------------- listings

_API_OK = f"(((o_orderkey // {X.API_PAGE_SIZE}) + 1) % {X.API_ERROR_EVERY} <> 0)"


def _responses(spark, sf):
    return parse_listing(X.api_pages(spark, sf))


@register("api_items", f"""
SELECT ((o_orderkey // {X.API_PAGE_SIZE}) + 1)::BIGINT AS page, (o_orderkey % {X.API_PAGE_SIZE})::BIGINT AS pos,
       o_orderkey AS id, {O.lit(API_BASE)} || '/' || o_orderkey::VARCHAR AS url
FROM orders WHERE {_API_OK}""")
def api_items(spark, sf):
    """Items of all usable pages, with their item URL."""
    items = LS.listing_items(_responses(spark, sf))
    return LS.item_urls(items, API_BASE)


@register("api_filter", f"""
SELECT o_orderkey AS id, o_orderstatus AS status, (o_custkey % 5)::BIGINT AS category_id
FROM orders WHERE {_API_OK} AND o_orderstatus = {O.lit(API_STATUS)} AND o_custkey % 5 = {API_CATEGORY}""")
def api_filter(spark, sf):
    """Status and category filter on listing items."""
    items = LS.filter_items(LS.listing_items(_responses(spark, sf)), API_STATUS, API_CATEGORY)
    return items.select("id", "status", F.col("category.id").alias("category_id"))


@register("api_expected", f"""
SELECT r.page::BIGINT AS page FROM range(1, (SELECT (count(*) + {X.API_PAGE_SIZE - 1}) // {X.API_PAGE_SIZE} + 1
                                           FROM orders)) AS r(page)""")
def api_expected(spark, sf):
    """Pages 1..ceil(total / size)."""
    return LS.expected_pages(_responses(spark, sf), X.API_PAGE_SIZE)


@register("api_missing", f"""
SELECT r.page::BIGINT AS page FROM range(1, (SELECT (count(*) + {X.API_PAGE_SIZE - 1}) // {X.API_PAGE_SIZE} + 1
                                           FROM orders)) AS r(page)
WHERE r.page % {X.API_ERROR_EVERY} = 0""")
def api_missing(spark, sf):
    """Expected pages without a usable response."""
    return LS.missing_pages(_responses(spark, sf), X.API_PAGE_SIZE)


@register("api_audit", f"""
SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE {_API_OK})::BIGINT AS items_got,
       ((count(*) + {X.API_PAGE_SIZE - 1}) // {X.API_PAGE_SIZE})::BIGINT AS pages_expected,
       (((count(*) + {X.API_PAGE_SIZE - 1}) // {X.API_PAGE_SIZE}) // {X.API_ERROR_EVERY})::BIGINT AS pages_missing
FROM orders""")
def api_audit(spark, sf):
    """Rows got against the reported total."""
    return LS.audit(_responses(spark, sf), X.API_PAGE_SIZE)
