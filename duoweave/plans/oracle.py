"""DuckDB SQL twins of the fixture views and queries (the correctness gate).

Each query is one SELECT over the pre-registered test tables.  Where an
operator has a simpler relational formulation, the oracle uses it instead
of mirroring the Spark plan: expected extraction results come straight from
the document lines (not from parsing the generated HTML), cosine scores of
merged sentences come from encoding the merged text (not from summing
vectors), dot products come from joins on shared buckets, ids come from a
global ROW_NUMBER, and the greedy pick uses full candidate lists.
"""

from __future__ import annotations

from duoweave.functions.text import (
    KHMER_LETTERS, KHMER_SHARE, LATIN_LETTERS, MIN_BLOCK_LENGTH, PLACEHOLDER,
    SEPARATOR_TOKENS, WHITESPACE_CLASS,
)
from duoweave.operators.encode import DIMS, HASH_MODULUS, HASH_MULTIPLIER, NGRAM
from duoweave.plans.fixtures import KHMER_26, LATIN_LOWER, SIDES_PAGE

WS = WHITESPACE_CLASS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOKENS = "(" + ", ".join(lit(t) for t in SEPARATOR_TOKENS) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS}+|{WS}+' + chr(92) + 'z')}, '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {lit(WS + '+')}, ' ', 'g')"


def clean(x: str) -> str:
    raw = f"coalesce({x}, '')"
    s = strip(raw)
    c = collapse(s)
    return (f"(CASE WHEN {raw} = '' THEN '' WHEN {s} IN {TOKENS} THEN {s} "
            f"WHEN regexp_matches({c}, '^[- ]*\\z') THEN '' WHEN {c} = '.' THEN '' ELSE {c} END)")


def kcount(x: str) -> str:
    return f"length(regexp_replace(coalesce({x}, ''), {lit('[^' + KHMER_LETTERS + ']')}, '', 'g'))"


def lcount(x: str) -> str:
    return f"length(regexp_replace(coalesce({x}, ''), {lit('[^' + LATIN_LETTERS + ']')}, '', 'g'))"


def is_khmer(x: str) -> str:
    k, l_ = kcount(x), lcount(x)
    return f"(CASE WHEN {k} + {l_} > 0 THEN {k} / ({k} + {l_}) > {KHMER_SHARE} ELSE false END)"


# Character references that occur in the test pages; '&amp;' is decoded last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"),
)


def decode(x: str) -> str:
    out = x
    for ent, ch in ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def text_of(x: str, glue: str) -> str:
    return (f"array_to_string(list_filter(list_transform(string_split_regex(coalesce({x}, ''), '<[^>]*>'), "
            f"lambda t: {strip(decode('t'))}), lambda t: t <> ''), {lit(glue)})")


def keep(x: str) -> str:
    return f"({x} <> '' AND {x} <> {lit(PLACEHOLDER)})"


# ----------------------------------------------------------------------------
# fixture views

DOC_LINES = """doc_lines AS (
  SELECT d.doc_id, len(d.lines)::BIGINT AS n, (u.o - 1)::BIGINT AS pos, u.line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d,
       unnest(d.lines) WITH ORDINALITY AS u(line, o)
)"""

BI_BLOCKS = f"""bi_blocks AS (
  SELECT doc_id, n, pos,
         CASE WHEN pos < n // 2 THEN translate(lower(line), {lit(LATIN_LOWER)}, {lit(KHMER_26)}) ELSE line END AS text
  FROM doc_lines
)"""

BI_DOCS = f"""bi_docs AS (
  SELECT doc_id,
         CASE WHEN doc_id % 3 <> 0
              THEN list_concat(list_slice(b, 1, half), [{lit(SEPARATOR_TOKENS[0])}], list_slice(b, half + 1, n))
              ELSE b END AS blocks
  FROM (
    SELECT doc_id, n, half,
           list_transform(lines, lambda x, i: CASE WHEN i - 1 < half
                 THEN translate(lower(x), {lit(LATIN_LOWER)}, {lit(KHMER_26)}) ELSE x END) AS b
    FROM (SELECT doc_id, lines, len(lines) AS n, len(lines) // 2 AS half
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
  )
)"""

# expected extraction of the news-layout pages: title = block 1, blocks = the rest
BI_EXTRACTED = f"""bi_extracted AS (
  SELECT doc_id AS page_id, {clean('blocks[1]')} AS title,
         list_filter(list_transform(list_slice(blocks, 2, len(blocks)), lambda b: {clean('b')}),
                     lambda t: length(t) >= {MIN_BLOCK_LENGTH}) AS blocks,
         len(blocks) >= 2 AS has_blocks
  FROM bi_docs
)"""

BI_ROUTE_PARTS = f"""bi_route_parts AS (
  SELECT page_id, title, blocks, has_blocks, sep,
         list_filter(list_slice(blocks, 1, greatest(sep - 1, 0)), lambda b: {keep('b')}) AS k0,
         list_filter(list_slice(blocks, sep + 1, len(blocks)), lambda b: {keep('b')}) AS e0,
         CASE WHEN title <> '' AND {is_khmer('title')} THEN [title] ELSE []::VARCHAR[] END AS title_k,
         CASE WHEN title <> '' AND NOT {is_khmer('title')} THEN [title] ELSE []::VARCHAR[] END AS title_e
  FROM (SELECT *, coalesce(list_position(list_transform(blocks, lambda b: b IN {TOKENS}), true), 0) AS sep
        FROM bi_extracted)
)"""

BI_ROUTED = f"""bi_routed AS (
  SELECT page_id, sep, has_blocks, title_k, title_e, k0, e0,
         CASE WHEN NOT has_blocks THEN []::VARCHAR[]
              WHEN sep > 0 THEN list_concat(title_k, k0)
              ELSE list_concat(title_k, list_filter(blocks, lambda b: {keep('b')} AND {is_khmer('b')})) END AS khmer,
         CASE WHEN NOT has_blocks THEN []::VARCHAR[]
              WHEN sep > 0 AND len(list_concat(title_k, k0)) = len(list_concat(title_e, e0)) + 1
                   THEN list_concat([''], list_concat(title_e, e0))
              WHEN sep > 0 THEN list_concat(title_e, e0)
              ELSE list_concat(title_e, list_filter(blocks, lambda b: {keep('b')} AND NOT {is_khmer('b')})) END
              AS english,
         has_blocks AND sep > 0 AND len(list_concat(title_k, k0)) = len(list_concat(title_e, e0)) + 1
              AS placeholder
  FROM bi_route_parts
)"""

BI_CONTENT = """bi_content AS (
  SELECT page_id, english, khmer, placeholder,
         has_blocks AND NOT placeholder AND len(english) > 0 AND len(khmer) > 0 AND len(english) > len(khmer)
              AS needs_align
  FROM bi_routed
)"""


def gram_bucket_sql(text: str, p: str) -> str:
    h = "0::BIGINT"
    for k in range(NGRAM):
        h = f"(({h}) * {HASH_MULTIPLIER} + unicode(substr({text}, {p} + {k}, 1))::BIGINT) % {HASH_MODULUS}"
    return f"(({h}) % {DIMS})"


def ngram_counts(name: str, source: str) -> str:
    """source(page_id, side, idx, text) -> name(page_id, side, idx, bucket, cnt)."""
    return f"""{name} AS (
  SELECT page_id, side, idx, {gram_bucket_sql('text', 'r.p')} AS bucket, count(*) AS cnt
  FROM {source}, range(1, length(text) - {NGRAM - 2}) AS r(p)
  WHERE length(text) >= {NGRAM}
  GROUP BY ALL
)"""


BI_ALIGN = f"""bi_todo AS (SELECT * FROM bi_content WHERE needs_align),
bi_sent AS (
  SELECT page_id, 'en' AS side, (u.o - 1) AS idx, u.t AS text FROM bi_todo, unnest(english) WITH ORDINALITY AS u(t, o)
  UNION ALL
  SELECT page_id, 'km' AS side, (u.o - 1) AS idx, u.t AS text FROM bi_todo, unnest(khmer) WITH ORDINALITY AS u(t, o)
),
{ngram_counts('bi_grams', 'bi_sent')},
bi_norm AS (SELECT page_id, side, idx, sum(cnt * cnt) AS nn FROM bi_grams GROUP BY ALL),
bi_dot AS (
  SELECT k.page_id, k.idx AS j, e.idx AS i, sum(k.cnt * e.cnt) AS dot
  FROM bi_grams k JOIN bi_grams e ON k.page_id = e.page_id AND k.bucket = e.bucket
  WHERE k.side = 'km' AND e.side = 'en' GROUP BY ALL
),
bi_scores AS (
  SELECT k.page_id, k.idx AS j, e.idx AS i,
         CASE WHEN coalesce(nk.nn, 0) = 0 OR coalesce(ne.nn, 0) = 0 THEN 0.0
              ELSE coalesce(d.dot, 0)::DOUBLE / sqrt(nk.nn::DOUBLE * ne.nn::DOUBLE) END AS score
  FROM bi_sent k JOIN bi_sent e ON k.page_id = e.page_id AND k.side = 'km' AND e.side = 'en'
  LEFT JOIN bi_norm nk ON nk.page_id = k.page_id AND nk.side = 'km' AND nk.idx = k.idx
  LEFT JOIN bi_norm ne ON ne.page_id = e.page_id AND ne.side = 'en' AND ne.idx = e.idx
  LEFT JOIN bi_dot d ON d.page_id = k.page_id AND d.j = k.idx AND d.i = e.idx
),
bi_best AS (
  SELECT page_id, j, i AS b, score AS base_score FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id, j ORDER BY score DESC, i ASC) AS rn FROM bi_scores)
  WHERE rn = 1
),
bi_unused AS (
  SELECT s.page_id, s.idx AS u, s.text FROM bi_sent s
  WHERE s.side = 'en' AND NOT EXISTS (SELECT 1 FROM bi_best b WHERE b.page_id = s.page_id AND b.b = s.idx)
),
bi_merged AS (
  SELECT p.page_id, p.j, u.u, eb.text || ' ' || u.text AS text
  FROM bi_best p JOIN bi_unused u ON p.page_id = u.page_id
  JOIN bi_sent eb ON eb.page_id = p.page_id AND eb.side = 'en' AND eb.idx = p.b
),
bi_mgrams AS (
  SELECT page_id, j, u, {gram_bucket_sql('text', 'r.p')} AS bucket, count(*) AS cnt
  FROM bi_merged, range(1, length(text) - {NGRAM - 2}) AS r(p)
  WHERE length(text) >= {NGRAM} GROUP BY ALL
),
bi_cands AS (
  SELECT m.page_id, m.j, m.u,
         CASE WHEN coalesce(mn.nn, 0) = 0 OR coalesce(nk.nn, 0) = 0 THEN 0.0
              ELSE coalesce(md.dot, 0)::DOUBLE / sqrt(mn.nn::DOUBLE * nk.nn::DOUBLE) END AS score
  FROM bi_merged m
  LEFT JOIN (SELECT page_id, j, u, sum(cnt * cnt) AS nn FROM bi_mgrams GROUP BY ALL) mn
         ON mn.page_id = m.page_id AND mn.j = m.j AND mn.u = m.u
  LEFT JOIN bi_norm nk ON nk.page_id = m.page_id AND nk.side = 'km' AND nk.idx = m.j
  LEFT JOIN (SELECT g.page_id, g.j, g.u, sum(g.cnt * k.cnt) AS dot FROM bi_mgrams g
             JOIN bi_grams k ON k.page_id = g.page_id AND k.side = 'km' AND k.idx = g.j AND k.bucket = g.bucket
             GROUP BY ALL) md ON md.page_id = m.page_id AND md.j = m.j AND md.u = m.u
),
{"greedy_sql('bi')"}
bi_aligned AS (
  SELECT t.page_id,
         list_transform(list_zip(g.bs, g.us), lambda z: t.english[z[1] + 1] ||
             CASE WHEN z[2] >= 0 THEN ' ' || t.english[z[2] + 1] ELSE '' END) AS english,
         t.khmer
  FROM bi_todo t JOIN bi_taken g ON g.page_id = t.page_id
),
bi_final AS (
  SELECT page_id, english, khmer FROM bi_content WHERE NOT needs_align
  UNION ALL SELECT page_id, english, khmer FROM bi_aligned
)"""


def greedy_sql(p: str) -> str:
    """{p}_best(page_id, j, b, base_score) + {p}_cands(page_id, j, u, score) -> {p}_taken."""
    return f"""{p}_ranked AS (
  SELECT page_id, j, list(u ORDER BY score DESC, u ASC) AS rk, list(score ORDER BY score DESC, u ASC) AS rs
  FROM {p}_cands GROUP BY page_id, j
),
{p}_lists AS (
  SELECT b.page_id, list(b.j ORDER BY b.j) AS js, list(b.b ORDER BY b.j) AS bs,
         list(b.base_score ORDER BY b.j) AS base_scores,
         list(coalesce(r.rk, []::BIGINT[]) ORDER BY b.j) AS rks,
         list(coalesce(r.rs, []::DOUBLE[]) ORDER BY b.j) AS rss
  FROM {p}_best b LEFT JOIN {p}_ranked r ON r.page_id = b.page_id AND r.j = b.j
  GROUP BY b.page_id
),
{p}_taken AS (
  SELECT page_id, js, bs, base_scores, rks, rss,
         list_reduce(rks, lambda acc, r: list_append(acc, coalesce(list_filter(r, lambda c: NOT list_contains(acc, c))[1], -1)),
                     []::BIGINT[]) AS us
  FROM {p}_lists
),"""


BI_ALIGN = BI_ALIGN.replace("greedy_sql('bi')\n", greedy_sql("bi") + "\n")

SIDES = f"""sides AS (
  SELECT page_id, side, (row_number() OVER (PARTITION BY page_id, side ORDER BY vec_id) - 1) AS idx, vec
  FROM (SELECT vec_id // {SIDES_PAGE} AS page_id, CASE WHEN vec_id % 3 = 0 THEN 'km' ELSE 'en' END AS side,
               vec_id, embedding::DOUBLE[] AS vec FROM embeddings)
)"""


def cos_sql(a: str, b: str) -> str:
    dot = f"list_reduce(list_transform(range(len({a})), lambda k: {a}[k + 1] * {b}[k + 1]), lambda s, v: s + v, 0.0::DOUBLE)"
    na = f"list_reduce(list_transform({a}, lambda x: x * x), lambda s, v: s + v, 0.0::DOUBLE)"
    nb = f"list_reduce(list_transform({b}, lambda x: x * x), lambda s, v: s + v, 0.0::DOUBLE)"
    return f"(CASE WHEN sqrt({na} * {nb}) = 0 THEN 0.0 ELSE {dot} / sqrt({na} * {nb}) END)"


SIDES_ALIGN = f"""sd_scores AS (
  SELECT k.page_id, k.idx AS j, e.idx AS i, {cos_sql('k.vec', 'e.vec')} AS score
  FROM sides k JOIN sides e ON k.page_id = e.page_id AND k.side = 'km' AND e.side = 'en'
),
sd_best AS (
  SELECT page_id, j, i AS b, score AS base_score FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id, j ORDER BY score DESC, i ASC) AS rn FROM sd_scores)
  WHERE rn = 1
),
sd_unused AS (
  SELECT s.page_id, s.idx AS u, s.vec FROM sides s
  WHERE s.side = 'en' AND NOT EXISTS (SELECT 1 FROM sd_best b WHERE b.page_id = s.page_id AND b.b = s.idx)
),
sd_cands AS (
  SELECT p.page_id, p.j, p.b, p.base_score, u.u,
         {cos_sql('list_transform(range(len(eb.vec)), lambda k: eb.vec[k + 1] + u.vec[k + 1])', 'km.vec')} AS score
  FROM sd_best p JOIN sd_unused u ON p.page_id = u.page_id
  JOIN sides eb ON eb.page_id = p.page_id AND eb.side = 'en' AND eb.idx = p.b
  JOIN sides km ON km.page_id = p.page_id AND km.side = 'km' AND km.idx = p.j
),
{greedy_sql('sd')}
sd_picks AS (
  SELECT t.page_id, z.j, z.b, z.base_score, z.u,
         CASE WHEN z.u >= 0 THEN z.rs[list_position(z.rk, z.u)] ELSE z.base_score END AS score
  FROM sd_taken t, unnest(list_transform(range(len(t.js)), lambda k: {{'j': t.js[k + 1], 'b': t.bs[k + 1],
       'base_score': t.base_scores[k + 1], 'u': t.us[k + 1], 'rk': t.rks[k + 1], 'rs': t.rss[k + 1]}})) AS q(z)
)"""

FETCH_LOG = """fetch_log AS (
  SELECT page_id + 1 AS pos, url,
         CASE WHEN page_id % 13 = 5 THEN NULL WHEN page_id % 11 = 0 THEN 404 ELSE 200 END AS status,
         CASE WHEN page_id % 7 = 0 THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END AS content_type,
         html
  FROM pages
)"""

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"


def prepared_url(x: str) -> str:
    return (f"regexp_replace(regexp_replace(coalesce({x}, ''), {lit(r'^[\x{00}-\x{20}]+')}, '', 'g'), "
            f"{lit(r'[\t\r\n]')}, '', 'g')")


def valid_url(x: str) -> str:
    u = prepared_url(x)
    auth = f"regexp_extract({u}, {lit('^' + _SCHEME + '://([^/?#]*)')}, 1)"
    return (f"(regexp_matches({u}, {lit('^' + _SCHEME + '://[^/?#]')}) AND "
            f"(CASE WHEN contains({auth}, '[') <> contains({auth}, ']') THEN false "
            f"WHEN contains({auth}, '[') THEN regexp_matches({auth}, "
            f"{lit(r'\[(v[0-9A-Fa-f]+\..+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.%]*)\]')}) ELSE true END))")


def article_title(html: str) -> str:
    inner = f"regexp_extract({html}, '(?s)<h1\\b[^>]*>(.*?)</h1\\s*>', 1)"
    return clean(text_of(inner, ""))


def article_blocks(html: str) -> str:
    """list of cleaned paragraph texts (len >= 3) of the article layout."""
    region = f"regexp_extract({html}, '(?s)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    pieces = f"string_split_regex({region}, '<p\\b[^>]*>')"
    paras = f"list_transform(list_slice({pieces}, 2, len({pieces})), lambda p: split_part(p, '</p>', 1))"
    return (f"list_filter(list_transform({paras}, lambda p: {clean(text_of('p', ''))}), "
            f"lambda t: length(t) >= {MIN_BLOCK_LENGTH})")


def article_has_blocks(html: str) -> str:
    region = f"regexp_extract({html}, '(?s)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    return (f"(regexp_matches({html}, '(?s)<article\\b[^>]*>') AND "
            f"len(string_split_regex({region}, '<p\\b[^>]*>')) > 1)")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.rstrip().rstrip(",") for c in ctes) + "\n"
