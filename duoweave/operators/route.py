"""Per-page routing of block texts into a Khmer and an English list.

Input is the output of ``layout.extract``: one row per page with a title and
an ordered ``blocks`` array.  All rules are array expressions on that row,
staged so each intermediate is computed once; routing is a chain of
narrow projections (no shuffle):

* the first block equal to a separator token splits the page: blocks before
  it are Khmer, after it English (by position only);
* otherwise each block goes to the list of its script label;
* the title goes first into the list of its own language;
* with a separator, one more Khmer than English entry means a heading:
  an empty English entry is put first and the page is done;
* a page needs alignment when both lists are non-empty and English is longer;
* pages without blocks use the fallback texts, labelled one by one, and are
  never aligned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.functions.text import KHMER, PLACEHOLDER, SEPARATOR_TOKENS, LanguageRule, is_script, labelled


def _empty() -> Column:
    return F.array().cast("array<string>")


def _tokens() -> Column:
    return F.array(*[F.lit(t) for t in SEPARATOR_TOKENS])


def separator_index(blocks: Column) -> Column:
    """1-based index of the first separator block, 0 when there is none."""
    return F.array_position(F.transform(blocks, lambda b: F.array_contains(_tokens(), b)), True)


def _keep(b: Column) -> Column:
    return (b != "") & (b != PLACEHOLDER)


def split_at_separator(blocks: Column, sep: Column) -> tuple[Column, Column]:
    """(khmer, english) lists around the separator, placeholders dropped."""
    before = F.slice(blocks, 1, F.greatest(sep - 1, F.lit(0)))
    after = F.slice(blocks, sep + 1, F.greatest(F.size(blocks), F.lit(1)))
    return F.filter(before, _keep), F.filter(after, _keep)


def _texts(arr: Column, khmer: bool) -> Column:
    picked = F.filter(arr, lambda x: x["k"] if khmer else ~x["k"])
    return F.transform(picked, lambda x: x["t"])


def route(extracted: DataFrame, rule: LanguageRule = KHMER,
          keep: tuple[str, ...] = ("page_id",), detail: bool = False) -> DataFrame:
    """extracted (title, blocks, has_blocks, fallback) -> content.

    content: keep..., english array<string>, khmer array<string>, needs_align;
    with ``detail`` also separator (1-based, 0 = none), k0/e0 (the lists
    around the separator), title_side and placeholder.
    """
    s1 = extracted.select(
        *keep, "blocks", "has_blocks", "fallback",
        F.coalesce(F.col("title"), F.lit("")).alias("_t"),
        separator_index(F.col("blocks")).alias("separator"))
    s2 = s1.select(
        "*", is_script(F.col("_t"), rule).alias("_tk"),
        labelled(F.when(F.col("separator") == 0, F.filter("blocks", _keep)), rule).alias("_lab"),
        labelled("fallback", rule).alias("_fblab"))
    k0, e0 = split_at_separator(F.col("blocks"), F.col("separator"))
    has_title = F.col("_t") != ""
    s3 = s2.select(
        "*", k0.alias("k0"), e0.alias("e0"),
        F.when(has_title & F.col("_tk"), F.array("_t")).otherwise(_empty()).alias("_title_k"),
        F.when(has_title & ~F.col("_tk"), F.array("_t")).otherwise(_empty()).alias("_title_e"))
    sep = F.col("separator") > 0
    s4 = s3.select(
        "*",
        F.when(~F.col("has_blocks"), _texts(F.col("_fblab"), True))
        .when(sep, F.concat("_title_k", "k0"))
        .otherwise(F.concat("_title_k", _texts(F.col("_lab"), True))).alias("khmer"),
        F.when(~F.col("has_blocks"), _texts(F.col("_fblab"), False))
        .when(sep, F.concat("_title_e", "e0"))
        .otherwise(F.concat("_title_e", _texts(F.col("_lab"), False))).alias("_english0"))
    s5 = s4.select(
        "*", (F.col("has_blocks") & sep & (F.size("khmer") == F.size("_english0") + 1)).alias("placeholder"))
    s6 = s5.select(
        "*", F.when(F.col("placeholder"), F.concat(F.array(F.lit("")), F.col("_english0")))
        .otherwise(F.col("_english0")).alias("english"))
    unequal = (F.size("english") > 0) & (F.size("khmer") > 0) & (F.size("english") > F.size("khmer"))
    s7 = s6.select("*", (F.col("has_blocks") & ~F.col("placeholder") & unequal).alias("needs_align"))
    out = [*keep, "english", "khmer", "needs_align"]
    if detail:
        title_side = (F.when(~has_title, F.lit(None).cast("string"))
                      .when(F.col("_tk"), F.lit(rule.script_label)).otherwise(F.lit(rule.other_label)))
        s7 = s7.withColumn("title_side", title_side)
        out += ["separator", "k0", "e0", "title_side", "placeholder", "has_blocks"]
    return s7.select(*out)


def dedup_blocks(lines: DataFrame, key: str = "page_id", pos: str = "pos", text: str = "text") -> DataFrame:
    """Row form of in-page dedup: first position of each exact text per page.

    A plain aggregation (min position per key and text), so a text repeated
    on many rows of one page is combined map-side before the shuffle.
    """
    return (lines.filter(F.col(text) != "")
            .groupBy(key, text).agg(F.min(pos).alias(pos))
            .select(key, pos, text))
