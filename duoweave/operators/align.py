"""Sentence alignment of pages whose English list is longer than the Khmer one.

Steps, each a DataFrame join or aggregation keyed by page:

1. encode both sides (``encode``): one row per sentence with its vector;
2. best match: every Khmer sentence takes the English sentence of its page
   with the highest cosine, lowest index on ties (a Khmer sentence without any
   positive score takes English sentence 0); several Khmer sentences may share
   one;
3. unused English sentences of the page (anti join);
4. merge candidates: every (pair, unused sentence) of a page, scored as
   cosine(encode(base + ' ' + unused), khmer).  A pair's base never
   changes before its own turn, so all scores are computed up front, from
   dot products in the row of the candidate: M.K = B.K + U.K + J.K and
   |M|^2 = |B|^2 + |U|^2 + |J|^2 + 2 (B.U + B.J + U.J), J being the
   n-grams across the joining space (none for given vectors);
5. greedy pick, pairs in Khmer order: each takes its best-scored unused
   sentence still free (lowest index on ties), even when the score falls,
   and removes it from the pool.  Pairs take their turns in chunks of
   ``TURNS``; a chunk is one ``aggregate`` in one row.  The r-th pair of a
   chunk can lose at most r candidates to those before it, so its r+1 best of
   what earlier chunks left are enough: an exact cut, not a cap;
6. assemble: English text of pair j = base, plus ' ' + the taken sentence.

A page's pairs are joined by blocks of ``BLOCK`` sentences of either side, so
that a large page is many join keys.

Alignment changes the English list only; it gets the length of the Khmer
list.  Unused English sentences not taken by any pair are dropped, as in the
reference; ``dropped`` returns them for audit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duoweave.operators.encode import NgramEncoder, dot, ratio
from duoweave.session import materialize

_INT_ARRAY = "array<int>"


# Sentences of one side in a block; a pair of blocks is one join key.
BLOCK = 256
# Pairs that take their turns in one row.
TURNS = 1024


def sentences(content: DataFrame, key: str = "page_id") -> DataFrame:
    """content(key, english, khmer) -> (key, side, idx, text, n_en, n_km), side 'en' / 'km'."""
    n = [F.greatest(F.size("english"), F.lit(0)).alias("n_en"), F.greatest(F.size("khmer"), F.lit(0)).alias("n_km")]
    en = content.select(key, F.lit("en").alias("side"), *n, F.posexplode("english").alias("idx", "text"))
    km = content.select(key, F.lit("km").alias("side"), *n, F.posexplode("khmer").alias("idx", "text"))
    return en.unionByName(km).select(key, "side", "idx", "text", "n_en", "n_km")


def _sized(sent: DataFrame, key: str) -> DataFrame:
    """``sent`` with n_en and n_km, the greatest index of either side of the page plus 1."""
    if {"n_en", "n_km"} <= set(sent.columns):
        return sent
    n = sent.groupBy(key).agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col("idx") + 1)), F.lit(0)).alias(f"n_{s}")
                                for s in ("en", "km")])
    return sent.join(n, key)


class Vectors:
    """One row per sentence of either side: its vector, the page's numbers of sentences (n_en, n_km), and
    head and tail where sentences join."""

    def __init__(self, sent: DataFrame, encoder, key: str = "page_id", text: str = "text",
                 checkpoint: bool = True):
        self.key = key
        self.sent = _sized(sent, key)
        rows = encoder.vectors(self.sent, [key, "side", "idx", "n_en", "n_km"], text)
        failed = encoder.failed_pages() if hasattr(encoder, "failed_pages") else None
        if failed is not None:
            # pages whose encoding failed are not aligned (they keep their lists)
            self.sent = self.sent.join(failed, key, "left_anti")
        # read by every later join: encode once
        self.rows = materialize(rows) if checkpoint else rows

    def side(self, side: str, idx: str, vec: str, *more: str) -> DataFrame:
        """(key, idx, vec, more...) of one side."""
        return self.rows.filter(F.col("side") == side).select(
            self.key, F.col("idx").alias(idx), F.col("vec").alias(vec), *more)

    def side_vecs(self, side: str, idx: str, vec: str) -> DataFrame:
        return self.side(side, idx, vec)


def block_join(left: DataFrame, right: DataFrame, key: str, left_side: tuple[str, str], right_side: tuple[str, str],
               how: str = "inner") -> DataFrame:
    """Every left row with every right row of its page, joined on (page, left block, right block).

    A side is the column of its sentences' index and that of their number on
    the page, which both frames have; the numbers are dropped from the result.
    Each row is repeated once per block of the page's other side; a page of one
    block on each side, which is nearly every page, is not repeated.
    """
    (i, n_left), (j, n_right) = left_side, right_side

    def blocked(df: DataFrame, own: str, own_block: str, other: str, other_block: str) -> DataFrame:
        last = F.greatest(F.ceil(F.col(other) / BLOCK) - 1, F.lit(0)).cast("int")
        return df.select(*[c for c in df.columns if c not in (n_left, n_right)], F.floor(F.col(own) / BLOCK).cast("int").alias(own_block),
                         F.explode(F.sequence(F.lit(0), last)).alias(other_block))

    return blocked(left, i, "_lb", n_right, "_rb").join(
        blocked(right, j, "_rb", n_left, "_lb"), [key, "_lb", "_rb"], how).drop("_lb", "_rb")


def best_matches(v: Vectors) -> DataFrame:
    """Per Khmer sentence the best English one: (key, j, i, score, d, nk, nb).

    ``d`` is the dot product of the pair, ``nk`` / ``nb`` the squared norms of
    the Khmer sentence and of its base (carried for the merge step).
    """
    k = v.key
    km = v.side("km", "j", "kv", "n_en", "n_km").withColumn("nk", dot(F.col("kv"), F.col("kv")))
    en = v.side("en", "i", "ev", "n_en", "n_km").withColumn("nb", dot(F.col("ev"), F.col("ev")))
    met = block_join(km, en, k, ("j", "n_km"), ("i", "n_en"), "left")
    scored = met.select(k, "j", "i", "nk", "nb", dot(F.col("kv"), F.col("ev")).alias("d")) \
        .withColumn("score", ratio(F.col("d"), F.col("nk"), F.col("nb")))
    best = scored.groupBy(k, "j").agg(F.max(F.struct("score", (-F.col("i")).alias("neg_i"), "d", "nk", "nb")).alias("m"))
    m = F.col("m")
    return best.select(
        k, "j", F.coalesce(-m["neg_i"], F.lit(0)).alias("i"),
        *[F.coalesce(m[c], F.lit(0.0)).alias(c) for c in ("score", "d", "nk", "nb")])


def unused_english(v: Vectors, best: DataFrame) -> DataFrame:
    """English sentences no Khmer sentence matched: (key, i) and the rest of their vector row."""
    k = v.key
    en = v.rows.filter(F.col("side") == "en").withColumnRenamed("idx", "i").drop("side")
    return en.join(best.select(k, "i").distinct(), [k, "i"], "left_anti")


def merge_candidates(v: Vectors, best: DataFrame, unused: DataFrame, encoder) -> DataFrame:
    """(key, j, b, base_score, u, score) for every pair and unused sentence."""
    k, sides = v.key, (("j", "n_km"), ("u", "n_en"))
    more = encoder.has_junction
    pairs = best.select(k, "j", F.col("i").alias("b"), F.col("score").alias("base_score"), F.col("d").alias("bk"), "nk", "nb") \
        .join(v.side("en", "b", "bv", "n_en", "n_km", *["tail"] * more), [k, "b"])
    pool = unused.withColumnRenamed("i", "u").withColumnRenamed("vec", "uv")
    merged = _merged_as_text(v, pairs.drop("bv", "tail"), pool.drop("uv", "head", "tail"), encoder)
    if merged is not None:
        return merged
    pairs = pairs.join(v.side_vecs("km", "j", "kv"), [k, "j"])
    pool = pool.drop("tail").withColumn("nu", dot(F.col("uv"), F.col("uv")))
    out = block_join(pairs, pool, k, *sides)
    jk = jj = bj = uj = F.lit(0.0)
    if more:
        out = out.withColumn("_j", encoder.junction(F.col("tail"), F.col("head")))
        at = lambda vec: F.aggregate("_j", F.lit(0.0), lambda s, x: s + F.get(F.col(vec), x))
        jk, bj, uj = at("kv"), at("bv"), at("uv")
        jj = F.aggregate("_j", F.lit(0.0), lambda s, x: s + F.size(F.filter("_j", lambda y: y == x)))
    mk = F.col("bk") + dot(F.col("uv"), F.col("kv")) + jk
    mm = F.col("nb") + F.col("nu") + jj + 2 * (dot(F.col("bv"), F.col("uv")) + bj + uj)
    return out.select(k, "j", "b", "base_score", "u", "nk", mk.alias("mk"), mm.alias("mm")) \
        .select(k, "j", "b", "base_score", "u", ratio(F.col("mk"), F.col("mm"), F.col("nk")).alias("score"))


def _merged_as_text(v: Vectors, pairs: DataFrame, pool: DataFrame, encoder) -> DataFrame | None:
    """Candidates scored by the encoder's vector of each distinct merged text; None if it has none."""
    k, sides = v.key, (("j", "n_km"), ("u", "n_en"))
    if "text" not in v.sent.columns:
        return None
    texts = v.sent.filter(F.col("side") == "en").select(k, F.col("idx").alias("i"), "text")
    bases = pairs.select(k, "b", "n_en", "n_km").distinct() \
        .join(texts.select(k, F.col("i").alias("b"), F.col("text").alias("bt")), [k, "b"]).withColumn("n_km", F.col("n_en"))
    rest = pool.join(texts.select(k, F.col("i").alias("u"), F.col("text").alias("ut")), [k, "u"]) \
        .withColumn("n_km", F.col("n_en"))
    joint = block_join(bases, rest, k, ("b", "n_km"), ("u", "n_en")) \
        .select(k, "b", "u", F.concat_ws(" ", "bt", "ut").alias("merged"))
    vecs = encoder.merged(joint, [k, "b", "u"], "merged")
    if vecs is None:
        return None
    rows = block_join(pairs, pool, k, *sides).join(vecs.withColumnRenamed("vec", "mv"), [k, "b", "u"], "left") \
        .join(v.side_vecs("km", "j", "kv"), [k, "j"])
    score = F.when(F.col("mv").isNull(), F.lit(0.0)).otherwise(
        ratio(dot(F.col("mv"), F.col("kv")), dot(F.col("mv"), F.col("mv")), F.col("nk")))
    return rows.select(k, "j", "b", "base_score", "u", score.alias("score"))


def _turns(best: DataFrame, cands: DataFrame, key: str, first: int) -> DataFrame:
    """The picks of up to ``TURNS`` pairs of each page, from pair ``first`` on, in one row per page."""
    w = Window.partitionBy(key, "j").orderBy(F.col("score").desc(), F.col("u").asc())
    top = cands.withColumn("_r", F.row_number().over(w)) \
        .filter((F.col("_r") <= TURNS) & (F.col("_r") <= F.col("j") - first + 1))
    ranked = top.groupBy(key, "j").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_r").alias("r"),
                                             F.col("u").cast("int").alias("u"), "score")))
        .alias("ranked"))
    pairs = best.select(key, "j", F.col("i").alias("b"), F.col("score").alias("base_score")) \
        .join(ranked, [key, "j"], "left") \
        .withColumn("ranked", F.coalesce("ranked", F.array().cast("array<struct<r:int,u:int,score:double>>")))
    per_page = pairs.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("j", "b", "base_score", "ranked"))).alias("pairs"))
    taken = F.aggregate(
        F.col("pairs"), F.array().cast(_INT_ARRAY),
        lambda acc, p: F.concat(acc, F.array(F.coalesce(
            F.get(F.array_except(F.transform(p["ranked"], lambda c: c["u"]), acc), 0), F.lit(-1)))))
    picked = per_page.select(key, "pairs", taken.alias("taken"))
    rows = picked.select(key, "taken", F.posexplode("pairs").alias("k", "p"))
    u = F.get(F.col("taken"), F.col("k"))
    hit = F.get(F.filter(F.col("p.ranked"), lambda c: c["u"] == u), 0)
    return rows.select(
        key, F.col("p.j").alias("j"), F.col("p.b").alias("b"), F.col("p.base_score").alias("base_score"),
        u.alias("u"), F.coalesce(hit["score"], F.col("p.base_score")).alias("score"))


def greedy_merge(best: DataFrame, cands: DataFrame, key: str = "page_id",
                 only_if_better: bool = False) -> DataFrame:
    """Sequential greedy pick per page: (key, j, b, base_score, u, score).

    ``u`` is -1 when the pool was empty at the pair's turn; ``score`` is then
    the best-match score.  With ``only_if_better`` a pair only takes a
    sentence that raises its score.

    Pages of up to ``TURNS`` pairs are done in one pass.  Larger ones go on in
    further passes over what is left of them: the next pairs, with the
    candidates that no earlier pair took.
    """
    if only_if_better:
        cands = cands.filter(F.col("score") > F.col("base_score"))
    last = best.agg(F.max("j")).first()[0] or 0
    if last < TURNS:
        return _turns(best, cands, key, 0)
    cands = materialize(cands)
    done = None
    for first in range(0, last + 1, TURNS):
        now = F.col("j").between(first, first + TURNS - 1)
        free = cands.filter(now)
        if done is not None:
            free = free.join(done.filter("u >= 0").select(key, "u"), [key, "u"], "left_anti")
        picks = materialize(_turns(best.filter(now), free, key, first))
        done = picks if done is None else done.unionByName(picks)
    return done


def assemble(content: DataFrame, picks: DataFrame, key: str = "page_id") -> DataFrame:
    """content rows needing alignment + picks -> aligned content (English of length #Khmer)."""
    per_page = picks.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("j", "b", "u"))).alias("picks"))
    joined = content.join(per_page, key, "left")
    english = F.transform(
        F.col("picks"),
        lambda p: F.concat_ws(" ", F.get(F.col("english"), p["b"]),
                              F.when(p["u"] >= 0, F.get(F.col("english"), p["u"])))
    )
    return joined.withColumn("english", F.coalesce(english, F.col("english"))).drop("picks")


def dropped(unused: DataFrame, picks: DataFrame, key: str = "page_id") -> DataFrame:
    """English sentences left out of the aligned output: (key, i)."""
    taken = picks.filter(F.col("u") >= 0).select(key, F.col("u").alias("i"))
    return unused.select(key, "i").join(taken, [key, "i"], "left_anti")


def align_steps(sent: DataFrame, encoder, key: str = "page_id", only_if_better: bool = False,
                checkpoint: bool = True):
    """All intermediate frames of the alignment of sentence rows (key, side, idx, text/vec).

    With ``checkpoint`` the vector rows and best matches (each read by several
    joins) are written once to the checkpoint folder.
    """
    v = Vectors(sent, encoder, key, checkpoint=checkpoint)
    best = best_matches(v)
    if checkpoint:
        best = materialize(best)
    pool = unused_english(v, best)
    cands = merge_candidates(v, best, pool, encoder)
    picks = greedy_merge(best, cands, key, only_if_better)
    return {"vectors": v, "best": best, "unused": pool, "candidates": cands, "picks": picks}


def align_pages(content: DataFrame, encoder=None, key: str = "page_id",
                only_if_better: bool = False) -> DataFrame:
    """Align the English list of every page to its Khmer list.

    ``content`` holds only pages that need alignment (see ``route``).
    Returns the same columns with ``english`` replaced.
    """
    require_columns(content, (key, "english", "khmer"))
    encoder = encoder or NgramEncoder()
    steps = align_steps(sentences(content, key), encoder, key, only_if_better)
    return assemble(content, steps["picks"], key)


def require_columns(df: DataFrame, cols) -> None:
    """Plan-time input check: the alignment needs both lists and the page key."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"content must contain columns {list(cols)}; missing {missing}")


def align(content: DataFrame, encoder=None, key: str = "page_id",
          only_if_better: bool = False) -> DataFrame:
    """Route pages by ``needs_align``: align those, pass the rest unchanged.

    ``needs_align`` is only true when both lists are non-empty (``route``),
    so the aligner never sees an empty side.
    """
    require_columns(content, (key, "english", "khmer", "needs_align"))
    todo = content.filter(F.col("needs_align"))
    rest = content.filter(~F.col("needs_align"))
    done = align_pages(todo, encoder, key, only_if_better).select(*content.columns)
    return rest.unionByName(done)
