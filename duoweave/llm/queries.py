"""Registered queries of the thirteen operators: thin calls that derive the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoweave.llm import (chat, linealign, merkle, mixing, packing, ranking, repair, rules, sharding, simhash, sketches,
                          substrings, toxicity)
from duoweave.llm.oracle import OP12_SQL, OP13_SQL
from duoweave.llm.work import table

SHARDS = 40


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 40 by its doc_id, its slot there, and its shard among 41."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    docs = sharding.assign(sharding.assign(docs, F.col("doc_id"), SHARDS), F.col("doc_id"), SHARDS + 1, "grown_shard")
    return sharding.number(docs)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; sources weigh 3, 1, 2 and share 150 % of all words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.with_copies(docs).select("doc_id", "size", "source_size", "target",
                                           (F.col("copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS cap FROM s
), r AS (
  SELECT *, cap / weight AS lim, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM w
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY lim, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY lim, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r
), t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(lev, lim) FROM l WHERE lim >= lev), 1e300) * weight) AS target FROM l
), m AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) * size AS taken FROM m
"""

def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 64-bit SimHash of 3-word shingles and its class at 3 differing bits or fewer."""
    return simhash.classes(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op2_line_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line blocks that it shares, aligned, with an earlier one."""
    return linealign.kept(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_lines", "n_deleted", F.col("sha").alias("kept_sha256"))


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids, filled with lexical neighbours."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's paragraph sketch, its edited version's, and their likeness and the next document's."""
    pairs = sketches.likenesses(sketches.versions(table(spark, sf_dir, "documents")), {
        "near_edited": ("digests", "edited"), "near_next": ("digests", "next_digests")})
    text = lambda c: sketches.as_text(sketches.sketch(F.col(c)))
    return pairs.select(F.col("key").alias("doc_id"), "n_chars", "edited_sha256", text("digests").alias("fingerprint"),
                        text("edited").alias("edited_fingerprint"), "near_edited", "near_next")


def op7_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; labels are learned from four fifths of the rows by crc32 of the id."""
    def held_out(key):
        return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score(docs, model).select(
        F.col("key").alias("doc_id"), F.coalesce(held_out(F.col("key")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, base rule and the verdict of the list learned from labels.quality."""
    found, _ = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[F.col("stats")[c].alias(c) for c in counts], "base_failed", "kept", "rule")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one whose texts are control strings."""
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    turns = chat.canonical_turns(rows.select("conv_id", record.alias("record")), "conv_id", "record")
    return chat.read_back(chat.format_turns(turns)).withColumnRenamed("id", "conv_id")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier somewhere."""
    return substrings.removed(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"))


def op11_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; labels are learned from three quarters of the rows by crc32 of the id."""
    def held_out(key):
        return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2

    found = ranking.statistics(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = ranking.fit(found, table(spark, sf_dir, "labels"), ~held_out(F.col("key")))
    return ranking.score(found, model).select(
        F.col("key").alias("doc_id"), F.coalesce(held_out(F.col("key")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof, and the root that follows from its tampered version."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    docs = table(spark, sf_dir, "documents")
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = F.when((F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0) & F.contains("text", F.lit("\n")),
                      merkle.leaf(*[cut if c == "text" else F.col(c) for c in columns]))
    found = merkle.manifest(docs.withColumn("tampered", tampered), columns, keep=("doc_id", "tampered"))
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("witness")))
    proof = F.sha2(F.encode(merkle.siblings(F.col("witness")), "UTF-8"), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given the role user, by crc32 of conv_id:turn."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.encode(F.concat(some("conv_id"), F.lit(":"), some("turn")), "UTF-8")) % 20
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), how.alias("how"))
    return rows.filter("how != 0").select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times)).drop("col")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and the repaired text's digest."""
    rows = table(spark, sf_dir, "conversations")
    fixed = repair.repair(damaged(rows))
    audits = fixed.audits.groupBy("key").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "audit"))), lambda a: a["audit"]), "").alias("audit"))
    out = rows.select("conv_id").distinct()
    for part in (fixed.report, audits, repair.digests(fixed.turns)):
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("key")), "left").drop("key")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_line_align": op2_line_align,
    "op3_jump_shards": op3_jump_shards,
    "op4_source_mix": op4_source_mix,
    "op5_bm25_packing": op5_bm25_packing,
    "op6_iblt_fingerprint": op6_iblt_fingerprint,
    "op7_compression_toxicity": op7_compression_toxicity,
    "op8_decision_list": op8_decision_list,
    "op9_chat_format": op9_chat_format,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_pairwise_quality": op11_pairwise_quality,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_turn_repair": op13_turn_repair,
}
ORACLE = {"op4_source_mix": OP4_SQL, "op12_merkle_manifest": OP12_SQL, "op13_turn_repair": OP13_SQL}
