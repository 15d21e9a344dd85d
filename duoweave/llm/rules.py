"""Quality rules: a learned decision list over text statistics, native from end to end.

``statistics`` derives counts and ratios of every whole text with array
expressions.  ``learn`` grows a list of threshold conjunctions by sequential
covering: each step is one grouped count of labelled rows by feature and
threshold bin, grown on two thirds of the labelled rows and pruned on the
rest.  ``apply`` emits the list as one ordered conditional expression.  No
Python runs on the executors, and only per-bin counts reach the driver.

Defined results: a null text has no words; an empty or unlabelled training
table gives an empty list, which rejects nothing; labels of repeated keys
count as the lowest label; null labels are left out; ties in gain go to the
earlier feature and lower threshold; other columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT = 3


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text`` but with one column ``stats`` of counts over the whole text.

    Windows of three words that occur twice are found by sorting the windows'
    64-bit hashes inside the row.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != text]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = df.select(*keep, body.alias("__t"),
                      F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "").alias("__w"))
    last = F.size("__w") - REPEAT
    gram = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(
        F.xxhash64(*[F.get("__w", i + k) for k in range(REPEAT)]).alias("h"), i.alias("i")))
    grams = words.select(*keep, "__t", "__w", F.sort_array(F.when(last >= 0, gram)).alias("__g"))
    twice = F.filter("__g", lambda g, k: (F.get("__g", k - 1)["h"] == g["h"]).eqNullSafe(True)
                     | (F.get("__g", k + 1)["h"] == g["h"]).eqNullSafe(True))
    covered = F.array_distinct(F.flatten(F.transform(
        twice, lambda g: F.array(*[g["i"] + k for k in range(REPEAT)]))))
    lines = grams.select(*keep, "__t", "__w", F.coalesce(F.size(covered), F.lit(0)).alias("__r"),
                         F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("__l"))
    return lines.select(*keep, F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate("__t", WHITE, "")).cast("long").alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.greatest("__r", F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct_words"),
        _count_of(F.col("__t"), "!?").alias("n_calls"),
        _count_of(F.col("__t"), "0123456789").alias("n_digits"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    ).alias("stats"))


def features(stats: Column) -> dict[str, Column]:
    """Ratios that conditions may use, by name; a text without words has ratio 0."""
    s = lambda name: stats[name].cast("double")
    per_word = lambda name: F.when(s("n_words") > 0, s(name) / s("n_words")).otherwise(0.0)
    per_char = lambda name: F.when(s("word_chars") > 0, s(name) / s("word_chars")).otherwise(0.0)
    per_line = lambda name: F.when(s("n_lines") > 0, s(name) / s("n_lines")).otherwise(0.0)
    return {
        "n_words": s("n_words"),
        "chars_per_word": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "calls_per_word": per_word("n_calls"),
        "upper_per_char": per_char("n_upper"),
        "digits_per_char": per_char("n_digits"),
        "repeat_share": per_word("n_repeat_words"),
        "distinct_share": per_word("n_distinct_words"),
        "dup_line_share": per_line("n_dup_lines"),
        "words_per_line": per_line("n_words"),
    }


def base_failed(stats: Column) -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        f = features(stats)[self.feature]
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The first rule that holds, as text; null where none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_all(rule, stats), F.lit(" AND ".join(map(str, rule)))).otherwise(out)
    return out


def _all(rule: Rule, stats: Column) -> Column:
    held = F.lit(True)
    for c in rule:
        held = held & c.column(stats)
    return held


#: Shares of each class at which thresholds are tried.
CUTS = [0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99]


def learn(labelled: DataFrame, key: str = "doc_id", label: str = "quality", max_rules: int = 12,
          max_conditions: int = 3, min_precision: float = 0.95, min_rows: int = 5) -> list[Rule]:
    """Decision list that names low quality (label 0), from rows (key, label, stats).

    Thresholds are quantiles of each class over all labelled rows.  A rule is
    grown condition by condition by information gain and pruned from the end by
    (p - n) / (p + n) on the held-out third; it is taken if it is precise
    enough there, and rows that it covers leave both parts.
    """
    names = list(features(F.col("stats")))
    values = F.array(*features(F.col("stats")).values())
    rows = labelled.filter(F.col(label).isNotNull()).select(
        (F.col(label) == 0).alias("bad"), (F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(3)) == 0).alias("prune"),
        values.alias("v"))
    cuts = rows.groupBy("bad").agg(*[F.percentile_approx(F.col("v")[i], CUTS, 1000).alias(n)
                                     for i, n in enumerate(names)]).collect()
    tried = {n: sorted({x for r in cuts for x in r[n] or []}) for n in names}
    def bin_of(i: int, name: str) -> Column:
        """Number of thresholds below the row's value."""
        return F.size(F.filter(F.array(*[F.lit(x) for x in tried[name]]).cast("array<double>"),
                               lambda t: t < F.col("v")[i]))

    bins = F.array(*[bin_of(i, n) for i, n in enumerate(names)])
    rows, path = work.save(rows.withColumn("bin", bins).groupBy("bad", "prune", "bin").agg(
        F.count(F.lit(1)).alias("n")), "rule-rows")

    def holds(c: Condition) -> Column:
        at = tried[c.feature].index(c.threshold)
        b = F.col("bin")[names.index(c.feature)]
        return b > at if c.above else b <= at

    def keep(rule) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & holds(c)
        return out

    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows
        for r in rules:
            left = left.filter(~keep(r))
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            inside = left.filter(~F.col("prune") & keep(rule))
            counts = inside.select("bad", "n", F.posexplode("bin").alias("f", "b")).groupBy("f", "b", "bad").agg(
                F.sum("n").alias("n")).collect()
            best = _best_condition(names, tried, counts)
            if best is None:
                break
            rule.append(best[0])
            if best[1] == 0:
                break
        if not rule:
            break
        sums = [F.sum(F.when(keep(rule[:k]) & (F.col("bad") == b), F.col("n")).otherwise(0)).alias(f"c{k}_{int(b)}")
                for k in range(1, len(rule) + 1) for b in (True, False)]
        row = left.filter("prune").agg(*sums).first()
        worth = []
        for k in range(1, len(rule) + 1):
            p, n = row[f"c{k}_1"] or 0, row[f"c{k}_0"] or 0
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        value, k, p, n = max(worth)
        if p < min_rows or p < min_precision * (p + n):
            break
        rules.append(tuple(rule[:-k]))
    work.drop(labelled.sparkSession, path)
    return rules


def _best_condition(names, tried, counts) -> tuple[Condition, int] | None:
    """The condition with the most information gain, and the good rows it still covers."""
    tally: dict[tuple[int, bool], dict[int, int]] = {}
    for r in counts:
        tally.setdefault((r["f"], r["bad"]), {})[r["b"]] = r["n"]
    all_p = sum(tally.get((0, True), {}).values())
    all_n = sum(tally.get((0, False), {}).values())
    if not all_p or not all_n:
        return None
    before = math.log2(all_p / (all_p + all_n))
    best = None
    for f, name in enumerate(names):
        bad, good = tally.get((f, True), {}), tally.get((f, False), {})
        for at, t in enumerate(tried[name]):
            above = sum(n for b, n in bad.items() if b > at), sum(n for b, n in good.items() if b > at)
            for up, (p, n) in ((True, above), (False, (all_p - above[0], all_n - above[1]))):
                if p and p + n < all_p + all_n:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > 1e-9 and (best is None or gain > best[2] + 1e-9):
                        best = (Condition(name, up, t), n, gain)
    return best[:2] if best else None


def labelled(stats: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, stats) of the labelled rows; ``stats`` has columns key and stats."""
    marks = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")) \
        .filter("key IS NOT NULL AND label IS NOT NULL").groupBy("key").agg(F.min("label").alias("label"))
    return stats.join(marks, "key")


def judged(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           carry: bool = False, **options) -> tuple[DataFrame, list[Rule]]:
    """(key, stats, base_failed, rule, kept) for every row of ``df``, and the learned list.

    Statistics are derived once and written; learning and the verdict read
    them.  With ``carry`` the rows are written beside their statistics and a
    column ``row`` holds them.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    stats, _ = work.save(statistics(df.select(F.col(f"`{key}`").alias("key"), *row, F.col(f"`{text}`").alias("__text")),
                                    "__text"), "rule-stats")
    rules = learn(labelled(stats.select("key", "stats"), labels, key, label), key="key", label="label", **options)
    s = F.col("stats")
    out = stats.select(F.col("key").alias(key), "stats", base_failed(s).alias("base_failed"),
                       verdict(rules, s).alias("rule"), *["row"] * carry)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def keep(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that neither the base rule nor the learned list rejects."""
    return judged(df, labels, carry=True, **options)[0].filter("kept").select("row.*")
