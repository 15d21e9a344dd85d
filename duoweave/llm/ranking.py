"""Quality by pairwise ranking (Bradley-Terry).

Each whole text becomes a short vector of statistics of its bytes, words and
lines, in the scan's tasks.  From labelled rows preference pairs are drawn (a
good text is preferred to a bad one); the chance that one text beats another is
the logistic function of the difference of their scores, a score is linear in
the statistics, and the weights minimise the logistic loss on the pairs'
differences.  Texts whose score reaches a quantile of the labelled scores (the
one that parts as many rows as are labelled bad) are good.

Weights are fitted on a bounded sample (``ROWS`` labelled rows of each label,
``PARTNERS`` pairs per row); counts and the quantile's cut cover all labelled
rows, as counts of rounded scores; every text is scored.

Defined results: a null text is empty; an empty text has statistics like any
other; without labelled rows of both labels every score is the share of label
1 among them (0.5 without any); repeated rows are scored alike; labels of
repeated keys count as the highest one, null labels as none; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoweave.llm import work

#: Bounds of the sample that weights are fitted on.
ROWS, PARTNERS = 4000, 16
#: Places that the hash of a row may fall in.
PLACES = 1 << 40
#: Weight of the squared weights in the loss, per pair; rounds of Newton's method.
PENALTY, ROUNDS = 1e-3, 30
#: Scores are counted in steps of 1 / STEPS up to LIMIT away from 0.
STEPS, LIMIT = 200, 100.0
#: Score of a text that just reaches the quantile.
CUT = 0.7
#: Marks that are counted one by one.
MARKS = b"#*$%&|<>!?.,:;-_/=@~^+'\"()[]{}"
SMOOTH = 8.0


def shares(text: str) -> list[float]:
    """Statistics of a text: logarithms of smoothed shares, so that rare marks count by ratio."""
    raw = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [x.strip() for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    n, n_lines, size = len(words), len(lines), len(raw)
    upper, lower, digits = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum())
    again = sum(a == b for a, b in zip(words, words[1:]))
    closed = sum(x[-1] in b".!?" for x in lines)

    def share(part: float, whole: float) -> float:
        return float(np.log((part + 1.0) / (whole + SMOOTH)))

    return [
        np.log1p(n), np.log1p(n / (n_lines + 1.0)), size / (n + 1.0) / 10.0,
        share(upper, upper + lower), share(digits, size), share(int(count[128:].sum()), size),
        share(len(set(words)), n), share(again, n), share(n_lines - len(set(lines)), n_lines),
        share(closed, n_lines), again / (n + 1.0), upper / (upper + lower + 1.0),
        *[share(int(count[m]), n) for m in MARKS],
    ]


def statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, f): the statistics of every row's text, written once."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            f = [shares(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f, pa.list_(pa.float32()))], ["key", "f"])

    rows = docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, f"key {kind}, f array<float>")
    return work.save(rows, "text-statistics")[0]


@dataclass(frozen=True)
class Model:
    """Score of a text: weights on its statistics, and the score that reaches the quantile; or one share for all."""

    weights: tuple[float, ...] = ()
    cut: float = 0.0
    share: float = 0.5

    def raw(self, f: Column) -> Column:
        total = F.lit(0.0)
        for i, w in enumerate(self.weights):
            total = total + f[i].cast("double") * F.lit(w)
        return total

    def score(self, f: Column) -> Column:
        if not self.weights:
            return F.lit(self.share)
        at_cut = float(np.log(CUT / (1 - CUT)))
        return 1 / (1 + F.exp(F.lit(self.cut) - F.lit(at_cut) - self.raw(f)))


def pairs(good: np.ndarray, bad: np.ndarray, partners: int = PARTNERS) -> np.ndarray:
    """Differences of statistics of preference pairs: each row of the larger label with so many of the other."""
    n = max(len(good), len(bad))
    at = np.arange(n * partners)
    # Each turn through the rows meets the other label at another place.
    turn = at // n
    return good[(at + turn * 7) % len(good)] - bad[(at + turn * 13) % len(bad)]


def fit_weights(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights of least logistic loss on the pairs' differences, by Newton's method."""
    scale = np.concatenate([good, bad]).std(0)
    scale[scale < 1e-6] = np.inf
    x = pairs(good, bad) / scale
    w = np.zeros(x.shape[1])

    def loss(w):
        return np.logaddexp(0, -x @ w).sum() + PENALTY * len(x) / 2 * w @ w

    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(x @ w, -500, 500)))
        slope = x.T @ p - PENALTY * len(x) * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + PENALTY * len(x) * np.eye(len(w))
        step, now = np.linalg.solve(curve, slope), loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w / scale


def fit(found: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", label: str = "quality") -> Model:
    """Model from the rows of ``found`` (key, f) with a label whose key meets ``train``."""
    marked = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")) \
        .filter("key IS NOT NULL AND label IN (0, 1)").filter(train).groupBy("key").agg(F.max("label").alias("label"))
    rows, path = work.save(found.join(marked, "key"), "labelled-statistics")
    spark = rows.sparkSession
    count = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = count.get(1, 0), count.get(0, 0)
    if not good or not bad:
        work.drop(spark, path)
        return Model(share=good / (good + bad) if good + bad else 0.5)
    picked = {}
    for value, n in ((0, bad), (1, good)):
        # About twice as many as asked for, by a hash, of which the first are taken: a bounded number reaches the driver.
        place = F.pmod(F.xxhash64("key", "f"), F.lit(PLACES))
        some = rows.filter((F.col("label") == value) & (place < int(PLACES * min(1.0, 2 * ROWS / n)))) \
            .select("f", place.alias("place")).distinct()
        first = sorted((r["place"], r["f"]) for r in some.collect())[:ROWS]
        picked[value] = np.array([f for _, f in first], np.float64)
    weights = tuple(float(w) for w in fit_weights(picked[1], picked[0]))
    # The quantile that parts as many labelled rows as are labelled bad, in the gap above it.
    raw = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), Model(weights).raw(F.col("f"))))
    steps = rows.groupBy(F.round(raw * STEPS).cast("long").alias("at")).count().orderBy("at").collect()
    work.drop(spark, path)
    below = np.cumsum([r["count"] for r in steps])
    i = int(np.searchsorted(below, bad))
    cut = (steps[i]["at"] + steps[min(i + 1, len(steps) - 1)]["at"]) / 2 / STEPS
    return Model(weights, float(cut))


def score(found: DataFrame, model: Model) -> DataFrame:
    """(key, score): from 0 to 1, at least ``CUT`` where the quantile is reached."""
    return found.select("key", model.score(F.col("f")).alias("score"))
