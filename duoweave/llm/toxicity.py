"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on the words
of toxic texts that recur there and are in a ``RATIO`` times larger share of
toxic than of ordinary texts.  Each also holds the
same ordinary background, so that the two differ in their trained part alone.
A text is read in overlapping
windows of ``WINDOW`` words; a window's gain is its length
compressed with the ordinary dictionary less its length with the toxic one.
Gains are compared with thresholds calibrated on labelled texts that the
dictionaries have not seen: each step of gain has a log-likelihood ratio, and
a logistic curve turns a text's ratios into its score.

The model is fitted on a bounded sample of labelled rows (``TOXIC_ROWS`` and
``ORDINARY_ROWS`` rows, ``SAMPLE_BYTES`` bytes); every whole text is scored, in
the scan's tasks, without a shuffle.

Defined results: a null text is empty; an empty text has no windows and the
score of the curve's foot; without labelled rows of both classes every score
is the share of toxic labels (0 without any); repeated rows are scored alike;
labels of repeated keys count as the highest label; of the texts of a repeated
key the one with the least hash is sampled; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

WINDOW, STEP = 12, 6
#: Bounds of the labelled sample: rows of each class and bytes of all; longer texts are not sampled.
TOXIC_ROWS, ORDINARY_ROWS, SAMPLE_BYTES, TEXT_BYTES = 2000, 4000, 48 << 20, 200_000
#: Bytes of the background and of the trained part of each dictionary.
BACKGROUND, TRAINED = 8192, 1024
LEVEL = 9
#: Parts of the sample, each calibrated by dictionaries of the others.
FOLDS = 3
#: A word recurs if it is in at least so many toxic texts of the sample, and in this share of them.
SPREAD, SPREAD_SHARE = 3, 0.015
#: A recurring word counts if its share of toxic texts is so many times that of ordinary texts (each count plus one).
RATIO = 20
#: Gains are clipped to this range.
LEAST, MOST = -3, 9


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def windows(text: str | None) -> list[bytes]:
    """Windows of ``WINDOW`` words, one every ``STEP`` words; the last one may be shorter."""
    w = words(text)
    return [b" ".join(w[i:i + WINDOW]) for i in range(0, max(len(w) - WINDOW, 0) + STEP, STEP)] if w else []


def bare(word: bytes) -> bytes:
    return word.strip(b".,;:!?\"'()")


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    ratios: np.ndarray | None = None
    curve: np.ndarray | None = None
    prior: float = 0.0

    def compressors(self):
        def of(content: bytes):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                            write_dict_id=False).compress
        return of(self.ordinary), of(self.toxic)

    def gains(self, text: str | None, compressors) -> np.ndarray:
        """Index of each window's clipped gain."""
        a, b = compressors
        found = np.array([len(a(w)) - len(b(w)) for w in windows(text)], np.int64)
        return np.clip(found, LEAST, MOST) - LEAST

    def features(self, gains: np.ndarray) -> np.ndarray:
        """Constant, sum of ratios, sum by root of the length, and the highest ratio."""
        if not len(gains):
            return np.array([1.0, 0.0, 0.0, 0.0])
        r = self.ratios[gains]
        return np.array([1.0, r.sum(), r.sum() / np.sqrt(len(r)), r.max()])

    def scores(self, texts, compressors) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.prior)
        x = np.array([self.features(self.gains(t, compressors)) for t in texts]).reshape(-1, 4)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -40, 40)))


def dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Content that zstandard's trainer picks; too few samples are the content themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(samples)[:size]


def dictionaries(toxic: list[str], ordinary: list[str]) -> Model:
    """Model with the two dictionaries only."""
    plain = [w for t in ordinary for w in windows(t)]
    half = len(plain) // 2
    background = dictionary(plain[:half], BACKGROUND, 64, 8)
    common, spread = (Counter(w for t in ts for w in {bare(w) for w in words(t)}) for ts in (ordinary, toxic))
    rate = RATIO * (len(toxic) + 2) / (len(ordinary) + 2)
    recurring = {w for w, c in spread.items()
                 if c >= max(SPREAD, SPREAD_SHARE * len(toxic)) and c + 1 >= rate * (common[w] + 1) and w}
    marked = [b" " + b" ".join(x) + b" " for t in toxic if (x := [bare(w) for w in words(t) if bare(w) in recurring])]
    return Model(dictionary(plain[half:], TRAINED, 32, 6) + background, dictionary(marked, TRAINED, 24, 6) + background)


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """Model from labelled texts.

    Thresholds are calibrated on gains of texts that the dictionaries have not
    seen: each third by dictionaries of the other two.  The model's own
    dictionaries are trained on all of the texts.
    """
    n = len(toxic) + len(ordinary)
    if len(toxic) < FOLDS or len(ordinary) < FOLDS:
        return Model(prior=len(toxic) / n if n else 0.0)
    gains: list[list[np.ndarray]] = [[], []]
    for fold in range(FOLDS):
        seen = [[t for i, t in enumerate(xs) if i % FOLDS != fold] for xs in (toxic, ordinary)]
        partial = dictionaries(*seen)
        both = partial.compressors()
        for found, xs in zip(gains, (toxic, ordinary)):
            found += [partial.gains(t, both) for t in xs[fold::FOLDS]]
    model = dictionaries(toxic, ordinary)
    count = [np.bincount(np.concatenate(g), minlength=MOST - LEAST + 1) + 1.0 for g in gains]
    model.ratios = np.log(count[0] / count[0].sum()) - np.log(count[1] / count[1].sum())
    x = np.array([model.features(g) for gs in gains for g in gs])
    y = np.repeat([1.0, 0.0], [len(gains[0]), len(gains[1])])
    model.curve = logistic(x, y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(docs: DataFrame, marks: DataFrame) -> tuple[list[str], list[str]]:
    """Toxic and ordinary texts of the labelled sample.

    Rows are picked by the order of their keys' hashes, from keys, text hashes
    and text sizes alone, one row of each key (the least text hash); only the
    picked texts (bounded in rows and bytes) are read and brought to the driver.
    """
    h = F.xxhash64(F.col("key").cast("string")).alias("h")
    version = F.xxhash64("text").alias("version")
    sized = docs.select("key", version, F.octet_length("text").alias("size")).filter(F.col("size") <= TEXT_BYTES) \
        .join(marks, "key").groupBy("key", "mark").agg(F.min(F.struct("version", "size")).alias("row")) \
        .select("key", "mark", "row.version", "row.size", h)
    chosen = []
    for label, rows in ((F.col("mark") > 0, TOXIC_ROWS), (F.col("mark") <= 0, ORDINARY_ROWS)):
        left = SAMPLE_BYTES // 2
        for r in sized.filter(label).orderBy("h", "key").limit(rows).collect():
            left -= r["size"]
            if left < 0:
                break
            chosen.append((r["key"], r["version"], r["mark"] > 0))
    keys = docs.sparkSession.createDataFrame(
        chosen, StructType([docs.schema["key"], StructField("version", LongType()), StructField("toxic", BooleanType())]))
    found = docs.filter(F.octet_length("text") <= TEXT_BYTES).withColumn("version", version) \
        .join(F.broadcast(keys), ["key", "version"]).dropDuplicates(["key"]).select(h, "toxic", "text").collect()
    found.sort(key=lambda r: (r["h"], r["text"]))
    return [r["text"] for r in found if r["toxic"]], [r["text"] for r in found if not r["toxic"]]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> Model:
    """Model from the labelled rows of ``docs`` for which ``allowed`` (over ``key``) holds."""
    marks = (labels.filter(F.col(f"`{label}`").isNotNull()).filter(allowed)
             .groupBy(F.col(f"`{key}`").alias("key")).agg(F.max(f"`{label}`").alias("mark")))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return train(*sample(rows, marks))


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): one row per row of ``df``."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        compressors = model.compressors()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(model.scores(b.column(1).to_pylist(), compressors))], ["key", "score"])

    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`")).mapInArrow(run, f"key {kind}, score double")
