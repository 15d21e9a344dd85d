"""Sentence encoders: one vector per sentence, as an array in its row.

Dot products, norms and cosines are taken inside the row of a sentence or of a
pair, native; nothing is exploded.

``NgramEncoder`` (default, no model): character n-grams hashed into ``dims``
buckets and counted in the row.  The vector of "a + ' ' + b" is vec(a) +
vec(b) + vec(J), J being the (at most n) n-grams that cross the joining space,
so merge candidates never have to be re-encoded.

``GivenVectors``: vectors already in the data; a merged sentence is the sum of
its parts.

``ModelEncoder``: a user's sentence model behind an iterator pandas UDF
(model loaded once per Python worker, Arrow batches), producing given
vectors; a merged sentence is encoded as the text that it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:  # only the model plug-in needs pandas (Arrow batches in Python workers)
    import pandas as pd
except ImportError:  # pragma: no cover
    pd = None

# Fixed values of the built-in encoder: n-gram length, number of buckets,
# multiplier and modulus of the polynomial hash over code points.
NGRAM = 3
DIMS = 64
HASH_MULTIPLIER = 1000003
HASH_MODULUS = 2147483647


def ratio(d: Column, na: Column, nb: Column) -> Column:
    """d / sqrt(na * nb) in double, 0 for a zero vector."""
    den = F.sqrt(na.cast("double") * nb.cast("double"))
    return F.when(den == 0, F.lit(0.0)).otherwise(d.cast("double") / den)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


class NgramEncoder:
    """Hashed character n-gram counts.

    The hash is a polynomial of the code points, modulo ``HASH_MODULUS``; its
    terms are added before the one modulo, which 64 bits hold for 3 code points.
    """

    kind = "ngram"
    has_junction = True

    def __init__(self, n: int = NGRAM, dims: int = DIMS):
        if n > 3:
            raise ValueError("n-grams of more than 3 characters don't fit the hash")
        self.n = n
        self.dims = dims

    def buckets(self, text: Column) -> Column:
        """array<int>: bucket of every n-gram of a text (whole text, code points); empty if it is shorter than n."""
        points = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("bigint"))

        def bucket(cs: Column, i: Column) -> Column:
            h = F.get(cs, i + (self.n - 1) if self.n > 1 else i)
            for k in range(self.n - 1):
                h = h + F.get(cs, i + k if k else i) * F.lit(HASH_MULTIPLIER ** (self.n - 1 - k))
            # no code point is negative, so % and pmod agree
            bucket = (h % F.lit(HASH_MODULUS).cast("bigint") % F.lit(self.dims).cast("bigint")).cast("int")
            return F.coalesce(bucket, F.lit(0))

        def places(cs: Column) -> Column:
            return F.when(F.size(cs) >= self.n, F.sequence(F.lit(0), F.size(cs) - self.n)).otherwise(
                F.array().cast("array<int>"))

        return let(points, lambda cs: F.transform(places(cs), lambda i: bucket(cs, i)))

    def runs(self, buckets: Column) -> Column:
        """array<int>: the sorted buckets, every bucket of the encoder added once."""
        return F.sort_array(F.concat(buckets, F.sequence(F.lit(0), F.lit(self.dims - 1))))

    def counts(self, runs: Column) -> Column:
        """array<double> of length ``dims``: how often each bucket is there, from the ends of the runs (one per bucket)."""
        ends = F.filter(F.sequence(F.lit(1), F.size(runs)),
                        lambda i: F.coalesce(F.get(runs, i) != F.get(runs, i - 1), F.lit(True)))
        return let(ends, lambda es: F.transform(
            es, lambda e, k: (e - F.coalesce(F.get(es, k - 1), F.lit(0)) - 1).cast("double")))

    def vectors(self, sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        """(keys..., vec, head, tail): one row per sentence; head and tail are what a junction needs."""
        t = F.coalesce(F.col(text), F.lit(""))
        return sentences.select(*keys, self.buckets(t).alias("_b"), self.head(t).alias("head"), self.tail(t).alias("tail")) \
            .select(*keys, self.runs(F.col("_b")).alias("_b"), "head", "tail") \
            .select(*keys, self.counts(F.col("_b")).alias("vec"), "head", "tail")

    def sparse(self, sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        """(keys..., bucket, val): the non-zero components as rows, for use outside the alignment."""
        vecs = self.vectors(sentences, keys, text).select(*keys, F.posexplode("vec").alias("bucket", "val"))
        return vecs.filter(F.col("val") > 0).withColumn("val", F.col("val").cast("bigint"))

    def head(self, text: Column) -> Column:
        return F.substring(text, 1, self.n - 1)

    def tail(self, text: Column) -> Column:
        k = self.n - 1
        return F.when(F.length(text) >= k, F.substring(text, -k, k)).otherwise(text)

    def junction(self, tail: Column, head: Column) -> Column:
        """array<int>: buckets of the n-grams crossing "left + ' ' + right"."""
        return self.buckets(F.concat(tail, F.lit(" "), head))

    def merged(self, texts: DataFrame, keys: list[str], text: str) -> DataFrame | None:
        return None


class GivenVectors:
    """Dense vectors already in the data; merged sentence = sum of the vectors."""

    kind = "given"
    has_junction = False

    def __init__(self, column: str = "vec", dims: int | None = None):
        self.column = column
        self.dims = dims

    def vectors(self, sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        """(keys..., vec): one row per sentence."""
        v = F.col(self.column).cast("array<double>")
        if self.dims is not None:
            v = F.when(F.size(v) == self.dims, v).otherwise(
                F.raise_error(F.lit(f"vector length differs from dims={self.dims}")))
        return sentences.select(*keys, v.alias("vec"))

    def merged(self, texts: DataFrame, keys: list[str], text: str) -> DataFrame | None:
        """(keys..., vec) of merged sentences; None where they are the sums of their parts."""
        return None


class ModelEncoder(GivenVectors):
    """A user's sentence model behind an iterator pandas UDF.

    ``load`` returns a callable ``list[str] -> list[list[float]]``; it runs
    once per Python worker; batches arrive as Arrow record batches.  Each
    distinct merged text of a page is encoded once.

    Error tolerance: a model that cannot load fails the job.  When a batch
    call raises, its texts are retried one by one; a text whose call raises
    (or gives a vector of the wrong length) gets a null vector; pages with any
    null vector are left out of the alignment and keep their unaligned lists
    (``failed_pages`` names them).  A merged text without a vector scores 0.
    """

    kind = "model"

    def __init__(self, load: Callable[[], Callable[[list[str]], list[list[float]]]], dims: int):
        super().__init__("_model_vec", dims)
        self.load = load
        self._failed = None

    def udf(self):
        load = self.load
        dims = self.dims

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()  # a model that cannot load fails the job

            def checked(v):
                return list(map(float, v)) if v is not None and len(v) == dims else None

            def one(t):
                try:
                    return checked(model([t])[0])
                except Exception:  # noqa: BLE001 - this sentence failed
                    return None

            for s in batches:
                texts = s.fillna("").tolist()
                try:
                    out = [checked(v) for v in model(texts)]
                except Exception:  # noqa: BLE001 - retry the batch text by text
                    out = [one(t) for t in texts]
                yield pd.Series(out)

        return encode

    def vectors(self, sentences: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
        from duoweave.session import materialize

        # the model runs once per sentence; its output is read twice below
        withvec = materialize(sentences.select(*keys, self.udf()(F.col(text)).alias("vec")))
        self._failed = withvec.filter(F.col("vec").isNull()).select(keys[0]).distinct()
        return withvec.join(self._failed, keys[0], "left_anti")

    def merged(self, texts: DataFrame, keys: list[str], text: str) -> DataFrame | None:
        return texts.select(*keys, self.udf()(F.col(text)).alias("vec"))

    def failed_pages(self) -> DataFrame | None:
        return self._failed
