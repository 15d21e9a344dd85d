"""Document fingerprints: invertible Bloom lookup sketches, native from end to end.

A text is a set of paragraph digests: its lines, long ones cut into pieces of
``PIECE_WORDS`` words.  A sketch adds each digest to one cell of each of three
sub-tables; a cell holds a count, the xor of its digests and the xor of their
checks.  Sketches of two versions subtract cell by cell; cells that hold one
digest are peeled, round by round, until the difference is recovered or no
such cell is left.  Then the same is done with sketches four times as large.
The first size tried follows from the numbers of digests.

All of it is array expressions inside the row; no Python runs on the executors.

Defined results: a null text is empty; an empty text has an empty sketch; two
empty sketches have likeness 1; repeated paragraphs count once; an empty table
gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoweave.functions.markup import bound
from duoweave.llm import work

PIECE_WORDS = 32
#: Cells of the fingerprint that documents carry, and of the first attempt.
CELLS = 48
#: Rounds of peeling before a larger sketch is tried, and the largest number of attempts.
ROUNDS, ATTEMPTS = 16, 12
CHECK, PLACE = 1, 2


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the text's pieces."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(
        r"(?:[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+){1," + str(PIECE_WORDS) + "}+"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p, F.lit(" \t\x0b\x0c\r")))))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(CHECK)).bitwiseAND(F.lit(0xFFFFFFFF))


def entries(digest: Column, sign: Column, cells: int) -> Column:
    """The three cells that a digest adds to."""
    part = cells // 3
    return F.array(*[F.struct(
        (F.pmod(F.xxhash64(digest, F.lit(PLACE + j), F.lit(cells)), F.lit(part)) + j * part).cast("int").alias("i"),
        sign.alias("c"), digest.alias("k"), check(digest).alias("x")) for j in range(3)])


#: Entries ``v`` added up by cell: sorted, cut at the ends ``e`` of each cell's run, and each run folded on its own, so
#: that the work is linear in the entries.
_SUMMED = """get(transform(array(sort_array(v)), s -> get(transform(array(filter(
    IF(size(s) > 0, sequence(1, size(s)), CAST(array() AS array<int>)), j -> coalesce(get(s, j).i != get(s, j - 1).i, true))), e ->
  filter(transform(e, (z, q) -> aggregate(
      slice(s, coalesce(get(e, q - 1), 0) + 1, z - coalesce(get(e, q - 1), 0)),
      named_struct('i', -1, 'c', 0, 'k', 0L, 'x', 0L),
      (a, y) -> named_struct('i', y.i, 'c', a.c + y.c, 'k', a.k ^ y.k, 'x', a.x ^ y.x))),
    f -> f.c != 0 OR f.k != 0 OR f.x != 0)), 0)), 0)"""


def summed(cells: Column) -> Column:
    """Entries added up by cell, in order of cells; empty cells are left out."""
    return bound(cells, "v", _SUMMED)


def sketch(found: Column, cells: int = CELLS) -> Column:
    """Sketch of an array of digests: its non-empty cells."""
    return summed(F.flatten(F.transform(found, lambda d: entries(d, F.lit(1), cells))))


def subtract(a: Column, b: Column) -> Column:
    """Cells of a sketch less those of another of the same size."""
    return summed(F.concat(a, F.transform(b, lambda z: F.struct(
        z["i"].alias("i"), (-z["c"]).alias("c"), z["k"].alias("k"), z["x"].alias("x")))))


def peel(difference: Column, cells: int = CELLS) -> Column:
    """struct(left, found): cells that could not be peeled, and the recovered (sign, digest)."""
    def step(acc: Column, _: Column) -> Column:
        single = F.filter(acc["left"], lambda z: (F.abs(z["c"]) == 1) & (z["x"] == check(z["k"])))
        pure = F.array_distinct(F.transform(single, lambda z: F.struct(z["c"].alias("c"), z["k"].alias("k"))))
        after = let(pure, lambda p: F.when(F.size(p) == 0, F.struct(
            acc["left"].alias("left"), acc["found"].alias("found"), F.lit(False).alias("go"))).otherwise(F.struct(
                summed(F.concat(acc["left"], F.flatten(F.transform(p, lambda q: entries(q["k"], -q["c"], cells)))))
                .alias("left"), F.concat(acc["found"], p).alias("found"), F.lit(True).alias("go"))))
        return F.when(acc["go"] & (F.size(acc["left"]) > 0), after).otherwise(acc)

    start = F.struct(difference.alias("left"), F.array().cast("array<struct<c:int,k:bigint>>").alias("found"),
                     F.lit(True).alias("go"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def members(cells: Column) -> Column:
    """Number of digests in a sketch, from its counts."""
    return F.aggregate(cells, F.lit(0), lambda n, z: n + z["c"]) / 3


def likeness(a: Column, b: Column, cells: int = CELLS) -> Column:
    """Shared by all digests of two sketches; null where the difference could not be peeled.

    Where the numbers of digests alone differ by more than the cells, peeling is not tried.
    """
    def of(p: Column) -> Column:
        only_a = F.size(F.filter(p["found"], lambda q: q["c"] > 0))
        only_b = F.size(F.filter(p["found"], lambda q: q["c"] < 0))
        every = members(a) + only_b
        return F.when(F.size(p["left"]) == 0, F.when(every == 0, F.lit(1.0)).otherwise((members(a) - only_a) / every))
    return F.when(F.abs(members(a) - members(b)) <= cells, let(peel(subtract(a, b), cells), of))


def as_text(cells: Column) -> Column:
    """A sketch as text: cell, count, digests, checks of each non-empty cell."""
    return F.array_join(F.transform(cells, lambda z: F.concat_ws(
        ":", z["i"].cast("string"), z["c"].cast("string"), F.lower(F.hex(z["k"])), F.lower(F.hex(z["x"])))), ";")


def likenesses(pairs: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """``pairs`` with a column per wanted likeness of two digest columns.

    A likeness is first tried with the least size of sketch (four times the one
    before) that has a cell for every digest of the two, then with larger ones
    until the difference is peeled.  A pass sketches only what it tries.
    """
    keep = pairs.columns
    level = {n: F.greatest(F.ceil(F.log(4.0, F.greatest(F.size(a) + F.size(b), F.lit(1)) / CELLS)), F.lit(0)).cast("int")
             for n, (a, b) in wanted.items()}
    now = pairs.withColumns({n: F.lit(None).cast("double") for n in wanted}).withColumns(
        {f"__level_{n}": c for n, c in level.items()})
    done = None
    for attempt in range(ATTEMPTS):
        cells = CELLS * 4 ** attempt
        due = {n: F.col(n).isNull() & (F.col(f"__level_{n}") <= attempt) for n in wanted}
        need = {c: reduce(or_, [due[n] for n, ab in wanted.items() if c in ab]) for ab in wanted.values() for c in ab}
        tried = now.withColumns({f"__{c}": F.when(d, sketch(F.col(c), cells)) for c, d in need.items()})
        tried = tried.select(*keep, *[f"__level_{n}" for n in wanted], *[
            F.coalesce(n, F.when(due[n], likeness(F.col(f"__{a}"), F.col(f"__{b}"), cells))).alias(n)
            for n, (a, b) in wanted.items()])
        tried, _ = work.save(tried, "sketch-likeness")
        failed = reduce(or_, [F.col(n).isNull() for n in wanted])
        ok = tried.filter(~failed).select(*keep, *wanted)
        done = ok if done is None else done.unionByName(ok)
        now = tried.filter(failed)
        if not now.limit(1).count():
            return done
    raise RuntimeError(f"a difference could not be peeled with {cells} cells")


def following(keys: DataFrame, key: str) -> DataFrame:
    """(key, next): each distinct key's next greater one, the last one's the least.

    Keys are range-partitioned and written with their partition; only one row
    per partition meets in one task.
    """
    rows = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts, _ = work.save(rows.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()), "key-order")
    order = Window.orderBy("part")
    ends = parts.groupBy("part").agg(F.min("key").alias("first"))
    ends = ends.select("part", F.coalesce(F.lead("first").over(order),
                                          F.first("first").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    inside = parts.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    return inside.join(ends, "part").select("key", F.coalesce("next", "after").alias("next"))


def versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of each text, of its edited version and of the next document.

    The edited version's last quarter of code points gives way to the first as
    many (or all) of the next document, ascending keys, the last one's next
    being the first.  A null key has no next document: nothing takes the
    quarter's place.  Of rows with equal keys the least start of a text counts
    as the next one's.  Returns key, version (hash of the text), n_chars,
    edited_sha256, digests, edited and next_digests.
    """
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sizes, _ = work.save(docs.select("key", F.floor(F.char_length("text") / 4).cast("int").alias("quarter")), "quarters")
    after, _ = work.save(sizes.filter("key IS NOT NULL").groupBy("key").agg(
        F.max("quarter").alias("quarter"), F.count(F.lit(1)).alias("n")).join(following(sizes, "key"), "key"), "next-keys")
    # Both joins read the texts dealt by key, so that one exchange serves them.
    keyed = docs.filter("key IS NOT NULL")
    starts = keyed.join(after.select(F.col("key").alias("before"), F.col("next").alias("key"), "quarter"), "key") \
        .select("before", F.expr("substring(text, 1, quarter)").alias("start"))
    if after.filter("n > 1").limit(1).count():
        starts = starts.groupBy("before").agg(F.min("start").alias("start"))
    rows = keyed.join(starts, F.col("key") == F.col("before"), "left").select("key", "text", "start") \
        .union(docs.filter("key IS NULL").select("key", "text", F.lit(None).cast("string").alias("start"))) \
        .withColumn("n", F.char_length("text"))
    quarter = F.floor(F.col("n") / 4).cast("int")
    rows = rows.select("key", "text", "n", F.concat(
        F.substring("text", F.lit(1), F.col("n") - quarter),
        F.substring(F.coalesce("start", F.lit("")), F.lit(1), quarter)).alias("edited"))
    rows, _ = work.save(rows.select(
        "key", F.xxhash64("text").alias("version"), F.col("n").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("digests"),
        digests(F.col("edited")).alias("edited")), "digests")
    nexts = rows.join(after.select(F.col("next").alias("key"), F.col("key").alias("before")), "key") \
        .select("before", F.col("digests").alias("next_digests"))
    if after.filter("n > 1").limit(1).count():
        nexts = nexts.groupBy("before").agg(F.min("next_digests").alias("next_digests"))
    return rows.join(nexts, F.col("key") == F.col("before"), "left").drop("before").withColumn(
        "next_digests", F.coalesce("next_digests", F.array().cast("array<bigint>")))
