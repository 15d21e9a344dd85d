from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duoweave.functions.text import clean_array, clean_text, is_script, language_label, text_of
from tests.models import clean, is_khmer

NBSP = "\u00a0"

CLEAN_CASES = [
    (None, ""), ("", ""), ("-", ""), ("--", ""), ("-----", ""), ("---", "---"),
    ("  a" + NBSP + NBSP + "b ", "a b"), (" - - - ", "- - -"), ("\u001c a\u001fb\u0085", "a b"),
    ("- -  -", ""), ("　x y", "x y"), ("* *  *", "* * *"), ("a\u200bb", "a\u200bb"),
    ("***", "***"), ("****", "****"), (".", ""), (" . ", ""), ("..", ".."), ("...", "..."),
    ("- a", "- a"), ("-" + NBSP + "-" + NBSP + "-", ""),
]


def test_clean_text_vectors(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CLEAN_CASES)], "i int, s string")
    got = {r["i"]: r["c"] for r in df.select("i", clean_text("s").alias("c")).collect()}
    arr = df.agg(F.collect_list(F.struct("i", "s")).alias("a")).select(
        F.transform("a", lambda x: x["i"]).alias("i"), clean_array(F.transform("a", lambda x: x["s"])).alias("c"))
    row = arr.collect()[0]
    got_arr = dict(zip(row["i"], row["c"]))
    for i, (_, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, CLEAN_CASES[i]
        assert got_arr[i] == want, CLEAN_CASES[i]


KHMER = "កខគ"
KHMER_CASES = [
    ("", False), ("123", False), ("абв", False), (KHMER + "ab", False),
    ("កខ" + "a", True), ("០១", True), ("ាិ", False), (None, False),
]


def test_is_khmer_vectors(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(KHMER_CASES)], "i int, s string")
    got = {r["i"]: (r["k"], r["lab"]) for r in
           df.select("i", is_script("s").alias("k"), language_label("s").alias("lab")).collect()}
    for i, (_, want) in enumerate(KHMER_CASES):
        assert got[i][0] == want, KHMER_CASES[i]
        assert got[i][1] == ("khmer" if want else "english")


ALPHABET = st.sampled_from(list("ab- .*\t\n") + [NBSP, " ", "　", "​", "ក", "ា",
                                                 "០", "é", "а", "\u001c", "\u0085", "Z", "1"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=50, max_size=200))
def test_clean_and_label_match_python_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", clean_text("t").alias("c"), is_script("t").alias("k")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["c"] == clean(t), repr(t)
        assert r["k"] == is_khmer(t), repr(t)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=20, max_size=80))
def test_clean_is_idempotent_without_tokens(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(clean_text("t").alias("c"))
    twice = once.select("c", clean_text("c").alias("cc")).collect()
    for r in twice:
        assert r["c"] == r["cc"]


def test_text_of_glue_and_entities(spark):
    df = spark.createDataFrame([("one <i>two</i>",), ("a &amp; b&lt;c&gt; &nbsp;",), ("<b></b>",)], "h string")
    glued = [r[0] for r in df.select(text_of("h", "")).collect()]
    spaced = [r[0] for r in df.select(text_of("h", " ")).collect()]
    assert glued == ["onetwo", "a & b<c>", ""]
    assert spaced == ["one two", "a & b<c>", ""]


def test_character_sets_equal_python_definitions():
    import re

    from duoweave.functions import text as T

    ws = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(T.WHITESPACE_CHARS) == ws
    khmer = {chr(i) for i in range(0x1780, 0x1800) if re.sub(r"[^\w\s]", "", chr(i)) and not chr(i).isspace()}
    assert set(T._chars(T.KHMER_LETTERS)) == khmer
    latin = {chr(i) for i in range(256) if chr(i).isalpha()}
    assert set(T._chars(T.LATIN_LETTERS)) == latin


def test_numeric_references_match_html_unescape(spark):
    import html

    from duoweave.functions.markup import decode_references

    cases = ["&#65;&#x42;c", "it&#8217;s", "&#128512; smile", "&amp;#65;", "no refs", "&#0;x", "a&#xD800;b",
             "&#x1F600;&#X41;", "&lt;p&gt; &#60;", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["d"] for r in df.select("i", decode_references(F.col("t")).alias("d")).collect()}
    for i, t in enumerate(cases):
        assert got[i] == html.unescape(t), t


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(st.lists(st.sampled_from(["&", "#", "x", "38", "0", "128", ";", "amp", "lt", "notin", "not", "copy", "d800",
                                          "110000", " ", "rsquo", "eacute", "1F600", "a", "<"]), max_size=8).map("".join),
                min_size=60, max_size=150))
def test_references_match_html_unescape(spark, texts):
    import html

    from duoweave.functions.markup import decode_references

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", decode_references(F.col("t")).alias("d")).collect():
        assert r["d"] == html.unescape(texts[r["i"]]), texts[r["i"]]


def test_script_counts_are_taken_once(spark):
    """The letters of a text are counted once for its label, also inside a lambda."""
    rows = spark.createDataFrame([(["កខគab", "abc", "", "é1", "ក", "កខab"],)], "a array<string>")
    df = rows.select(F.transform("a", lambda x: is_script(x)).alias("k"))
    assert df.first()["k"] == [False, False, False, False, True, False]
    assert df._jdf.queryExecution().analyzed().toString().count("translate(") == 2


def test_every_space_is_spaced(spark):
    """Texts are rewritten where they hold any whitespace character but ' ', wherever it stands."""
    from duoweave.functions.text import WHITESPACE_CHARS, _spaced

    texts = [f"a{c}b" for c in WHITESPACE_CHARS] + ["កខ គ", "ab", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["s"], r["x"], r["y"]) for r in rows.select(
        "i", _spaced(F.col("t")).alias("s"), text_of(F.concat(F.substring("t", 2, 1), "t", F.substring("t", 2, 1))).alias("x"),
        clean_text("t").alias("y")).collect()}
    for i, t in enumerate(texts[:len(WHITESPACE_CHARS)]):
        assert got[i] == ("a b", t, "a b"), repr(t)
