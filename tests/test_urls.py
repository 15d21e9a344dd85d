from urllib.parse import urljoin, urlsplit

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duoweave.functions.urls import absolute_url, in_domain, is_valid_url, normalize_link

CASES = [
    ("https://a.gov.kh/news/1", True), ("ftp://u@h:21/x", True), ("HTTP://X", True),
    ("http://a b.com/x", True), ("//a.kh/x", False), ("a.kh/x", False), ("http://", False),
    ("mailto:a@b", False), ("http://[bad/x", False), ("http://[::1]/x", True), (" \thttp://x.y", True),
]


def test_url_validity_vectors(spark):
    df = spark.createDataFrame([(u,) for u, _ in CASES], "u string")
    got = [r[0] for r in df.select(is_valid_url("u")).collect()]
    assert got == [w for _, w in CASES]


PARTS = st.sampled_from(["http", "HTTPS", "ftp", "a+b", "1x", "", ":", "//", "/", "?", "#", "[", "]", "::1",
                         "host", "a b", "@", ":80", "x.kh", "mailto:", " ", "\t"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=7).map("".join), min_size=50, max_size=150))
def test_url_validity_matches_stdlib(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    for r in df.select("i", is_valid_url("u").alias("v")).collect():
        u = urls[r["i"]]
        assert r["v"] == _valid(u), repr(u)


def _valid(u):
    try:
        return "" not in urlsplit(u)[:2]
    except ValueError:
        return False


HOST = st.sampled_from(["1", "abcd", "12345", "g", ":", "::", ".", "1.2.3.4", "01.2.3.4", "256.1.1.1", "%", "%eth0", "v1.x", "vF.", "V1.x",
                        "]", "[", "@", ":80", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6", "\u2100", "\uff1a", "é", "\u00bd"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(HOST, max_size=5).map("".join), min_size=100, max_size=200))
def test_hosts_match_stdlib(spark, hosts):
    """IPv6, zones, IPvFuture and characters that normalise to marks, as the standard library takes them."""
    fixed = ["::", "::1", "1::", "1::8", ":1", "1:", ":::", "1::2::3", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7::8", "::1.2.3.4",
             "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5::1.2.3.4", "1:2:3:4:5:6::1.2.3.4", "::1.2.3", "1.2.3.4", "fe80::1%25eth0",
             "fe80::1%", "fe80::1%a%b", "%1", "v1.a:b", "v.x", "vg.x", "", "::g", "::12345", "1.2.3.4::", "::1.2.3.4:1"]
    urls = [f"http://[{h}]/x" for h in fixed + hosts] + [f"http://{h}" for h in hosts] + ["http://a]b[::1", "http://u@[::1]:80x/"]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string")
    for r in df.select("i", is_valid_url("u").alias("v")).collect():
        assert r["v"] == _valid(urls[r["i"]]), repr(urls[r["i"]])


def test_unsafe_characters_are_the_stdlib_ones(spark):
    import unicodedata

    chars = [c for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF and (unicodedata.decomposition(chr(c)) or c % 997 == 0)]
    df = spark.createDataFrame([(c, f"http://a{chr(c)}b/") for c in chars], "c int, u string")
    got = {r["c"] for r in df.filter(~is_valid_url("u")).select("c").collect()}
    assert got and got == {c for c in chars if not _valid(f"http://a{chr(c)}b/")}


def test_domain_flag_and_links(spark):
    df = spark.createDataFrame([("https://www.news.gov.kh/news/1", "/news/2/"), ("http://x.org/a/b?q=1", "c//"),
                                ("https://x.org", "#top")], "url string, href string")
    rows = df.select(in_domain("url", "news.gov.kh").alias("d"),
                     normalize_link(absolute_url(F.col("href"), F.col("url"))).alias("l")).collect()
    assert [r["d"] for r in rows] == [True, False, False]
    assert [r["l"] for r in rows] == ["https://www.news.gov.kh/news/2", "http://x.org/a/c", "https://x.org#top"]


# Empty segments stay, as in browsers; the standard library drops them.
SEGMENTS = st.sampled_from(["a", "b.html", "..", ".", "c d", "x?q=/../1", "y#f/../2", "z"])


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(st.lists(SEGMENTS, min_size=1, max_size=5).map("/".join), min_size=50, max_size=120))
def test_absolute_urls_match_stdlib(spark, hrefs):
    bases = ["https://h.kh/p/q/r.html", "http://x.org/", "https://a.b/c/d/?k=1"]
    hrefs = [h for h in hrefs if not h.startswith("//") and "://" not in h]
    rows = [(b, h) for h in hrefs for b in bases]
    df = spark.createDataFrame(rows, "b string, h string")
    for r in df.select("b", "h", absolute_url(F.col("h"), F.col("b")).alias("u")).collect():
        assert r["u"] == urljoin(r["b"], r["h"]), (r["b"], r["h"])
