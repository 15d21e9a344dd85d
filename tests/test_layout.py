from html.parser import HTMLParser

from pyspark.sql import functions as F

from duoweave.functions.text import MIN_BLOCK_LENGTH
from duoweave.operators.layout import ARTICLE_LAYOUT, NEWS_LAYOUT, extract
from duoweave.operators.route import route
from duoweave.plans.fixtures import table
from tests.conftest import SF_SMALL
from tests.models import clean

T, U = "ចំណងជើង", "Title"
K1, K2, K3 = "ខ្មែរមួយ", "ខ្មែរពីរ", "ខ្មែរបី"
E1, E2 = "English one", "English two"


def news_page(title, blocks):
    h = '<html><body><div class="article-content">'
    if title is not None:
        h += f'<h2 class="title-detail">{title}</h2>'
    h += '<div class="page-description">'
    for b in blocks:
        h += f'<div id="paragraphBlock">{b if b.startswith("<") else "<p>" + b + "</p>"}</div>'
    return h + "</div></div></body></html>"


CASES = [
    # title, blocks, english, khmer, needs_align
    (T, [K1, "- - -", E1], ["", E1], [T, K1], False),
    (U, [K1, "- - -", E1], [U, E1], [K1], True),
    (T, [K1, K2, K3, "***", E1], [E1], [T, K1, K2, K3], False),
    (None, [K1, "- - -", E1, "***", "..."], [E1, "***"], [K1], True),
    (T, [K1, E1, E2], [E1, E2], [T, K1], False),
    (None, ["ab", E1], [E1], [], False),
    (None, ["<p>one <i>two</i></p>", "<span>no paragraph</span>"], ["onetwo"], [], False),
]


def test_news_layout_routing(spark):
    rows = [(i, news_page(t, b)) for i, (t, b, *_r) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = {r["page_id"]: r for r in route(extract(pages, NEWS_LAYOUT)).collect()}
    for i, (_, _, en, km, need) in enumerate(CASES):
        assert got[i]["english"] == en, i
        assert got[i]["khmer"] == km, i
        assert got[i]["needs_align"] == need, i


def test_fallback_layout(spark):
    html = ('<div class="postbox__content"><div class="postbox__text">'
            f'<div>A</div><div> A </div><div>{K1}</div></div></div>')
    plain = ('<div class="postbox__content"><div class="postbox__text">'
             f'<p>first</p><p>{K1}</p></div></div><div>outside</div>')
    pages = spark.createDataFrame([(1, html), (2, plain)], "page_id long, html string")
    got = {r["page_id"]: r for r in route(extract(pages, NEWS_LAYOUT)).collect()}
    assert got[1]["english"] == ["A"] and got[1]["khmer"] == [K1] and not got[1]["needs_align"]
    assert got[2]["english"] == [f"first {K1}"] and got[2]["khmer"] == []


class ArticleParagraphs(HTMLParser):
    """stdlib parser model of the article layout: an opening <p> ends the previous one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.in_article = False
        self.skip = 0
        self.cur = None
        self.paras = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "article":
            self.in_article = True
        elif self.in_article and tag == "p":
            self._close()
            self.cur = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip -= 1
        if tag == "p" and self.in_article:
            self._close()
        if tag == "article":
            self._close()
            self.in_article = False

    def handle_data(self, data):
        if self.cur is not None and not self.skip:
            s = data.strip()
            if s:
                self.cur.append(s)

    def _close(self):
        if self.cur is not None:
            self.paras.append("".join(self.cur))
        self.cur = None


def test_article_blocks_match_stdlib_parser(spark):
    pages = table(spark, SF_SMALL, "pages")
    got = {r["page_id"]: r["blocks"] for r in extract(pages, ARTICLE_LAYOUT).collect()}
    for r in pages.select("page_id", "html").collect():
        p = ArticleParagraphs()
        p.feed(r["html"])
        want = [t for t in (clean(x) for x in p.paras) if len(t) >= MIN_BLOCK_LENGTH]
        assert got[r["page_id"]] == want, r["page_id"]


def test_extraction_plan_is_narrow(spark):
    pages = table(spark, SF_SMALL, "pages")
    plan = route(extract(pages, ARTICLE_LAYOUT))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "Exchange" not in plan


def _blocks(spark, html):
    return extract(spark.createDataFrame([(1, html)], "page_id long, html string"), NEWS_LAYOUT).first()


def test_main_layout_boundaries(spark):
    """Asides, comments, scripts, blocks without a paragraph, other quotes and cases."""
    got = _blocks(spark, "<H2 CLASS='title-detail'>Ti&rsquo;tle</H2><aside><div id=\"paragraphBlock\"><p>aside</p></div></aside>"
                         "<div class='x article-content'><DIV class=page-description>"
                         "<div id='paragraphBlock'><p>One<!-- a > b --> two<script>var q=1;</script></p></div>"
                         "<!-- <div id=\"paragraphBlock\"><p>hidden</p></div> -->"
                         "<div id=paragraphBlock><div><P>Three &#38;lt;</P></div></div>"
                         "<div id=\"paragraphBlock\"><span>none</span></div></DIV></div>"
                         "<div id=\"paragraphBlock\"><p>outside</p></div><footer><p>foot</p></footer>")
    assert got["title"] == "Ti\u2019tle"
    assert got["blocks"] == ["Onetwo", "Three &lt;"] and got["has_blocks"]


def test_fallback_boundaries(spark):
    """Other children before the container, nested divs, divs inside lists."""
    a = _blocks(spark, '<div class="postbox__content"><p>intro</p><div class="postbox__text">'
                       "<div><div>In</div><div>ner</div></div><div>Second</div><ul><li><div>listed</div></li></ul></div></div>")
    assert a["fallback"] == ["In ner", "Second"]
    b = _blocks(spark, '<div class="postbox__content"><div class="postbox__text"><ul><li><div>x</div></li></ul>y</div></div><p>z</p>')
    assert b["fallback"] == ["x y"]


def test_all_containers_and_nested_blocks(spark):
    """Every container counts; a block in a block is one more block, searched by the outer one too."""
    block = '<div id="paragraphBlock"><p>{}</p></div>'.format
    scope = '<div class="article-content"><div class="page-description">{}</div></div>'.format
    got = _blocks(spark, scope(block("first one")) + "<p>between</p>" + scope(block("second one") + block("third one")))
    assert got["blocks"] == ["first one", "second one", "third one"]
    got = _blocks(spark, scope('<div id="paragraphBlock"><p>outer</p>' + block("inner") + "</div>"
                               '<div id="paragraphBlock"><span>x</span>' + block("only inner") + "</div>"))
    assert got["blocks"] == ["outer", "inner", "only inner", "only inner"]
    got = _blocks(spark, '<div class="page-description"><div class="article-content">' + block("wrong order") + "</div></div>")
    assert got["blocks"] == [] and not got["has_blocks"]
    got = _blocks(spark, '<div class="article-content"><div class="page-description">' + block("never closed"))
    assert got["blocks"] == ["never closed"]


def test_fallback_takes_the_first_direct_child_of_any_parent(spark):
    outer, inner = '<div class="postbox__content">', '<div class="postbox__text">'
    cases = [
        (f"{outer}<p>no text</p></div>{outer}{inner}<div>found</div></div></div>", ["found"]),
        (f"{outer}<section>{inner}<div>not a child</div></div></section></div>", []),
        (f"{outer}<section>{outer}{inner}<div>deep</div></div></div></section>{inner}<div>later</div></div></div>", ["deep"]),
        (f"{inner}<div>no parent</div></div>{outer}<br><p>lead</p>{inner}<div>found</div></div></div>", ["found"]),
    ]
    rows = [(i, h) for i, (h, _) in enumerate(cases)]
    got = {r["page_id"]: r["fallback"] for r in extract(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


class Text(HTMLParser):
    """Text nodes as the stdlib parser gives them, joined over character data that stands together."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [""]

    def handle_starttag(self, tag, attrs):
        self.nodes.append("")

    def handle_endtag(self, tag):
        self.nodes.append("")

    def handle_data(self, data):
        self.nodes[-1] += data


def test_text_nodes_match_stdlib_parser(spark):
    """Bare angle brackets, quoted ones, quotes that don't close, declarations."""
    from duoweave.functions.text import text_of

    cases = ["One < two <b>x</b>", '<a title="x > y">t</a>', "<a title='a>b' class=q>t</a> > u", "1 <2 and 3> 2", "a <= b => c",
             "<i lang=don't>it</i>s", "x < y <i>z</i> < w", "<p data-a='1' data-b=\">\">q</p>", "a &lt; b <br/> c &gt; d", "<<b>>"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, html string")
    got = {r["i"]: (r["glued"], r["spaced"]) for r in rows.select(
        "i", text_of("html").alias("glued"), text_of("html", " ").alias("spaced")).collect()}
    for i, c in enumerate(cases):
        p = Text()
        p.feed(c)
        p.close()
        nodes = [x.strip() for x in p.nodes if x.strip()]
        assert got[i] == ("".join(nodes), " ".join(nodes)), c


def test_rows_of_extracts_once(spark):
    """Exploding the blocks copies no extraction into a filter below it."""
    from duoweave.operators.layout import rows_of

    pages = table(spark, SF_SMALL, "pages")
    plan = rows_of(extract(pages, ARTICLE_LAYOUT), "blocks")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("article(?=") <= 3 and "Filter (size(" not in plan


def test_places_are_bytes(spark):
    """Elements are cut out by bytes, so that no cut walks the page's characters before it; Khmer takes three each."""
    from duoweave.functions.markup import Sel, content, elements

    markup = "ខ្មែរ<div id='a'>កខ<p>x</p></div>é<div id='a'>😀</div>"
    row = spark.createDataFrame([(markup,)], "m string").select(
        "m", elements(F.col("m"), "div", (Sel("div", id="a"),)).alias("e"))
    got = row.select("e", F.transform("e", lambda x: content(F.col("m"), x)).alias("c")).first()
    assert got["c"] == ["កខ<p>x</p>", "😀"]
    raw = markup.encode()
    assert [raw[x["s"]:x["e"]].decode() for x in got["e"]] == got["c"]


def test_first_paragraph_ends(spark):
    """Title and paragraph end at their closing tag, the next paragraph, or the end of the markup."""
    from duoweave.functions.markup import Sel
    from duoweave.operators.layout import up_to

    p = Sel("p")
    end = rf"{p.close()}|{p.open()}"
    cases = ["<p>a<b>b</b></p>c", "<P class='>'>a<p>b", "x<pre>y</pre>", "<p>a < b", "", "<p></P >z", "<p>" + "<i>y</i> " * 20000]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, m string")
    got = {r["i"]: r["t"] for r in rows.select("i", F.regexp_extract("m", up_to(p, end), 1).alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == ["a<b>b</b>", "a", "", "a < b", "", "", "<i>y</i> " * 20000]
