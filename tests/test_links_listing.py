import json

from pyspark.sql import functions as F

from duoweave.operators import links as L
from duoweave.operators import listing as LS
from duoweave.operators.layout import Sel
from duoweave.sources.listing import read_listing


def _snapshots(spark, heights, new_at):
    rows, seen = [], []
    for p, h in enumerate(heights):
        if p in new_at:
            seen.append(f"/news/{p}/")
        rows += [(p, k, href, h) for k, href in enumerate(seen)]
    return spark.createDataFrame(rows, "snapshot long, pos long, href string, height long")


def test_idle_streak_unchanged_height(spark):
    s = _snapshots(spark, [100] * 12, {0})
    out = {r["snapshot"]: r for r in L.idle_streak(s).collect()}
    assert [out[p]["streak"] for p in range(6)] == [0, 2, 4, 6, 8, 10]
    assert out[5]["stop"] and not any(out[p]["stop"] for p in range(5))
    assert out[6]["after_stop"]


def test_idle_streak_changing_height(spark):
    s = _snapshots(spark, [100 * p for p in range(14)], {0, 2})
    out = {r["snapshot"]: r for r in L.idle_streak(s).collect()}
    assert out[2]["streak"] == 0 and out[12]["streak"] == 10 and out[12]["stop"]
    d = {r["snapshot"]: (r["new_links"], r["total_links"]) for r in L.discovery(s).collect()}
    assert d[0] == (1, 1) and d[1] == (0, 1) and d[2] == (1, 2)


def test_first_seen_and_container_links(spark):
    links = spark.createDataFrame([(1, 5, "/a/"), (0, 9, "/a"), (0, 3, "/b")], "snapshot long, pos long, href string")
    got = {r["href"]: (r["snapshot"], r["pos"]) for r in
           L.first_seen(links.withColumn("href", L.normalize_link(F.col("href")))).collect()}
    assert got == {"/a": (0, 9), "/b": (0, 3)}
    html = ('<div id="blog-one-page"><div class="tp-blog__link"><a href="/x">x</a></div>'
            '<div class="tp-blog__link"><span>none</span></div>'
            '<div class="tp-blog__link"><a name="q">q</a></div>'
            '<div class="tp-blog__link"><a href="/y">y</a><a href="/z">z</a></div></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r["href"] for r in L.container_links(pages).orderBy("pos").collect()] == ["/x", "/y"]
    seeds = spark.createDataFrame([(0, 1, " https://hub.gov.kh "), (1, 2, "https://a.org/1"), (2, 3, "  ")],
                                  "pos long, page_id long, url string")
    out = L.expand_seeds(seeds, pages, key="page_id").orderBy("seed_pos", "link_pos").collect()
    assert [r["url"] for r in out] == ["/x", "/y", "https://a.org/1"]
    hubs = pages.withColumn("url", F.lit("https://hub.gov.kh"))
    out = L.expand_seeds(seeds.drop("page_id"), hubs).orderBy("seed_pos", "link_pos").collect()
    assert [r["url"] for r in out] == ["/x", "/y", "https://a.org/1"]


def test_links_stay_inside_their_container(spark):
    html = ('<div id="blog-one-page"><div class="tp-blog__link"><span>no anchor</span></div></div>'
            '<div class="tp-blog__link"><a href="/outside">x</a></div><footer><a href="/footer">y</a></footer>')
    pages = spark.createDataFrame([(1, "https://h.kh/a/", html)], "page_id long, url string, html string")
    assert L.container_links(pages).count() == 0
    html = ("<a data-href='/no' href='/news/1'>x</a><A HREF=\"/news/2?a=1&amp;b=2\">y</A><a href=/news/3>z</a>"
            "<a href='/news/x/../4'>w</a><!-- <a href='/news/5'>v</a> -->")
    pages = spark.createDataFrame([(1, "https://h.kh/a/", html)], "page_id long, url string, html string")
    got = [r["link"] for r in L.resolve(L.prefix_links(pages)).orderBy("pos").collect()]
    assert got == ["https://h.kh/news/1", "https://h.kh/news/2?a=1&b=2", "https://h.kh/news/3", "https://h.kh/news/4"]


def test_any_errors_key_fails_a_response(spark):
    from duoweave.sources.listing import parse_listing

    data = '"data": {"publicNewsList": {"data": [], "pagination": {"total": 0}}}'
    bodies = ['{%s}' % data, '{%s, "errors": "boom"}' % data, '{%s, "errors": {"a": 1}}' % data,
              '{%s, "errors": null}' % data, 'oops', None]
    raw = spark.createDataFrame(list(enumerate(bodies)), "page bigint, body string")
    assert [r["page"] for r in LS.usable(parse_listing(raw)).collect()] == [0]


def test_reports_read_their_table_at_most_twice(spark, tmp_dir):
    from duoweave.operators import listing

    s = _snapshots(spark, [100] * 12, {0})
    s.write.parquet(tmp_dir + "/snaps")
    stored = spark.read.parquet(tmp_dir + "/snaps")
    plan = L.idle_streak(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert tmp_dir not in plan
    seen = []
    keep = L.materialize
    try:
        L.materialize = lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1]
        L.idle_streak(stored)
    finally:
        L.materialize = keep
    assert sum(p.count(tmp_dir + "/snaps") for p in seen) <= 2
    r = read_listing(spark, _listing(tmp_dir, 250, 100, {2}))
    seen = []
    keep = listing.materialize
    try:
        listing.materialize = lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1]
        plan = LS.audit(r)._jdf.queryExecution().executedPlan().toString()
    finally:
        listing.materialize = keep
    assert sum(p.count("listing.json") for p in seen) == 1 and "listing.json" not in plan


def _listing(tmp_dir, total, size, bad_pages):
    lines = []
    pages = (total + size - 1) // size
    for p in range(1, pages + 1):
        if p in bad_pages:
            body = {"errors": [{"message": "boom"}]}
        else:
            n = min(size, total - (p - 1) * size)
            items = [{"id": (p - 1) * size + k, "status": "PUBLISHED", "category": {"id": 2}} for k in range(n)]
            body = {"data": {"publicNewsList": {"data": items, "pagination": {"total": total}}}}
        lines.append(json.dumps({"page": p, "body": body}))
    with open(tmp_dir + "/listing.json", "w") as f:
        f.write("\n".join(lines))
    return tmp_dir + "/listing.json"


def test_listing_audit(spark, tmp_dir):
    r = read_listing(spark, _listing(tmp_dir, 250, 100, {2}))
    assert sorted(x[0] for x in LS.expected_pages(r).collect()) == [1, 2, 3]
    assert [x[0] for x in LS.missing_pages(r).collect()] == [2]
    assert LS.listing_items(r).count() == 150
    a = LS.audit(r).collect()[0]
    assert (a["total"], a["items_got"], a["pages_expected"], a["pages_missing"]) == (250, 150, 3, 1)
    urls = LS.item_urls(LS.listing_items(r), "https://x.kh/news").orderBy("page", "pos").first()
    assert urls["url"] == "https://x.kh/news/0"


def test_listing_page_one_failed(spark, tmp_dir):
    r = read_listing(spark, _listing(tmp_dir, 250, 100, {1}))
    assert LS.listing_items(r).count() == 0
    assert LS.expected_pages(r).count() == 0


def test_listing_filter_pushed_to_parquet_scan(spark, tmp_dir):
    from duoweave.sources.listing import read_items, write_items

    r = read_listing(spark, _listing(tmp_dir, 250, 100, {2}))
    write_items(LS.listing_items(r), tmp_dir + "/items")
    filtered = LS.filter_items(read_items(spark, tmp_dir + "/items"), "PUBLISHED", 2)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(status,PUBLISHED)" in plan and "EqualTo(category_id,2)" in plan
    assert filtered.count() == 150
