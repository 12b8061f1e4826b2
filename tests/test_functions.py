"""Column functions against the examples that their rules are known by."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cairn.functions import dates, text, udfs, vocab
from cairn.functions import url as u

HOME = "https://www.example.com/"


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.orderBy("k").select(f(F.col("v"))).collect()]


def test_normalize(spark):
    got = column(spark, ["https://a.com/", "https://a.com/x/", "https://a.com/x/#top", "https://a.com/x//", "https://a.com", None], u.normalize)
    assert got == ["https://a.com/", "https://a.com/x", "https://a.com/x", "https://a.com/x", "https://a.com", None]


def test_extension_and_kind(spark):
    urls = ["https://a.com/b/C.PDF?x=1", "https://a.com/.hidden", "https://a.com/x.tar.gz", "https://a.com/logo.png", "https://a.com/"]
    assert column(spark, urls, u.extension) == [".pdf", "", ".gz", ".png", ""]
    assert column(spark, urls, u.resource_kind) == ["document", "html", "html", "asset", "html"]
    assert column(spark, ["application/pdf; q=1", "text/html", None, "image/png"], lambda c: u.resource_kind(F.lit("https://a.com/x"), c)) == ["document", "html", "html", "other"]


@pytest.mark.parametrize(
    ("url", "plain", "sub"),
    [("http://example.com/x", True, True), ("https://www.example.com", True, True), ("https://shop.example.com/", False, True), ("https://example.org/", False, False), ("ftp://example.com/", False, False), ("https://notexample.com/", False, False)],
)
def test_scope(spark, url, plain, sub):
    row = spark.range(1).select(u.in_scope(F.lit(url), F.lit(HOME)), u.in_scope(F.lit(url), F.lit(HOME), True)).first()
    assert tuple(row) == (plain, sub)


PAGES = {
    "": "homepage", "privacy-policy": "company", "terms-of-service": "company", "careers": "career", "contact-us": "contact", "about/team": "company", "itar": "compliance", "security": "compliance",
    "hivemind-solutions": "product", "x/our-new-long-article-about-things": "news", "blog/1": "news", "design": "news", "mounts": "news", "platforms/x": "product", "autonomy": "capability", "airport": "other",
    "x/datasheet-1": "product", "catalog.pdf": "document", "ground-systems": "capability", "zzz": "other", "join-us": "career", "my_company/facilities": "company", "foo-product-page": "product",
}


def test_classify(spark):
    got = column(spark, [HOME + p for p in PAGES], lambda c: u.classify_page(c, F.lit(HOME)))
    assert dict(zip(PAGES, got, strict=True)) == PAGES


def test_score(spark):
    got = column(spark, [HOME + p for p in ("", "products", "a/b/c/d", "careers", "x/autopilot", "a-b-c-d-e-f")], lambda c: u.page_score(c, ("flight_vehicle_control",)))
    assert got == [20, 20 + 70 - 1, -4, 20 - 50 - 1, 25 - 2, 20 - 35 - 1]


PATHS = {
    "/news/": "news", "/newsroom/a": "newsroom", "/en/company/news/x": "news", "/Category/Press-Releases/foo": "press", "/blog.php": "blog", "/news/page/2": "news", "/News_bc_1.html": "news", "/de/news/": None, "/resources/news": None,
    "/posts/1": "blog", "/story/1": "stories", "/news.pdf": None, "/feed/update/urn:li:1": None, "/newsletter": None, "/news-and-events/x": "news-events", "/media-center": "media-center", "/en-us/news/a": None, "/products": None,
}


def test_families(spark):
    assert dict(zip(PATHS, column(spark, list(PATHS), u.classify_path), strict=True)) == PATHS
    assert column(spark, ["/News_bc_1.html", "/Category/Press-Releases/foo", "/news/page/2", "/", "/a/"], u.normalize_path) == ["/news", "/press-releases/foo", "/news", "/", "/a"]
    assert column(spark, ["/news", "/en/news/", "/news/foo"], lambda c: u.bare_index(c, F.lit("news"))) == [True, True, False]
    assert column(spark, ["newsroom", "updates", "what"], u.family_rank) == [1, 11, 99]


def test_item_filter(spark):
    base = "https://a.com/news"
    urls = [base + "/x", base, base + "/", base + "/tag/x", "https://b.com/news/x", "https://a.com/newsy/x", base + "/page/2"]
    assert column(spark, urls, lambda c: u.is_item_of(c, F.lit(base))) == [True, False, False, False, False, False, False]


HREFS = ["/x", "y?z=1#f", "https://b.com/q#1", "//c.com/a", "mailto:a@b", "#top", "?p=2", "", "javascript:x()", "ftp://a/b"]


def test_resolve_agrees_with_the_parser(spark):
    base = "https://a.com/d/e.html"
    want = [udfs.resolve_one(h, base) for h in HREFS]
    assert column(spark, HREFS, lambda c: u.resolve(c, F.lit(base))) == want
    assert column(spark, HREFS, lambda c: udfs.urljoin_column(c, F.lit(base))) == want


def test_homepage_and_store(spark):
    assert column(spark, ["HTTPS://Example.COM/", "example.com", "http://A.com/B/"], u.normalize_homepage) == ["https://example.com", "https://example.com", "http://a.com/B"]
    assert column(spark, ["s3://bucket/a/b"], u.split_store_uri)[0].asDict() == {"bucket": "bucket", "key": "a/b"}


COUNTRIES = {"USA": "United States", " u.s.a. ": "United States", "u.k.": "United Kingdom", "Deutschland": "Germany", "Türkiye": "Turkey", "the  Netherlands": "Netherlands", "Wakanda": "Wakanda", "": "", "Viet Nam": "Vietnam", "usak": "usak"}


def test_vocab(spark):
    assert dict(zip(COUNTRIES, column(spark, list(COUNTRIES), vocab.normalize_country), strict=True)) == COUNTRIES
    assert column(spark, ["CA", "texas", "Ontario ", "D.C", "dc.", None], vocab.normalize_us_state) == ["California", "Texas", "Ontario", "D.C", "District of Columbia", None]
    assert column(spark, ["Germany", "Estonia", None, "US"], vocab.iso2) == ["DE", "ES", "US", "US"]
    assert column(spark, ["Estonia", None], lambda c: vocab.iso2(c, strict=True)) == [None, None]
    assert column(spark, ["sensors_and_navigation", "new_thing", None, ""], vocab.category_slug) == ["sensors-navigation", "new-thing", None, None]
    assert column(spark, ["low_rate_production", "prototype", None, "x"], vocab.normalize_readiness) == ["low_rate", "prototype", "unknown", "unknown"]


def test_text(spark):
    assert column(spark, ["Hello, World!", "--", "a.b_c"], text.slugify) == ["hello-world", "item", "a-b-c"]
    assert column(spark, ["a  \n\n b\n"], text.markdown_to_text) == ["a\n b"]
    assert column(spark, ["one two three, four", "one two", None], lambda c: text.truncate_words(c, 3)) == ["one two three…", "one two", None]
    assert column(spark, ["a\nb\nc"], lambda c: text.snippet(c, F.lit(2), F.lit(3))) == ["b\nc"]
    assert column(spark, ["a\nb"], lambda c: text.snippet(c, F.lit(2), F.lit(3))) == [None]
    assert column(spark, [7, 12345], text.resource_id, "int") == ["resource-0007", "resource-12345"]
    html = "<p>a &amp; b</p><script>var x='</p>'</script><svg><text>no</text></svg><b>c"
    assert column(spark, [html], text.html_to_text) == ["a & b\nc"] == column(spark, [html], lambda c: udfs.html_to_text(c))
    assert column(spark, ["Foo Bar, Inc.", "Größe GmbH (test)", "", "Acme Co"], lambda c: udfs.ascii_slug(c)) == ["foo-bar", "groe", "unnamed", "acme"]
    assert column(spark, ["Foo S.A", "Foo Inc!", "Foo L L C", "Foo L.L.C.", "Foo s.a.", "FOO B.V.", "Inc.", "Cisco", "Foo LTD.", "x" * 70], lambda c: udfs.ascii_slug(c)) == ["foo-s-a", "foo-inc", "foo-l-l-c", "foo", "foo", "foo", "unnamed", "cisco", "foo", "x" * 60]


DATES = {
    "April 27, 2026": date(2026, 4, 27), "on 27 Apr 2026 it": date(2026, 4, 27), "2026-4-7": date(2026, 4, 7), "4/27/2026": date(2026, 4, 27), "27/4/2026": date(2026, 4, 27), "May 2030": None, "May 1, 2030": None,
    "none": None, "2009-01-01": None, "June 31, 2025": None, "x 1999-01-01 then 5/6/2025": date(2025, 5, 6),
}


def test_dates(spark):
    as_of = F.lit("2026-05-01").cast("date")
    assert dict(zip(DATES, column(spark, list(DATES), lambda c: dates.in_text(c, as_of)), strict=True)) == DATES
    assert column(spark, ["/2026/04/15/x", "/a/2025/3/", "/2025/13/1", "/2025/2/30", "/news/20261"], lambda c: dates.from_url(c, as_of)) == [date(2026, 4, 15), date(2025, 3, 1), None, None, None]
    assert column(spark, ["April 27, 2026 - Launch", "Launch"], dates.strip_leading) == ["Launch", "Launch"]
    assert column(spark, ["published 3rd of March 2025 or so"], lambda c: udfs.fuzzy_date(c)) == [date(2025, 3, 3)]


def test_news_items():
    html = """<body><ul><li><a href="/news/a">Read more</a><h3>First</h3><time datetime="2026-04-01">x</time></li>
    <li><time>2 Apr 2026</time><a href="/news/b">Second item</a></li></ul><a href="/about">About</a></body>"""
    assert udfs.items_of(html, "https://a.com/news") == [{"url": "https://a.com/news/a", "title": "First", "date_text": "2026-04-01"}, {"url": "https://a.com/news/b", "title": "Second item", "date_text": "2 Apr 2026"}]
    plain = '<a href="/news/a">First one</a><a href="/news/tag/x">T</a>' + '<a href="/news/nav">Nav</a>' * 4
    assert [x["url"] for x in udfs.items_of(plain, "https://a.com/news/")] == ["https://a.com/news/a"]


def test_news_items_as_table_function(spark):
    spark.udtf.register("news_items", udfs.NewsItems)
    got = spark.sql("""SELECT x.url FROM VALUES ('<a href="/news/a">First one</a>', 'https://a.com/news') t(h, s), LATERAL news_items(h, s) x""").collect()
    assert [r.url for r in got] == ["https://a.com/news/a"]


def test_best_text_and_fetchable(spark):
    rows = spark.createDataFrame([("# T\n\nbody", "<p>h</p>"), ("", "<p>h</p>"), (None, None)], "m string, h string")
    got = [r[0] for r in rows.select(text.best_text(F.col("m"), F.col("h"))).collect()]
    assert "body" in got[0] and got[1:] == ["h", ""]
    urls = ["https://example.com/a", "https://files.example.net/x.pdf", "https://files.example.net/x", "https://elsewhere.org/x.pdf"]
    hosts = F.array(F.lit("files.example.net"))
    assert column(spark, urls, lambda c: u.fetchable(c, F.lit(HOME), hosts)) == column(spark, urls, lambda c: u.in_scope(c, F.lit(HOME)) | u.associated_document(c, hosts))
    assert column(spark, urls, lambda c: u.fetchable(c, F.lit(HOME), hosts))[::3] == [True, False]


def test_join_homepage_and_iso(spark):
    assert column(spark, ["/news", "news"], lambda c: u.join_homepage(F.lit("https://a.com/x?y"), c)) == ["https://a.com/news", "https://a.com/news"]
    assert column(spark, ["/n"], lambda c: u.join_homepage(F.lit("a.com/"), c)) == ["https://a.com/n"]
    assert spark.range(1).select(dates.iso_seconds(F.lit("2024-01-02 03:04:05.678").cast("timestamp"))).first()[0] == "2024-01-02T03:04:05+00:00"


def test_date_values(spark):
    as_of = F.lit("2024-05-01").cast("date")
    values = ["2023/04/15", "2023-04-15T10:00:00Z", "20230415", "2023-04/15", "2031-01-01", "April 15, 2023", "the 5th of May 2023", None, ""]
    d = date(2023, 4, 15)
    assert column(spark, values, lambda c: dates.parse_value(c, as_of)) == [d, d, d, None, None, d, None, None, None]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    assert [r.date for r in dates.with_free_date(rows, "v", as_of).orderBy("k").collect()][6:] == [date(2023, 5, 5), None, None]


def test_broken_pdfs_have_no_text(spark):
    from cairn.sources import readers

    files = spark.createDataFrame([("a", bytearray(b"no pdf")), ("b", None)], "path string, content binary")
    assert [r.text for r in readers.pdf_texts(files).collect()] == [None, None]
