"""Queries over page URLs: normalisation, scope, classes, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, text, udfs, vocab
from ..functions import url as u
from ..functions.trims import rstrip
from ..operators import keys, news, quality, select
from ..session import table

#: Paths that stand in for those of a crawled site, dealt to pages by page_id.
PATHS = (
    "products/autopilot", "about", "contact-us", "careers/pilot", "privacy-policy", "compliance/itar", "news/2026/04/15/launch", "blog", "technology", "catalog.pdf", "logo.png", "stories/a",
    "newsroom", "en/company/news/x", "platforms/v-bat-teams", "a-very-long-article-slug-here", "design", "ground-systems/", "Category/Press-Releases/foo.html", "news_bc_1.html", "blog/page/2", "team/leadership",
    "solutions/radio_link", "fr/news/y", "resources/datasheet-1", "specs/manual", "", "insights/2025/13/1", "press-room/2024/2/30/", "feed/update/urn:li:1",
)


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with site, home and a crawl_url of a telling path."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    root = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    path = F.element_at(F.array(*[F.lit(x) for x in PATHS]), (F.col("page_id") % len(PATHS) + 1).cast("int"))
    return p.select("page_id", "url", u.host(F.col("url")).alias("site"), F.concat(root, F.lit("/")).alias("home"), F.concat(root, F.lit("/"), path).alias("crawl_url"))


_PATHS_SQL = "[" + ", ".join(f"'{p}'" for p in PATHS) + "]"
_H = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*"
CRAWL_SQL = f"""crawl AS (
  SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS site, regexp_extract(url, '^(https?://[^/]+)', 1) || '/' AS home,
    regexp_extract(url, '^(https?://[^/]+)', 1) || '/' || ({_PATHS_SQL})[(page_id % {len(PATHS)}) + 1] AS crawl_url FROM pages
)"""


def _path_sql(url: str) -> str:
    return f"regexp_extract({url}, '{_H}([^?#]*)', 1)"


def _norm_sql(url: str) -> str:
    bare = f"regexp_replace({url}, '#.*$', '')"
    return f"CASE WHEN ends_with({bare}, '/') AND {_path_sql(bare)} <> '/' THEN rtrim({bare}, '/') ELSE {bare} END"


def _ext_sql(url: str) -> str:
    return f"lower(regexp_extract(rtrim({_path_sql(url)}, '/'), '[^/.][^/]*(\\.[^./]+)$', 1))"


def _in(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def _any_sql(value: str, tokens) -> str:
    return "(" + " OR ".join(f"contains({value}, '{t}')" for t in tokens) + ")"


def _token_sql(value: str, tokens) -> str:
    return f"regexp_matches({value}, '(^|[^a-z0-9])(" + "|".join(t.replace(" ", "[- ]") for t in tokens) + ")([^a-z0-9]|$)')"


def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, c = table(spark, sf_dir, "pages"), F.col("url")
    return p.select("page_id", u.normalize(c).alias("normalized"), u.extension(c).alias("extension"), u.resource_kind(c).alias("kind"), u.slash_key(c).alias("slash_key"), u.normalize_homepage(F.regexp_replace(c, r"[?#].*$", "")).alias("homepage"))


def url_canonical_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", u.apex(u.host(F.col("url"))).alias("apex"), F.regexp_replace(rstrip("/", u.path(F.col("url"))), r"\.html$", "").alias("path"))
    return keys.first_occurrence(p, ["apex", "path"], [F.col("page_id")])


def site_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").withColumn("apex", F.regexp_replace(u.host(F.col("url")), r"^(www|m|blog)\.", ""))
    homes = p.groupBy("apex").agg(F.min_by("url", "page_id").alias("home"))
    j = p.join(homes, "apex")
    return j.select("page_id", u.in_scope(F.col("url"), F.col("home")).alias("same_site"), u.in_scope(F.col("url"), F.col("home"), True).alias("with_subdomains"), u.associated_document(F.concat(F.col("url"), F.lit("/x.pdf")), F.array(F.lit("EXAMPLE.com"))).alias("document_host"))


def page_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl(spark, sf_dir)
    return c.select("page_id", "crawl_url", u.classify_page(F.col("crawl_url"), F.col("home")).alias("page_class"), u.page_score(F.col("crawl_url"), ("communications", "flight_vehicle_control")).cast("int").alias("score"), u.resource_kind(F.col("crawl_url")).alias("kind"))


def path_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = u.path(F.col("crawl_url"))
    f = u.classify_path(p)
    return crawl(spark, sf_dir).select("page_id", u.rejected_path(p).alias("rejected"), u.normalize_path(p).alias("normalized"), f.alias("family"), u.family_rank(f).alias("family_rank"), F.coalesce(u.bare_index(p, f), F.lit(False)).alias("bare"))


def selected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl(spark, sf_dir).drop("url").withColumnRenamed("crawl_url", "url").withColumn("site", F.regexp_replace("site", r"^(www|m|blog)\.", "")).withColumn("home", F.concat(F.lit("https://"), "site", F.lit("/")))
    c = keys.first_occurrence(c.withColumn("url", F.regexp_replace("url", r"^https?://[^/]+", F.concat(F.lit("https://"), "site"))), ["url"], [F.col("page_id")])
    return select.pages_of_site(c, "serious_vendor").select("page_id", "site", "url", "page_class", F.col("score").cast("int").alias("score"), "selected", "status")


def site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: which pages would be kept of each site, and whether its corpus is complete."""
    s = selected_pages(spark, sf_dir).join(table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("text_chars")), "page_id")
    low = F.lower("url")
    rows = s.select("site", F.when(F.col("selected"), F.when(F.col("page_id") % 17 == 0, "failed").otherwise("fetched")).otherwise(F.col("status")).alias("status"), F.lit("html").alias("kind"), F.when(F.col("selected") & (F.col("page_id") % 17 != 0), F.col("text_chars")).otherwise(0).alias("text_chars"), "url")
    return quality.crawl(rows, ["site"], 3000, text.matches_tokens(low, vocab.PRODUCT_TOKENS), text.matches_tokens(low, vocab.ABOUT_TOKENS))


def budgeted_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    n = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    out = select.budgeted(p, ["p_partkey"], ["p_size"], "p_brand", [F.col("p_retailprice").desc(), F.length("p_name"), F.col("p_partkey")], (n % 4).cast("int"), F.col("p_brand"), 12)
    return out.select("p_partkey", "p_size", "p_brand", "selected", "status")


def document_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.top_k(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 3)


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r"href\s*=\s*\"([^\"]*)\""), F.lit(1))).alias("href"))
    t = p.select("page_id", u.resolve(F.col("href"), F.col("url")).alias("target_url"), F.col("url"))
    return t.where("target_url IS NOT NULL").groupBy("page_id", "target_url").agg(F.count("*").alias("n"), F.bool_or(u.in_scope(F.col("target_url"), F.col("url"))).alias("in_scope"))


#: What follows the addresses that pages link to, by a hash of the address itself: telling words in all places.
TAILS = ("", "/products", "/product-page", "-news-2026-04-15", "/2025/13/1", "/2024/2/29/x", "/careers", "/contact", "/about-us", ".pdf", ".png", "/blog/page/2", "/privacy_policy", "/press-releases/", "/a-b-c-d-e-f", "/itar_compliance", "?y=1#news", "/resources/x", "/Category/News/y.html", "/news_bc_7", "//x//", "/de/")


def links_told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All addresses that pages link to or have themselves, joined as they come from the tables, under every URL rule."""
    p = table(spark, sf_dir, "pages")
    hrefs = p.select("url", F.explode(F.regexp_extract_all("html", F.lit(r"href\s*=\s*\"([^\"]*)\""), F.lit(1))).alias("href"))
    found = hrefs.select(F.concat(F.regexp_replace("url", r"[?#].*$", ""), "href").alias("url"), F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("root")).unionByName(p.select("url", F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("root")))
    tail = F.element_at(F.array(*[F.lit(t) for t in TAILS]), (F.conv(F.left(F.md5("url"), F.lit(6)), 16, 10).cast("int") % len(TAILS) + 1).cast("int"))
    a = found.distinct().select(F.concat("url", tail).alias("url"), F.concat("root", F.lit("/")).alias("home")).distinct()
    p = u.path(F.col("url"))
    f = u.classify_path(p)
    return a.select(
        "url", "home", u.classify_page(F.col("url"), F.col("home")).alias("page_class"), u.page_score(F.col("url")).cast("int").alias("score"), u.resource_kind(F.col("url")).alias("kind"), u.rejected_path(p).alias("rejected"),
        u.normalize_path(p).alias("normalized"), f.alias("family"), F.coalesce(u.bare_index(p, f), F.lit(False)).alias("bare"), dates.from_url(p, F.lit("2026-05-01").cast("date")).alias("date"),
    )


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


def html_text_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", udfs.html_to_text("html").alias("text"))


def common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl(spark, sf_dir).select("site", u.path(F.col("url")).alias("path"))
    return c.groupBy("site").agg(news.common_prefix(F.col("path")).alias("prefix"), F.count("*").alias("n"))


def url_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl(spark, sf_dir).select("page_id", dates.from_url(u.path(F.col("crawl_url")), F.lit("2026-05-01").cast("date")).alias("date"))


def path_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl(spark, sf_dir).select(F.expr(_PREFIX_GROUP).alias("g"), u.path(F.col("crawl_url")).alias("path"))
    return c.groupBy("g").agg(news.common_prefix(F.col("path")).alias("prefix"), F.count("*").alias("n"))


def news_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl(spark, sf_dir).withColumn("slug", F.regexp_replace("site", r"^(www|m|blog)\.", "")).withColumn("pos", F.row_number().over(Window.partitionBy("slug").orderBy("page_id")))
    return news.families(c, ["slug"], "crawl_url").select("slug", "family", "items", "rank", "bare_index_seen", "index_path", "family_rank")


_FAMILY_SQL = "CASE " + " ".join(f"WHEN regexp_matches(np, '(^|/){rx.replace('?:', '')}(/|$)') THEN '{f}'" for f, rx in vocab.FAMILIES) + " END"
_RANK_SQL = "CASE " + " ".join(f"WHEN family = '{f}' THEN {k}" for k, (f, _) in enumerate(vocab.FAMILIES, 1)) + " ELSE 99 END"
_BARE_SQL = "(CASE " + " ".join(f"WHEN family = '{f}' THEN regexp_matches(@, '(^|/){rx.replace('?:', '')}/?$')" for f, rx in vocab.FAMILIES) + " ELSE false END)"
_NORM_PATH_SQL = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p), '^/category/', '/'), '\.(html|htm|php|aspx|jsp)$', ''), '/(page|p)/\d+/?$', ''), '_bc_\d+$|_page_\d+$', ''), '^(.+)/$', '\1')"
_REJECT_SQL = f"regexp_matches(lower(p), '^/({'|'.join(vocab.LOCALES)})/') OR ends_with(lower(p), '.pdf') OR regexp_matches(lower(p), '/(feed|activity)/.*urn[:\\-]') OR starts_with(lower(p), '/resources/') OR lower(p) = '/resources'"
_FAM_CTES = f"""{CRAWL_SQL},
a AS (SELECT page_id, site, crawl_url, {_path_sql('crawl_url')} AS p FROM crawl),
n AS (SELECT *, {_NORM_PATH_SQL} AS np, {_REJECT_SQL} AS rejected FROM a),
f AS (SELECT *, CASE WHEN NOT rejected THEN {_FAMILY_SQL} END AS family FROM n)"""

_CLASS_SQL = f"""CASE WHEN ext IN {_in(vocab.DOCUMENT_EXTENSIONS)} THEN 'document' WHEN nu = nh OR p = '' THEN 'homepage'
  WHEN {_any_sql('p', vocab.CAREER_TOKENS)} THEN 'career' WHEN {_any_sql('p', vocab.CONTACT_TOKENS)} THEN 'contact'
  WHEN {_any_sql('p', vocab.LEGAL_TOKENS)} OR list_has_any(t, [{', '.join(f"'{x}'" for x in vocab.COMPANY_SEGMENTS)}]) THEN 'company'
  WHEN {_token_sql('p', vocab.COMPLIANCE_TOKENS)} OR {_token_sql('p', vocab.GOVERNMENT_TOKENS)} THEN 'compliance'
  WHEN leaf IN {_in(vocab.PRODUCT_SLUGS)} OR ends_with(leaf, 'product-page') THEN 'product' WHEN {_any_sql('p', vocab.NEWS_TOKENS)} OR hyphens >= 5 THEN 'news'
  WHEN {_token_sql('p', vocab.CLEAR_PRODUCT_TOKENS)} THEN 'product' WHEN {_token_sql('p', vocab.CAPABILITY_TOKENS)} THEN 'capability'
  WHEN {_any_sql('leaf', vocab.LEAF_PRODUCT_TOKENS)} THEN 'product' ELSE 'other' END"""


def _class_ctes(source: str, categories=()) -> str:
    extra = " ".join(f"+ CASE WHEN contains(low, '{x.lower().replace(' ', '-')}') OR contains(low, '{x.lower().replace(' ', '')}') THEN 25 ELSE 0 END" for c in categories for x in vocab.CATEGORY_QUERY_TERMS[c])
    return f"""b AS (SELECT *, lower(trim({_path_sql('url')}, '/')) AS p, {_ext_sql('url')} AS ext, {_norm_sql('url')} AS nu, {_norm_sql('home')} AS nh, lower(url) AS low,
  list_filter(string_split({_path_sql('url')}, '/'), lambda x: x <> '') AS segs FROM {source}),
c AS (SELECT *, list_filter(string_split(replace(p, '_', '-'), '/'), lambda x: x <> '') AS t, len(regexp_replace(p, '^.*/', '')) - len(replace(regexp_replace(p, '^.*/', ''), '-', '')) AS hyphens FROM b),
k AS (SELECT *, coalesce(t[-1], '') AS leaf FROM c),
cl AS (SELECT *, {_CLASS_SQL} AS page_class,
  (CASE WHEN len(segs) <= 1 THEN 20 ELSE 0 END + CASE WHEN hyphens >= 5 THEN -35 ELSE 0 END + CASE WHEN {_any_sql('low', vocab.PRODUCT_TOKENS)} THEN 70 ELSE 0 END
   + CASE WHEN {_any_sql('low', vocab.COMPLIANCE_TOKENS)} THEN 55 ELSE 0 END + CASE WHEN {_any_sql('low', vocab.ABOUT_TOKENS)} THEN 35 ELSE 0 END {extra}
   + CASE WHEN {_any_sql('low', vocab.LOW_VALUE_TOKENS)} THEN -50 ELSE 0 END + CASE WHEN ext IN {_in(vocab.DOCUMENT_EXTENSIONS)} THEN 20 ELSE 0 END - least(len(segs), 8))::INTEGER AS score,
  CASE WHEN ext IN {_in(vocab.DOCUMENT_EXTENSIONS)} THEN 'document' WHEN ext IN {_in(vocab.STATIC_EXTENSIONS)} THEN 'asset' ELSE 'html' END AS kind FROM k)"""


_BUDGET_SQL = "CASE " + " ".join(f"WHEN page_class = '{c}' THEN {n}" for c, n in zip(vocab.PAGE_CLASSES, vocab.PROFILE_BUDGETS["serious_vendor"], strict=True)) + " ELSE 0 END"
_ORDER_SQL = "list_position([" + ", ".join(f"'{c}'" for c in vocab.PAGE_CLASSES) + "], page_class)"
_SELECT_CTES = f"""{CRAWL_SQL},
s0 AS (SELECT page_id, regexp_replace(site, '^(www|m|blog)\\.', '') AS site, crawl_url FROM crawl),
s1 AS (SELECT page_id, site, 'https://' || site || '/' AS home, regexp_replace(crawl_url, '^https?://[^/]+', 'https://' || site) AS url FROM s0),
s2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM s1) WHERE rn = 1),
{_class_ctes('s2')},
r1 AS (SELECT *, {_BUDGET_SQL} AS budget, row_number() OVER (PARTITION BY site, page_class ORDER BY score DESC, length({_path_sql('url')}), url) AS rk FROM cl WHERE kind = 'html' AND page_class <> 'homepage'),
r2 AS (SELECT *, rk <= budget AS fits, row_number() OVER (PARTITION BY site ORDER BY (rk <= budget) DESC, {_ORDER_SQL}, rk, score DESC, length({_path_sql('url')}), url) AS place FROM r1),
sel AS (SELECT page_id, site, url, page_class, score, fits AND place <= {vocab.PROFILE_LIMITS['serious_vendor'][0] - 1} AS selected,
  CASE WHEN fits AND place <= {vocab.PROFILE_LIMITS['serious_vendor'][0] - 1} THEN 'selected' WHEN budget <= 0 THEN 'skipped_class_budget' ELSE 'skipped_budget' END AS status FROM r2)"""

_TAGS_SQL = "html"
for _t in ("script", "style", "noscript", "svg"):
    _TAGS_SQL = rf"regexp_replace({_TAGS_SQL}, '(?is)<{_t}\b[^>]*>.*?</{_t}\s*>', chr(10), 'g')"
_ENTITY_SQL = "t"
for _e, _c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _ENTITY_SQL = f"replace({_ENTITY_SQL}, '{_e}', '{_c}')"

#: Longest common prefix by how many values each place has.
_PREFIX_CTES = """p AS (SELECT {key}, list_filter(string_split(trim({col}, '/'), '/'), lambda x: true) AS segs FROM {src} WHERE trim({col}, '/') <> ''),
pn AS (SELECT {key}, count(*) AS pn, min(len(segs)) AS shortest FROM p GROUP BY {key}),
ps AS (SELECT {key}, i, segs[i] AS seg FROM (SELECT *, unnest(range(1, len(segs) + 1)) AS i FROM p)),
pc AS (SELECT {key}, i, count(DISTINCT seg) AS kinds, count(*) AS have, min(seg) AS seg FROM ps GROUP BY {key}, i),
pb AS (SELECT {key}, coalesce(min(i) FILTER (kinds > 1 OR have < pn), shortest + 1) - 1 AS m FROM pc JOIN pn USING ({key}) GROUP BY {key}, shortest),
pre AS (SELECT {key}, '/' || string_agg(seg, '/' ORDER BY i) AS prefix FROM pc JOIN pb USING ({key}) WHERE i <= m GROUP BY {key})"""
#: Pages whose stand-in paths lie near each other form a group: some share segments, some only letters, some have none.
_PREFIX_GROUP = "(page_id % 3) * 1000 + CASE WHEN contains(crawl_url, 'news') THEN 1 WHEN contains(crawl_url, 'blog') THEN 2 WHEN contains(crawl_url, 'en/') THEN 3 ELSE 4 END"

QUERIES = {
    "url_normalize": url_normalize, "url_canonical_dedupe": url_canonical_dedupe, "site_scope": site_scope, "page_classify": page_classify, "path_family": path_family, "selected_pages": selected_pages,
    "site_quality": site_quality, "budgeted_selection": budgeted_selection, "document_topk": document_topk, "html_links": html_links, "html_text": html_text, "html_text_parsed": html_text_parsed,
    "common_prefix": common_prefix, "path_prefix": path_prefix, "url_dates": url_dates, "news_sources": news_sources, "links_told": links_told,
}

ORACLES = {
    "url_normalize": f"""SELECT page_id, {_norm_sql('url')} AS normalized, {_ext_sql('url')} AS extension,
  CASE WHEN {_ext_sql('url')} IN {_in(vocab.DOCUMENT_EXTENSIONS)} THEN 'document' WHEN {_ext_sql('url')} IN {_in(vocab.STATIC_EXTENSIONS)} THEN 'asset' ELSE 'html' END AS kind,
  rtrim(url, '/') AS slash_key, rtrim(lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1)) || {_path_sql('url')}, '/') AS homepage FROM pages""",
    "url_canonical_dedupe": f"""SELECT page_id, apex, path FROM (SELECT page_id, apex, path, row_number() OVER (PARTITION BY apex, path ORDER BY page_id) AS rn FROM (
  SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)), '^www\\.', '') AS apex, regexp_replace(rtrim({_path_sql('url')}, '/'), '\\.html$', '') AS path FROM pages)) WHERE rn = 1""",
    "site_scope": r"""WITH a AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS h FROM pages),
b AS (SELECT *, regexp_replace(h, '^(www|m|blog)\.', '') AS apex FROM a),
g AS (SELECT apex, arg_min(h, page_id) AS g FROM b GROUP BY apex)
SELECT page_id, h = g OR h = 'www.' || g OR g = 'www.' || h AS same_site,
  h = g OR h = 'www.' || g OR g = 'www.' || h OR ends_with(regexp_replace(h, '^www\.', ''), '.' || regexp_replace(g, '^www\.', '')) AS with_subdomains,
  (h = 'example.com' OR ends_with(h, '.example.com')) AND NOT regexp_matches(url, '[?#]') AS document_host FROM b JOIN g USING (apex)""",
    "page_classify": f"""WITH {CRAWL_SQL}, cu AS (SELECT page_id, home, crawl_url, crawl_url AS url FROM crawl),
{_class_ctes('cu', ('communications', 'flight_vehicle_control'))}
SELECT page_id, crawl_url, page_class, score, kind FROM cl""",
    "path_family": f"""WITH {_FAM_CTES} SELECT page_id, rejected, np AS normalized, family, ({_RANK_SQL})::INTEGER AS family_rank, coalesce({_BARE_SQL.replace('@', 'np')}, false) AS bare FROM f""",
    "selected_pages": f"WITH {_SELECT_CTES} SELECT * FROM sel",
    "site_quality": f"""WITH {_SELECT_CTES},
q AS (SELECT site, url, CASE WHEN selected THEN CASE WHEN page_id % 17 = 0 THEN 'failed' ELSE 'fetched' END ELSE status END AS status, CASE WHEN selected AND page_id % 17 <> 0 THEN length(html) ELSE 0 END AS chars FROM sel JOIN pages USING (page_id, ) ),
g AS (SELECT site, count(*) FILTER (status = 'fetched') AS fetched_pages, count(*) FILTER (status = 'failed') AS failed_pages, 0::BIGINT AS fetched_documents, count(*) AS discovered_urls,
  count(*) FILTER (starts_with(status, 'skipped')) AS skipped_urls, sum(chars)::BIGINT AS total_text_chars,
  coalesce(bool_or(status = 'fetched' AND {_any_sql('lower(url)', vocab.PRODUCT_TOKENS)}), false) AS hp, coalesce(bool_or(status = 'fetched' AND {_any_sql('lower(url)', vocab.ABOUT_TOKENS)}), false) AS ha FROM q GROUP BY site),
r AS (SELECT *, array_to_string(list_filter([CASE WHEN fetched_pages = 0 THEN 'no_html' END, CASE WHEN total_text_chars < 3000 THEN 'little_text' END, CASE WHEN NOT hp THEN 'no_product' END,
  CASE WHEN NOT ha THEN 'no_about' END, CASE WHEN failed_pages > 0 THEN 'failed_pages' END], lambda x: x IS NOT NULL), ',') AS reasons FROM g)
SELECT site, fetched_pages, failed_pages, fetched_documents, discovered_urls, skipped_urls, total_text_chars, reasons,
  CASE WHEN fetched_pages = 0 THEN 'failed' WHEN reasons = '' THEN 'complete' WHEN total_text_chars >= 3000 THEN 'partial' ELSE 'review_required' END AS quality FROM r""".replace("USING (page_id, )", "USING (page_id)").replace("SELECT site, url, CASE", "SELECT site, sel.url, CASE"),
    "budgeted_selection": r"""WITH a AS (SELECT *, regexp_extract(p_brand, '(\d+)', 1)::INTEGER % 4 AS budget FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_retailprice DESC, length(p_name), p_partkey) AS rk FROM a),
c AS (SELECT *, rk <= budget AS fits, row_number() OVER (PARTITION BY p_size ORDER BY (rk <= budget) DESC, p_brand, rk) AS place FROM b)
SELECT p_partkey, p_size, p_brand, fits AND place <= 12 AS selected, CASE WHEN fits AND place <= 12 THEN 'selected' WHEN budget <= 0 THEN 'skipped_class_budget' ELSE 'skipped_budget' END AS status FROM c""",
    "document_topk": "SELECT doc_id, source, n_chars FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= 3",
    "html_links": r"""WITH a AS (SELECT page_id, url, trim(unnest(regexp_extract_all(html, 'href\s*=\s*"([^"]*)"', 1))) AS h FROM pages),
b AS (SELECT *, regexp_extract(url, '^(https?)', 1) AS s, regexp_extract(url, '^https?://([^/?#]*)', 1) AS n, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS p FROM a),
c AS (SELECT page_id, n, regexp_replace(CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN h WHEN starts_with(h, '//') THEN s || ':' || h WHEN starts_with(h, '/') THEN s || '://' || n || h
  WHEN starts_with(h, '?') THEN s || '://' || n || p || h ELSE s || '://' || n || CASE WHEN regexp_replace(p, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END || h END, '#.*$', '') AS target_url
  FROM b WHERE h <> '' AND NOT regexp_matches(h, '^(javascript:|mailto:|tel:|#)')),
d AS (SELECT *, lower(regexp_extract(target_url, '^https?://([^/?#:]*)', 1)) AS th, lower(regexp_replace(n, ':.*$', '')) AS nh FROM c WHERE regexp_matches(target_url, '^https?:'))
SELECT page_id, target_url, count(*) AS n, bool_or(th = nh OR th = 'www.' || nh OR nh = 'www.' || th) AS in_scope FROM d GROUP BY page_id, target_url""",
    "html_text": rf"""WITH a AS (SELECT page_id, {_TAGS_SQL} AS b FROM pages), c AS (SELECT page_id, regexp_replace(regexp_replace(b, '(?s)<!--.*?-->', chr(10), 'g'), '(?s)<[^>]*>', chr(10), 'g') AS t FROM a),
d AS (SELECT page_id, {_ENTITY_SQL} AS t FROM c)
SELECT page_id, array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10)) AS text FROM d""",
    "common_prefix": f"""WITH {CRAWL_SQL}, a AS (SELECT site, {_path_sql('url')} AS path FROM crawl), n AS (SELECT site, count(*) AS n FROM a GROUP BY site),
{_PREFIX_CTES.format(key='site', col='path', src='a')}
SELECT site, coalesce(prefix, '') AS prefix, n FROM n LEFT JOIN pre USING (site)""",
    "path_prefix": f"""WITH {CRAWL_SQL}, a AS (SELECT {_PREFIX_GROUP} AS g, {_path_sql('crawl_url')} AS path FROM crawl), n AS (SELECT g, count(*) AS n FROM a GROUP BY g),
{_PREFIX_CTES.format(key='g', col='path', src='a')}
SELECT g, coalesce(prefix, '') AS prefix, n FROM n LEFT JOIN pre USING (g)""",
    "url_dates": rf"""WITH {CRAWL_SQL}, a AS (SELECT page_id, regexp_extract({_path_sql('crawl_url')}, '/(20\d\d)/(\d{{1,2}})(?:/(\d{{1,2}}))?(?:/|$)', ['y', 'm', 'd']) AS x FROM crawl),
b AS (SELECT page_id, CASE WHEN x.y <> '' THEN try_cast(x.y || '-' || lpad(x.m, 2, '0') || '-' || lpad(CASE WHEN x.d = '' THEN '1' ELSE x.d END, 2, '0') AS DATE) END AS d FROM a)
SELECT page_id, CASE WHEN d BETWEEN DATE '2010-01-01' AND DATE '2026-05-03' THEN d END AS date FROM b""",
    "news_sources": f"""WITH {_FAM_CTES},
v AS (SELECT regexp_replace(site, '^(www|m|blog)\\.', '') AS slug, page_id, family, np, {_BARE_SQL.replace('@', 'np')} AS bare FROM f WHERE family IS NOT NULL),
{_PREFIX_CTES.format(key='slug, family', col='np', src='v')},
g AS (SELECT slug, family, count(*) AS items, arg_min(np, page_id) FILTER (bare) AS bp, arg_min(np, (len(string_split(np, '/')), len(np), page_id)) AS short FROM v GROUP BY slug, family),
h AS (SELECT *, ({_RANK_SQL})::INTEGER AS family_rank FROM g),
i AS (SELECT h.*, coalesce(prefix, '') AS pre, regexp_replace(short, '/[^/]*$', '') AS parent FROM h LEFT JOIN pre USING (slug, family)),
j AS (SELECT slug, family, items, bp IS NOT NULL AS bare_index_seen, family_rank, CASE WHEN bp IS NOT NULL THEN bp WHEN {_BARE_SQL.replace('@', 'i.pre')} THEN i.pre WHEN {_BARE_SQL.replace('@', 'parent')} THEN parent ELSE '/' || family END AS index_path,
  coalesce(min(family_rank) FILTER (items >= 3) OVER (PARTITION BY slug), min(family_rank) OVER (PARTITION BY slug)) AS best FROM i)
SELECT slug, family, items, row_number() OVER (PARTITION BY slug ORDER BY (family_rank = best) DESC, family_rank)::INTEGER AS rank, bare_index_seen, index_path, family_rank FROM j""",
    "links_told": rf"""WITH h AS (SELECT regexp_replace(url, '[?#].*$', '') || unnest(regexp_extract_all(html, 'href\s*=\s*"([^"]*)"', 1)) AS url, regexp_extract(url, '^(https?://[^/]+)', 1) AS root FROM pages
  UNION SELECT url, regexp_extract(url, '^(https?://[^/]+)', 1) FROM pages),
cu AS (SELECT DISTINCT url || ([{", ".join("'" + t + "'" for t in TAILS)}])[('0x' || left(md5(url), 6))::INTEGER % {len(TAILS)} + 1] AS url, root || '/' AS home FROM h),
{_class_ctes('cu')},
pp AS (SELECT cl.*, {_path_sql('url')} AS rp FROM cl), pq AS (SELECT url, home, page_class, score, kind, rp AS p FROM pp),
n AS (SELECT *, {_NORM_PATH_SQL} AS np, {_REJECT_SQL} AS rejected FROM pq),
f AS (SELECT *, CASE WHEN NOT rejected THEN {_FAMILY_SQL} END AS family FROM n),
x AS (SELECT *, regexp_extract(p, '/(20\d\d)/(\d{{1,2}})(?:/(\d{{1,2}}))?(?:/|$)', ['y', 'm', 'd']) AS x FROM f),
y AS (SELECT *, CASE WHEN x.y <> '' THEN try_cast(x.y || '-' || lpad(x.m, 2, '0') || '-' || lpad(CASE WHEN x.d = '' THEN '1' ELSE x.d END, 2, '0') AS DATE) END AS d FROM x)
SELECT url, home, page_class, score, kind, rejected, np AS normalized, family, coalesce({_BARE_SQL.replace('@', 'np')}, false) AS bare, CASE WHEN d BETWEEN DATE '2010-01-01' AND DATE '2026-05-03' THEN d END AS date FROM y""",
}
