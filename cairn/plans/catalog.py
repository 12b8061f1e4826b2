"""Queries of the catalog: vocabularies, rows, facets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocab as v
from ..operators import catalog, facets
from ..session import table

#: Spellings to normalise, dealt to nations by key.
SPELLINGS = (
    "USA", " u.s. ", "United  States of America", "England", "Deutschland", "república", "France.", "Holland", "Türkiye", "Republic of Korea", "DPRK", "U.A.E.", "Brasil", "Eire", "Czechia", "people's republic of china", "Nederland", "Wakanda", "", "nz",
    "Canada", "IRAN", "Viet Nam", "SUOMI", "r.f.",
)
STATES = ("CA", "texas", "N.Y.", " Ontario ", "dc", "District of Columbia", "wa.", "Bavaria", "", "NEW MEXICO")


def country_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    raw = F.element_at(F.array(*[F.lit(x) for x in SPELLINGS]), (F.col("n_nationkey") % len(SPELLINGS) + 1).cast("int"))
    state = F.element_at(F.array(*[F.lit(x) for x in STATES]), (F.col("n_nationkey") % len(STATES) + 1).cast("int"))
    c = v.normalize_country(raw)
    return n.select("n_nationkey", raw.alias("raw"), c.alias("country"), v.iso2(c).alias("iso2"), v.iso2(c, strict=True).alias("iso2_strict"), v.country_name(c).alias("shown"), v.normalize_us_state(state).alias("state"))


def _category(key) -> F.Column:
    return F.element_at(F.array(*[F.lit(raw) for raw, _, _ in v.CATEGORIES]), (key % len(v.CATEGORIES) + 1).cast("int"))


def _supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of suppliers: the lines they ship, with a category by part and a place."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), "l_returnflag")
    return li.withColumn("category", v.category_slug(_category(F.col("l_partkey") % 7 + F.col("l_suppkey") % 5)))


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.most_common(_supplied(spark, sf_dir), ["l_suppkey"], "category", "pos", 4).select("l_suppkey", "category", "n", F.col("rank").cast("int").alias("rank"))


def category_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    claims = s.select("s_suppkey", F.posexplode(F.array(*[_category(F.col("s_suppkey") + k) for k in (11, 3, 11)])).alias("pos", "category"), "s_nationkey").select(F.col("s_suppkey").alias("k"), v.category_slug(F.col("category")).alias("category"), "pos", (F.col("pos") == F.col("s_nationkey") % 4).alias("is_primary"))
    products = _supplied(spark, sf_dir).select(F.col("l_suppkey").alias("k"), "category", "pos")
    return catalog.categories(claims, products, ["k"]).withColumn("categories", F.array_join("categories", ","))


def catalog_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    li = _supplied(spark, sf_dir).groupBy("l_suppkey").agg(F.count("*").alias("n_products"), F.count_distinct("category").alias("n_categories"), F.array_sort(F.collect_set(v.normalize_readiness(F.when(F.col("l_returnflag") == "R", "prototype").when(F.col("l_returnflag") == "A", "low_rate_production").otherwise("engineering_services")))).alias("levels"))
    j = s.join(li, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    ndaa, blue = F.when(F.col("s_suppkey") % 3 == 0, "yes").when(F.col("s_suppkey") % 3 == 1, "no"), F.when(F.col("s_suppkey") % 5 == 0, "yes")
    comp = v.compliance(ndaa, blue)
    ready = catalog.readiness(F.when(F.col("s_suppkey") % 4 == 0, "production").otherwise("unknown"), F.coalesce("levels", F.array().cast("array<string>")))
    hq = catalog.headquarters(F.initcap("n_name"), F.when(F.col("s_suppkey") % 2 == 0, F.initcap("n_name")).otherwise(""), v.country_name(F.initcap("n_name")))
    role = F.element_at(F.array(F.lit("component_supplier"), F.lit("integrator")), (F.col("s_suppkey") % 2 + 1).cast("int"))
    n = F.coalesce("n_products", F.lit(0))
    facts = catalog.facts(hq, role, comp, ready, n, F.concat(F.col("n_categories").cast("string"), F.lit(" kinds")))
    letter = v.category_letter(v.category_slug(_category(F.col("s_suppkey"))))
    shown = F.array_join(F.transform(facts, lambda x: F.concat_ws("=", x["label"], x["value"])), "; ")
    return j.select("s_suppkey", t.slug_key(F.col("s_name")).alias("slug"), comp.alias("compliance"), ready.alias("readiness"), letter.alias("letter"), shown.alias("facts"), catalog.tagline(role, F.slice(F.coalesce("levels", F.array().cast("array<string>")), 1, 3)).alias("tagline"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    level = F.element_at(F.array(*[F.lit(x) for x in ("ndaa_compliant", "blue_uas_framework", "blue_uas_cleared", "unknown")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    return c.select("c_custkey", F.when(F.upper("n_name") == "UNITED STATES", "United States").otherwise(F.initcap("n_name")).alias("country"), F.lower("c_mktsegment").alias("category"), level.alias("compliance"), F.lower("r_name").alias("region"), (F.col("c_custkey") % 9 == 0).alias("meta"), t.search_string(F.col("c_name"), F.col("n_name"), F.col("r_name")).alias("search"), "c_acctbal")


def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    tests = [facets.compliance_facet(F.col("compliance"), "framework"), facets.country_facet(F.col("country"), "allied-only"), facets.category_facet(F.col("category"), F.col("meta"), "building"), facets.readiness_facet(F.col("region"), "asia")]
    both = facets.apply(c, tests, "0").withColumn("view", F.lit("framework")).unionByName(facets.apply(c, [facets.category_facet(F.col("category"), F.col("meta"), "avionics"), facets.country_facet(F.col("country"), "us-only")]).withColumn("view", F.lit("avionics")))
    return both.select("c_custkey", "view", "country", "compliance")


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.counts(_customers(spark, sf_dir), "country", "category", "compliance", "region")


def sector_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = spark.createDataFrame([(x, k) for k, x in enumerate(("building", "furniture", "aviation", "machinery"))], "category string, position int")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("reviewed"))
    vendors = _customers(spark, sf_dir).join(o, F.col("c_custkey") == F.col("o_custkey")).select("category", F.to_date("reviewed").alias("reviewed"))
    return facets.sectors(dim, vendors, "category", "reviewed")


QUERIES = {f.__name__: f for f in (country_norm, top_categories, category_order, catalog_row, facet_filter, facet_counts, sector_totals)}

_q = lambda x: "'" + x.replace("'", "''") + "'"
_SPELL = "[" + ", ".join(map(_q, SPELLINGS)) + "]"
_STATE = "[" + ", ".join(map(_q, STATES)) + "]"
_COUNTRY = "CASE " + " ".join(f"WHEN regexp_full_match(b, {_q(p)}) THEN {_q(c)}" for p, c in v.COUNTRIES) + " ELSE trim(raw) END"
_map = lambda d: "MAP {" + ", ".join(f"{_q(k)}: {_q(x)}" for k, x in d.items()) + "}"
_RAWCAT = "[" + ", ".join(_q(r) for r, _, _ in v.CATEGORIES) + "]"
_SLUGS = _map({r: s for r, s, _ in v.CATEGORIES})
_LETTERS = _map({s: x for _, s, x in v.CATEGORIES})
_SUPPLIED = f"sp AS (SELECT l_suppkey, l_partkey, l_orderkey * 10 + l_linenumber AS pos, l_returnflag, ({_SLUGS})[({_RAWCAT})[(l_partkey % 7 + l_suppkey % 5) % 16 + 1]] AS category FROM lineitem)"
_CUST = """c AS (SELECT c_custkey, CASE WHEN upper(n_name) = 'UNITED STATES' THEN 'United States' ELSE array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(left(w, 1)) || substring(w, 2)), ' ') END AS country, lower(c_mktsegment) AS category,
  (['ndaa_compliant', 'blue_uas_framework', 'blue_uas_cleared', 'unknown'])[c_custkey % 4 + 1] AS compliance, lower(r_name) AS region, c_custkey % 9 = 0 AS meta, lower(c_name || ' ' || n_name || ' ' || r_name) AS search
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_INIT = "array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(left(w, 1)) || substring(w, 2)), ' ')"
ORACLES = {
    "country_norm": rf"""WITH a AS (SELECT n_nationkey, ({_SPELL})[n_nationkey % {len(SPELLINGS)} + 1] AS raw, ({_STATE})[n_nationkey % {len(STATES)} + 1] AS st FROM nation),
b AS (SELECT *, regexp_replace(lower(rtrim(trim(raw), '.')), '\s+', ' ', 'g') AS b, rtrim(trim(st), '.') AS sb FROM a),
c AS (SELECT *, CASE WHEN raw = '' THEN raw ELSE {_COUNTRY} END AS country FROM b),
d AS (SELECT *, coalesce(({_map(v.COUNTRY_ISO2)})[country], left(upper(country), 2)) AS iso2 FROM c)
SELECT n_nationkey, raw, country, iso2, ({_map(v.COUNTRY_ISO2)})[country] AS iso2_strict, coalesce(({_map(v.ISO2_NAMES)})[iso2], CASE WHEN length(country) > 2 THEN country END, iso2) AS shown,
  CASE WHEN st = '' THEN st ELSE coalesce(({_map(v.US_STATES)})[upper(sb)], ({_map({x.upper(): x for x in v.US_STATES.values()})})[upper(sb)], sb) END AS state FROM d""",
    "top_categories": f"WITH {_SUPPLIED}, g AS (SELECT l_suppkey, category, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(pos))::INTEGER AS rank FROM sp GROUP BY l_suppkey, category) SELECT * FROM g WHERE rank <= 4",
    "category_order": f"""WITH {_SUPPLIED},
cl AS (SELECT s_suppkey AS k, ({_SLUGS})[({_RAWCAT})[(s_suppkey + o) % 16 + 1]] AS category, p, p = s_nationkey % 4 AS prim FROM supplier, (VALUES (0, 11), (1, 3), (2, 11)) t(p, o)),
cg AS (SELECT k, category, min(p) AS a, min(p) FILTER (prim) AS pp FROM cl GROUP BY k, category),
lead AS (SELECT k, arg_min(category, pp) AS lead FROM cg WHERE pp IS NOT NULL GROUP BY k),
pg AS (SELECT l_suppkey AS k, category, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(pos)) AS a FROM sp GROUP BY l_suppkey, category),
al AS (SELECT k, category, min(t * 1000 + a) AS o FROM (SELECT k, category, 1 AS t, a FROM cg UNION ALL SELECT k, category, 2, a FROM pg) GROUP BY k, category)
SELECT k, string_agg(category, ',' ORDER BY (CASE WHEN category = lead THEN 0 ELSE 1 END), o) AS categories FROM al LEFT JOIN lead USING (k) GROUP BY k""",
    "catalog_row": f"""WITH {_SUPPLIED},
g AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT category) AS nc, list_sort(list_distinct(list(CASE l_returnflag WHEN 'R' THEN 'prototype' WHEN 'A' THEN 'low_rate' ELSE 'engineering_services' END))) AS lv FROM sp GROUP BY l_suppkey),
j AS (SELECT s_suppkey, s_name, {_INIT} AS nm, coalesce(n, 0) AS n, nc, coalesce(lv, []) AS lv FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN g ON l_suppkey = s_suppkey),
k AS (SELECT *, CASE WHEN s_suppkey % 5 = 0 THEN 'blue_uas_framework' WHEN s_suppkey % 3 = 0 THEN 'ndaa_compliant' WHEN s_suppkey % 3 = 1 THEN 'not_eligible' ELSE 'unknown' END AS compliance,
  CASE WHEN s_suppkey % 4 = 0 THEN 'production' WHEN list_contains(lv, 'low_rate') THEN 'low_rate' WHEN list_contains(lv, 'prototype') THEN 'prototype' WHEN list_contains(lv, 'engineering_services') THEN 'engineering_services' ELSE 'unknown' END AS readiness,
  coalesce(({_map(v.COUNTRY_ISO2)})[nm], left(upper(nm), 2)) AS iso, CASE WHEN s_suppkey % 2 = 0 THEN 'Component Supplier' ELSE 'Integrator' END AS role FROM j),
l AS (SELECT *, coalesce(({_map(v.ISO2_NAMES)})[iso], CASE WHEN length(nm) > 2 THEN nm END, iso) AS cn FROM k)
SELECT s_suppkey, replace(lower(trim(s_name)), '_', '-') AS slug, compliance, readiness, coalesce(({_LETTERS})[({_SLUGS})[({_RAWCAT})[s_suppkey % 16 + 1]]], 'X') AS letter,
  'Headquarters=' || CASE WHEN nm = cn THEN nm ELSE nm || ', ' || cn END || '; Supply-chain role=' || role || '; Compliance=' || ({_map(v.COMPLIANCE_LABELS)})[compliance] || '; Readiness=' || ({_map(v.READINESS_LABELS)})[readiness]
  || CASE WHEN n > 0 THEN '; Product count=' || n || '; Product categories=' || nc || ' kinds' ELSE '' END AS facts,
  CASE WHEN len(lv) > 0 THEN role || ' with public evidence for ' || array_to_string(lv[1:3], ', ') || '.' ELSE '(tagline pending review)' END AS tagline FROM l""",
    "facet_filter": f"""WITH {_CUST} SELECT c_custkey, 'framework' AS view, country, compliance FROM c WHERE compliance IN ('blue_uas_framework', 'blue_uas_cleared') AND country <> 'United States' AND category = 'building' AND region = 'asia' AND contains(search, '0')
UNION ALL SELECT c_custkey, 'avionics', country, compliance FROM c WHERE meta AND country = 'United States'""",
    "facet_counts": f"""WITH {_CUST} SELECT facet, value, count(*) AS n FROM (SELECT 'country' AS facet, country AS value FROM c UNION ALL SELECT 'category', category FROM c UNION ALL SELECT 'compliance', compliance FROM c UNION ALL SELECT 'region', region FROM c) GROUP BY facet, value""",
    "sector_totals": f"""WITH {_CUST}, o AS (SELECT o_custkey, max(o_orderdate)::DATE AS r FROM orders GROUP BY 1)
SELECT category, position, count(*) AS vendors, max(r) AS latest FROM c JOIN o ON o_custkey = c_custkey JOIN (VALUES ('building', 0), ('furniture', 1), ('aviation', 2), ('machinery', 3)) d(category, position) USING (category) GROUP BY category, position""",
}
