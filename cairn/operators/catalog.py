"""Rows of the catalog: facts, categories, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocab as v


def field(answer: Column) -> Column:
    return answer["value"]


def first_evidence(evidence: Column) -> Column:
    """The first citation as (ref, snippet, source_url, renderer); null where there is none."""
    e = F.try_element_at(evidence, F.lit(1))
    return F.when(e.isNotNull(), F.struct(F.lit("SUPPORTING EVIDENCE").alias("ref"), e["snippet"].alias("snippet"), e["url"].alias("source_url"), e["page_class"].alias("renderer")))


def facts(hq: Column, role: Column, compliance: Column, readiness: Column, n_products: Column, top: Column) -> Column:
    """Label and value of four facts, and two more where there are products."""
    row = lambda label, value: F.struct(F.lit(label).alias("label"), value.cast("string").alias("value"))
    fixed = [row("Headquarters", hq), row("Supply-chain role", t.title_label(role)), row("Compliance", v.compliance_label(compliance)), row("Readiness", v.readiness_label(readiness))]
    more = [F.when(n_products > 0, row("Product count", n_products)), F.when(n_products > 0, row("Product categories", top))]
    return F.array_compact(F.array(*fixed, *more))


def headquarters(city: Column, state: Column, country: Column) -> Column:
    """Distinct non-empty parts, commas between."""
    return F.array_join(F.array_distinct(F.array_compact(F.array(F.nullif(city, F.lit("")), F.nullif(state, F.lit("")), country))), ", ")


def most_common(rows: DataFrame, key: list[str], value: str, pos: str, k: int | None = None) -> DataFrame:
    """Values by count, ties by first place; ranked within the key."""
    g = rows.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(pos).alias("_first"))
    g = g.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("n"), "_first"))).drop("_first")
    return g if k is None else g.where(F.col("rank") <= k)


def categories(claims: DataFrame, products: DataFrame, key: list[str]) -> DataFrame:
    """Ordered categories of each key: the first primary claim, other claims in order, then product categories by frequency.

    ``claims`` has key, category, is_primary, pos; ``products`` has key, category, pos.
    """
    c = claims.groupBy(*key, "category").agg(F.min("pos").alias("a"), F.min(F.when(F.col("is_primary"), F.col("pos"))).alias("p")).withColumn("tier", F.lit(1))
    m = most_common(products, key, "category", "pos").select(*key, "category", F.col("rank").cast("long").alias("a"), F.lit(None).cast("long").alias("p"), F.lit(2).alias("tier"))
    one = c.select(*key, "category", F.col("a").cast("long"), F.col("p").cast("long"), "tier").unionByName(m).groupBy(*key, "category").agg(F.min(F.struct("tier", "a")).alias("o"), F.min("p").alias("p"))
    lead = F.min("p").over(Window.partitionBy(*key))
    one = one.withColumn("_lead", (F.col("p") == lead) & lead.isNotNull())
    order = F.struct((~F.coalesce("_lead", F.lit(False))).alias("x"), "o", "category")
    return one.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["category"]).alias("categories"))


def readiness(own: Column, product_values: Column) -> Column:
    """The profile's readiness, else the best among the products."""
    o = v.normalize_readiness(own)
    ranked = [F.when(F.array_contains(product_values, r), F.lit(r)) for r in v.READINESS_ORDER]
    return F.coalesce(F.when(o != "unknown", o), *ranked, F.lit("unknown"))


def tagline(role: Column, names: Column) -> Column:
    """Fallback tagline from role and the first three products."""
    subject = F.coalesce(t.title_label(role), F.lit("Vendor"))
    return F.when(F.size(names) > 0, F.concat(subject, F.lit(" with public evidence for "), F.array_join(F.slice(names, 1, 3), ", "), F.lit("."))).otherwise("(tagline pending review)")


def product(item: Column) -> Column:
    """A product with defaults filled in and its first evidence."""
    e = F.try_element_at(item["evidence"], F.lit(1))
    return F.struct(
        item["name"].alias("name"), F.coalesce(v.category_slug(item["category"]), F.lit("mechanical-subsystems")).alias("category"), item["descriptor"].alias("descriptor"),
        item["granularity"].alias("granularity"), v.normalize_readiness(item["readiness"]).alias("readiness"), F.coalesce(item["ndaa"], F.lit("unknown")).alias("ndaa"),
        F.coalesce(item["blue_uas"], F.lit("unknown")).alias("blue_uas"), e["url"].alias("source_url"), e["snippet"].alias("snippet"),
    )


def vendor_rows(profiles: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Gold rows: vendors with both documents; profile and catalog keyed by target_id.

    profiles: display_name, homepage_url, headquarters.value(city, state_or_province, country), drone_supply_chain_role,
    ndaa, blue_uas, readiness (answers), tagline, products_categories.items. catalogs: products.
    """
    j = profiles.join(catalogs.select("target_id", F.col("products").alias("_products")), "target_id")
    hq = F.col("headquarters.value")
    items = F.transform(F.coalesce("_products", F.array().cast(catalogs.schema["products"].dataType)), product)
    j = j.withColumn("_items", items).withColumn("compliance", v.compliance(F.col("ndaa.value"), F.col("blue_uas.value")))
    j = j.withColumn("readiness_level", readiness(F.col("readiness.value"), F.transform("_items", lambda x: x["readiness"])))
    name = v.country_name(hq["country"])
    return j.select(
        t.slug_key(F.col("target_id")).alias("slug"), "display_name", "homepage_url", v.iso2(hq["country"]).alias("country"), name.alias("country_name"),
        headquarters(hq["city"], hq["state_or_province"], name).alias("location"), "compliance", F.col("readiness_level").alias("readiness"),
        F.coalesce(F.nullif("tagline", F.lit("")), tagline(F.col("drone_supply_chain_role.value"), F.transform("_items", lambda x: x["name"]))).alias("tagline"),
        F.slice("_items", 1, 12).alias("products"), F.size("_items").alias("n_products"),
    )
