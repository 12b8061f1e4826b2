"""Final documents from submissions, and the texts that sum a vendor up for the next pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ABOUT = ("target_id", "run_id", "display_name", "homepage_url", "corpus_root", "meta")
PROFILE_FIELDS = ("products_categories", "headquarters", "drone_supply_chain_role", "products", "ndaa", "blue_uas", "readiness", "unresolved_questions", "fetch_requests", "status")
CATALOG_FIELDS = ("products", "unresolved_questions", "fetch_requests", "status")
TEXT_CHARS = 8000


def _finished(submissions: DataFrame, about: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    rows = submissions.select("target_id", *fields).join(about.select(*ABOUT), "target_id")
    return rows.select(*[c for c in ABOUT if c != "meta"], *fields, "meta")


def profiles(submissions: DataFrame, about: DataFrame) -> DataFrame:
    """Profiles: a submission's answers under its target's metadata; of ``about`` (one row a target) only what is asked for is read."""
    return _finished(submissions, about, PROFILE_FIELDS)


def catalogs(submissions: DataFrame, about: DataFrame) -> DataFrame:
    """Product catalogs, made like profiles."""
    return _finished(submissions, about, CATALOG_FIELDS)


def priorities(submissions: DataFrame, about: DataFrame, max_products: int, status: str = "complete") -> DataFrame:
    """Product priority lists: the first ``max_products`` of the order handed in (all where that is 0 or less), and how many there were."""
    rows = submissions.withColumn("agent_listed", F.size("products"))
    if max_products > 0:
        rows = rows.withColumn("products", F.slice("products", 1, max_products))
    done = rows.withColumn("max_products", F.lit(max_products)).withColumn("status", F.lit(status))
    return _finished(done, about, ("products", "agent_listed", "max_products", "status", "notes"))


def homepage_text(resources: DataFrame, key: list[str]) -> DataFrame:
    """(key, text) of the homepage: the first fetched page of that class that has a text, else that of resource-0001, else empty; cut at TEXT_CHARS.

    ``resources`` has resource_id, page_class, status, pos and text.
    """
    own = F.min_by("text", F.when((F.col("status") == "fetched") & (F.col("page_class") == "homepage") & F.col("text").isNotNull(), F.col("pos")))
    first = F.min_by("text", F.when((F.col("resource_id") == "resource-0001") & F.col("text").isNotNull(), F.col("pos")))
    return resources.groupBy(*key).agg(F.left(F.coalesce(own, first, F.lit("")), F.lit(TEXT_CHARS)).alias("text"))


def _named(items: Column, primary: bool) -> Column:
    return F.transform(F.filter(items, lambda c: F.coalesce(c["is_primary"], F.lit(False)) == primary), lambda c: c["category"])


def _or(value: Column, other: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(other))


def profile_digest() -> Column:
    """A profile in a few lines, from the columns of schemas.PROFILE. The wording is fixed."""
    items, hq = F.coalesce(F.col("products_categories.items"), F.array().cast("array<struct<category:string,is_primary:boolean>>")), F.col("headquarters.value")
    also = F.array_join(_named(items, False), ", ")
    place = F.array_join(F.filter(F.array(hq["city"], hq["state_or_province"], hq["country"]), lambda x: x.isNotNull() & (x != "")), ", ")
    named = F.array_join(F.transform(F.slice("products.items", 1, 8), lambda p: p["name"]), ", ")
    lines = [
        F.concat(F.lit("  display_name: "), "display_name"), F.concat(F.lit("  role: "), _or(F.col("drone_supply_chain_role.value"), "unknown")),
        F.concat(F.lit("  primary category: "), F.coalesce(F.get(_named(items, True), 0), F.lit("(none)")), F.when(also != "", F.concat(F.lit(" (also: "), also, F.lit(")"))).otherwise("")),
        F.concat(F.lit("  hq: "), _or(place, "unknown")), *[F.concat(F.lit(f"  {c}: "), _or(F.col(f"{c}.value"), "unknown")) for c in ("ndaa", "blue_uas", "readiness")],
        F.concat(F.lit("  vendor-pass-named products: "), _or(named, "(none enumerated)")),
    ]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def products_digest(products: Column) -> Column:
    """The first twenty products, a line each, and how many more there are. The wording is fixed."""

    def line(p: Column) -> Column:
        known = lambda c, label: F.when(p[c] != "unknown", F.concat(F.lit(f"{label}="), p[c]))
        marks = F.concat_ws(", ", known("ndaa", "NDAA"), known("blue_uas", "BlueUAS"))
        say = lambda c: F.coalesce(p[c], F.lit("None"))
        return F.concat(F.lit("  - "), p["name"], F.lit(" ("), say("category"), F.lit("/"), say("granularity"), F.lit("/"), say("readiness"), F.lit(") — "), say("descriptor"), F.when(marks != "", F.concat(F.lit(" ["), marks, F.lit("]"))).otherwise(""))

    n = F.size(products)
    more = F.when(n > 20, F.concat(F.lit("\n  ... and "), (n - 20).cast("string"), F.lit(" more"))).otherwise("")
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.concat(F.array_join(F.transform(F.slice(products, 1, 20), line), "\n"), more)).otherwise("  (none)")


def vendor_context(full: bool = True) -> Column:
    """What the vendor pass found, as a hint for the product passes: in ``full`` with the other categories and ten products, or in brief. The wording is fixed."""
    items = F.coalesce(F.col("products_categories.items"), F.array().cast("array<struct<category:string,is_primary:boolean>>"))
    role, primary = _or(F.col("drone_supply_chain_role.value"), "(unknown)"), F.coalesce(F.get(_named(items, True), 0), F.lit("(no primary)"))
    if not full:
        return F.concat(F.lit("\n\nVENDOR-PASS CONTEXT:\n  role: "), role, F.lit("\n  primary category: "), primary, F.lit("\n"))
    also, named = F.array_join(_named(items, False), ", "), F.array_join(F.transform(F.slice("products.items", 1, 10), lambda p: p["name"]), ", ")
    seen = F.when(named != "", F.concat(F.lit("Vendor pass already named these products: "), named)).otherwise("Vendor pass did not enumerate any products.")
    return F.concat(
        F.lit("\n\nVENDOR-PASS CONTEXT (from existing profile.json):\n  role: "), role, F.lit("\n  primary category: "), primary, F.when(also != "", F.concat(F.lit(" (also: "), also, F.lit(")"))).otherwise(""), F.lit("\n  "), seen,
        F.lit("\n\nTreat this as a hint, not ground truth. Re-derive products from the corpus; you may find more (or fewer) SKUs than the vendor pass listed.\n"),
    )


def corpus_summary(corpora: DataFrame, index: DataFrame) -> DataFrame:
    """(target_id, prompt): what a corpus holds, in words. ``corpora`` has one row a target, ``index`` target_id, status, resource and page_class. The wording is fixed."""
    got = (F.col("status") == "fetched") & F.col("resource_id").isNotNull()
    by = index.select("target_id", F.when(got, F.coalesce("page_class", F.lit("other"))).alias("c")).groupBy("target_id", "c").agg(F.count("*").alias("n"))
    classes = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("c").isNotNull(), F.struct("c", "n")))), lambda x: F.concat(x["c"], F.lit("="), x["n"].cast("string"))), ", ")
    g = by.groupBy("target_id").agg(F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("n"))), F.lit(0)).alias("_got"), F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("n"))), F.lit(0)).alias("_not"), classes.alias("_classes"))
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    prompt = F.concat(
        F.lit("Vendor: "), "display_name", F.lit("\ntarget_id: "), "target_id", F.lit("\nhomepage_url: "), "homepage_url", F.lit("\nrun_id: "), "run_id", F.lit("\ncorpus_root: "), "corpus_root",
        F.lit("\n\nMirror coverage: status="), "quality_status", F.lit(", total_text_chars="), say("total_text_chars"), F.lit(", fetched_pages="), say("_got"), F.lit(", skipped_or_failed="), say("_not"),
        F.lit(".\nFetched page_classes: "), _or(F.col("_classes"), "(none)"),
        F.lit(".\n\nRead crawl_index.json to see exactly which URLs were fetched vs skipped, then read the relevant text/ files. Submit a single `submit_profile` call when done."),
    )
    return corpora.join(g, "target_id", "left").select("target_id", prompt.alias("prompt"))
