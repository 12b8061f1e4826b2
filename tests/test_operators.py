"""Operators against folds and loops written from their rules."""

import random
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.functions import vocab
from cairn.operators import catalog, cite, documents, facets, fold, journal, keys, news, quality, registry, select


def answer_loop(rows):
    """The oldest value, replaced by an answered one, or by any known one while it is unknown itself."""
    value, status = rows[0]
    for v, s in rows[1:]:
        if v is None:
            continue
        if s == "answered" or (value is None or status == "unknown") and s != "unknown":
            value, status = v, s
    return value


def test_answer_fold(spark):
    rng = random.Random(5)
    groups = {}
    for g in range(400):
        rows = [(rng.choice([None, *range(5)]), rng.choice(["answered", "not_disclosed", "unknown"])) for _ in range(rng.randrange(1, 6))]
        groups[g] = [(v, s if v is not None else None) for v, s in rows]
    flat = [(g, k, v, s) for g, rows in groups.items() for k, (v, s) in enumerate(rows)]
    df = spark.createDataFrame(flat, "g int, seq int, value int, status string")
    got = {r.g: r.v for r in df.groupBy("g").agg(fold.answer(F.col("value"), F.col("status"), F.col("seq")).alias("v")).collect()}

    def closed(rows):
        for v, s in reversed(rows):
            if s == "answered":
                return v
        for v, s in rows:
            if v is not None and s != "unknown":
                return v
        return rows[0][0]

    assert got == {g: closed(rows) for g, rows in groups.items()}
    plain = {g: rows for g, rows in groups.items() if all(v is not None for v, _ in rows)}
    assert {g: got[g] for g in plain} == {g: answer_loop(rows) for g, rows in plain.items()}


def test_best_status_tagline_and_union(spark):
    df = spark.createDataFrame([(1, 1, "partial", "", ["b", "a"]), (1, 2, "complete", "two", ["a", "c"]), (1, 3, "failed", "three", None), (2, 1, None, None, [])], "g int, seq int, status string, tagline string, xs array<string>")
    rows = {r.g: r for r in df.groupBy("g").agg(fold.best_status(F.col("status")).alias("s"), fold.first_filled(F.col("tagline"), F.col("seq")).alias("t"), fold.forward_looking(F.col("tagline"), F.col("seq")).alias("f")).collect()}
    assert tuple(rows[1])[1:] == ("complete", "two", "three") and tuple(rows[2])[1:] == ("unknown", None, None)
    assert {r.g: r.xs for r in fold.ordered_union(df, ["g"], "xs").collect()} == {1: ["b", "a", "c"], 2: []}


def test_url_fold(spark):
    ddl = "url string, seq int, status string, resource string, skip_reason string, final_url string, page_class string, kind string, depth int, in_scope boolean"
    rows = [
        ("a", 1, "fetched", "r1", None, "a1", "news", "html", 2, False), ("a", 2, "fetched", "r2", None, "a2", None, "html", 1, True), ("a", 3, "skipped_budget", None, "budget", "a3", "other", None, 0, False),
        ("b", 1, "skipped_budget", None, "budget", None, None, None, 3, False), ("b", 2, "failed", None, "timeout", None, None, None, 2, False), ("c", 1, "skipped_budget", None, "budget", None, None, None, 1, True), ("c", 2, "fetched", "r9", None, "c", "product", "html", 1, True),
    ]
    got = {r.url: r for r in fold.urls(spark.createDataFrame(rows, ddl), ["url"]).collect()}
    assert (got["a"].resource, got["a"].status, got["a"].final_url, got["a"].page_class, got["a"].depth, got["a"].in_scope) == ("r2", "fetched", "a2", "news", 0, True)
    assert (got["b"].status, got["b"].skip_reason, got["b"].depth) == ("failed", "timeout", 2)
    assert (got["c"].status, got["c"].skip_reason, got["c"].page_class) == ("fetched", "budget", "product")


def test_products(spark):
    rows = [(1, "x", 1, 1, "old"), (1, "y", 1, 2, "old"), (1, "x", 2, 5, "new"), (1, "z", 2, 1, "new"), (2, "x", 1, 1, "a"), (2, "x", 1, 2, "b")]
    out = fold.products(spark.createDataFrame(rows, "k int, name string, seq int, pos int, body string"), ["k"], "name", ["body"])
    assert sorted((r.k, r.position, r.name, r.body) for r in out.collect()) == [(1, 1, "x", "new"), (1, 2, "y", "old"), (1, 3, "z", "new"), (2, 1, "x", "a"), (2, 2, "x", "b")]


def greedy(cands, budget, total):
    chosen, used = [], {}
    for cls in sorted({c for c, _, _ in cands}):
        for _, _, k in sorted((x for x in cands if x[0] == cls), key=lambda x: (-x[1], x[2])):
            if len(chosen) < total and used.get(cls, 0) < budget[cls]:
                chosen.append(k)
                used[cls] = used.get(cls, 0) + 1
    return set(chosen)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=25), st.lists(st.integers(0, 4), min_size=3, max_size=3), st.integers(0, 10))
def test_budgets_equal_the_greedy_loop(spark, rows, caps, total):
    cands = [(c, s, k) for k, (c, s) in enumerate(rows)]
    budget = dict(zip("abc", caps, strict=True))
    df = spark.createDataFrame(cands, "cls string, score int, k int").withColumn("g", F.lit(1))
    b = F.when(F.col("cls") == "a", budget["a"]).when(F.col("cls") == "b", budget["b"]).otherwise(budget["c"])
    out = select.budgeted(df, ["k"], ["g"], "cls", [F.col("score").desc(), F.col("k")], b, F.col("cls"), total).collect()
    assert {r.k for r in out if r.selected} == greedy(cands, budget, total)
    assert {r.k for r in out if r.status == "skipped_class_budget"} == {k for c, _, k in cands if budget[c] == 0}


def test_stable_ids(spark):
    old = spark.createDataFrame([("v", "a", 1), ("v", "b", 7), ("v", "gone", 9)], "v string, url string, id int")
    now = spark.createDataFrame([("v", "a", 0), ("v", "b", 1), ("v", "c", 2), ("v", "d", 1), ("w", "e", 0)], "v string, url string, depth int")
    got = {(r.v, r.url): r.id for r in keys.stable_ids(old, now, ["v"], "url", [F.col("depth"), F.col("url")]).collect()}
    assert got == {("v", "a"): 1, ("v", "b"): 7, ("v", "d"): 8, ("v", "c"): 9, ("w", "e"): 1}


def test_gap_serials(spark):
    used = spark.createDataFrame([("A", 1), ("A", 3), ("A", 4), ("B", 2)], "letter string, serial int")
    new = spark.createDataFrame([("A", k) for k in range(4)] + [("B", 9), ("C", 1)], "letter string, k int")
    got = {(r.letter, r.k): r.serial for r in keys.gap_serials(used, new, "letter", [F.col("k")]).collect()}
    assert got == {("A", 0): 2, ("A", 1): 5, ("A", 2): 6, ("A", 3): 7, ("B", 9): 1, ("C", 1): 1}
    assert new.select(keys.designation(F.lit("A"), F.lit(12))).first()[0] == "A.0012"


def test_citations(spark):
    texts = spark.createDataFrame([("resource-0001", "Acme builds radios.\nSecond line."), ("resource-0002", " ".join(["w"] * 80))], "resource_id string, text string")
    c = spark.createDataFrame([("resource-0001", 1, 2), ("resource-0001", 2, 3), ("resource-0009", 1, 1), ("resource-0002", 1, 1)], "resource_id string, line_start int, line_end int")
    got = [(r.snippet, r.problem) for r in cite.hydrate(c, texts, ["resource_id"]).orderBy("resource_id", "line_start").collect()]
    assert got[0] == ("Acme builds radios.\nSecond line.", None) and [p for _, p in got[1:]] == ["out_of_range", "too_long", "missing_text"]
    drifted = cite.drift(spark.createDataFrame([("a", "a"), ("a", "b")], "snippet string, recorded string"))
    assert [(r.drifted, r.rewritten) for r in drifted.collect()] == [(False, True), (True, True)]
    assert [r.rewritten for r in cite.drift(drifted.select("snippet", "recorded"), refuse=True).collect()] == [True, False]


def test_remap(spark):
    c = spark.createDataFrame([("r1", "t", f"resource-000{k}") for k in range(1, 5)], "run string, t string, resource_id string")
    a = spark.createDataFrame([("r1", "resource-0001", "u1"), ("r1", "resource-0002", "u2"), ("r1", "resource-0003", "u3")], "run string, resource_id string, url string")
    b = spark.createDataFrame([("t", "u1", 1), ("t", "u2", 12)], "t string, url string, canonical_id int")
    assert {r.resource_id[-1]: (r.new_id, r.outcome) for r in cite.remap(c, a, b, ["run"], ["t"]).collect()} == {"1": ("resource-0001", "already_canonical"), "2": ("resource-0012", "migrated"), "3": (None, "url_not_canonical"), "4": (None, "unknown_resource")}


def test_request_rules(spark):
    r = spark.createDataFrame([("a", True), ("b", False), ("c", True), ("d", False)], "url string, in_corpus_index boolean")
    i = spark.createDataFrame([("b", "queued"), ("c", "fetched")], "url string, status string")
    assert {x.url: x.violation for x in cite.request_violations(r, i, []).collect()} == {"a": "not_in_index", "b": "unmarked_in_index", "c": "already_fetched"}


def test_rewrite_ids(spark):
    df = spark.createDataFrame([([{"resource_id": "a", "n": 1}, {"resource_id": "b", "n": 2}],)], "e array<struct<resource_id: string, n: int>>")
    got = df.select(cite.rewrite_ids(F.col("e"), F.create_map(F.lit("a"), F.lit("z")))).first()[0]
    assert [(x.resource_id, x.n) for x in got] == [("z", 1), ("b", 2)]


def test_quality(spark):
    ddl = "k int, status string, kind string, text_chars int, url string"
    rows = [(1, "fetched", "html", 900, "/products"), (1, "fetched", "html", 200, "/about"), (2, "failed", "html", 0, "/x"), (3, "fetched", "html", 10, "/x"), (3, "skipped_budget", "html", 0, "/y"), (4, "fetched", "html", 2000, "/products/about"), (4, "failed", "html", 0, "/z")]
    low = F.col("url")
    out = {r.k: r for r in quality.crawl(spark.createDataFrame(rows, ddl), ["k"], 1000, low.contains("product"), low.contains("about")).collect()}
    assert {k: (r.quality, r.reasons) for k, r in out.items()} == {1: ("complete", ""), 2: ("failed", "no_html,little_text,no_product,no_about,failed_pages"), 3: ("review_required", "little_text,no_product,no_about"), 4: ("partial", "failed_pages")}
    assert {r.k: r.quality for r in quality.canonical(spark.createDataFrame(rows, ddl), ["k"]).collect()} == {1: "complete", 2: "failed", 3: "partial", 4: "partial"}


def test_summary_counts_each_dimension(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "s string, p string")
    assert {(r.dimension, r.value): r.n for r in quality.summary(df, "s", "p").collect()} == {("s", "a"): 2, ("s", "b"): 1, ("p", "x"): 2, ("p", None): 1, ("all", None): 3}


def test_news(spark):
    urls = ["https://a.com/newsroom", "https://a.com/stories/1", "https://a.com/stories/2", "https://a.com/stories/3", "https://a.com/x"]
    got = {r.family: r for r in news.families(spark.createDataFrame([("a", u, k) for k, u in enumerate(urls)], "slug string, url string, pos int"), ["slug"]).collect()}
    assert got["stories"].rank == 1 and got["stories"].index_path == "/stories" and not got["stories"].bare_index_seen
    assert got["newsroom"].rank == 2 and got["newsroom"].bare_index_seen and got["newsroom"].items == 1


def test_jsonld(spark):
    html = """<script type="application/ld+json">{"@graph": [{"url": "u1", "datePublished": "2026-04-01T10:00:00Z"}, {"@id": "u2", "dateCreated": "April 2, 2026"}]}</script>
    <script type='application/ld+json'>[{"mainEntityOfPage": {"@id": "u3"}, "datePublished": "2026-04-03"}, {"url": "u1", "datePublished": "2026-04-09"}]</script><script type="application/ld+json">{broken</script>"""
    got = news.jsonld_dates(spark.createDataFrame([(html,)], "html string"), F.lit("2026-05-01").cast("date")).collect()
    assert {r.url: r.date for r in got} == {"u1": date(2026, 4, 9), "u2": date(2026, 4, 2), "u3": date(2026, 4, 3)}


def test_delta_and_bundle(spark):
    items = spark.createDataFrame([("v", "https://a/1/"), ("v", "https://a/2")], "slug string, url string")
    assert [r.is_new for r in news.delta(items, items.limit(1), ["slug", "url"]).orderBy("url").collect()] == [False, True]
    res = spark.createDataFrame([("https://x", "https://a/1", 1, "one"), ("https://a/1", None, 2, "two")], "url string, final_url string, seq int, text string")
    assert [r.section for r in news.bundle(items, res).orderBy("url").collect()] == ["==== https://a/1/ ====\ntwo", "==== https://a/2 ====\nNOT MIRRORED"]


def test_journal(spark):
    df = spark.createDataFrame([("a", k, s, 10.0) for k, s in enumerate("okffok")] + [("b", 0, "f", 5.0)], "g string, k int, s string, cost double")
    out = journal.failure_window(df, ["g"], [F.col("k")], F.col("s") == "f", 2).orderBy("g", "k").collect()
    assert [r.stop for r in out] == [False, False, False, True, False, False, False]
    run = journal.cumulative(df, ["g"], [F.col("k")], F.col("cost"), F.lit(30)).orderBy("g", "k").collect()
    assert [r.capped for r in run] == [False, False, True, True, True, True, False]
    left = journal.remaining_time(df, ["g"], [F.col("k")], "cost", 25).orderBy("g", "k").collect()
    assert [r.left for r in left] == [25.0, 15.0, 5.0, 0.0, 0.0, 0.0, 25.0]


def test_registry(spark):
    ts = lambda d: datetime(2026, 4, d)
    reg = spark.createDataFrame([("a", "complete", ts(1)), ("a", "complete", ts(9)), ("a", "partial", ts(20)), ("b", "complete", ts(1))], "k string, quality_status string, updated_at timestamp")
    got = registry.newest_valid(reg, ["k"], "updated_at", F.lit("2026-04-21").cast("timestamp"), 15.0, F.col("quality_status") == "complete", [])
    assert [(r.k, r.updated_at.day) for r in got.collect()] == [("a", 9)]
    targets = spark.createDataFrame([("a",), ("b",)], "k string")
    assert {r.k: r.disposition for r in registry.disposition(targets, got, ["k"]).collect()} == {"a": "skip", "b": "mirror"}
    assert {r.disposition for r in registry.disposition(targets, got, ["k"], force=True).collect()} == {"mirror"}


def test_categories(spark):
    claims = spark.createDataFrame([(1, "c", False, 0), (1, "b", True, 1), (1, "a", False, 2)], "k int, category string, is_primary boolean, pos int")
    prods = spark.createDataFrame([(1, c, k) for k, c in enumerate("xyyaz")] + [(2, "q", 0)], "k int, category string, pos int")
    assert {r.k: r.categories for r in catalog.categories(claims, prods, ["k"]).collect()} == {1: ["b", "c", "a", "y", "x", "z"], 2: ["q"]}


def test_facets(spark):
    df = spark.createDataFrame([("ndaa_compliant", "United States"), ("blue_uas_cleared", "Norway"), ("unknown", "Norway")], "c string, country string")
    n = lambda *t: facets.apply(df, list(t)).count()
    assert [n(facets.compliance_facet(F.col("c"), f)) for f in ("ndaa", "framework", "cleared", "all")] == [2, 1, 1, 3]
    assert [n(facets.country_facet(F.col("country"), f)) for f in ("us-only", "allied-only", None)] == [1, 2, 3]
    assert {(r.facet, r.value): r.n for r in facets.counts(df, "c", "country").collect()}[("country", "Norway")] == 2


def test_vendor_row(spark):
    from cairn import schemas

    ev = [{"resource_id": "resource-0001", "line_start": 1, "line_end": 1, "url": "https://e", "page_class": "homepage", "snippet": "s"}]
    ans = lambda v: {"value": v, "status": "answered", "evidence": ev}
    profile = {"target_id": "Example_Vendor", "display_name": "Example", "homepage_url": "https://e", "headquarters": ans({"city": "Oslo", "country": "Norway"}), "drone_supply_chain_role": ans("component_supplier"), "ndaa": ans("yes"), "blue_uas": ans("no"), "readiness": ans("unknown"), "tagline": ""}
    cat = {"target_id": "Example_Vendor", "products": [{"name": "P1", "category": "sensors_and_navigation", "readiness": "production", "evidence": ev}, {"name": "P2", "category": None, "readiness": None, "evidence": []}]}
    row = catalog.vendor_rows(spark.createDataFrame([profile], schemas.PROFILE), spark.createDataFrame([cat], schemas.CATALOG)).first()
    assert (row.slug, row.country, row.location, row.compliance, row.readiness, row.n_products) == ("example-vendor", "NO", "Oslo, Norway", "ndaa_compliant", "production", 2)
    assert row.tagline == "Component Supplier with public evidence for P1, P2." and row.products[0].category == "sensors-navigation" and row.products[1].category == "mechanical-subsystems" and row.products[1].source_url is None


@pytest.mark.parametrize("profile", list(vocab.PROFILE_BUDGETS))
def test_budget_tables(spark, profile):
    got = spark.range(1).select(*[select.class_budget(F.lit(c), profile).alias(c) for c in vocab.PAGE_CLASSES]).first()
    assert tuple(got) == vocab.PROFILE_BUDGETS[profile]


def url_loop(rows):
    """One URL's rows, oldest first, as rules: a fetch with its resource wins; before any fetch the newest row speaks."""
    s = dict(rows[0], resource=rows[0]["resource"] if rows[0]["status"] == "fetched" else None)
    for r in rows[1:]:
        if r["status"] == "fetched" and r["resource"]:
            s.update(status="fetched", resource=r["resource"], **{c: r[c] or s[c] for c in ("final_url", "page_class", "kind")})
        elif s["status"] != "fetched":
            s.update(status=r["status"], skip_reason=r["skip_reason"])
        s["depth"], s["in_scope"] = min(s["depth"], r["depth"]), s["in_scope"] or r["in_scope"]
    return s


def test_url_fold_equals_the_loop(spark):
    rng = random.Random(11)
    cols = ["status", "resource", "skip_reason", "final_url", "page_class", "kind", "depth", "in_scope"]
    groups = {}
    for g in range(600):
        groups[g] = []
        for k in range(rng.randrange(1, 6)):
            status = rng.choice(["fetched", "failed", "skipped_budget"])
            some = lambda x: rng.choice([None, f"{x}{k}"])  # noqa: E731, B023
            groups[g].append(dict(zip(cols, [status, some("r") if status == "fetched" else None, some("s"), some("f"), some("p"), some("k"), rng.randrange(4), rng.random() < 0.2], strict=True)))
    flat = [(g, k, *[r[c] for c in cols]) for g, rows in groups.items() for k, r in enumerate(rows)]
    df = spark.createDataFrame(flat, "url int, seq int, status string, resource string, skip_reason string, final_url string, page_class string, kind string, depth int, in_scope boolean")
    got = {r.url: {c: r[c] for c in cols} for r in fold.urls(df, ["url"]).collect()}
    assert got == {g: {c: url_loop(rows)[c] for c in cols} for g, rows in groups.items()}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "a-b", "a.b", "a-", "", "c"]), min_size=0, max_size=4), min_size=1, max_size=6))
def test_common_prefix_equals_the_loop(spark, paths):
    rows = [("/" + "/".join(p),) for p in paths]
    split = [r[0].strip("/").split("/") for r in rows if r[0].strip("/")]
    want, k = [], 0
    while split and all(len(p) > k for p in split) and len({p[k] for p in split}) == 1:
        want.append(split[0][k])
        k += 1
    got = spark.createDataFrame(rows, "p string").agg(news.common_prefix(F.col("p"))).first()[0]
    assert got == ("/" + "/".join(want) if want else "")


def test_common_prefix_of_near_names(spark):
    got = lambda *paths: spark.createDataFrame([(p,) for p in paths], "p string").agg(news.common_prefix(F.col("p"))).first()[0]
    assert got("/news", "/news-room", "/news/a") == "" and got("/en/news/a", "/en/news-b/c", "") == "/en" and got("", "/") == "" and got("/a/b") == "/a/b"


def test_jsonld_nests_and_free_dates(spark):
    html = """<script type="application/ld+json">[[{"@graph": [{"@graph": [[{"url": "deep", "datePublished": "the 5th of May, 2023"}]]}, {"url": "", "@id": "second", "dateCreated": "2023/04/15"}]}]]</script>
    <script type="application/ld+json">{"url": 5, "datePublished": "2023-01-01"}</script>"""
    pages = spark.createDataFrame([("a", 1, html), ("a", 2, html.replace("2023/04/15", "2023/04/16")), ("b", 1, html)], "slug string, n int, html string")
    rows = news.jsonld_dates(pages, F.lit("2024-05-01").cast("date"), key=["slug"], order=F.col("n"), free=True).collect()
    assert {(r.slug, r.url): r.date for r in rows} == {("a", "deep"): date(2023, 5, 5), ("a", "second"): date(2023, 4, 16), ("b", "deep"): date(2023, 5, 5), ("b", "second"): date(2023, 4, 15)}
    strict = news.jsonld_dates(pages, F.lit("2024-05-01").cast("date"), key=["slug"], order=F.col("n"))
    assert {r.url for r in strict.collect()} == {"second"}


def test_newsletter_state(spark):
    state = spark.createDataFrame([("a", ["u1"], "t0", 3, {"u1": "t0"}), ("b", ["x"], "t0", 1, {"x": "t0"})], "slug string, seen_urls array<string>, last_polled_at string, polls_completed int, first_seen map<string,string>")
    items = spark.createDataFrame([("a", "u1", date(2024, 1, 1)), ("a", "u2", date(2024, 1, 2)), ("c", "z", date(2024, 1, 3))], "slug string, url string, date date")
    after, rendered = news.merge_state(state.drop("first_seen"), items, F.lit("t1"))
    assert {(r.url, r.is_new, r.first_seen_at, r.place) for r in rendered.collect()} == {("u1", False, "t1", 2), ("u2", True, "t1", 1), ("z", True, "t1", 1)}
    assert {(r.slug, tuple(r.seen_urls), r.last_polled_at, r.polls_completed) for r in after.collect()} == {("a", ("u1", "u2"), "t1", 4), ("b", ("x",), "t0", 1), ("c", ("z",), "t1", 1)}
    after, rendered = news.merge_state(state, items, F.lit("t1"), strict=True)
    assert {(r.url, r.first_seen_at) for r in rendered.collect()} == {("u1", "t0"), ("u2", "t1"), ("z", "t1")}
    assert {r.slug: r.first_seen for r in after.collect()} == {"a": {"u1": "t0", "u2": "t1"}, "b": {"x": "t0"}, "c": {"z": "t1"}}


def test_gap_serials_equal_the_loop(spark):
    import random

    rng = random.Random(1)
    used = [(g, rng.randrange(1, 30)) for g in "abc" for _ in range(rng.randrange(0, 20))]
    new = [(rng.choice("abcd"), k) for k in range(60)]
    want, taken = {}, {g: {s for h, s in used if h == g} for g in "abcd"}
    for g, k in new:
        n = 1
        while n in taken[g]:
            n += 1
        taken[g].add(n)
        want[k] = n
    got = keys.gap_serials(spark.createDataFrame(used, "g string, serial int"), spark.createDataFrame(new, "g string, k int"), "g", [F.col("k")])
    assert {r.k: r.serial for r in got.collect()} == want and set(got.columns) == {"g", "k", "serial"}


def test_small_reports(spark):
    rows = spark.createDataFrame([("s1", "home", True, None), ("s1", "news", False, "late"), ("s2", "news", True, "x")], "slug string, page_class string, ok boolean, reason string")
    assert [(r.page_class, r.n) for r in quality.page_class_counts(rows).collect()] == [("home", 1), ("news", 2)]
    assert [(r.outcome, r.reason) for r in quality.split_outcomes(rows, F.col("ok")).orderBy("slug", "page_class").collect()] == [("succeeded", None), ("failed", "late"), ("succeeded", None)]
    files = spark.createDataFrame([("/w/vendors/a/x.json", 3), ("/w/vendors/a/y.json", 4), ("/w/vendors/b/x.json", 5)], "path string, length long")
    assert quality.snapshot(files).first() == (3, 2, 12)
    index = spark.createDataFrame([("u1", "fetched", "r", None, None), ("u2", "fetched", None, "a", 1), ("u3", None, "r", "a", 1)], "url string, status string, resource_id string, page_class string, depth int")
    assert [(r.url, r.page_class, r.depth) for r in quality.fetched(index).collect()] == [("u1", "other", 0)] and sorted(r.url for r in quality.not_fetched(index).collect()) == ["u2", "u3"]
    items = spark.createDataFrame([("a", "s", True, date(2024, 1, 1)), ("a", "s", False, None), ("b", "t", True, None)], "slug string, source_url string, is_new boolean, date date")
    assert news.poll_counters(items, items.limit(1)).first() == (2, 2, 3, 2, 2, 1)
    assert [r.url for r in select.index_order(spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "url string, depth int")).collect()] == ["c", "a", "b"]


def test_small_columns(spark):
    one = spark.range(1)
    get = lambda *c: one.select(*c).first()
    assert get(keys.rewritten_name(F.lit("0003-a-b.txt"), F.lit(12)))[0] == "0012-a-b.txt"
    assert get(select.ordered_distinct(F.array(*map(F.lit, "baba")), 1))[0] == ["b"] and get(select.ordered_distinct(F.array(*map(F.lit, "baba"))))[0] == ["b", "a"]
    assert get(select.map_limit(F.lit(30), F.lit(5)), select.map_limit(F.lit(3000), F.lit(5)), select.map_limit(F.lit(7), F.lit(0)))[:] == (150, 5000, 7)
    assert get(facets.member(F.array(F.lit("a"), F.lit("b")), "a"), facets.member(F.array(F.lit("a")), "z", ("b", "a")), facets.member(F.array(F.lit("a")), "z"))[:] == (True, True, False)
    e = F.array(F.struct(F.lit("s").alias("snippet"), F.lit("u").alias("url"), F.lit("p").alias("page_class")))
    assert get(catalog.first_evidence(e))[0] == ("SUPPORTING EVIDENCE", "s", "u", "p") and get(catalog.first_evidence(F.slice(e, 2, 1)))[0] is None
    r = F.array(F.struct(F.array(F.lit("ndaa")).alias("expected_evidence")))
    assert get(cite.requested(F.lit("needs_more_fetches"), "ndaa", r), cite.requested(F.lit("needs_more_fetches"), "role", r), cite.requested(F.lit("answered"), "role", r))[:] == (True, False, True)
    assert get(registry.policy_hash(F.lit(1).alias("a"), F.lit("x").alias("b")))[0] == __import__("hashlib").sha256(b'{"a":1,"b":"x"}').hexdigest()


def test_priorities_and_profiles(spark):
    subs = spark.createDataFrame([("t", ["a", "b", "c"], "n")], "target_id string, products array<string>, notes string")
    about = spark.createDataFrame([("t", "r", "d", "h", "c", "m", "extra")], "target_id string, run_id string, display_name string, homepage_url string, corpus_root string, meta string, other string")
    row = documents.priorities(subs, about, 2).first()
    assert (row.products, row.agent_listed, row.max_products, row.status, row.meta) == (["a", "b"], 3, 2, "complete", "m")
    assert documents.priorities(subs, about, 0).first().products == ["a", "b", "c"]
    full = subs.select("target_id", *[F.lit(x).alias(x) for x in documents.PROFILE_FIELDS])
    assert documents.profiles(full, about).columns == ["target_id", "run_id", "display_name", "homepage_url", "corpus_root", *documents.PROFILE_FIELDS, "meta"]
    assert documents.catalogs(full, about).first().status == "status"


def test_running_sums_over_ranges(spark):
    """One group holds most rows, in many ranges; null groups, null values and ties in all but the last order column."""
    from pyspark.sql import Window

    from cairn.operators import ordered

    rng = random.Random(9)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.randrange(50), k, rng.choice([1, 2, 5, None])) for k in range(5000)]
    df = spark.createDataFrame(rows, "g string, a int, nr int, v long").repartition(7)
    order = [F.desc("a"), F.col("nr")]
    got = ordered.running(df, ["g"], order, {"total": F.col("v"), "n": F.lit(1).cast("long")})
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("total", F.coalesce(F.sum("v").over(w), F.lit(0))).withColumn("n", F.count("*").over(w))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert ordered.rank(df.limit(0), ["g"], order).collect() == [] and ordered.rank(df, ["g", "a"], [F.col("nr")]).where("rank = 1").count() == df.select("g", "a").distinct().count()


def test_hot_letter_is_many_ranges(spark):
    from cairn.operators import ordered

    df = spark.range(20_000).select(F.lit("A").alias("letter"), F.col("id"))
    got = ordered.rank(df, ["letter"], [F.desc("id")])
    assert got.where("rank + id <> 20000").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and got.select("letter").distinct().count() == 1


def test_stored_messages(spark):
    df = spark.createDataFrame([("x" * 3000, True), ("x" * 3000, False), ("é" * 600, None), ("short", True), (None, False)], "m string, known boolean")
    assert [r.n for r in df.select(F.length(journal.stored_message(F.col("m"), F.col("known"))).alias("n")).collect()] == [2000, 500, 500, 5, None]


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("run"), (F.col("id") * 7 % 40_000).alias("v"))
    by_run = quality.sketches(df, ["run"], "v")
    got = quality.distinct_of(by_run.withColumn("all", F.lit(1)), ["all"]).first().distinct
    exact = df.select("v").distinct().count()
    assert abs(got - exact) <= 0.02 * exact and by_run.count() == 6


def test_entries_take_the_last_resource_of_their_corpus(spark):
    e = spark.createDataFrame([("t", "r1", "u1", "resource-0001"), ("t", "r1", "u2", "resource-0009"), ("t", "r2", "u1", "resource-0001"), ("t", "r1", "u3", None)], "target_id string, run_id string, url string, resource_id string")
    r = spark.createDataFrame([("t", "r1", "resource-0001", 1, "old"), ("t", "r1", "resource-0001", 2, "new"), ("t", "r3", "resource-0001", 3, "other"), ("t", "r1", None, 4, "none")], "target_id string, run_id string, resource_id string, pos int, text_path string")
    got = fold.with_resources(e, r, ["target_id", "run_id"]).collect()
    assert {(x.run_id, x.url): x.resource and x.resource.text_path for x in got} == {("r1", "u1"): "new", ("r1", "u2"): None, ("r2", "u1"): None, ("r1", "u3"): None}
