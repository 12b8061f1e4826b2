"""URL functions as Column expressions; every one stays inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as v
from .trims import lstrip, rstrip, strip

_HEAD = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*"


def path(url: Column) -> Column:
    return F.regexp_extract(url, _HEAD + r"([^?#]*)", 1)


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def apex(h: Column) -> Column:
    return F.regexp_replace(h, r"^www\.", "")


def normalize(url: Column) -> Column:
    """Without fragment, and without trailing slashes unless the path is a lone slash."""
    bare = F.regexp_replace(url, r"#.*$", "")
    return F.when(bare.endswith("/") & (path(bare) != "/"), rstrip("/", bare)).otherwise(bare)


def slash_key(url: Column) -> Column:
    """Key under which URLs that differ in trailing slashes are one."""
    return rstrip("/", url)


def extension(url: Column) -> Column:
    """Lower-case suffix of the last path segment; names that begin with the dot have none."""
    return F.lower(F.regexp_extract(rstrip("/", path(url)), r"[^/.][^/]*(\.[^./]+)$", 1))


def resource_kind(url: Column, content_type: Column | None = None) -> Column:
    ext = extension(url)
    kind = F.lit("") if content_type is None else F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    return (
        F.when(ext.isin(*v.DOCUMENT_EXTENSIONS), "document").when(ext.isin(*v.STATIC_EXTENSIONS), "asset")
        .when(kind == "application/pdf", "document").when(kind.isin("text/html", "application/xhtml+xml", ""), "html").otherwise("other")
    )


def in_scope(url: Column, home: Column, subdomains: bool = False) -> Column:
    """Same site: equal hosts, one the www form of the other, or with ``subdomains`` a host below the home's."""
    h, g = host(url), host(home)
    same = (h == g) | (h == F.concat(F.lit("www."), g)) | (g == F.concat(F.lit("www."), h))
    if subdomains:
        same = same | apex(h).endswith(F.concat(F.lit("."), apex(g)))
    return scheme(url).isin("http", "https") & same


def associated_document(url: Column, hosts: Column) -> Column:
    """A document on one of the allowed hosts or below one."""
    h = host(url)
    return (resource_kind(url) == "document") & F.exists(hosts, lambda a: (h == F.lower(a)) | h.endswith(F.concat(F.lit("."), F.lower(a))))


def fetchable(url: Column, home: Column, hosts: Column, subdomains: bool = False) -> Column:
    return in_scope(url, home, subdomains) | associated_document(url, hosts)


def terms(url: Column) -> Column:
    """Lower-case path segments with hyphens for underscores."""
    return F.filter(F.split(F.replace(F.lower(strip("/", path(url))), F.lit("_"), F.lit("-")), "/"), lambda x: x != "")


def _any(value: Column, tokens: tuple[str, ...]) -> Column:
    """One of the tokens occurs anywhere."""
    return value.rlike("|".join(t.replace(".", r"\.") for t in tokens))


def _token(value: Column, tokens: tuple[str, ...]) -> Column:
    """One of the tokens occurs between characters that are neither letters nor digits."""
    return value.rlike("(?:^|[^a-z0-9])(?:" + "|".join(t.replace(" ", "[- ]") for t in tokens) + ")(?:[^a-z0-9]|$)")


def classify_page(url: Column, home: Column) -> Column:
    """Class of a page by its URL: the first rule that applies, from documents down to other."""
    p = F.lower(strip("/", path(url)))
    t = terms(url)
    leaf = F.coalesce(F.try_element_at(t, F.lit(-1)), F.lit(""))
    hyphens = F.length(F.substring_index(p, "/", -1)) - F.length(F.replace(F.substring_index(p, "/", -1), F.lit("-"), F.lit("")))
    company = F.arrays_overlap(t, F.array(*[F.lit(x) for x in v.COMPANY_SEGMENTS]))
    return (
        F.when(resource_kind(url) == "document", "document").when((normalize(url) == normalize(home)) | (p == ""), "homepage")
        .when(_any(p, v.CAREER_TOKENS), "career").when(_any(p, v.CONTACT_TOKENS), "contact").when(_any(p, v.LEGAL_TOKENS) | company, "company")
        .when(_token(p, v.COMPLIANCE_TOKENS) | _token(p, v.GOVERNMENT_TOKENS), "compliance")
        .when(leaf.isin(*v.PRODUCT_SLUGS) | leaf.endswith("product-page"), "product").when(_any(p, v.NEWS_TOKENS) | (hyphens >= 5), "news")
        .when(_token(p, v.CLEAR_PRODUCT_TOKENS), "product").when(_token(p, v.CAPABILITY_TOKENS), "capability")
        .when(_any(leaf, v.LEAF_PRODUCT_TOKENS), "product").otherwise("other")
    )


def page_score(url: Column, categories: tuple[str, ...] = ()) -> Column:
    """Additive score of a URL: shallow, telling paths first."""
    low, p = F.lower(url), path(url)
    depth = F.size(F.filter(F.split(p, "/"), lambda x: x != ""))
    leaf = F.substring_index(strip("/", p), "/", -1)
    hyphens = F.length(leaf) - F.length(F.replace(leaf, F.lit("-"), F.lit("")))
    points = [
        (depth <= 1, 20), (hyphens >= 5, -35), (_any(low, v.PRODUCT_TOKENS), 70), (_any(low, v.COMPLIANCE_TOKENS), 55), (_any(low, v.ABOUT_TOKENS), 35),
        (_any(low, v.LOW_VALUE_TOKENS), -50), (resource_kind(url) == "document", 20),
    ]
    for c in categories:
        for term in v.CATEGORY_QUERY_TERMS.get(c, ()):
            points.append((low.contains(term.lower().replace(" ", "-")) | low.contains(term.lower().replace(" ", "")), 25))
    total = reduce(lambda a, b: a + b, [F.when(test, n).otherwise(0) for test, n in points])
    return total - F.least(depth, F.lit(8))


def normalize_homepage(url: Column) -> Column:
    """Lower-case scheme and host, no trailing slash; https where no scheme is given."""
    full = F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.\\-]*://"), url).otherwise(F.concat(F.lit("https://"), url))
    return rstrip("/", F.concat(scheme(full), F.lit("://"), F.lower(netloc(full)), path(full)))


def rejected_path(p: Column) -> Column:
    """Paths that never lead to news: localised sites, PDFs, feed identifiers, resource pages."""
    low = F.lower(p)
    return low.rlike(f"^/(?:{'|'.join(v.LOCALES)})/") | low.endswith(".pdf") | low.rlike(r"/(feed|activity)/.*urn[:\-]") | low.startswith("/resources/") | (low == "/resources")


def normalize_path(p: Column) -> Column:
    """The path by which pages are put into families: no category prefix, extension, page number or trailing slash, in this order."""
    low = F.regexp_replace(F.lower(p), r"^/category/", "/")
    low = F.regexp_replace(low, r"\.(?:html|htm|php|aspx|jsp)$", "")
    low = F.regexp_replace(low, r"/(?:page|p)/\d+/?$", "")
    low = F.regexp_replace(low, r"_bc_\d+$|_page_\d+$", "")
    return F.regexp_replace(low, r"^(.+)/$", "$1")


def _family(p: Column, end: str) -> Column:
    rule = lambda x: p.rlike(f"(?:^|/){x}{end}")
    return reduce(lambda c, f: c.when(rule(f[1]), f[0]), v.FAMILIES[1:], F.when(rule(v.FAMILIES[0][1]), v.FAMILIES[0][0]))


def classify_path(p: Column) -> Column:
    """News family of a path, the first in rank; null if none or rejected."""
    return F.when(~rejected_path(p), _family(normalize_path(p), "(?:/|$)"))


def family_rank(family: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(f) for f, _ in v.FAMILIES]), family), F.lit(0).cast("long")), F.lit(99).cast("long")).cast("int")


def bare_index(p: Column, family: Column) -> Column:
    """The path ends at the marker of its family."""
    n = normalize_path(p)
    return reduce(lambda a, b: a | b, [(family == f) & n.rlike(f"(?:^|/){x}/?$") for f, x in v.FAMILIES])


def family_prefix(source: Column) -> Column:
    """Path prefix with trailing slash below which a source's items lie."""
    p = path(source)
    return F.when(p.endswith("/"), p).otherwise(F.concat(p, F.lit("/")))


def is_item_of(item: Column, source: Column) -> Column:
    """The item lies below the source's path on the same host, and is neither the index nor an archive page."""
    family, p = family_prefix(source), path(item)
    first = F.split_part(F.substr(p, F.length(family) + 1), F.lit("/"), F.lit(1))
    return (netloc(item) == netloc(source)) & p.startswith(family) & (rstrip("/", p) != rstrip("/", family)) & ~first.isin(*v.ARCHIVE_SEGMENTS)


def resolve(href: Column, base: Column) -> Column:
    """Absolute form of plain references: full URLs, //host, /path and relative paths without dots; null for script, mail, phone and fragment links.

    References with dot segments need full resolution, which ``cairn.functions.udfs.urljoin_column`` gives.
    """
    h = F.trim(href)
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    full = (
        F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.\\-]*:"), h).when(h.startswith("//"), F.concat(scheme(base), F.lit(":"), h)).when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(root, path(base), h)).otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), h))
    )
    out = F.regexp_replace(full, r"#.*$", "")
    return F.when((h != "") & ~h.rlike("^(?:javascript:|mailto:|tel:|#)") & scheme(out).isin("http", "https"), out)


def join_homepage(home: Column, p: Column) -> Column:
    s, n = scheme(home), netloc(home)
    authority = F.when(n == "", rstrip("/", F.regexp_replace(home, "^https?://", ""))).otherwise(n)
    return F.concat(F.when(s.isin("http", "https"), s).otherwise("https"), F.lit("://"), authority, F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))


def split_store_uri(uri: Column) -> Column:
    """(bucket, key) of a store URI such as s3://bucket/key."""
    return F.struct(netloc(uri).alias("bucket"), lstrip("/", path(uri)).alias("key"))
