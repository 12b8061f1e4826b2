"""The few functions that need Python, as Arrow batches: HTML parsing, URL resolution, Unicode folding, fuzzy dates."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from datetime import date
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlparse

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

SKIPPED = {"script", "style", "noscript", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Corporate suffixes, in any case and with or without a final dot; one is dropped.
SUFFIXES = "inc incorporated llc l.l.c. ltd limited corp corporation co company gmbh sa s.a. plc ag bv b.v.".split()
_SUFFIX = re.compile(rf"\b(?:{'|'.join(map(re.escape, SUFFIXES))})\.?$", re.IGNORECASE)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs) -> None:
        self.skip += tag in SKIPPED

    def handle_endtag(self, tag) -> None:
        self.skip -= tag in SKIPPED and self.skip > 0

    def handle_data(self, data) -> None:
        if not self.skip:
            self.out += [x.strip() for x in data.split("\n")]


def text_of(html: str | None) -> str | None:
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    return "\n".join(x for x in p.out if x)


@F.pandas_udf(StringType())
def html_to_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text nodes of a page, one a line, without script, style, noscript and svg."""
    for html in batches:
        yield html.map(text_of, na_action="ignore")


def resolve_one(href: str | None, base: str | None) -> str | None:
    if not href or not (h := href.strip()) or h.startswith(("javascript:", "mailto:", "tel:", "#")):
        return None
    try:
        full, _ = urldefrag(urljoin(base or "", h))
        return full if urlparse(full).scheme in ("http", "https") else None
    except ValueError:
        return None


@F.pandas_udf(StringType())
def urljoin_column(href: pd.Series, base: pd.Series) -> pd.Series:
    """Absolute URL of a reference, without fragment; null where it leads to no page."""
    return pd.Series([resolve_one(h, b) for h, b in zip(href, base, strict=True)], dtype=object)


def slug_of(name: str | None) -> str:
    """The suffix is one of the name as written, so ``Foo S.A`` and ``Foo Inc!`` keep theirs."""
    bare = re.sub(r"\s*\([^)]*\)\s*$", "", (name or "").strip()).strip()
    folded = _SUFFIX.sub("", unicodedata.normalize("NFKD", bare).encode("ascii", "ignore").decode())
    return re.sub(r"[^a-z0-9]+", "-", folded.lower()).strip("-")[:60].rstrip("-") or "unnamed"


@F.pandas_udf(StringType())
def ascii_slug(names: pd.Series) -> pd.Series:
    """Slug of a name: no trailing parenthesis, accents folded, one corporate suffix dropped."""
    return names.map(slug_of)


@F.pandas_udf(DateType())
def fuzzy_date(texts: pd.Series) -> pd.Series:
    """A date anywhere in free text, where the strict forms found none; null where nothing reads as one."""
    from dateutil import parser

    def one(t) -> date | None:
        try:
            return parser.parse(t, fuzzy=True).date() if isinstance(t, str) and t.strip() else None
        except (ValueError, OverflowError, TypeError):
            return None

    return pd.Series([one(t) for t in texts], dtype=object)


@F.pandas_udf(StringType())
def pdf_text(contents: pd.Series) -> pd.Series:
    """Text of PDF files by page; null where one cannot be read or the library is missing."""
    import io

    try:
        from pypdf import PdfReader
    except ModuleNotFoundError:
        return pd.Series([None] * len(contents), dtype=object)

    def one(raw) -> str | None:
        try:
            parts = [(page.extract_text() or "").strip() for page in PdfReader(io.BytesIO(raw)).pages]
        except Exception:  # broken files are many and of all kinds
            return None
        return "\n\n".join(p for p in parts if p) or None

    return pd.Series([one(c) for c in contents], dtype=object)


class _Node:
    __slots__ = ("attrs", "children", "parent", "tag", "text")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def texts(self) -> str:
        out, todo = [], [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in SKIPPED:
                todo += reversed(n.children)
        return " ".join("".join(out).split())

    def find(self, tags: set[str]) -> _Node | None:
        todo = list(reversed(self.children))
        while todo:
            n = todo.pop()
            if isinstance(n, _Node):
                if n.tag in tags:
                    return n
                todo += reversed(n.children)
        return None


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.all: list[_Node] = []

    def handle_starttag(self, tag, attrs) -> None:
        node = _Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        self.all.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag) -> None:
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data) -> None:
        self.at.children.append(data)


def links_of(html: str | None, base: str) -> list[tuple[str, str]]:
    """(url, title) of every link of a page; the title is the link's text, the nearest heading up to five levels above, or its title attribute."""
    from .vocab import GENERIC_LINK_TEXT

    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    out = []
    for a in tree.all:
        if a.tag != "a" or not (url := resolve_one(a.attrs.get("href"), base)):
            continue
        title, up = a.texts(), a.parent
        if len(title) <= 2 or title.lower() in GENERIC_LINK_TEXT:
            title = ""
            for _ in range(5):
                if up is None or title:
                    break
                h = up.find({"h1", "h2", "h3", "h4"})
                title, up = (h.texts() if h else ""), up.parent
        out.append((url, (title or (a.attrs.get("title") or "").strip())[:240]))
    return out


def items_of(html: str | None, source: str, max_repeats: int = 3) -> list[dict]:
    """News items of an index page: links around time elements first, all links below the source's path if that gives none.

    A URL that occurs more often than ``max_repeats`` times is navigation and dropped; of the rest the first stays.
    """
    from .vocab import ARCHIVE_SEGMENTS

    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    src = urlparse(source)
    family = src.path if src.path.endswith("/") else src.path + "/"

    def below(url: str) -> bool:
        u = urlparse(url)
        rest = u.path[len(family) :]
        return u.netloc == src.netloc and u.path.startswith(family) and u.path.rstrip("/") != family.rstrip("/") and rest.split("/")[0] not in ARCHIVE_SEGMENTS

    titles: dict[str, str] = {}
    count: dict[str, int] = {}
    for url, title in links_of(html, source):
        if below(url):
            count[url] = count.get(url, 0) + 1
            titles.setdefault(url, title)
    timed: dict[str, str] = {}
    for t in tree.all:
        if t.tag != "time":
            continue
        up = t.parent
        for _ in range(6):
            if up is None or up.tag in ("", "body", "html"):
                break
            a = up if up.tag == "a" else up.find({"a"})
            url = resolve_one(a.attrs.get("href"), source) if a is not None else None
            if url and below(url):
                timed.setdefault(url, t.attrs.get("datetime") or t.texts())
                break
            up = up.parent
    kept = [u for u in timed if count.get(u, 0) <= max_repeats] or [u for u in titles if count[u] <= max_repeats]
    return [{"url": u, "title": titles.get(u, ""), "date_text": timed.get(u)} for u in kept]


@F.udtf(returnType=StructType([StructField(c, StringType()) for c in ("url", "title", "date_text")]))
class NewsItems:
    """Lateral table function: the items of one index page."""

    def eval(self, html: str, source: str):
        for x in items_of(html, source):
            yield x["url"], x["title"], x["date_text"]
