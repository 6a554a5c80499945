"""Article text from raw pages: one parse per page, everything else in built-in functions."""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from presslake.functions.html import page_date
from presslake.functions.language import detect_language
from presslake.functions.text import clean_title, has_body, skip_url, strip, truncate, valid_title

# Executors need not have the package installed to run the parser.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Containers of an article's text, in order of preference.
BODY = ["article", ".article", ".content", ".story", "main", "#content", ".post-content", ".news-content"]
BODY_FIRST = BODY[:7]
LEAD = ["article", ".article-content", ".story-content", "#story-content", ".post-content"]
# Where pages state their date.
META_DATES = [
    ("property", "article:published_time"), ("property", "article:published"), ("name", "publishdate"),
    ("name", "publication_date"), ("name", "date"), ("name", "article:published_time"),
    ("property", "og:published_time"), ("property", "og:updated_time"),
    ("itemprop", "datePublished"), ("itemprop", "dateCreated"),
]
DATE_ELEMENTS = [
    ".publish-date", ".article-date", ".date", ".timestamp", "*date", "*time",
    ".byline-date", ".story-date", ".post-date", "#publish-date",
]
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = {"script", "style", "template"}

LISTS = {"h1", "meta_dates", "date_texts"}
FIELDS = [
    "h1", "title", "og_title", "description", "first_paragraph", "lead", "body", "body_first", "body_longest",
    "meta_dates", "time_date", "date_texts", "jsonld", "error",
]
PARTS = T.StructType(
    [T.StructField(f, T.ArrayType(T.StringType()) if f in LISTS else T.StringType()) for f in FIELDS]
)
_ARROW = pa.struct([(f, pa.list_(pa.string()) if f in LISTS else pa.string()) for f in FIELDS])
#: A worker holds the parsed parts of so many pages, or characters of markup, at once; a batch may have far more of both.
PAGES, SLICE_CHARS = 200, 4_000_000


class _Page(HTMLParser):
    """Flat list of elements; each covers a range of text pieces and a range of later elements.

    An end tag closes the innermost open element of its name together with all inside it; an element
    that is never closed reaches to the end of its parent.
    """

    def __init__(self, html: str):
        super().__init__()
        self.elements, self.pieces, self.open, self.data, self.jsonld = [], [], [], [], None
        self.by_tag: dict[str, list[int]] = {}
        self.feed(html)
        self.close()
        self._flush()
        self._close_from(0)
        self.lengths = [0, *accumulate(map(len, self.pieces))]

    def parse_marked_section(self, i, report=1):
        """``<![...]>`` in a page is a comment up to the first ``>``, whatever stands in it."""
        end = self.rawdata.find(">", i)
        if end < 0:
            return -1
        self._flush()
        return end + 1

    def _flush(self):
        text = "".join(self.data)
        self.data = []
        if not text:
            return
        top = self.elements[self.open[-1]] if self.open else None
        if top and top["tag"] == "script" and top["attrs"].get("type") == "application/ld+json" and self.jsonld is None:
            self.jsonld = text
        if not any(self.elements[i]["tag"] in HIDDEN for i in self.open):
            if not text.strip(" \n\t\f\r"):
                text = "\n" if "\n" in text else " "
            self.pieces.append(text)

    def _close_from(self, depth: int):
        for i in self.open[depth:]:
            self.elements[i].update(text_end=len(self.pieces), last=len(self.elements))
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        self._flush()
        values = {k: v or "" for k, v in reversed(attrs)}
        here = len(self.pieces)
        at = len(self.elements)
        self.by_tag.setdefault(tag, []).append(at)
        self.elements.append({"tag": tag, "attrs": values, "text_start": here, "text_end": here, "index": at, "last": at + 1})
        if tag not in VOID:
            self.open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.elements[self.open[depth]]["tag"] == tag:
                self._close_from(depth)
                return

    def handle_data(self, data):
        self.data.append(data)

    def handle_comment(self, data):
        self._flush()

    def text(self, e) -> str:
        return "".join(self.pieces[e["text_start"]:e["text_end"]])

    def lines(self, e) -> str:
        stripped = (p.strip() for p in self.pieces[e["text_start"]:e["text_end"]])
        return "\n".join(p for p in stripped if p)

    def size(self, e) -> int:
        return self.lengths[e["text_end"]] - self.lengths[e["text_start"]]

    def _range(self, tag, inside) -> tuple[list[int], int, int]:
        places = self.by_tag.get(tag, [])
        if inside is None:
            return places, 0, len(places)
        return places, bisect_right(places, inside["index"]), bisect_left(places, inside["last"])

    def find(self, tag, inside=None):
        places, first, last = self._range(tag, inside)
        return [self.elements[i] for i in places[first:last]]

    def count(self, tag, inside) -> int:
        _, first, last = self._range(tag, inside)
        return last - first

    def select(self, selector):
        kind, name = selector[0], selector[1:]
        if kind == ".":
            return [e for e in self.elements if name in e["attrs"].get("class", "").split()]
        if kind == "#":
            return [e for e in self.elements if e["attrs"].get("id") == name]
        if kind == "*":
            return [e for e in self.elements if name in e["attrs"].get("class", "")]
        return [e for e in self.elements if e["tag"] == selector]

    def paragraphs(self, least, inside=None) -> list[str]:
        texts = (self.text(p).strip() for p in self.find("p", inside))
        return [t for t in texts if len(t) > least]


def _container_text(page: _Page, container) -> str:
    if page.find("p", container):
        return "\n".join(page.paragraphs(20, container))
    return page.lines(container)


def _body(page: _Page) -> str:
    """Text of the largest container, or of the largest of the three divs with most paragraphs."""
    candidates = [e for s in BODY for e in page.select(s)]
    if not candidates:
        counted = [(page.count("p", d), d) for d in page.find("div")]
        rich = sorted((c for c in counted if c[0] >= 3), key=lambda c: -c[0])
        candidates = [d for _, d in rich[:3]]
    text = _container_text(page, max(candidates, key=page.size)) if candidates else ""
    return text if len(text) >= 200 else "\n".join(page.paragraphs(30))


def _body_first(page: _Page) -> str:
    """Text of the first container that occurs; all longer paragraphs when that is short."""
    found = next((es[0] for es in map(page.select, BODY_FIRST) if es), None)
    text = page.lines(found) if found else ""
    return text if len(text) >= 200 else ("\n".join(page.paragraphs(30)) or text)


def _body_longest(page: _Page) -> str:
    """Text of the longest element of the first kind of container that occurs."""
    found = next((es for es in map(page.select, BODY) if es), None)
    return _container_text(page, max(found, key=page.size)) if found else ""


def _lead(page: _Page) -> str | None:
    lead = None
    for selector in LEAD:
        found = page.select(selector)
        if found:
            lead = " ".join(page.text(p).strip() for p in page.find("p", found[0])[:3])
            if len(lead) > 100:
                break
    return lead


def _parts(html: str | None) -> dict:
    page = _Page(html or "")
    metas = page.find("meta")

    def meta(attribute, value):
        first = next((m for m in metas if m["attrs"].get(attribute) == value), None)
        return (first["attrs"].get("content") or None) if first else None

    first_text = lambda elements: page.text(elements[0]).strip() if elements else None
    times = page.find("time")
    body = _body(page)
    # The later strategies matter only when the first gives too little.
    more = len(body) <= 200
    return {
        "h1": [page.text(e).strip() for e in page.find("h1")],
        "title": first_text(page.find("title")),
        "og_title": meta("property", "og:title"),
        "description": meta("name", "description"),
        "first_paragraph": next(iter(page.paragraphs(50)), None),
        "lead": _lead(page),
        "body": body,
        "body_first": _body_first(page) if more else None,
        "body_longest": _body_longest(page) if more else None,
        "meta_dates": [meta(a, v) for a, v in META_DATES],
        "time_date": (times[0]["attrs"].get("datetime") or None) if times else None,
        "date_texts": [first_text(page.select(s)) for s in DATE_ELEMENTS],
        "jsonld": page.jsonld,
        "error": None,
    }


def _parts_or_error(html: str | None) -> dict:
    """A page that cannot be parsed has nothing but its ``error``; it must not end the job."""
    try:
        return _parts(html)
    except (AssertionError, ValueError, RecursionError, IndexError) as problem:
        return dict.fromkeys(FIELDS) | {"error": f"{type(problem).__name__}: {problem}"}


def _slices(html: pa.Array) -> Iterator[list[str | None]]:
    """Pages in order, as many at a time as have SLICE_CHARS characters together, PAGES at most."""
    some, chars = [], 0
    for page in html:
        some.append(page.as_py())
        chars += len(some[-1] or "")
        if len(some) == PAGES or chars >= SLICE_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


@F.arrow_udf(PARTS)
def _parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for html in batches:
        for some in _slices(html):
            yield pa.array([_parts_or_error(h) for h in some], _ARROW)


# Not deterministic for the optimizer: it then neither repeats the parse nor moves it below a join.
_parse = _parse.asNondeterministic()


def parse_pages(pages: DataFrame) -> DataFrame:
    """``pages`` plus a struct ``parts``; only the markup column travels to Python."""
    return pages.withColumn("parts", _parse(F.col("html")))


def title_of(parts: Column) -> Column:
    title = F.coalesce(
        F.try_element_at(F.filter(parts["h1"], lambda t: valid_title(t)), F.lit(1)),
        F.nullif(strip(parts["og_title"]), F.lit("")),
        clean_title(parts["title"]),
    )
    return F.when(F.length(title) >= 10, title)


def simple_title_of(parts: Column) -> Column:
    return F.coalesce(F.try_element_at(parts["h1"], F.lit(1)), parts["title"])


def summary_of(parts: Column) -> Column:
    """Description, else the first paragraph above 50 characters, cut to 300; else empty."""
    return truncate(F.coalesce(strip(parts["description"]), parts["first_paragraph"], F.lit("")), 300)


def longer_summary_of(parts: Column) -> Column:
    """The summary, replaced by the lead paragraphs when it is below 100 characters and there are any."""
    summary = summary_of(parts)
    return F.when(F.length(summary) < 100, F.coalesce(parts["lead"], summary)).otherwise(summary)


def text_of(parts: Column) -> Column:
    """First strategy with more than 200 characters on a page that has a title; NULL when all fail."""
    long = lambda c: F.when(has_body(c), c)
    text = F.coalesce(long(parts["body"]), long(parts["body_first"]), long(parts["body_longest"]))
    return F.when(F.coalesce(simple_title_of(parts), F.lit("")) != "", text)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``final_url, page_title, text, language``; a page without an article keeps NULLs.

    Skipped addresses are not parsed.
    """
    wanted = F.when(~skip_url(F.col("url")), F.col("html"))
    parsed = parse_pages(pages.withColumn("html", wanted))
    text = text_of(F.col("parts"))
    out = parsed.withColumn("text", text)
    found = F.col("text").isNotNull()
    return out.select(
        *[c for c in pages.columns if c != "html"],
        F.when(found, F.col("url")).alias("final_url"),
        F.when(found, simple_title_of(F.col("parts"))).alias("page_title"),
        "text",
        F.when(found, detect_language(F.col("text"))).alias("language"),
    )


def link_pages(pages: DataFrame, as_of: Column) -> DataFrame:
    """Title, summary and date per page."""
    parts = F.col("parts")
    return parse_pages(pages).select(
        "url",
        title_of(parts).alias("title"),
        longer_summary_of(parts).alias("summary"),
        page_date(parts, F.col("url"), as_of).alias("page_date"),
    )
