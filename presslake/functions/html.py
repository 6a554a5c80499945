"""Titles and structured dates read from markup with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from presslake.functions.dates import META_FORMATS, date_from_url, date_part, parse_date_text
from presslake.functions.text import clean_title, let, strip, valid_title

# Character references decoded here; numeric ones are decoded by rule.
NAMED_REFERENCES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00A0", "copy": "\u00A9", "reg": "\u00AE",
    "middot": "\u00B7", "bull": "\u2022", "hellip": "\u2026", "ndash": "\u2013", "mdash": "\u2014",
    "lsquo": "\u2018", "rsquo": "\u2019", "ldquo": "\u201C", "rdquo": "\u201D", "laquo": "\u00AB",
    "raquo": "\u00BB", "euro": "\u20AC", "pound": "\u00A3", "deg": "\u00B0", "times": "\u00D7",
}

# References that count even without their semicolon.
BARE_REFERENCES = {"lt", "gt", "quot", "nbsp", "copy", "reg", "middot", "laquo", "raquo", "pound", "deg", "times"}


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def unescape(text: Column) -> Column:
    """Character references as characters; ``&amp;`` last, so that nothing is decoded twice."""
    pieces = F.split(text, "&#")
    decoded = F.transform(
        pieces,
        lambda p, i: F.when(
            (i > 0) & p.rlike(r"^0*(?:1[01]\d{5}|\d{1,6});") & (F.substring_index(p, ";", 1).try_cast("long") <= 0x10FFFF),
            F.concat(_code_point(F.substring_index(p, ";", 1).cast("long")), F.substring(p, F.instr(p, ";") + 1, F.length(p))),
        )
        .when(
            (i > 0) & p.rlike(r"^[xX]0*(?:10)?[0-9A-Fa-f]{1,4};|^[xX]0*[0-9A-Fa-f]{1,5};"),
            F.concat(
                _code_point(F.conv(F.substring(F.substring_index(p, ";", 1), F.lit(2), F.lit(64)), 16, 10).cast("long")),
                F.substring(p, F.instr(p, ";") + 1, F.length(p)),
            ),
        )
        .when(i > 0, F.concat(F.lit("&#"), p))
        .otherwise(p),
    )
    out = F.array_join(decoded, "")
    for name, char in NAMED_REFERENCES.items():
        out = F.regexp_replace(out, f"&{name};{'?' if name in BARE_REFERENCES else ''}", char)
    return F.when(text.contains("&"), F.regexp_replace(out, "&amp;?", "&")).otherwise(text)


def visible(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>", "")


def inner_text(markup: Column) -> Column:
    return strip(let(F.regexp_replace(markup, "<[^>]*>", ""), unescape))


def _elements(markup: Column, tag: str) -> Column:
    return F.regexp_extract_all(markup, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))


def _first(texts: Column) -> Column:
    return F.try_element_at(texts, F.lit(1))


def meta_content(html: Column, attribute: str, value: str) -> Column:
    """Content of the first ``meta`` element whose attribute has this value, whatever the attribute order."""
    tag = F.regexp_extract(html, rf"""(?is)<meta\b[^>]*\b{attribute}\s*=\s*["']{value}["'][^>]*>""", 0)
    content = F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    return F.nullif(unescape(content), F.lit(""))


def page_title(html: Column) -> Column:
    """First fitting ``h1``, else the shared title, else the document title; shorter than 10 gives NULL."""
    def title(markup: Column) -> Column:
        headings = F.transform(_elements(markup, "h1"), lambda m: inner_text(m))
        return F.coalesce(
            _first(F.filter(headings, lambda t: valid_title(t))),
            F.nullif(strip(meta_content(markup, "property", "og:title")), F.lit("")),
            clean_title(let(_first(_elements(markup, "title")), inner_text)),
        )

    return let(let(visible(html), title), lambda t: F.when(F.length(t) >= 10, t))


def simple_title(html: Column) -> Column:
    """First ``h1``, else the document title."""
    def element(markup: Column) -> Column:
        return F.coalesce(_first(_elements(markup, "h1")), _first(_elements(markup, "title")))

    return let(let(visible(html), element), inner_text)


def jsonld_date(block: Column) -> Column:
    """Publication date of a JSON-LD object: the first of three keys decides."""
    stamp = F.coalesce(*[F.get_json_object(block, f"$.{k}") for k in ("datePublished", "dateCreated", "uploadDate")])
    return date_part(stamp, ["yyyy-M-d"])


def page_date(parts: Column, url: Column, as_of: Column) -> Column:
    """Date of a parsed page: its link, meta elements, ``time``, date-like elements, JSON-LD.

    ``parts`` is the struct of ``operators.pages.parse_pages``.
    """
    metas = F.try_element_at(
        F.filter(F.transform(parts["meta_dates"], lambda m: date_part(m, META_FORMATS)), lambda d: d.isNotNull()), F.lit(1)
    )
    texts = F.try_element_at(
        F.filter(F.transform(parts["date_texts"], lambda t: parse_date_text(t, as_of)), lambda d: d.isNotNull()), F.lit(1)
    )
    return F.coalesce(
        date_from_url(url), metas, date_part(parts["time_date"], ["yyyy-M-d"]), texts, jsonld_date(parts["jsonld"])
    )
