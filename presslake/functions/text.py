"""URLs, fingerprints, grades, query strings and error messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Characters that count as white space, as a trim set and as a regex class body.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200A\u2028\u2029\u202F\u205F\u3000"
)
SPACE_CLASS = r"\s\p{Z}\x1C-\x1F\x85"

# Query parameters that only track the visitor (case-sensitive).
TRACKING_PARAMETERS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
    "fbclid", "gclid", "_ga", "_gac", "ref", "source", "medium", "campaign", "oc",
]

# Domains that never yield an article.
SOCIAL_DOMAINS = ["facebook.com", "twitter.com", "instagram.com", "youtube.com"]

# Publisher suffixes removed from page titles, in this order.
TITLE_SUFFIXES = [" - The Hindu", " - NDTV", " - Times of India", " | The Hindu", " | NDTV"]

# Error classes and the message fragments that select them; first hit wins.
ERROR_CLASSES = [
    ("rate_limit", ["max retries", "retries exceeded"]),
    ("ssl_error", ["ssl", "eof", "certificate"]),
    ("connection_error", ["connection", "remotedisconnected", "connectionerror"]),
    ("timeout_error", ["timeout", "timed out"]),
    ("access_denied", ["forbidden", "403", "blocked"]),
    ("not_found", ["not found", "404"]),
]
FATAL_FRAGMENTS = [
    "forbidden", "403", "access denied", "authentication",
    "invalid api key", "quota exceeded permanently",
]
BLOCKING_FRAGMENTS = ["retries", "ssl", "connection"]

AGGREGATOR_PATH = "news.google.com/rss/articles/"
AGGREGATOR_LONG_ID = "news.google.com/rss/articles/CBMi"


def strip(c: Column) -> Column:
    """Both ends trimmed of every white-space character, line breaks included."""
    return F.btrim(c, F.lit(WHITESPACE))


def words(c: Column) -> Column:
    """White-space separated words; none for a blank text."""
    return let(strip(c), lambda t: F.when(t != "", F.split(t, f"[{SPACE_CLASS}]+")).otherwise(F.array().cast("array<string>")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def contains_any(c: Column, fragments: list[str]) -> Column:
    hit = F.lit(False)
    for fragment in fragments:
        hit = hit | c.contains(fragment)
    return hit


# ---------------------------------------------------------------- URLs


def _decode(c: Column) -> Column:
    return F.when(c.contains("%") | c.contains("+"), F.coalesce(F.try_url_decode(c), c)).otherwise(c)


def _encode(c: Column) -> Column:
    # Java leaves '*' and escapes '~'; the wanted form is the other way round.
    encoded = F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.when(c.rlike("[^A-Za-z0-9_.-]"), encoded).otherwise(c)


def _clean_query(query: Column) -> Column:
    """Query string without tracking and blank parameters, repeated keys grouped at their first place."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.")),
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~p["k"].isin(TRACKING_PARAMETERS))
    grouped = let(
        kept,
        lambda ps: F.flatten(
            F.transform(
                F.array_distinct(F.transform(ps, lambda p: p["k"])), lambda k: F.filter(ps, lambda p: p["k"] == k)
            )
        ),
    )
    return F.array_join(F.transform(grouped, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def normalize_url(url: Column) -> Column:
    """Form under which two addresses of one article are equal.

    Tracking parameters, blank parameters and the fragment go; repeated keys are grouped at their first
    place; everything is lower-cased and trailing slashes are cut. Aggregator links keep their case.
    """
    no_fragment = F.substring_index(url, "#", 1)
    base = F.substring_index(no_fragment, "?", 1)
    query = F.substring(no_fragment, F.length(base) + 2, F.length(no_fragment))
    with_query = let(_clean_query(query), lambda q: F.when(q != "", F.concat(base, F.lit("?"), q)).otherwise(base))
    plain = F.when(no_fragment.contains("?"), with_query).otherwise(base)
    article = F.regexp_extract(url, "/articles/([^?]+)", 1)
    return F.when(
        url.contains(AGGREGATOR_PATH) & (article != ""), F.concat(F.lit("google_news_"), article)
    ).otherwise(F.rtrim(F.lower(plain), F.lit("/")))


def url_domain(url: Column) -> Column:
    """Authority with its port, without a leading ``www.``; empty when there is none."""
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.coalesce(F.regexp_replace(authority, r"^www\.", ""), F.lit(""))


def is_http_url(link: Column) -> Column:
    trimmed = strip(link)
    return F.coalesce(trimmed.startswith("http://") | trimmed.startswith("https://"), F.lit(False))


def skip_url(url: Column) -> Column:
    """Very long aggregator links and social networks."""
    too_long = url.contains(AGGREGATOR_LONG_ID) & (F.length(url) > 350)
    return too_long | contains_any(F.lower(url), SOCIAL_DOMAINS)


# ---------------------------------------------------------------- articles


def article_id(normalized_url: Column, page_title: Column) -> Column:
    return F.md5(F.concat(normalized_url, F.coalesce(page_title, F.lit(""))))


def content_fingerprint(text: Column, prefix: int = 500) -> Column:
    return F.md5(F.substring(F.lower(text), 1, prefix))


def has_body(text: Column, min_length: int = 200) -> Column:
    return F.coalesce(F.length(text) > min_length, F.lit(False))


def valid_title(title: Column, low: int = 10, high: int = 300) -> Column:
    """Length strictly between ``low`` and ``high``."""
    return F.coalesce((F.length(title) > low) & (F.length(title) < high), F.lit(False))


def quality_grade(text: Column) -> Column:
    """``high``, ``medium`` or ``low`` by length, long lines, markup left-overs and word variety."""
    length = F.length(text)
    long_lines = F.size(F.filter(F.split(text, "\n"), lambda line: F.length(strip(line)) > 20))
    markup = length - F.length(F.translate(text, "<>", ""))
    variety = let(words(text), lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(0.0))

    def grade(measures: Column) -> Column:
        lines, ratio = measures["lines"], measures["ratio"]
        high = (length > 1500) & (lines >= 3) & (ratio > 0.3) & (markup <= 10)
        return F.when(high, "high").when((lines >= 2) & (ratio > 0.2), "medium").otherwise("low")

    # Texts of up to 500 characters are low without being split.
    measured = let(F.struct(long_lines.alias("lines"), variety.alias("ratio")), grade)
    return F.when(length > 500, measured).otherwise("low")


def quality_rank(grade: Column) -> Column:
    return F.when(grade == "high", 3).when(grade == "medium", 2).otherwise(1)


def clean_title(title: Column, suffixes: list[str] = TITLE_SUFFIXES) -> Column:
    out = title
    for suffix in suffixes:
        # One reference per step: the chain stays linear in the number of suffixes.
        out = F.regexp_replace(out, rf"(?s)^(.*)\Q{suffix}\E$", "$1")
    return strip(out)


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


# ---------------------------------------------------------------- queries


def query_text(*parts: Column) -> Column:
    """Non-empty parts joined by one blank."""
    return F.array_join(F.array_compact(F.array(*[F.nullif(p, F.lit("")) for p in parts])), " ")


def simplify_query(query: Column, strict: bool = True) -> Column:
    """Shorten queries with too many alternatives or too many special characters.

    ``strict=False`` counts and splits on ``OR`` anywhere, even inside a word such as ``STORM``.
    """
    operator = r"\bOR\b" if strict else "OR"
    parts = F.split(query, " OR ")
    many = (F.regexp_count(query, F.lit(operator)) > 6) & (F.size(parts) > 6)
    noisy = F.lit(False)
    for ch in ("(", ")", '"'):
        noisy = noisy | (F.length(query) - F.length(F.replace(query, F.lit(ch), F.lit(""))) > 4)
    cleaned = F.filter(
        F.transform(F.split(F.translate(query, '()"', ""), operator), strip), lambda p: p != ""
    )
    return (
        F.when(many, F.array_join(F.slice(parts, 1, 4), " OR "))
        .when(noisy & (F.size(cleaned) > 0), F.array_join(F.slice(cleaned, 1, 3), " OR "))
        .otherwise(query)
    )


def ban_key(query: Column, lang: Column) -> Column:
    return F.substring(F.md5(F.concat(query, F.lit("_"), lang)), 1, 8)


# ---------------------------------------------------------------- relevance


def mentions_hazard(title: Column, summary: Column, hazard: Column) -> Column:
    """The hazard, or one of its words longer than three characters, occurs in title or summary."""
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit(""))))
    name = F.lower(F.coalesce(hazard, F.lit("")))
    long_words = F.filter(words(name), lambda w: F.length(w) > 3)
    return (name == "") | F.contains(text, name) | F.exists(long_words, lambda w: F.contains(text, w))


def mentions_keyword(text: Column, keyword: Column) -> Column:
    word = F.lower(F.coalesce(keyword, F.lit("")))
    return F.coalesce(
        (F.length(text) > 0) & ((word == "") | F.contains(F.lower(text), word)), F.lit(False)
    )


# ---------------------------------------------------------------- request errors


def classify_error(message: Column) -> Column:
    text = F.lower(message)
    out = None
    for name, fragments in ERROR_CLASSES:
        out = F.when(contains_any(text, fragments), name) if out is None else out.when(contains_any(text, fragments), name)
    return out.otherwise("unknown_error")


def is_fatal(message: Column) -> Column:
    return contains_any(F.lower(message), FATAL_FRAGMENTS)


def is_blocking(success: Column, error_type: Column) -> Column:
    """A failure whose class starts a blocking period."""
    return F.coalesce(~success & contains_any(F.lower(error_type), BLOCKING_FRAGMENTS), F.lit(False))


def backoff_seconds(streak: Column, message: Column, hour: Column) -> Column:
    """Waiting time after ``streak`` failures; the cap applies before the time-of-day factor."""
    text = F.lower(F.coalesce(message, F.lit("")))
    factor = (
        F.when(contains_any(text, ["ssl", "eof"]), 3.0)
        .when(text.contains("timeout"), 2.5)
        .when(text.contains("connection"), 4.0)
        .when(text.contains("retries"), 5.0)
        .otherwise(2.0)
    )
    # 2 * 2^6 already exceeds the cap, so a longer streak need not be raised to a power.
    delay = F.least(F.lit(120.0), F.lit(2.0) * F.pow(factor, F.least(streak, F.lit(6))))
    clock = F.when(hour.between(9, 17), 1.5).when(hour.between(20, 23), 2.0).otherwise(1.0)
    return F.when(streak == 0, F.lit(2.0)).otherwise(delay) * clock
