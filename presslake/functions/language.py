"""Writing-script detection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from presslake.functions.text import SPACE_CLASS, let

# Language code and code-point range of its script, in tie-break order.
SCRIPTS = [
    ("hi", r"\u0900-\u097F"),
    ("bn", r"\u0980-\u09FF"),
    ("ta", r"\u0B80-\u0BFF"),
    ("te", r"\u0C00-\u0C7F"),
    ("kn", r"\u0C80-\u0CFF"),
    ("ml", r"\u0D00-\u0D7F"),
    ("gu", r"\u0A80-\u0AFF"),
    ("pa", r"\u0A00-\u0A7F"),
]
SIMPLE_SCRIPTS = SCRIPTS[:6]

# Digits of any script, and the digit-valued characters outside the decimal class.
_DIGITS = r"\p{Nd}\u00B2\u00B3\u00B9\u2070\u2074-\u2079\u2080-\u2089\u2460-\u2468"
_PLAIN = "[A-Za-z" + SPACE_CLASS + _DIGITS + r".,;:!?'\"()\[\]{}]"


def _count(text: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", ""))


def script_counts(text: Column) -> Column:
    """Struct with one character count per script."""
    return F.struct(*[_count(text, rng).alias(code) for code, rng in SCRIPTS])


def _top(counts: Column) -> Column:
    return F.greatest(*[counts[code] for code, _ in SCRIPTS])


def _first_with(counts: Column, n: Column) -> Column:
    return F.coalesce(*[F.when(counts[code] == n, code) for code, _ in SCRIPTS])


def dominant_script(text: Column) -> Column:
    """Script with most characters; the first listed wins a tie."""
    return let(let(_indic_only(text), script_counts), lambda c: _first_with(c, _top(c)))


def _indic_only(text: Column) -> Column:
    """What the per-script passes need to look at."""
    return F.regexp_replace(text, r"[^\u0900-\u0D7F]+", "")


def _has_indic(text: Column) -> Column:
    """One scan that settles every text without a character of the listed scripts."""
    return text.rlike(r"[\u0900-\u0D7F]")


def detect_language(text: Column) -> Column:
    """Code of the dominant Indic script, else ``en``.

    The script must fill more than 10 % of a text of 50 characters or more that is over 15 % non-Latin.
    """
    length = F.length(text)
    foreign = F.length(F.regexp_replace(text, _PLAIN + "+", ""))
    code = let(let(_indic_only(text), script_counts), lambda c: F.when(_top(c) > length * 0.1, _first_with(c, _top(c))))
    return F.coalesce(F.when((length >= 50) & _has_indic(text) & (foreign > length * 0.15), code), F.lit("en"))


def detect_language_simple(text: Column) -> Column:
    """First of six scripts that fills more than 15 % of the text, else ``en``."""
    length = F.length(text)
    first = let(
        _indic_only(text),
        lambda t: F.coalesce(*[F.when(_count(t, rng) > length * 0.15, code) for code, rng in SIMPLE_SCRIPTS]),
    )
    return F.coalesce(F.when((length >= 50) & _has_indic(text), first), F.lit("en"))
