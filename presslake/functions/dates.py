"""Dates from texts, links, paths and feeds. The clock is never read: ``as_of`` is an argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from presslake.functions.text import let

# Month names accepted in links.
MONTHS = {
    "january": 1, "jan": 1, "february": 2, "feb": 2, "march": 3, "mar": 3, "april": 4, "apr": 4,
    "may": 5, "june": 6, "jun": 6, "july": 7, "jul": 7, "august": 8, "aug": 8,
    "september": 9, "sep": 9, "sept": 9, "october": 10, "oct": 10, "november": 11, "nov": 11,
    "december": 12, "dec": 12,
}

# Date shapes in links, tried in this order; the order of the parts follows each.
LINK_PATTERNS = [
    (r"/(\d{4})/(\d{1,2})/(\d{1,2})/", "ymd"),
    (r"/(\d{4})-(\d{1,2})-(\d{1,2})/", "ymd"),
    (r"(\d{4})(\d{2})(\d{2})", "ymd"),
    (r"article(\d{4})(\d{2})(\d{2})", "ymd"),
    (r"/(\d{2})-(\d{2})-(\d{4})/", "dmy"),
    (r"/(\d{2})(\d{2})(\d{4})/", "dmy"),
    (r"/news/(\d{4})/(\d{1,2})/(\d{1,2})/", "ymd"),
    (r"(\d{1,2})_(\d{1,2})_(\d{4})", "dmy"),
    (r"-(\d{4})(\d{2})(\d{2})-", "ymd"),
    (r"/(\d{4})/(\w+)/(\d{1,2})/", "ymd"),
]
FIRST_YEAR, LAST_YEAR = 2000, 2030

# Accepted shapes of a written date, in this order.
WRITTEN_FORMATS = [
    "yyyy-M-d", "d-M-yyyy", "M/d/yyyy", "d/M/yyyy",
    "MMMM d, yyyy", "d MMMM yyyy", "MMM d, yyyy", "d MMM yyyy",
    "yyyy-M-d H:m:s", "d-M-yyyy H:m:s",
    "d MMMM, yyyy", "MMMM d yyyy", "d MMM, yyyy",
    "yyyy/M/d", "d.M.yyyy", "yyyy.M.d",
]
META_FORMATS = ["yyyy-M-d", "yyyy/M/d", "d-M-yyyy", "d/M/yyyy"]

WEEKDAYS = "mon|tue|wed|thu|fri|sat|sun"
SHORT_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"


def parse_dmy(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def format_dmy(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def parse_rfc822(c: Column) -> Column:
    """``Thu, 30 Oct 2025 10:11:12 GMT`` as a zone-less timestamp in GMT; NULL for anything else."""
    shape = rf"(?i)^\s*(?:{WEEKDAYS}),\s*(\d{{1,2}})\s+({SHORT_MONTHS})\s+(\d{{4}})\s+(\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}})\s+(?:GMT|UTC)\s*$"
    name = F.lower(F.regexp_extract(c, shape, 2))
    month = F.floor((F.instr(F.lit(SHORT_MONTHS.replace("|", "")), name) + 2) / 3)
    text = F.concat(F.regexp_replace(c, shape, "$3-"), month.cast("string"), F.regexp_replace(c, shape, "-$1 $4:$5:$6"))
    # Not by way of the session's zone, where the hour may not exist.
    return F.when(c.rlike(shape), text.try_cast("timestamp_ntz"))


def gmt_to_ist(c: Column) -> Column:
    """Feed time as India local time text; a text of another shape is returned unchanged."""
    local = parse_rfc822(c) + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    return F.coalesce(local.cast("string"), c)


def _calendar_date(parts: Column, first_year: int, last_year: int) -> Column:
    """``y-m-d`` text as a date when the year is accepted and the day exists."""
    accepted = F.substring(parts, 1, 4).between(str(first_year), str(last_year))
    return F.when(accepted & parts.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), parts.try_cast("date"))


# At one place of a link no two shapes but the first and the last can begin, and those two are the same text there. So one
# pass of a lookahead over all places gives, in order, whatever any shape matches. The first lookahead is only for speed.
_ANY_SHAPE = f"(?i)(?=[-/a\\d])(?=({'|'.join(p.replace('(', '(?:') for p, _ in LINK_PATTERNS)}))"


def date_from_url(url: Column, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> Column:
    """First valid date among ten shapes; only the first match of each shape is tried.

    The link is scanned once for the pieces that have a shape; the shapes are then told apart on these short texts.
    Years outside ``first_year`` to ``last_year`` are article numbers rather than dates; give a later last year for newer links.
    """
    months = F.create_map(*[x for name, n in MONTHS.items() for x in (F.lit(name), F.lit(str(n)))])

    def dated(pieces: Column, pattern: str, order: str) -> Column:
        whole = f"(?i)^{pattern}$"
        piece = F.get(F.filter(pieces, lambda p: p.rlike(whole)), F.lit(0))
        text = F.regexp_replace(piece, whole, "$1-$2-$3" if order == "ymd" else "$3-$2-$1")
        if r"(\w+)" in pattern:
            month = let(F.lower(F.regexp_extract(piece, whole, 2)), lambda m: F.coalesce(F.try_element_at(months, m), m))
            text = F.concat_ws("-", F.regexp_extract(piece, whole, 1), month, F.regexp_extract(piece, whole, 3))
        return let(text, lambda t: _calendar_date(t, first_year, last_year))

    found = lambda pieces: F.when(F.size(pieces) > 0, F.coalesce(*[dated(pieces, *shape) for shape in LINK_PATTERNS]))
    return let(F.regexp_extract_all(url, F.lit(_ANY_SHAPE), 1), found)


def date_from_path(path: Column) -> Column:
    """Date of ``.../YYYY/MM/DD/file``."""
    shape = r"^.*/(\d{1,4})/(\d{1,2})/(\d{1,2})/[^/]*$"
    return F.when(path.rlike(shape), F.try_to_date(F.regexp_replace(path, shape, "$1-$2-$3"), "yyyy-M-d"))


def parse_date_text(text: Column, as_of: Column) -> Column:
    """Written or relative date. Dots count in the two dotted shapes and are dropped for the others."""
    dotted = F.trim(F.regexp_replace(text, r"(?U)[^\w\s\-:/,.]", ""))
    plain = F.trim(F.replace(dotted, F.lit("."), F.lit("")))
    # Only texts with a day and a year can be a written date; the others skip sixteen failing parses.
    maybe = plain.rlike(r"\d") & plain.rlike(r"\d{4}")
    written = F.coalesce(*[F.try_to_date(dotted if "." in f else plain, f) for f in WRITTEN_FORMATS])
    low = F.lower(plain)
    # A number of days that no date can go back by is no date.
    days = F.regexp_extract(low, r"(\d+) day", 1)
    back = F.try_to_number(F.when(F.length(days) <= 7, days), F.lit("9999999")).cast("int")
    back = F.when(back < F.datediff(as_of, F.lit("0001-01-01").cast("date")), back)
    relative = (
        F.when(low.contains("yesterday"), F.date_sub(as_of, 1))
        .when(low.contains("today"), as_of)
        .when(low.contains("ago") & (days != ""), F.date_sub(as_of, back))
        .when(low.contains("ago") & low.contains("week"), F.date_sub(as_of, 7))
    )
    return F.coalesce(F.when(maybe, written), relative)


def date_part(text: Column, formats: list[str]) -> Column:
    """Date of a machine-written stamp: what stands before ``T``, in the first fitting format."""
    day = F.substring_index(text, "T", 1)
    return F.coalesce(*[F.try_to_date(day, f) for f in formats])


def entry_date(published: Column, link: Column, as_of: Column) -> Column:
    """Timestamp text of a feed entry: its own time, else the link's date at noon, else ``as_of`` at noon."""
    local = parse_rfc822(published) + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    day = F.coalesce(date_from_url(link), as_of)
    return F.coalesce(local.cast("string"), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 12:00:00")))


def within_window(day: Column, start: Column, end: Column, buffer: int = 7) -> Column:
    return day.between(F.date_sub(start, buffer), F.date_add(end, buffer))


def lookback_days(start: Column, end: Column) -> Column:
    return F.greatest(F.datediff(end, start) + 14, F.lit(30))


def date_key(stamp: Column) -> Column:
    """Date part of a timestamp text."""
    return F.nullif(F.substring_index(F.trim(stamp), " ", 1), F.lit(""))


def query_year(start: Column) -> Column:
    return F.year(start).cast("string")
