"""Hand-checked cases of the column functions."""

import datetime as dt
import random
import re

import pytest
from helpers import one
from pyspark.sql import functions as F

from presslake.functions import dates as D, html as H, language as L, regions as R, text as T

AS_OF = "2025-11-10"


@pytest.mark.parametrize("url, expected", [
    ("https://A.com/Path/?utm_source=x&b=2&a=1&b=3#frag", "https://a.com/path/?b=2&b=3&a=1"),
    ("https://a.com/p/?ref=x", "https://a.com/p"),
    ("https://a.com/p?x=&y", "https://a.com/p"),
    ("https://a.com/p?q=a%20b+c~*", "https://a.com/p?q=a+b+c~%2a"),
    ("https://a.com/p?q=%zz", "https://a.com/p?q=%25zz"),
    ("https://news.google.com/rss/articles/CBMiAb?oc=5", "google_news_CBMiAb"),
    ("https://a.com/p#x?y", "https://a.com/p"),
    ("", ""),
])
def test_normalize_url(spark, url, expected):
    assert one(spark, T.normalize_url(F.lit(url))) == expected


@pytest.mark.parametrize("url, expected", [
    ("https://www.ndtv.com:8080/x", "ndtv.com:8080"), ("http://user@a.com/x", "user@a.com"),
    ("//b.org/x", "b.org"), ("no address", ""),
])
def test_url_domain(spark, url, expected):
    assert one(spark, T.url_domain(F.lit(url))) == expected


def test_skip_url(spark):
    long_id = "https://news.google.com/rss/articles/CBMi" + "a" * 320
    assert one(spark, T.skip_url(F.lit("https://m.YouTube.com/watch")))
    assert one(spark, T.skip_url(F.lit(long_id)))
    assert not one(spark, T.skip_url(F.lit(long_id[:349])))
    assert one(spark, T.is_http_url(F.lit("  https://a.com")))
    assert not one(spark, T.is_http_url(F.lit("ftp://a.com")))


@pytest.mark.parametrize("url, expected", [
    ("/2025/10/24/", "2025-10-24"), ("/2025-10-24/", "2025-10-24"), ("x20251024y", "2025-10-24"),
    ("/24-10-2025/", "2025-10-24"), ("24_10_2025", "2025-10-24"), ("/2025/october/24/", "2025-10-24"),
    ("/2025/SEPT/4/", "2025-09-04"), ("/24102025/", "2025-10-24"), (".../article70220159.ece", None),
    ("/2025/02/30/", None), ("/2031/01/01/", None), ("/2000/13/01/x-20240105-y", "2024-01-05"), ("/plain/", None),
])
def test_date_from_url(spark, url, expected):
    got = one(spark, D.date_from_url(F.lit(url)))
    assert (got and got.isoformat()) == expected


def test_date_from_url_equals_shape_by_shape(spark):
    """Links of pieces that begin, end and overlap in all ways, against one search per shape over the whole link."""
    rng = random.Random(5)
    pieces = ["/", "/", "-", "_", "2024", "2031", "1999", "05", "5", "31", "02", "13", "20240105", "12052023", "article", "ARTICLE", "/news/", "may", "Sept", "x", "9", "é", "\n", "٣"]
    links = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(6000)]

    def plain(link):
        for pattern, order in D.LINK_PATTERNS:
            if found := re.search(pattern, link, re.I | re.A):
                y, m, d = found.groups() if order == "ymd" else reversed(found.groups())
                m = str(D.MONTHS.get(m.lower(), m))
                if "2000" <= y <= "2030" and m.isdigit() and m.isascii():
                    try:
                        return dt.date(int(y), int(m), int(d))
                    except ValueError:
                        continue
        return None

    table = spark.createDataFrame([*enumerate(links), (-1, None)], "i long, link string")
    got = {r.i: r.day for r in table.select("i", D.date_from_url(F.col("link")).alias("day")).collect()}
    expected = {i: plain(link) for i, link in enumerate(links)} | {-1: None}
    assert got == expected
    assert sum(day is not None for day in expected.values()) > 300


@pytest.mark.parametrize("text, expected", [
    ("3 days ago", "2025-11-07"), ("1 week ago", "2025-11-03"), ("10 days ago", "2025-10-31"),
    ("yesterday", "2025-11-09"), ("Today", "2025-11-10"), ("October 30, 2025", "2025-10-30"),
    ("30 Oct 2025", "2025-10-30"), ("Oct. 30, 2025", "2025-10-30"), ("05.10.2025", "2025-10-05"),
    ("2025-10-30 10:11:12", "2025-10-30"), ("30/10/2025", "2025-10-30"), ("10/30/2025", "2025-10-30"),
    ("(30 October, 2025)", "2025-10-30"), ("soon", None),
])
def test_parse_date_text(spark, text, expected):
    got = one(spark, D.parse_date_text(F.lit(text), F.lit(AS_OF).cast("date")))
    assert (got and got.isoformat()) == expected


def test_dates(spark):
    assert one(spark, D.gmt_to_ist(F.lit("Thu, 30 Oct 2025 20:00:00 GMT"))) == "2025-10-31 01:30:00"
    assert one(spark, D.gmt_to_ist(F.lit("30 Oct"))) == "30 Oct"
    assert one(spark, D.parse_dmy(F.lit("24/10/2025"))) == dt.date(2025, 10, 24)
    assert one(spark, D.date_from_path(F.lit("/d/x/2025/10/30/results.csv"))) == dt.date(2025, 10, 30)
    assert one(spark, D.entry_date(F.lit(None).cast("string"), F.lit("/x/"), F.lit(AS_OF).cast("date"))) == "2025-11-10 12:00:00"
    start, end = F.lit("2025-10-24").cast("date"), F.lit("2025-10-30").cast("date")
    inside = [one(spark, D.within_window(F.lit(d).cast("date"), start, end)) for d in ("2025-10-17", "2025-10-16", "2025-11-06", "2025-11-07")]
    assert inside == [True, False, True, False]
    assert one(spark, D.lookback_days(start, end)) == 30


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on that day.
        assert one(spark, D.gmt_to_ist(F.lit("Sun, 09 Mar 2025 02:30:00 GMT"))) == "2025-03-09 08:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quality_grade(spark):
    line = "word%d another thing here now"
    text = lambda n: "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(n))
    assert one(spark, T.quality_grade(F.lit(""))) == "low"
    assert one(spark, T.quality_grade(F.lit("x" * 501))) == "low"
    assert one(spark, T.quality_grade(F.lit(text(40)))) == "high"
    assert one(spark, T.quality_grade(F.lit(text(40) + "<" * 11))) == "medium"
    assert one(spark, T.quality_grade(F.lit(text(12)))) == "medium"
    assert one(spark, T.quality_grade(F.lit("\n".join(["same same same same same same"] * 30)))) == "low"
    assert one(spark, T.quality_grade(F.lit(None).cast("string"))) == "low"


def test_fingerprint_and_id(spark):
    assert one(spark, T.content_fingerprint(F.lit("A" * 600))) == one(spark, T.content_fingerprint(F.lit("a" * 500 + "b")))
    assert one(spark, T.ban_key(F.lit("Cyclone Montha"), F.lit("en"))) == "be5b972b"


def test_language(spark):
    assert one(spark, L.detect_language(F.lit("म" * 49))) == "en"
    assert one(spark, L.detect_language(F.lit("म" * 60))) == "hi"
    assert one(spark, L.detect_language(F.lit("a" * 95 + "म" * 10))) == "en"
    assert one(spark, L.detect_language(F.lit("மழை" * 30))) == "ta"
    assert one(spark, L.detect_language_simple(F.lit("ગુજરાત" * 20))) == "en"
    assert one(spark, L.detect_language_simple(F.lit("বন্যা" * 20))) == "bn"


def test_queries(spark):
    eight = " OR ".join("abcdefgh")
    assert one(spark, T.simplify_query(F.lit(eight))) == "a OR b OR c OR d"
    storms = " ".join(["STORM"] * 7)
    assert one(spark, T.simplify_query(F.lit(storms))) == storms
    noisy = " OR ".join(f'("{c}")' for c in "abcde")
    assert one(spark, T.simplify_query(F.lit(noisy))) == "a OR b OR c"
    assert one(spark, T.query_text(F.lit("a"), F.lit(""), F.lit("b"))) == "a b"


def test_errors(spark):
    cases = {"Max retries exceeded": "rate_limit", "SSL: EOF": "ssl_error", "403 Forbidden": "access_denied",
             "Read timed out": "timeout_error", "boom": "unknown_error", "404": "not_found"}
    assert {m: one(spark, T.classify_error(F.lit(m))) for m in cases} == cases
    backoff = lambda s, m, h=3: one(spark, T.backoff_seconds(F.lit(s), F.lit(m), F.lit(h)))
    assert [backoff(0, "x"), backoff(2, "timeout"), backoff(5, "retries"), backoff(0, "x", 12), backoff(9, "x", 21)] == [2.0, 12.5, 120.0, 3.0, 240.0]


def test_relevance(spark):
    hit = lambda title: one(spark, T.mentions_hazard(F.lit(title), F.lit(None).cast("string"), F.lit("Cyclone Montha")))
    assert hit("Severe cyclone hits coast") and not hit("Heavy rain today")
    assert one(spark, T.mentions_keyword(F.lit("Heavy Rain"), F.lit("rain")))
    assert not one(spark, T.mentions_keyword(F.lit(""), F.lit("")))


def test_html(spark):
    page = "<title>Short &#8217;n sweet headline - NDTV</title><script>var a='<h1>No such heading</h1>'</script><h1>tiny</h1>"
    assert one(spark, H.page_title(F.lit(page))) == "Short ’n sweet headline"
    assert one(spark, H.simple_title(F.lit(page))) == "tiny"
    assert one(spark, H.unescape(F.lit("&amp;lt; &#x41; &amp &copy;"))) == "&lt; A & ©"
    shared = '<meta content="Shared title of page" property="og:title"><title>x</title>'
    assert one(spark, H.page_title(F.lit(shared))) == "Shared title of page"
    assert one(spark, H.jsonld_date(F.lit('{"dateCreated": "2025-01-02T03:04"}'))) == dt.date(2025, 1, 2)
    assert one(spark, H.jsonld_date(F.lit('[{"dateCreated": "2025-01-02"}]'))) is None


def test_regions(spark):
    assert one(spark, R.primary_language(F.lit("ladakh"))) == "hi"
    assert one(spark, R.languages_of(F.lit("nowhere"))) == ["en"]
    assert one(spark, R.region_slug(F.lit("Jammu & Kashmir"))) == "jammu-and-kashmir"
    assert one(spark, R.language_code(F.lit("Mizo"))) == "lus"
    assert one(spark, R.language_code(F.lit("Khasi"))) is None
