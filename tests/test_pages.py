import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from presslake.functions.html import page_date
from presslake.operators import pages as P

LONG = "This sentence is long enough to count as a paragraph of text. " * 3


def parse(spark, *htmls):
    table = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string").withColumn("url", F.lit("https://a.example.com/x"))
    return P.parse_pages(table).orderBy("page_id")


def test_unclosed_paragraph_reaches_to_the_end_of_its_parent(spark):
    html = "<article><h1>A heading of words</h1><p><b>Lead words of the article.<br><p>Second paragraph of it.</p></article><p>outside</p>"
    parts = parse(spark, html).first()["parts"]
    assert parts["h1"] == ["A heading of words"]
    assert parts["body"] == "Lead words of the article.Second paragraph of it.\nSecond paragraph of it." or len(parts["body"]) < 200


def test_containers(spark):
    nav = f"<div><p>{LONG}nav</p></div>"
    chosen = f"<html><body>{nav}<div class='x content'><p>{LONG}one</p><p>{LONG}two</p><p>tiny</p></div></body></html>"
    plain = f"<body>{nav}<div id=a><p>{LONG}1</p><p>{LONG}2</p><p>{LONG}3</p></div></body>"
    loose = f"<body><p>{LONG}a</p><p>{LONG}b</p></body>"
    bare = f"<body><main> {LONG} <i>x</i> {LONG}</main></body>"
    bodies = [r["parts"]["body"] for r in parse(spark, chosen, plain, loose, bare).collect()]
    strip = LONG.strip()
    assert bodies[0] == f"{LONG}one\n{LONG}two"
    assert bodies[1] == f"{LONG}1\n{LONG}2\n{LONG}3"
    assert bodies[2] == f"{LONG}a\n{LONG}b"
    assert bodies[3] == f"{strip}\nx\n{strip}"


def test_hidden_text_and_references(spark):
    html = f"<title>A &amp; B of the page</title><article><script>if (a < b) '</p>'</script><style>p</style><!-- no --><p>{LONG}&eacute;&#8217;</p></article>"
    row = parse(spark, html).select("parts", P.text_of(F.col("parts")).alias("t"), P.title_of(F.col("parts")).alias("title")).first()
    assert row["title"] == "A & B of the page"
    assert row["t"] is None or row["t"].endswith("é’")
    assert row["parts"]["body"].endswith("é’")


def test_failures_stay_as_rows(spark):
    rows = [(0, "https://a.example.com", None), (1, "https://a.example.com/b", ""), (2, "https://x.twitter.com/", f"<h1>t</h1><p>{LONG}{LONG}</p>"),
            (3, "https://a.example.com/c", f"<p>{LONG}{LONG}</p>"), (4, "https://a.example.com/d", f"<h1>t</h1><p>{LONG}{LONG}</p>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in P.extract_pages(table).collect()}
    assert [i for i, r in sorted(got.items()) if r["text"]] == [4]
    assert got[4]["page_title"] == "t" and got[4]["language"] == "en" and got[0]["final_url"] is None


def test_a_worker_parses_few_pages_at_once(spark, monkeypatch):
    """A batch is parsed in slices, bounded by pages and by characters, and every page keeps its place."""
    pages = [None, "", *(f"<h1>heading {i}</h1>" + "x" * (900 * (i % 7 == 0)) for i in range(500))]
    some = list(P._slices(pa.array(pages)))
    assert [p for slice_ in some for p in slice_] == pages and max(map(len, some)) <= P.PAGES
    monkeypatch.setattr(P, "SLICE_CHARS", 1_000)
    assert all(sum(len(p or "") for p in slice_[:-1]) < 1_000 for slice_ in P._slices(pa.array(pages)))
    got = parse(spark, *pages).select("page_id", "html", "parts.h1", "parts.error").collect()
    assert [r["html"] for r in got] == pages
    assert [r["h1"] for r in got] == [[], [], *([f"heading {i}"] for i in range(500))]


def test_dates(spark):
    marks = [
        '<meta name="date" content="30/10/2025">', '<time datetime="2025-10-30T01:00">x</time>', '<b id="publish-date">30 Oct 2025</b>',
        '<script type="application/ld+json">{"dateCreated":"2025-10-30"}</script>', "<p>none</p>",
        '<meta property="og:published_time" content="soon"><i class="story-time">3 days ago</i>',
    ]
    day = page_date(F.col("parts"), F.col("url"), F.lit("2025-11-02").cast("date"))
    got = [r["d"] for r in parse(spark, *marks).select(day.alias("d")).collect()]
    assert got == [dt.date(2025, 10, 30)] * 4 + [None, dt.date(2025, 10, 30)]


def test_malformed_pages_do_not_end_the_job(spark):
    bad = ["<![foo[x]]>", "<![ bar", "<![1]>", "<!", "</", "<a", "&#xZZ;<p", "<![CDATA[x]]>", "\x00<"]
    whole = f"<article><h1>A heading of words</h1><p>{LONG}{LONG}</p></article>"
    rows = parse(spark, *bad, *[b + whole for b in ("<![foo[x]]>", "<![1]>")]).collect()
    assert len(rows) == len(bad) + 2
    assert all(r["parts"]["h1"] == ["A heading of words"] and r["parts"]["error"] is None for r in rows[-2:])


def test_a_flat_page_takes_linear_time():
    import time

    seconds = []
    for n in (4_000, 16_000):
        html = "<body>" + "<div><p>x</p></div>" * n + "</body>"
        start = time.perf_counter()
        P._parts(html)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 10 * seconds[0]


def test_pages_are_parsed_once_and_after_the_join(spark):
    from presslake.operators import articles as A

    pages = spark.createDataFrame([("https://a.example.com/", "<h1>A heading of words</h1>")], "url string, html string")
    configs = spark.createDataFrame(
        [("d", {"en": ["Storm"]}, ["https://a.example.com/"])], "disaster_id string, hazard_names map<string,array<string>>, specific_links array<string>"
    )
    plan = A.specific_link_row(configs, pages, F.lit("2025-11-02").cast("date"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("LeftSemi")
