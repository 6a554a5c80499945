"""Flows, storage and streams on small fixtures."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from presslake.catalog.inputs import request_log
from presslake.operators import health as H, matching as M, registry as R
from presslake.plans import flows
from presslake.sources import readers, writers
from presslake.streaming import health

STORM = {
    "disaster_id": "2025-coast-storm", "start_date": "24/10/2025", "end_date": "30/10/2025",
    "hazard_names": {"en": ["Cyclone Orlo"]}, "keywords": {"en": ["rain", "flood", "wind"]},
    "locations": {"Telangana": {"districts": {"Brack": ["Quay"]}}}, "newspapers": {"en": []}, "country_codes": ["IN"], "specific_links": [],
}

LONG = "Cyclone Orlo brought heavy rain and flooding to the coast on Tuesday, officials said. "
AS_OF = "2025-10-28"


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("config")
    links = ["https://www.a.example.com/2025/10/27/one", " https://b.example.com/two "]
    (folder / "c.json").write_text(json.dumps({**STORM, "specific_links": links}))
    return readers.read_config(spark, str(folder))


@pytest.fixture(scope="module")
def pages(spark):
    def body(title, extra=""):
        words = " ".join(f"word{i}{title[:1]}" for i in range(60))
        return f"<html><body><h1>{title}</h1><article><p>{LONG}{words}</p><p>{LONG * 3}{extra}</p><p>{LONG}</p></article></body></html>"

    rows = [
        ("https://www.a.example.com/2025/10/27/one", body("Storm news of the day")),
        ("https://b.example.com/two", body("Another headline here")),
        ("https://c.example.com/three?utm_source=feed", body("Third headline of all")),
        ("https://c.example.com/three", body("Third headline of all")),
        ("https://d.example.com/four", "<html><h1>Nothing here at all</h1></html>"),
    ]
    return spark.createDataFrame(rows, "url string, html string")


def test_collect_extract_audit(spark, config, pages, tmp_path):
    queries = flows.plan_queries(config)
    wanted = queries.filter("ord = 0").first()["query_id"]
    entry = lambda c, i, title, link, published: (wanted, c, i, title, link, published, None, None)
    entries = spark.createDataFrame(
        [
            entry(0, 0, "Cyclone hits", "https://c.example.com/three", "Thu, 30 Oct 2025 20:00:00 GMT"),
            entry(0, 1, "Cyclone hits", "https://c.example.com/three?utm_source=feed", "Thu, 30 Oct 2025 20:00:00 GMT"),
            entry(0, 2, "Cyclone old", "https://d.example.com/2025/01/02/x", None),
            entry(0, 3, "Quiet day", "https://d.example.com/four", None),
            entry(0, 4, "Cyclone here", "https://d.example.com/four", None),
            entry(1, 5, "Cyclone elsewhere", "https://e.example.com/", None),
        ],
        readers.FEED,
    )
    rows = flows.collect(config, queries, entries, pages, F.lit(AS_OF).cast("date"))
    got = {(r["link"], r["date"], r["query_type"]) for r in rows.collect()}
    assert got == {
        ("https://c.example.com/three", "2025-10-31 01:30:00", "hazard_only"),
        ("https://c.example.com/three?utm_source=feed", "2025-10-31 01:30:00", "hazard_only"),
        ("https://d.example.com/four", "2025-10-28 12:00:00", "hazard_only"),
        ("https://www.a.example.com/2025/10/27/one", "2025-10-27 00:00:00", "specific_link"),
        ("https://b.example.com/two", "2025-10-28 00:00:00", "specific_link"),
    }
    root = str(tmp_path / "metadata")
    writers.write_metadata(rows.withColumn("ord", F.monotonically_increasing_id()), root)
    stored = readers.read_metadata_days(spark, root)
    assert stored.count() == 5
    assert readers.read_metadata_days(spark, root, ("2025-10-28", "2025-10-31")).count() == 4
    numbered = stored.orderBy("link").withColumn("file", F.lit("f")).withColumn("ord", F.xxhash64("link"))
    articles = flows.extract(numbered, pages)
    found = articles.collect()
    assert {r["normalized_url"] for r in found} == {
        "https://www.a.example.com/2025/10/27/one", "https://b.example.com/two", "https://c.example.com/three"}
    assert {r["extraction_quality"] for r in found} <= {"high", "medium"}
    tables = flows.audit(articles)
    assert tables["duplicate_urls"].count() == 0
    assert tables["report"].first()["final_count"] == 3
    assert tables["similar_titles"].count() == 0
    out = str(tmp_path / "articles")
    writers.write_articles(articles, out)
    assert writers.read_written_articles(spark, out, "combined").count() == 3
    assert readers.read_articles(spark, out).count() == 3


def test_search_feeds_collect_and_extract(spark, config, pages, tmp_path):
    import datetime as dt

    schema = "ord long, country string, title string, link string, published string, summary string, source string, text string, date date"
    day, old = dt.date(2025, 10, 27), dt.date(2025, 5, 1)
    corpus = spark.createDataFrame(
        [
            (0, "IN", "Cyclone Orlo hits", "https://c.example.com/three", "Thu, 30 Oct 2025 20:00:00 GMT", None, "C", "Cyclone, ORLO. Rain and more", day),
            (1, "IN", "Cyclone before", "https://d.example.com/four", None, None, "D", "cyclone orlo rain", old),
            (2, "XX", "Cyclone abroad", "https://d.example.com/five", None, None, "D", "cyclone orlo rain", day),
            (3, "IN", "Other news", "https://d.example.com/six", None, None, "D", "nothing of it", day),
        ],
        schema,
    )
    as_of = F.lit(AS_OF).cast("date")
    queries = flows.plan_queries(config)
    entries = flows.search(config, queries, corpus, as_of)
    assert {r["ord"] for r in entries.collect()} == {0}
    first = queries.filter("type = 'hazard_only'").first()
    banned = queries.select(M.ban_key(F.col("query"), F.col("lang_code")).alias("ban_key"))
    assert first is not None and flows.search(config, queries, corpus, as_of, banned).count() == 0
    rows = flows.collect(config, queries, entries, pages, as_of)
    root = str(tmp_path / "metadata")
    writers.write_metadata(rows.withColumn("ord", F.monotonically_increasing_id()), root)
    found = flows.extract(readers.read_metadata(spark, root), pages).collect()
    assert "https://c.example.com/three" in {r["normalized_url"] for r in found}


def test_folders_by_date(spark, tmp_path):
    """CSV files in YYYY/MM/DD folders, as the pipeline's users have them."""
    day = tmp_path / "data" / "x" / "2025" / "10" / "30"
    day.mkdir(parents=True)
    header = ",".join(readers.METADATA.names)
    (day / "results.csv").write_text(f'{header}\n"Title, with ""quotes""",https://a.example.com,2025-10-30 00:00:00,a,"two\nlines",en,H,k,,,broad,x\n')
    rows = readers.read_metadata(spark, str(tmp_path / "data")).collect()
    assert [(r["title"], r["summary"], r["location"], str(r["day"])) for r in rows] == [('Title, with "quotes"', "two\nlines", None, "2025-10-30")]
    assert readers.read_metadata(spark, str(tmp_path / "data"), ("2025-10-31", "2025-11-01")).count() == 0


def test_links(spark, tmp_path):
    (tmp_path / "a.txt").write_text(" https://a.example.com \n\nhttps://b.example.com\n")
    (tmp_path / "b.txt").write_text('["https://c.example.com", " "]')
    assert sorted(r["link"] for r in readers.read_links(spark, str(tmp_path)).collect()) == [
        "https://a.example.com", "https://b.example.com", "https://c.example.com"]
    inline = spark.range(1).select(readers.split_links(F.lit("x, y,,z "), ",").alias("l")).first()["l"]
    assert inline == ["x", "y", "z"]


def test_combined_grades_every_article_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def grade(i):
        calls.add(1)
        return ["medium", "low", "high"][i % 3]

    rows = writers.combined(spark.range(300).select(F.col("id").alias("ord"), grade("id").alias("extraction_quality"))).collect()
    assert [(r["extraction_quality"], r["ord"]) for r in rows] == [("high", i) for i in range(2, 300, 3)] + [("medium", i) for i in range(0, 300, 3)]
    assert calls.value == 300


def test_registry(spark, config, tmp_path):
    (tmp_path / "r.csv").write_text('State/UT,Newspaper Name,Language(s),Website\nTelangana,T1,"English, Hindi",u1\nTelangana,T2,Khasi,u2\nKerala,K,Malayalam/English,u3\nNational,N,English,u4\n')
    registry = readers.read_registry(spark, str(tmp_path / "r.csv"))
    rows = R.registry_newspapers(registry, config).collect()
    assert sorted((r["name"], r["lang_code"]) for r in rows if r["lang_code"]) == [("N", "en"), ("T1", "en"), ("T1", "hi")]
    assert len(rows) == 4


def test_registry_aggregates_take_no_pairs(spark):
    """300 newspapers and 300 configurations of one region: no step has more rows than these together."""
    registry = spark.range(300).selectExpr("'Kerala' AS `State/UT`", "concat('n', id) AS `Newspaper Name`", "'English, Khasi' AS `Language(s)`", "'u' AS Website")
    states = spark.range(300).selectExpr("concat('ev-', id % 290) AS disaster_id", "map('Kerala', 1) AS locations")
    aggregates = F.count(F.lit(1)).alias("papers"), F.min("name").alias("first")
    found = R.registry_newspapers(registry, states, *aggregates)
    plain = R.registry_newspapers(registry, states).groupBy("disaster_id", "lang_code", "region").agg(*aggregates)
    key = lambda r: [str(x) for x in r]
    assert sorted(found.collect(), key=key) == sorted(plain.select(*found.columns).collect(), key=key)
    assert found.count() == 2 * 290
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)
    assert "Aggregate" not in below[0] and "name#" not in below[0].replace("first#", "")


def test_postings_do_not_pass_through_the_driver(spark, tmp_path):
    """Postings of few distinct words are tiny as a file; joined by broadcast, their rows would fill the driver."""
    spark.range(5000).selectExpr("id AS doc_id", "'heavy rain' AS text", "date'2024-01-01' AS date").write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    queries = spark.createDataFrame([(0, "heavy rain", dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "query_id long, query string, since date, until date")
    for wanted, mode in ((queries, "all"), (queries.select("query_id", "query"), "all"), (queries, "phrase")):
        found = M.match_queries(wanted, corpus, mode)
        assert found.count() == 5000
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["all", "phrase"])
def test_match_against_brute_force(spark, mode):
    docs = [(i, " ".join(w for j, w in enumerate("red storm blue rain green flood".split()) if i >> j & 1) + "\nhot  Hot") for i in range(64)]
    queries = [(0, "red rain"), (1, "storm blue OR green flood"), (2, "hot hot"), (3, "missing red"), (4, ""), (5, "Hot"), (6, "rain OR flood")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(queries, "query_id long, query string")
    got = sorted((r["query_id"], r["doc_id"]) for r in M.match_queries(table, corpus, mode, salts=3).collect())
    expected = []
    for q, text in queries:
        for d, doc in docs:
            tokens = doc.lower().split()
            hit = False
            for alt in text.split(" OR "):
                terms = alt.lower().split()
                if not terms:
                    continue
                if mode == "all":
                    hit |= all(t in tokens for t in terms)
                else:
                    hit |= any(tokens[i:i + len(terms)] == terms for i in range(len(tokens)))
            if hit:
                expected.append((q, d))
    assert got == sorted(expected)


def test_matching_ignores_punctuation_around_words(spark):
    docs = [(0, "Cyclone, coast"), (1, "The (cyclone) hit the «coast»."), (2, "cyclone-coast"), (3, "coast\ncyclone!"), (4, "ÉTÉ, été")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame([(0, "cyclone coast"), (1, "(Été)"), (2, "...")], "query_id long, query string")
    got = lambda mode: sorted((r["query_id"], r["doc_id"]) for r in M.match_queries(queries, corpus, mode).collect())
    assert got("all") == [(0, 0), (0, 1), (0, 3), (1, 4)]
    assert got("phrase") == [(0, 0), (1, 4)]


def test_phrases_move_no_text_and_do_not_cross_texts(spark):
    docs = [(1, "a heavy"), (1, "rain x heavy"), (2, "heavy rain heavy rain"), (3, "rain heavy"), (3, "x heavy rain"), (4, None), (2, "heavy rain heavy rain")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame([(0, "heavy rain"), (1, "rain heavy rain"), (2, "heavy heavy OR x heavy rain")], "query_id long, query string")
    found = M.match_queries(queries, corpus, "phrase")
    assert sorted((r["query_id"], r["doc_id"]) for r in found.collect()) == [(0, 2), (0, 3), (1, 2), (2, 3)]
    assert not re.search(r"(?<!_)text#", found._jdf.queryExecution().optimizedPlan().toString())  # only the queries


@pytest.mark.parametrize("mode", ["all", "phrase"])
def test_windows_of_queries(spark, mode):
    """Windows inside a span, over borders, of one day, turned round, open, far outside and over all time."""
    day = lambda n: None if n is None else dt.date(1969, 11, 1) + dt.timedelta(days=n)
    docs = [(i, "heavy rain" if i % 3 else "rain heavy", day(i * 7 % 150 if i % 11 else None)) for i in range(200)]
    windows = [(a, b) for a in (0, 15, 44, 61, 76) for b in (0, 15, 60, 61, 92, 149)] + [(None, 9), (9, None), (900, 990)]
    queries = [(k, "heavy rain OR rain", day(a), day(b)) for k, (a, b) in enumerate(windows)] + [(99, "heavy", dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    corpus = spark.createDataFrame(docs, "doc_id long, text string, date date")
    table = spark.createDataFrame(queries, "query_id long, query string, since date, until date")
    got = sorted((r["query_id"], r["doc_id"]) for r in M.match_queries(table, corpus, mode, salts=3).collect())
    inside = lambda d, a, b: d is not None and a is not None and b is not None and a <= d <= b
    assert got == sorted((q, i) for q, _, a, b in queries for i, _, d in docs if inside(d, a, b))
    stamped = corpus.withColumn("date", F.timestamp_seconds(F.unix_date("date").cast("long") * 86400 + 3600))
    late = sorted((r["query_id"], r["doc_id"]) for r in M.match_queries(table, stamped, mode, salts=3).collect())
    assert late == sorted((q, i) for q, _, a, b in queries for i, _, d in docs if inside(d, a, b) and d < b)
    assert M.match_queries(table, corpus.limit(0), mode).count() == 0


def test_days_that_no_query_asks_for_are_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "MOST_RANGES", 2)
    folder = str(tmp_path / "corpus")
    spark.range(400).selectExpr("id AS doc_id", "'rain' AS text", "date_add(date'2020-01-01', CAST(id AS INT)) AS date").write.partitionBy("date").parquet(folder)
    corpus = spark.read.parquet(folder)
    queries = [(0, "rain", dt.date(2020, 2, 1), dt.date(2020, 2, 3)), (1, "rain", dt.date(2020, 3, 20), dt.date(2020, 3, 21)), (2, "rain", dt.date(2020, 12, 1), dt.date(2020, 12, 2))]
    table = spark.createDataFrame(queries, "query_id long, query string, since date, until date")
    *_, spans = M._asked_spans(table, corpus)
    read = corpus.filter(M._in_spans(F.col("date"), spans))
    assert re.search(r"PartitionFilters: \[[^]]*date#", read._jdf.queryExecution().toString())
    days = sorted(r["date"] for r in read.select("date").distinct().collect())
    # Two ranges: the narrow gap is read as well, the wide one is not.
    assert len(days) < 110 and max(days) < dt.date(2020, 12, 20) and not any(dt.date(2020, 5, 1) < d < dt.date(2020, 11, 10) for d in days)
    assert sorted((r["query_id"], r["doc_id"]) for r in M.match_queries(table, corpus).collect()) == [(0, 31), (0, 32), (0, 33), (1, 79), (1, 80), (2, 335), (2, 336)]


def test_upserts_keep_the_best_and_bear_repetition(spark, tmp_path):
    import random

    from presslake.streaming import upserts

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]) if k % 3 else "hot", rng.randint(0, 3), k) for k in range(400)]
    schema = "key string, grade int, ord long"
    order = [F.col("grade").desc(), F.col("ord")]
    root = str(tmp_path)
    assert upserts.stored(spark, root, spark.createDataFrame([], schema).schema).count() == 0
    seen = []
    for number in range(4):
        part = rows[number::4]
        seen += part
        best = {}
        for key, grade, ord_ in seen:
            best[key] = min(best.get(key, (99, 0)), (-grade, ord_))
        for _ in range(2):  # a batch that is repeated changes nothing
            upserts.merge(spark.createDataFrame(part, schema), number, root, ["key"], order, 3)
            got = upserts.stored(spark, root, spark.createDataFrame([], schema).schema).collect()
            assert {(r["key"], r["grade"], r["ord"]) for r in got} == {(k, -g, o) for k, (g, o) in best.items()} and len(got) == len(best)
    # Written, but not yet in a manifest: readers do not see it.
    spark.createDataFrame([("a", 9, 1)], schema).write.parquet(f"{root}/rows/batch=9/bucket=0")
    assert upserts.stored(spark, root, spark.createDataFrame([], schema).schema).filter("grade = 9").count() == 0


def test_a_link_in_any_column(spark, tmp_path):
    header = [f"c{k}" for k in range(90)]
    header[71] = "link"
    (tmp_path / "wide.csv").write_text(",".join(header) + "\n" + ",".join("https://a.example.com" if h == "link" else '"x, y"' for h in header) + "\n")
    (tmp_path / "small.csv").write_text("title,link\nT,https://b.example.com\n")
    assert sorted(r["link"] for r in readers.read_metadata(spark, str(tmp_path)).collect()) == ["https://a.example.com", "https://b.example.com"]
    assert readers.metadata_errors(spark, str(tmp_path)).count() == 0


def test_the_newest_statistics_are_found_without_reading_the_others(spark, tmp_path):
    import os

    for k, name in enumerate(["a_stats.json", "B [x]_STATS.json", "sub/part-0.json", "newer.json"]):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps({"n": k}))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    (tmp_path / "none").mkdir()
    found = readers.latest_stats(spark, str(tmp_path))
    row = found.collect()
    assert [r["stats"] for r in row] == ['{"n": 1}'] and found.columns == ["file", "modified", "stats"]
    assert row[0]["modified"].timestamp() % 10 == 1
    assert found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == 1
    assert readers.latest_stats(spark, str(tmp_path / "none")).count() == 0


def plain_state(rows):
    """State of a key after its requests ``(ts, request_id, success, severe)``, by a loop."""
    import datetime as dt

    requests, successes, streak, last_success, last_failure, blocked_until = 0, 0, 0, None, None, None
    for ts, _, ok, severe in sorted(rows):
        requests += 1
        if ok:
            successes, streak, last_success, blocked_until = successes + 1, 0, ts, None
        else:
            streak, last_failure = streak + 1, ts
            if severe:
                blocked_until = ts + dt.timedelta(seconds=min(300, 30 * streak))
    return requests, successes, streak, last_success, last_failure, blocked_until


def test_health_state_is_the_same_in_any_split(spark, tmp_path):
    import datetime as dt
    import random

    from presslake.streaming import upserts

    rng, clock, rows = random.Random(3), dt.datetime(2024, 1, 1), []
    for k in range(900):
        clock += dt.timedelta(seconds=rng.choice([0, 0, 1, 60]))
        ok = rng.random() < 0.2
        key = "hot" if k % 3 else rng.choice(["a", "b", "c", None])
        rows.append((k, None if k % 50 == 7 else clock, key, None if k % 40 == 3 else ok, None if ok else rng.choice(["ssl_error", "not_found", "not_found", None]), k))
    rows += [(900 + k, clock + dt.timedelta(seconds=k), ["late", "stuck"][k % 2], k == 0, ["not_found", "ssl_error"][k % 4 > 2], 0) for k in range(8)]
    schema = "request_id long, ts timestamp, state_key string, success boolean, error_type string, blocked_until int"
    expected = {}
    for r in rows:
        if r[2] is not None and r[1] is not None:
            expected.setdefault(r[2], []).append((r[1], r[0], bool(r[3]), r[3] is False and r[4] == "ssl_error"))
    expected = {key: plain_state(own) for key, own in expected.items()}
    assert any(e[5] for e in expected.values())
    for parts, cuts in enumerate([[], [450], [5, 6, 30, 31, 100, 600, 899, 904]]):
        root, bounds = str(tmp_path / str(parts)), [0, *cuts, len(rows)]
        assert health.latest_state(spark, root).count() == 0
        for number, (low, high) in enumerate(zip(bounds, bounds[1:])):
            for _ in range(1 + (number == 2)):  # a batch that is repeated changes nothing
                new = health.summaries(spark.createDataFrame(rows[low:high], schema))
                upserts.rewrite(new, number, root, ["state_key"], health.advanced, 3, health.STATE)
        got = {r["state_key"]: tuple(r)[1:] for r in health.latest_state(spark, root).collect()}
        assert got == expected
        over = health.latest_state(spark, root, F.lit("2100-01-01").cast("timestamp")).filter("blocked_until IS NOT NULL")
        assert over.count() == 0


def test_health_keeps_requests_out_of_single_tasks(spark):
    schema = "request_id long, ts timestamp, state_key string, success boolean, error_type string"
    plan = health.summaries(spark.createDataFrame([], schema))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Window|Cartesian", plan) and "partial_max" in plan


def test_live_counts_of_repeated_batches(spark, tmp_path):
    from presslake.operators import stats
    from presslake.streaming import collection

    landing, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    conditions = {"found": F.lit(True), "long text": F.length("text") > 3}
    rows = spark.createDataFrame([(k, None if k % 5 == 0 else "x" * (k % 7)) for k in range(200)], "id long, text string")
    for part in range(2):
        rows.filter(F.col("id") % 2 == part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        collection.write_counted(stream, root, state, conditions).trigger(availableNow=True).start().awaitTermination()
    got = {r["batch"]: (r["found"], r["long text"]) for r in collection.live_counts(spark, root, conditions).collect()}
    whole = stats.funnel(rows, conditions).first()
    assert got[0][0] == got[1][0] == 100 and sum(g[1] for g in got.values()) == whole["long text"]
    assert spark.read.parquet(f"{root}/rows").count() == 200
    # A batch whose end was not noted is done once more, into the same folders.
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "state" / name).unlink()
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    collection.write_counted(stream, root, state, conditions).trigger(availableNow=True).start().awaitTermination()
    assert {r["batch"]: (r["found"], r["long text"]) for r in collection.live_counts(spark, root, conditions).collect()} == got


def test_requests_without_key_or_time_stay(spark):
    schema = "request_id long, ts timestamp, state_key string, success boolean, error_type string"
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(1, at, "a", False, None), (2, None, "a", False, None), (3, at, None, True, None)], schema)
    assert {r["request_id"]: r["streak"] for r in H.failure_streak(log).collect()} == {1: 1, 2: None, 3: None}
    assert H.recent_failure_rate(log, 1).count() == 3
    rows = {r["state_key"]: r["requests"] for r in H.request_statistics(log).collect()}
    assert rows == {"a": 2, None: 1, "total": 3}


def test_metadata_by_header(spark, tmp_path):
    """Columns in another order, more and fewer columns; a file without links is named, not lost."""
    day = tmp_path / "2025" / "10" / "30"
    day.mkdir(parents=True)
    (day / "a.csv").write_text("link,more,Title\nhttps://a.example.com,x,A\n")
    (day / "b.csv").write_text('title,link,date\n"B, b",https://b.example.com,2025-10-30 00:00:00\n')
    (day / "c.csv").write_text("name,address\nC,https://c.example.com\n")
    rows = readers.read_metadata(spark, str(tmp_path)).collect()
    assert sorted((r["title"], r["link"], r["date"]) for r in rows) == [("A", "https://a.example.com", None), ("B, b", "https://b.example.com", "2025-10-30 00:00:00")]
    assert [(r["file"].rsplit("/", 1)[1], r["header"]) for r in readers.metadata_errors(spark, str(tmp_path)).collect()] == [("c.csv", ["name", "address"])]
