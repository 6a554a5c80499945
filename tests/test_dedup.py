from pyspark.sql import functions as F

from presslake.operators import dedup as D, stats as S


def articles(spark, rows):
    """Rows of (url, grade, text)."""
    data = [("d", i, f"t{i % 3}", u, g, t) for i, (u, g, t) in enumerate(rows)]
    return spark.createDataFrame(
        data, "disaster_id string, ord long, title string, normalized_url string, extraction_quality string, article_text string"
    )


def kept(frame):
    return sorted(r["ord"] for r in frame.collect())


def test_grades(spark):
    rows = [("a", "low", ""), ("a", "high", ""), ("b", "medium", ""), ("b", "low", ""), ("b", "high", ""),
            ("c", "high", ""), ("c", "low", ""), ("", "low", ""), ("", "low", ""), (None, "low", "")]
    table = articles(spark, rows)
    assert kept(D.dedup_url(table)) == [1, 4, 5, 7, 8, 9]
    assert kept(D.dedup_url(table, "running")) == [0, 1, 2, 4, 5, 7, 8, 9]


def test_content(spark):
    text = "Some text " * 60
    rows = [("a", "low", text), ("b", "low", text.upper()), ("c", "low", text[:500] + "tail"), ("d", "low", "short"),
            ("e", "low", "short"), ("f", "low", None), ("g", "low", "x" * 99), ("h", "low", "x" * 100), ("i", "low", "x" * 100)]
    table = articles(spark, rows)
    assert kept(D.dedup_content(table)) == [0, 3, 4, 5, 6, 7]


def test_idempotent_and_skewed(spark):
    table = spark.range(30_000).select(
        F.lit("d").alias("disaster_id"), F.col("id").alias("ord"), F.lit("t").alias("title"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 4001).cast("string")).alias("normalized_url"),
        F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), (F.col("id") % 5 % 3 + 1).cast("int")).alias("extraction_quality"),
        F.repeat(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 977).cast("string")), 50).alias("article_text"),
    )
    for dedup in (D.dedup_url, lambda t: D.dedup_url(t, "running"), D.dedup_content):
        once = dedup(table)
        first = kept(once)
        if dedup is D.dedup_content or dedup is D.dedup_url:
            assert kept(dedup(once)) == first
            plan = once._jdf.queryExecution().executedPlan().toString()
            # Each task reduces its own part of a group to narrow rows before the shuffle; no group is sorted.
            assert "partial_min" in plan and "Window" not in plan
    assert kept(D.dedup_articles(table)) == kept(D.dedup_content(D.dedup_url(table)))
    report = D.dedup_report(table).first()
    urls = D.dedup_url(table)
    assert report["original_count"] - report["url_duplicates_removed"] == urls.count()
    assert report["final_count"] == D.dedup_content(urls).count()


def test_batch(spark):
    rows = [("f", 0, "https://A.com/x"), ("f", 1, " https://a.com/X "), ("g", 2, "https://a.com/x"),
            ("f", 3, "https://twitter.com/x"), ("f", 4, "https://twitter.com/x"), ("f", 5, None)]
    table = spark.createDataFrame(rows, "file string, ord long, link string")
    got = {r["ord"]: r["status"] for r in D.dedup_batch_urls(table).collect()}
    assert got == {0: "process", 1: "duplicate", 2: "process", 3: "skipped", 4: "skipped", 5: "skipped"}


def test_statistics(spark):
    rows = [("en", "high", "2024-01-01 10:00:00", "", "k"), (None, None, None, "NaN", "k"), ("en", "low", "2024-01-01", "x", "")]
    table = spark.createDataFrame(
        [("d", a, q, (d, l, k)) for a, q, d, l, k in rows],
        "disaster_id string, article_language string, extraction_quality string,"
        " metadata struct<csv_date: string, csv_location: string, csv_keyword: string>",
    )
    got = {(r["dimension"], r["key"]): r["n"] for r in S.article_statistics(table).collect()}
    assert got == {
        ("total", "all"): 3, ("language", "en"): 2, ("language", "unknown"): 1, ("quality", "high"): 1, ("quality", "low"): 1,
        ("quality", "unknown"): 1, ("date", "2024-01-01"): 2, ("location", "x"): 1, ("keyword", "k"): 2,
    }
    shares = S.distribution(table, "article_language").collect()
    assert [(r["value"], r["n"]) for r in shares] == [("en", 2), ("unknown", 1)]
    assert abs(sum(r["percentage"] for r in shares) - 100) < 1e-9
