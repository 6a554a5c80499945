"""Writers and readers, checked by writing rows of the driver tables and reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.articles import BEST, stages
from presslake.catalog.health import BLOCKS
from presslake.catalog.inputs import ARTICLES, CONFIGS, LINKS, LOG, articles, configs, links, request_log
from presslake.catalog.matching import AS_OF, ENTRIES, feed_entries, planned
from presslake.catalog.registry import query, table
from presslake.functions.text import quality_rank
from presslake.operators import stats
from presslake.sources import readers, writers
from presslake.sources.schemas import FEED, METADATA_COLUMNS
from presslake.sources.workspace import new_path
from presslake.streaming import collection, health, upserts

# ---------------------------------------------------------------- metadata


def metadata_rows(spark, sf_dir):
    """Rows of three disasters on the first day of each month; a third of the links share one address."""
    i = F.col("ord")
    stamp = F.concat(F.date_format(F.trunc(F.col("ts").cast("date"), "month"), "yyyy-MM-dd"), F.lit(" 09:00:00"))
    fields = {
        "title": F.concat(F.lit('A "quoted", title '), i.cast("string")),
        "link": F.when(i % 3 == 0, "https://front.example.com/").otherwise(F.col("link")),
        "date": F.when(i % 13 == 0, "unknown").otherwise(stamp),
        "hazard": F.lit("Storm"),
        "disaster_id": F.concat(F.lit("ev-"), (i % 3).cast("string")),
    }
    return links(spark, sf_dir).select("ord", *[fields.get(c, F.lit("")).alias(c) for c in METADATA_COLUMNS])


DAILY = f"""{LINKS}, rows0 AS (SELECT ord, 'ev-' || (ord % 3) AS disaster_id, 'A "quoted", title ' || ord AS title, date_trunc('month', ts)::DATE AS day,
      CASE WHEN ord % 3 = 0 THEN 'https://front.example.com/' ELSE link END AS link FROM links WHERE ord % 13 <> 0),
  daily AS (SELECT * FROM rows0 QUALIFY row_number() OVER (PARTITION BY disaster_id, day, link ORDER BY ord) = 1)"""


@query(f"WITH {DAILY} SELECT ord, disaster_id, link, strftime(day, '%Y-%m-%d') AS day FROM daily")
def dedup_links_per_day(spark, sf_dir):
    out = writers.daily_rows(metadata_rows(spark, sf_dir))
    return out.select("ord", "disaster_id", "link", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(f"WITH {DAILY} SELECT disaster_id, title, link, strftime(day, '%Y-%m-%d') AS day, NULL::VARCHAR AS summary FROM daily")
def write_metadata(spark, sf_dir):
    """Day folders written twice (the second time they replace themselves) and read back."""
    root = new_path(spark, "metadata")
    writers.write_metadata(metadata_rows(spark, sf_dir), root)
    writers.write_metadata(metadata_rows(spark, sf_dir).filter("disaster_id = 'ev-1'"), root)
    out = readers.read_metadata_days(spark, root)
    return out.select("disaster_id", "title", "link", F.date_format("day", "yyyy-MM-dd").alias("day"), "summary")


@query(f"WITH {DAILY} SELECT title, link, disaster_id, strftime(day, '%Y-%m-%d') AS day FROM daily WHERE day BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'")
def read_metadata(spark, sf_dir):
    """All CSV files below a written root by their headers, kept by the date in their path."""
    root = new_path(spark, "metadata")
    writers.write_metadata(metadata_rows(spark, sf_dir), root)
    days = readers.read_metadata(spark, root, ("1997-01-01", "1998-06-30"))
    return days.select("title", "link", "disaster_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(f"""WITH {LINKS} SELECT link, 'A "quoted", title ' || ord AS title, CASE WHEN ord % 3 = 0 THEN 'Storm' END AS hazard, '2024-05-0' || (ord % 3 + 1) AS day FROM links WHERE ord % 3 <> 2""")
def read_metadata_tree(spark, sf_dir):
    """Folders by year, month and day whose files name their columns in other orders, more or fewer; one has no link."""
    root = new_path(spark, "tree")
    plain = links(spark, sf_dir).select("ord", F.col("link").alias("plain"))
    rows = metadata_rows(spark, sf_dir).drop("link").join(plain.withColumnRenamed("plain", "link"), "ord")
    for kind, columns in enumerate((["extra", "hazard", "link", "title"], ["title", "link"], ["title", "date"])):
        part = rows.filter(F.col("ord") % 3 == kind).withColumn("extra", F.lit("x,\n y"))
        part.select(*columns).write.option("header", True).option("escape", '"').csv(f"{root}/k{kind}/2024/05/{kind + 1:02d}")
    return readers.read_metadata(spark, root).select("link", "title", "hazard", F.date_format("day", "yyyy-MM-dd").alias("day"))


# ---------------------------------------------------------------- articles and statistics


@query(f"WITH {ARTICLES} SELECT ord::VARCHAR AS id, extraction_quality, article_language, csv_date, nullif(csv_location, '') AS csv_location, length(article_text) AS n FROM articles WHERE extraction_quality <> 'low'")
def write_articles(spark, sf_dir):
    """Articles by grade, of which the combined output reads two folders."""
    root = new_path(spark, "articles")
    rows = articles(spark, sf_dir).withColumns(
        {"id": F.col("ord").cast("string"), "original_url": F.col("final_url"), "extraction_timestamp": F.lit(None).cast("string")}
    )
    writers.write_articles(rows, root)
    out = writers.read_written_articles(spark, root, "combined")
    return out.select(
        "id", "extraction_quality", "article_language", "metadata.csv_date",
        F.nullif("metadata.csv_location", F.lit("")).alias("csv_location"), F.length("article_text").alias("n"),
    )


@query(f"WITH {ARTICLES} SELECT ord::VARCHAR AS id, title, extraction_quality FROM articles")
def read_articles(spark, sf_dir):
    root = new_path(spark, "articles")
    rows = articles(spark, sf_dir).withColumns(
        {"id": F.col("ord").cast("string"), "original_url": F.col("final_url"), "extraction_timestamp": F.lit(None).cast("string")}
    )
    writers.write_articles(rows, root)
    return readers.read_articles(spark, root, prefix="grade=").select("id", "title", "extraction_quality")


@query(f"WITH {ARTICLES} SELECT extraction_quality, ord FROM articles WHERE extraction_quality IN ('high', 'medium')")
def combined_articles(spark, sf_dir):
    return writers.combined(articles(spark, sf_dir).select("extraction_quality", "ord"))


@query(f"WITH {ARTICLES} SELECT ord::VARCHAR AS id, disaster_id, extraction_quality FROM articles WHERE disaster_id <> 'ev-2' OR extraction_quality = 'high'")
def write_events(spark, sf_dir):
    """Events written one after the other into one root; each replaces only its own grades."""
    root = new_path(spark, "articles")
    rows = articles(spark, sf_dir).withColumns(
        {"id": F.col("ord").cast("string"), "original_url": F.col("final_url"), "extraction_timestamp": F.lit(None).cast("string")}
    )
    writers.write_articles(rows.filter("disaster_id <> 'ev-2'"), root)
    writers.write_articles(rows.filter("disaster_id = 'ev-2' AND extraction_quality = 'high'"), root)
    return writers.read_written_articles(spark, root).select("id", "disaster_id", "extraction_quality")


@query(f"""WITH {ARTICLES} SELECT disaster_id, count(*) AS total_articles, count(*) FILTER (extraction_quality = 'low') AS low, '2024-05-05 00:00:00' AS extraction_timestamp FROM articles GROUP BY 1""")
def write_stats(spark, sf_dir):
    """Statistics objects as JSON, read back from the newest files of the folder."""
    path = new_path(spark, "extraction_stats") + "/stats"
    writers.write_stats(stats.article_statistics(articles(spark, sf_dir)), path, F.lit("2024-05-05 00:00:00"))
    return readers.read_stats(spark, path).select(
        "disaster_id", "total_articles", F.coalesce(F.try_element_at("by_quality", F.lit("low")), F.lit(0)).alias("low"), "extraction_timestamp"
    )


@query("SELECT 2 AS files, count(*) AS n FROM documents WHERE doc_id % 2 = 1")
def latest_stats(spark, sf_dir):
    """The later of two statistics files."""
    root = new_path(spark, "stats")
    docs = table(spark, sf_dir, "documents")
    for i in (0, 1):
        counted = docs.filter(F.col("doc_id") % 2 == i).agg(F.count(F.lit(1)).alias("total_articles"))
        counted.write.option("maxRecordsPerFile", 1).json(f"{root}/run{i}_stats")
    newest = readers.latest_stats(spark, root)
    return newest.select(
        (F.regexp_extract("file", r"run(\d)_stats", 1).cast("int") + 1).alias("files"),
        F.get_json_object("stats", "$.total_articles").cast("long").alias("n"),
    )


@query(f"WITH {CONFIGS}, {ENTRIES} SELECT ord, title, summary, source FROM entries")
def read_feed(spark, sf_dir):
    path = new_path(spark, "feed")
    feed_entries(spark, sf_dir).write.json(path)
    return readers.read_feed(spark, path).select("ord", "title", "summary", F.col("source.title").alias("source"))


@query("SELECT page_id, url, length(html) AS n FROM pages WHERE page_id % 4 <> 1")
def read_pages(spark, sf_dir):
    path = new_path(spark, "pages")
    pages = table(spark, sf_dir, "pages")
    pages.withColumn("status", F.when(F.col("page_id") % 4 == 1, 503).otherwise(200)).write.parquet(path)
    return readers.read_pages(spark, path).select("page_id", "url", F.length("html").alias("n"))


# ---------------------------------------------------------------- streams


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


@query(f"WITH {CONFIGS}, {ENTRIES} SELECT DISTINCT disaster_id, lower(link) AS link FROM inside")
def incremental_collection(spark, sf_dir):
    """The feed as a stream: dated, joined, filtered, deduplicated and written by day."""
    landing, root, state = (new_path(spark, n) for n in ("feed", "days", "state"))
    feed_entries(spark, sf_dir).write.json(landing)
    entries = spark.readStream.schema(FEED).json(landing)
    rows = collection.stream_rows(entries, planned(spark, sf_dir), configs(spark, sf_dir), F.lit(AS_OF).cast("date"))
    _run(collection.write_days(rows, root, state))
    return readers.read_metadata_days(spark, root).select("disaster_id", F.lower("link").alias("link"))


@query(f"WITH {ARTICLES}, {BEST} SELECT disaster_id, ord, normalized_url, extraction_quality FROM best")
def upsert_articles(spark, sf_dir):
    """Articles over three runs of a stream, worse copies first; the table has the best copy of each address over all runs."""
    landing, root, state = (new_path(spark, n) for n in ("feed", "best", "state"))
    rows = articles(spark, sf_dir).select("disaster_id", "ord", "normalized_url", "extraction_quality")
    own = F.when(F.col("normalized_url") == "", F.col("ord"))  # rows without an address are no copies of each other
    for grade in ("low", "medium", "high"):
        rows.filter(F.col("extraction_quality") == grade).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing).withColumn("own", own)
        _run(upserts.upsert(stream, root, state, ["disaster_id", "normalized_url", "own"], [quality_rank(F.col("extraction_quality")).desc(), F.col("ord")], 8))
    return upserts.stored(spark, root, stream.schema).drop("own")


@query(f"""WITH {ARTICLES} SELECT extraction_quality, count(*) AS found, count(*) FILTER (length(article_text) > 200) AS with_body, count(*) FILTER (extraction_quality <> 'low') AS usable,
    count(*) FILTER (normalized_url <> '') AS with_address FROM articles GROUP BY 1""")
def live_funnel(spark, sf_dir):
    """Articles over three runs of a stream, one grade each: what each micro-batch counted while it was written."""
    landing, root, state = (new_path(spark, n) for n in ("feed", "counted", "state"))
    rows = articles(spark, sf_dir).select("ord", "article_text", "extraction_quality", "normalized_url")
    for grade in ("low", "medium", "high"):
        rows.filter(F.col("extraction_quality") == grade).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        _run(collection.write_counted(stream, root, state, stages()))
    grades = spark.read.parquet(f"{root}/rows").groupBy("batch").agg(F.max("extraction_quality").alias("extraction_quality"))
    return collection.live_counts(spark, root, stages()).join(grades, "batch").groupBy("extraction_quality").agg(*[F.sum(n).alias(n) for n in stages()])


_TS = "'%Y-%m-%d %H:%M:%S.%f'"


@query(f"""WITH {BLOCKS}, ends AS (SELECT state_key, arg_max(streak, struct_pack(ts, request_id)) AS streak, max(struct_pack(ts, request_id)) FILTER (success) AS ok, count(*) AS requests,
      count(*) FILTER (success) AS successes, max(ts) FILTER (success) AS s, max(ts) FILTER (NOT success) AS f FROM streaks GROUP BY 1),
  last_block AS (SELECT state_key, max(struct_pack(ts := blocked_from, request_id := request_id)) AS b, arg_max(planned, struct_pack(blocked_from, request_id)) AS until FROM blocks GROUP BY 1)
  SELECT state_key, requests, successes, streak, strftime(s, {_TS}) AS last_success, strftime(f, {_TS}) AS last_failure,
    CASE WHEN ok IS NULL OR b > ok THEN strftime(until, {_TS}) END AS blocked_until FROM ends LEFT JOIN last_block USING (state_key)""")
def request_health(spark, sf_dir):
    """Health state kept over three runs of a stream; it equals the state computed from the whole log."""
    landing, root, state = (new_path(spark, n) for n in ("log", "health", "state"))
    log = request_log(spark, sf_dir)
    bounds = ["2024-01-01", "2024-01-10", "2024-01-20", "2100-01-01"]
    for low, high in zip(bounds, bounds[1:]):
        part = log.filter((F.col("ts") >= F.lit(low).cast("timestamp")) & (F.col("ts") < F.lit(high).cast("timestamp")))
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(log.schema).parquet(landing)
        _run(health.keep_health(stream, root, state))
    out = health.latest_state(spark, root)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return out.select("state_key", "requests", "successes", "streak", text("last_success"), text("last_failure"), text("blocked_until"))


@query(f"WITH {LOG} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, state_key, count(*) AS requests, count(*) FILTER (success) AS successes FROM log GROUP BY ALL")
def hourly_success_rate(spark, sf_dir):
    """The log as a stream; hours are given out when the watermark has passed them, the last ones by a later row."""
    landing, root, state = (new_path(spark, n) for n in ("log", "hours", "state"))
    log = request_log(spark, sf_dir)
    log.write.parquet(landing)
    closing = log.agg((F.max("ts") + F.expr("INTERVAL 3 HOURS")).alias("ts")).withColumn("state_key", F.lit("closing"))
    for _ in range(2):
        stream = spark.readStream.schema(log.schema).parquet(landing)
        rates = health.hourly_success_rate(stream)
        _run(rates.writeStream.outputMode("append").format("parquet").option("path", root).option("checkpointLocation", state))
        log.limit(0).unionByName(closing, allowMissingColumns=True).write.mode("append").parquet(landing)
    out = spark.read.parquet(root).filter("state_key <> 'closing'")
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))
