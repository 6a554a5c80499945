"""Queries against a corpus, feed entries and their joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.inputs import CONFIGS, LINKS, configs, links, request_log, sql_words
from presslake.catalog.health import STREAKS
from presslake.catalog.registry import query, table
from presslake.functions.text import words
from presslake.operators import matching as M
from presslake.operators.articles import all_metadata
from presslake.operators.querygen import smart_queries
from presslake.operators.querygen import query_id as make_query_id
from presslake.sources.schemas import METADATA_COLUMNS

_RAW = sql_words("lower(text)")


def _bare(words_: str) -> str:
    """The words of a list without the punctuation around them."""
    around = "^[^\\p{L}\\p{M}\\p{N}]+|[^\\p{L}\\p{M}\\p{N}]+$"
    return f"list_filter(list_transform({words_}, lambda w: regexp_replace(w, '{around}', '', 'g')), lambda w: w <> '')"


_W = _bare(_RAW)


def _groups(size: int) -> str:
    return f"unnest(list_transform(range(1, len(raw) + 1, {size}), lambda i: list_distinct({_bare(f'raw[i:i + {size - 1}]')})))"


def _query_text(size: int):
    """The whole text, cut into alternatives of some words."""
    w = words(F.col("text"))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(size)), lambda i: F.array_join(F.slice(w, i, size), " ")), " OR ")


@query(f"""WITH b AS (SELECT item_id, {_RAW} AS raw FROM benchmark), q AS (SELECT item_id, {_groups(6)} AS terms FROM b),
  d AS (SELECT doc_id, list_distinct({_W}) AS tokens FROM documents)
  SELECT DISTINCT item_id AS query_id, doc_id FROM q JOIN d ON len(terms) > 0 AND list_has_all(tokens, terms)""")
def match_queries(spark, sf_dir):
    """Whole passages as alternatives of six words each, every word anywhere in the document."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), _query_text(6).alias("query"))
    return M.match_queries(queries, table(spark, sf_dir, "documents"))


@query(f"""WITH b AS (SELECT item_id, {_RAW} AS raw, DATE '2024-01-01' + (item_id % 20)::INT AS since FROM benchmark), q AS (SELECT item_id, since, {_groups(5)} AS terms FROM b),
  d AS (SELECT doc_id, list_distinct({_W}) AS tokens, DATE '2024-01-01' + (doc_id % 60)::INT AS day FROM documents)
  SELECT DISTINCT item_id AS query_id, doc_id FROM q JOIN d ON len(terms) > 0 AND list_has_all(tokens, terms) AND day BETWEEN since AND since + 30""")
def match_queries_dated(spark, sf_dir):
    """Alternatives of five words, within a look-back window per query."""
    start = F.lit("2024-01-01").cast("date")
    since = F.date_add(start, (F.col("item_id") % 20).cast("int"))
    queries = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), _query_text(5).alias("query"), since.alias("since"), F.date_add(since, 30).alias("until"),
    )
    corpus = table(spark, sf_dir, "documents").withColumn("date", F.date_add(start, (F.col("doc_id") % 60).cast("int")))
    return M.match_queries(queries, corpus)


_NORM = f"' ' || array_to_string({_W}, ' ') || ' '"


@query(f"""WITH q AS (SELECT item_id AS query_id, {_NORM} AS t FROM benchmark), d AS (SELECT doc_id, {_NORM} AS t FROM documents)
  SELECT query_id, doc_id FROM q JOIN d ON contains(d.t, q.t)""")
def match_queries_phrase(spark, sf_dir):
    """Documents that contain a whole benchmark passage."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return M.match_queries(queries, table(spark, sf_dir, "documents"), "phrase")


_COVER = """keys AS (SELECT DISTINCT user_id AS query_id, 'q' || user_id AS query, 'c' || (event_id % 3) AS country FROM events),
  hits AS (SELECT user_id AS query_id, 'c' || (event_id % 3) AS country, event_id AS ord, event_type || event_id AS title FROM events WHERE event_type = 'click' AND user_id % 10 <> 4),
  coverage AS (SELECT query_id, country, any_value(query) AS query, count(ord) AS n, array_to_string(list(title ORDER BY ord) FILTER (ord IS NOT NULL)[1:3], '|') AS samples
    FROM keys LEFT JOIN hits USING (query_id, country) GROUP BY ALL)"""


def _coverage(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    country = F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string"))
    keys = events.select(F.col("user_id").alias("query_id"), F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("query"), country.alias("country")).distinct()
    hits = events.filter("event_type = 'click' AND user_id % 10 <> 4").select(
        F.col("user_id").alias("query_id"), country.alias("country"), F.col("event_id").alias("ord"),
        F.concat("event_type", F.col("event_id").cast("string")).alias("title"),
    )
    return M.query_coverage(keys, hits)


@query(f"WITH {_COVER} SELECT query_id, country, query, n, coalesce(samples, '') AS samples FROM coverage")
def query_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir).withColumn("samples", F.array_join("samples", "|"))


@query(f"WITH {_COVER} SELECT count(*) AS combinations, count(DISTINCT query) AS queries, array_to_string(list_sort(list(DISTINCT country)), ',') AS countries FROM coverage WHERE n > 0")
def coverage_totals(spark, sf_dir):
    return M.coverage_totals(_coverage(spark, sf_dir)).withColumn("countries", F.array_join("countries", ","))


@query("""WITH e AS (SELECT user_id AS query_id, (event_id % 3)::INT AS country_ord, event_id AS ord FROM events WHERE NOT (user_id % 3 = 0 AND event_id % 3 = 0) AND NOT (user_id % 5 = 0 AND event_id % 3 < 2))
  SELECT query_id, country_ord, ord FROM e QUALIFY country_ord = min(country_ord) OVER (PARTITION BY query_id)""")
def first_country_with_results(spark, sf_dir):
    entries = table(spark, sf_dir, "events").filter(
        "NOT (user_id % 3 = 0 AND event_id % 3 = 0) AND NOT (user_id % 5 = 0 AND event_id % 3 < 2)"
    ).select(F.col("user_id").alias("query_id"), (F.col("event_id") % 3).cast("int").alias("country_ord"), F.col("event_id").alias("ord"))
    return M.first_country_with_results(entries)


# ---------------------------------------------------------------- feed entries from orders

AS_OF = "2024-03-10"
ENTRIES = f"""{LINKS}, entries AS (SELECT l.ord, l.link, 'ev-' || o_custkey || '/en/0' AS query_id, o_custkey AS k, CASE WHEN l.ord % 2 = 0 THEN 'A Storm came' ELSE 'Calm day' END AS title,
    CASE WHEN l.ord % 5 = 0 THEN 'All about ' || o_orderpriority ELSE '' END AS summary, CASE WHEN l.ord % 4 = 0 THEN 'n' || (l.ord % 5) ELSE '' END AS source,
    CASE WHEN l.ord % 7 = 0 THEN strftime(ts + INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S')
      WHEN year(ts) >= 2000 AND l.ord % 12 < 10 THEN strftime(ts, '%Y-%m-%d') || ' 12:00:00' ELSE '{AS_OF} 12:00:00' END AS date
    FROM links l JOIN orders ON o_orderkey = l.ord),
  attached AS (SELECT e.*, c.disaster_id, c.start_date, c.end_date, c.seg || ' storm' AS hazard FROM entries e JOIN cfg c ON c.k = e.k AND c.k % 53 <> 0),
  relevant AS (SELECT * FROM attached WHERE ord % 2 = 0),
  inside AS (SELECT * FROM relevant WHERE substring(date, 1, 10)::DATE BETWEEN start_date - 7 AND end_date + 7)"""


def feed_entries(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    i = F.col("ord")
    rows = links(spark, sf_dir).join(orders.select(F.col("o_orderkey").alias("ord"), "o_custkey", "o_orderpriority"), "ord")
    return rows.select(
        F.concat(F.lit("ev-"), F.col("o_custkey").cast("string"), F.lit("/en/0")).alias("query_id"),
        F.lit(0).alias("country_ord"), "ord",
        F.when(i % 2 == 0, "A Storm came").otherwise("Calm day").alias("title"), "link",
        F.when(i % 7 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(i % 7 == 1, "soon").alias("published"),
        F.when(i % 5 == 0, F.concat(F.lit("All about "), "o_orderpriority")).alias("summary"),
        F.when(i % 4 == 0, F.struct(F.concat(F.lit("n"), (i % 5).cast("string")).alias("title"))).alias("source"),
    )


def planned(spark, sf_dir):
    return smart_queries(configs(spark, sf_dir), 50).withColumn(
        "query_id", make_query_id(F.col("disaster_id"), F.col("lang_code"), F.col("ord"))
    )


@query(f"WITH {CONFIGS}, {ENTRIES} SELECT ord, query_id, disaster_id, hazard FROM attached")
def attach_query(spark, sf_dir):
    out = M.attach_query(feed_entries(spark, sf_dir), planned(spark, sf_dir).drop("ord"))
    return out.select("ord", "query_id", "disaster_id", "hazard")


@query(f"WITH {CONFIGS}, {ENTRIES} SELECT ord, disaster_id, date FROM attached WHERE substring(date, 1, 10)::DATE BETWEEN start_date - 7 AND end_date + 7")
def window_join(spark, sf_dir):
    from presslake.functions.dates import entry_date

    dated = feed_entries(spark, sf_dir).withColumn("date", entry_date(F.col("published"), F.col("link"), F.lit(AS_OF).cast("date")))
    rows = M.attach_query(dated, planned(spark, sf_dir).select("query_id", "disaster_id"))
    return M.window_join(rows, configs(spark, sf_dir)).select("ord", "disaster_id", "date")


_META = f"""WITH {CONFIGS}, {ENTRIES} SELECT {{0}}title, link, date, source, summary, 'en' AS language, hazard, '' AS keyword, '' AS location, '' AS newspaper, 'hazard_only' AS query_type, disaster_id FROM inside"""


@query(_META.format("ord, "))
def collect_entries(spark, sf_dir):
    """Entries dated, joined to their query, filtered to window and hazard, as metadata rows."""
    return M.collect_entries(feed_entries(spark, sf_dir), planned(spark, sf_dir), configs(spark, sf_dir), F.lit(AS_OF).cast("date"))


@query(f"{_META.format('')} UNION ALL SELECT 'Link ' || page_id, url, '2024-03-10 00:00:00', '', '', 'en', 'Storm', 'specific_link', '', '', 'specific_link', 'ev-0' FROM pages")
def all_metadata_rows(spark, sf_dir):
    feed = collect_entries(spark, sf_dir)
    fixed = {"date": "2024-03-10 00:00:00", "language": "en", "hazard": "Storm", "keyword": "specific_link", "query_type": "specific_link", "disaster_id": "ev-0"}
    given = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("Link "), F.col("page_id").cast("string")).alias("title"), F.col("url").alias("link"),
        *[F.lit(fixed.get(c, "")).alias(c) for c in METADATA_COLUMNS[2:]],
    )
    return all_metadata(feed, given)


@query(f"""WITH {STREAKS} SELECT DISTINCT substring(md5('q' || (state_key::INT % 20) || '_en'), 1, 8) AS ban_key FROM streaks WHERE request_id % 2 = 0 AND NOT success AND streak >= 3""")
def banned_queries(spark, sf_dir):
    log = request_log(spark, sf_dir).withColumns(
        {
            "query": F.concat(F.lit("q"), (F.col("state_key").cast("int") % 20).cast("string")),
            "lang_code": F.lit("en"),
            "last_attempt": F.col("request_id") % 2 == 0,
        }
    )
    return M.banned_queries(log)
