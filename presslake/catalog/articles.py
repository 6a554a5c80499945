"""Grades, fingerprints, dedup, statistics and audit over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.inputs import ARTICLES, SQL_RANK, articles, sql_grade, sql_words
from presslake.catalog.registry import query, table
from presslake.functions import text as T
from presslake.functions.blocks import text_ratio
from presslake.functions.html import page_title
from presslake.operators import articles as A, audit, dedup, stats
from presslake.sources.workspace import materialize


@query(f"SELECT doc_id, {sql_grade('text')} AS grade FROM documents")
def quality_grade(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.quality_grade(F.col("text")).alias("grade"))


@query("SELECT doc_id, md5(substring(lower(text), 1, 500)) AS fingerprint, length(text) > 200 AS has_body FROM documents")
def content_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.content_fingerprint(F.col("text")).alias("fingerprint"), T.has_body(F.col("text")).alias("has_body")
    )


BEST = f"""best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY disaster_id, normalized_url,
      CASE WHEN normalized_url = '' THEN ord END ORDER BY {SQL_RANK} DESC, ord) AS rn FROM articles) WHERE rn = 1)"""


@query(f"WITH {ARTICLES}, {BEST} SELECT disaster_id, ord, normalized_url, extraction_quality FROM best")
def dedup_url(spark, sf_dir):
    return dedup.dedup_url(articles(spark, sf_dir)).select("disaster_id", "ord", "normalized_url", "extraction_quality")


@query(f"""WITH {ARTICLES}, ranked AS (SELECT *, {SQL_RANK} AS rank FROM articles),
  earlier AS (SELECT *, max(rank) OVER (PARTITION BY disaster_id, normalized_url, CASE WHEN normalized_url = '' THEN ord END
      ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM ranked)
  SELECT disaster_id, ord, normalized_url, extraction_quality FROM earlier WHERE above IS NULL OR rank > above""")
def dedup_url_running(spark, sf_dir):
    return dedup.dedup_url(articles(spark, sf_dir), "running").select(
        "disaster_id", "ord", "normalized_url", "extraction_quality"
    )


CONTENT = """content AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY disaster_id, CASE WHEN length(article_text) >= 100
      THEN md5(substring(lower(article_text), 1, 500)) ELSE 'row ' || ord END ORDER BY ord) AS rn2 FROM {0}) WHERE rn2 = 1)"""


@query(f"WITH {ARTICLES}, {CONTENT.format('articles')} SELECT disaster_id, ord FROM content")
def dedup_content(spark, sf_dir):
    return dedup.dedup_content(articles(spark, sf_dir)).select("disaster_id", "ord")


@query(f"WITH {ARTICLES}, {BEST}, {CONTENT.format('best')} SELECT disaster_id, extraction_quality, count(*) AS n FROM content GROUP BY ALL")
def dedup_pipeline(spark, sf_dir):
    """Both dedup stages in order, then the grades that are left."""
    kept = dedup.dedup_content(dedup.dedup_url(articles(spark, sf_dir)))
    return kept.groupBy("disaster_id", "extraction_quality").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {ARTICLES}, {BEST}, {CONTENT.format('best')},
  o AS (SELECT disaster_id, count(*) AS n FROM articles GROUP BY 1),
  b AS (SELECT disaster_id, count(*) AS n, count(nullif(title, '')) - count(DISTINCT nullif(title, '')) AS t FROM best GROUP BY 1),
  c AS (SELECT disaster_id, count(*) AS n FROM content GROUP BY 1)
  SELECT o.disaster_id, o.n AS original_count, c.n AS final_count, o.n - b.n AS url_duplicates_removed,
    b.t AS title_duplicates, b.n - c.n AS content_duplicates_removed, round((o.n - c.n) * 100.0 / o.n, 6) AS removal_percentage
  FROM o JOIN b USING (disaster_id) JOIN c USING (disaster_id)""")
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(articles(spark, sf_dir)).withColumn("removal_percentage", F.round("removal_percentage", 6))


@query(f"""WITH {ARTICLES}, l AS (
    SELECT 'f' || (ord % 9) AS file, ord, CASE WHEN ord % 11 = 0 THEN 'https://www.Facebook.com/x' WHEN ord % 2 = 0 THEN upper(final_url) || ' ' ELSE final_url END AS link FROM articles),
  f AS (SELECT file, ord, link, lower(link) LIKE '%facebook.com%' AS skipped, lower(trim(link)) AS key FROM l)
  SELECT file, ord, CASE WHEN skipped THEN 'skipped' WHEN row_number() OVER (PARTITION BY file, key ORDER BY ord) = 1 THEN 'process' ELSE 'duplicate' END AS status FROM f""")
def dedup_batch_urls(spark, sf_dir):
    i, url = F.col("ord"), F.col("final_url")
    link = F.when(i % 11 == 0, "https://www.Facebook.com/x").when(i % 2 == 0, F.concat(F.upper(url), F.lit(" "))).otherwise(url)
    rows = articles(spark, sf_dir).select(F.concat(F.lit("f"), (i % 9).cast("string")).alias("file"), "ord", link.alias("link"))
    return dedup.dedup_batch_urls(rows).select("file", "ord", "status")


@query(f"""WITH {ARTICLES}, d AS (
    SELECT disaster_id, 'language' AS dimension, article_language AS key FROM articles
    UNION ALL SELECT disaster_id, 'quality', extraction_quality FROM articles
    UNION ALL SELECT disaster_id, 'date', split_part(csv_date, ' ', 1) FROM articles
    UNION ALL SELECT disaster_id, 'location', nullif(csv_location, '') FROM articles
    UNION ALL SELECT disaster_id, 'keyword', csv_keyword FROM articles
    UNION ALL SELECT disaster_id, 'total', 'all' FROM articles)
  SELECT disaster_id, dimension, key, count(*) AS n FROM d WHERE key IS NOT NULL GROUP BY ALL""")
def article_statistics(spark, sf_dir):
    return stats.article_statistics(articles(spark, sf_dir))


@query(f"""WITH {ARTICLES} SELECT disaster_id, count(*) AS total_articles, count(DISTINCT article_language) AS languages,
    count(*) FILTER (extraction_quality = 'high') AS high, count(DISTINCT csv_date) AS days,
    count(DISTINCT nullif(csv_location, '')) AS locations, count(*) FILTER (csv_keyword = 'k3') AS k3
  FROM articles GROUP BY 1""")
def stats_to_map(spark, sf_dir):
    """The statistics object of each disaster, read back through its maps."""
    maps = stats.stats_to_map(stats.article_statistics(articles(spark, sf_dir)))
    return maps.select(
        "disaster_id", "total_articles",
        F.size("by_language").cast("long").alias("languages"),
        F.coalesce(F.try_element_at("by_quality", F.lit("high")), F.lit(0)).alias("high"),
        F.size("by_date").cast("long").alias("days"),
        F.size("by_location").cast("long").alias("locations"),
        F.coalesce(F.try_element_at("by_keyword", F.lit("k3")), F.lit(0)).alias("k3"),
    )


@query(f"WITH {ARTICLES} SELECT 'url' AS kind, final_url AS value, count(*) AS n FROM articles GROUP BY 2 HAVING count(*) > 1 "
       "UNION ALL SELECT 'title', title, count(*) FROM articles WHERE title <> '' GROUP BY 2 HAVING count(*) > 1")
def find_duplicates(spark, sf_dir):
    rows = articles(spark, sf_dir)
    urls = stats.find_duplicates(rows, "final_url").select(F.lit("url").alias("kind"), "value", "n")
    titles = stats.find_duplicates(rows, "title").select(F.lit("title").alias("kind"), "value", "n")
    return urls.unionByName(titles)


@query(f"WITH {ARTICLES} SELECT extraction_quality AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM articles), 6) AS percentage FROM articles GROUP BY 1")
def distribution(spark, sf_dir):
    return stats.distribution(articles(spark, sf_dir), "extraction_quality").withColumn("percentage", F.round("percentage", 6))


def stages():
    """Conditions of the stages that an article passes."""
    return {
        "found": F.lit(True),
        "with_body": T.has_body(F.col("article_text")),
        "usable": F.col("extraction_quality") != "low",
        "with_address": F.col("normalized_url") != "",
    }


@query(f"""WITH {ARTICLES} SELECT disaster_id, count(*) AS found, count(*) FILTER (length(article_text) > 200) AS with_body,
    count(*) FILTER (extraction_quality <> 'low') AS usable, count(*) FILTER (normalized_url <> '') AS with_address FROM articles GROUP BY 1""")
def funnel(spark, sf_dir):
    return stats.funnel(articles(spark, sf_dir), stages(), "disaster_id")


@query("""WITH m AS (SELECT doc_id % 7 AS file, 'https://x.example.com/' || (doc_id % 300) AS link, doc_id, quality, toxic FROM labels),
  last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, link ORDER BY doc_id DESC) AS rn FROM m) WHERE rn = 1),
  p AS (SELECT doc_id AS page, doc_id % 7 AS file, 'https://x.example.com/' || (doc_id % 300) AS url FROM documents)
  SELECT page, quality, toxic FROM p LEFT JOIN last ON p.file = last.file AND p.url = last.link""")
def attach_metadata(spark, sf_dir):
    i = F.col("doc_id")
    link = F.concat(F.lit("https://x.example.com/"), (i % 300).cast("string"))
    rows = table(spark, sf_dir, "labels").select(
        (i % 7).alias("file"), F.concat(F.lit(" "), link).alias("link"), i.alias("ord"), "quality", "toxic"
    )
    pages = table(spark, sf_dir, "documents").select(i.alias("page"), (i % 7).alias("file"), link.alias("url"))
    return A.attach_metadata(pages, rows).select("page", "meta.quality", "meta.toxic")


@query(f"""SELECT doc_id AS ord, md5('https://x.example.com/a/' || doc_id || coalesce(page_title, '')) AS id,
    coalesce(nullif(csv_title, ''), page_title, '') AS title, 'https://x.example.com/a/' || doc_id AS normalized_url,
    lang AS article_language, {sql_grade('text')} AS extraction_quality, source AS csv_source, 'ev-' || (doc_id % 4) AS disaster_id
  FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'Title ' || doc_id END AS page_title,
          CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Row ' || doc_id END AS csv_title FROM documents) WHERE length(text) > 200""")
def article_projection(spark, sf_dir):
    i, empty = F.col("doc_id"), F.lit("")
    title = F.when(i % 4 == 0, "").when(i % 4 == 1, F.concat(F.lit("Row "), i.cast("string")))
    url = F.concat(F.lit("https://x.example.com/A/"), i.cast("string"), F.lit("/?utm_source=feed#top"))
    meta = F.struct(
        title.alias("title"), F.col("source").alias("source"), F.col("lang").alias("language"),
        *[empty.alias(c) for c in ("date", "summary", "hazard", "keyword", "location", "newspaper", "query_type")],
    )
    pages = table(spark, sf_dir, "documents").select(
        i.alias("ord"), url.alias("url"), url.alias("final_url"),
        F.when(i % 3 == 0, F.concat(F.lit("Title "), i.cast("string"))).alias("page_title"),
        "text", F.col("lang").alias("language"), meta.alias("meta"),
        F.concat(F.lit("ev-"), (i % 4).cast("string")).alias("disaster_id"),
    )
    return A.article_projection(pages, "ord").select(
        "ord", "id", "title", "normalized_url", "article_language", "extraction_quality",
        F.col("metadata.csv_source").alias("csv_source"), "disaster_id",
    )


_TRIGRAMS = "CASE WHEN t <> '' THEN list_distinct(list_transform(range(1, length(t) + 3), lambda i: substring(chr(2) || chr(2) || t || chr(3) || chr(3), i, 3))) ELSE [] END"


@query(f"""WITH first AS (SELECT doc_id, lower(split_part(text, chr(10), 1)) AS t FROM documents),
  titles AS (SELECT t, count(*) AS n, min(doc_id) AS id, {_TRIGRAMS} AS g FROM first WHERE t <> '' GROUP BY t),
  pairs AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS n_a, b.n AS n_b, len(list_intersect(a.g, b.g)) AS c, len(a.g) + len(b.g) AS s FROM titles a JOIN titles b ON a.id < b.id
    AND len(a.g) >= 0.6 * len(b.g) - 1e-9 AND len(b.g) >= 0.6 * len(a.g) - 1e-9)
  SELECT id_a, id_b, n_a, n_b, round(c / (s - c), 6) AS similarity FROM pairs WHERE c / (s - c) >= 0.6 - 1e-12""")
def similar_titles(spark, sf_dir):
    """Near-equal first lines of documents."""
    titles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.substring_index("text", "\n", 1).alias("title"))
    return audit.similar_titles(titles).select("id_a", "id_b", "n_a", "n_b", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH words AS (SELECT lang, doc_id, lower(text) AS t FROM documents WHERE text <> ''),
  texts AS (SELECT lang, t, count(*) AS n, min(doc_id) AS id, {sql_words('t')} AS w FROM words GROUP BY lang, t),
  sets AS (SELECT lang, id, n, CASE WHEN len(w) > 0 THEN list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) ELSE [] END AS g FROM texts),
  rows AS (SELECT lang, id, unnest(g) AS g FROM sets),
  common AS (SELECT x.lang, x.id AS id_a, y.id AS id_b, count(*) AS c FROM rows x JOIN rows y ON x.lang = y.lang AND x.g = y.g AND x.id < y.id GROUP BY ALL),
  rated AS (SELECT c.lang, id_a, id_b, a.n AS n_a, b.n AS n_b, c / (len(a.g) + len(b.g) - c) AS r FROM common c JOIN sets a ON a.id = id_a AND a.lang = c.lang JOIN sets b ON b.id = id_b AND b.lang = c.lang)
  SELECT lang AS disaster_id, id_a, id_b, n_a, n_b, round(r, 6) AS similarity FROM rated WHERE r >= 0.8 - 1e-12""")
def similar_content(spark, sf_dir):
    """Pairs of documents of a language whose whole texts are alike."""
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("disaster_id"), F.col("doc_id").alias("ord"), F.col("text").alias("article_text"))
    return audit.similar_content(rows).withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH lines AS (SELECT doc_id, lower(split_part(text, chr(10), 1)) AS a, lower(split_part(text, chr(10), 2)) AS b FROM documents),
  g AS (SELECT doc_id, {_TRIGRAMS.replace("t <>", "a <>").replace("length(t)", "length(a)").replace("|| t ||", "|| a ||")} AS x, {_TRIGRAMS.replace("t <>", "b <>").replace("length(t)", "length(b)").replace("|| t ||", "|| b ||")} AS y FROM lines),
  c AS (SELECT doc_id, len(list_intersect(x, y)) AS c, len(x) + len(y) AS s FROM g)
  SELECT doc_id, round(CASE WHEN s - c > 0 THEN c / (s - c) ELSE 0.0 END, 6) AS similarity FROM c""")
def title_similarity(spark, sf_dir):
    """Ratio of the first two lines of each document."""
    lines = F.split("text", "\n")
    line = lambda i: F.lower(F.coalesce(F.get(lines, F.lit(i)), F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.round(audit.similarity(line(0), line(1)), 6).alias("similarity"))


@query()
def similar_titles_blocks(spark, sf_dir):
    """Near-equal titles of pages by matching blocks; no SQL form."""
    # Written once, so that the markup is searched once.
    titles = materialize(table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), page_title(F.col("html")).alias("title")), "page-titles")
    return audit.similar_titles(titles, metric="blocks").select("id_a", "id_b", "n_a", "n_b", F.round("similarity", 9).alias("similarity"))


@query()
def title_ratio(spark, sf_dir):
    """Matching-blocks ratio of the first two lines of each document; no SQL form."""
    lines = F.split("text", "\n")
    line = lambda i: F.lower(F.get(lines, F.lit(i)))
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text_ratio(line(0), line(1)), 9).alias("similarity"))
