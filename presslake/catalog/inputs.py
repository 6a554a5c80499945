"""Inputs derived from the driver tables: each as a DataFrame and as the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presslake.catalog.registry import table
from presslake.functions.text import classify_error, quality_grade
from presslake.sources.schemas import CONFIG

# ---------------------------------------------------------------- SQL fragments


def sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')"


def sql_grade(text: str) -> str:
    lines = f"len(list_filter(string_split({text}, chr(10)), lambda x: length(trim(x)) > 20))"
    variety = f"(len(list_distinct({sql_words(text)})) / greatest(len({sql_words(text)}), 1))"
    return (
        f"CASE WHEN length({text}) > 1500 AND {lines} >= 3 AND length({text}) - length(translate({text}, '<>', '')) <= 10"
        f" AND {variety} > 0.3 THEN 'high'"
        f" WHEN length({text}) > 500 AND {lines} >= 2 AND {variety} > 0.2 THEN 'medium' ELSE 'low' END"
    )


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# ---------------------------------------------------------------- articles from documents


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    i, text = F.col("doc_id"), F.col("text")
    stamp = F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")), "yyyy-MM-dd"), F.lit(" 10:00:00"))
    blank = F.lit("")
    # Two copies of every address, and one address that a third of all rows share.
    page = F.when(i % 3 == 0, "front").otherwise((F.floor(i / 8) * 4 + i % 4).cast("string"))
    path = F.concat(F.lit("news.example.com/"), page)
    return docs.select(
        F.concat(F.lit("ev-"), (i % 4).cast("string")).alias("disaster_id"),
        i.alias("ord"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.concat(F.lit("https://"), path).alias("final_url"),
        F.when(i % 50 == 0, "").otherwise(F.concat(F.lit("https://"), path)).alias("normalized_url"),
        text.alias("article_text"),
        F.col("lang").alias("article_language"),
        quality_grade(text).alias("extraction_quality"),
        F.struct(
            F.when(i % 17 != 0, stamp).alias("csv_date"),
            F.col("source").alias("csv_source"),
            blank.alias("csv_summary"),
            F.col("lang").alias("csv_language"),
            F.lit("Storm").alias("csv_hazard"),
            F.concat(F.lit("k"), (i % 7).cast("string")).alias("csv_keyword"),
            F.when(i % 5 != 0, F.col("source")).otherwise("").alias("csv_location"),
            blank.alias("csv_newspaper"),
            F.lit("broad").alias("query_type"),
        ).alias("metadata"),
    )


ARTICLES = f"""articles AS (
  SELECT 'ev-' || (doc_id % 4) AS disaster_id, doc_id AS ord, split_part(text, chr(10), 1) AS title,
    'https://news.example.com/' || CASE WHEN doc_id % 3 = 0 THEN 'front' ELSE (doc_id // 8 * 4 + doc_id % 4)::VARCHAR END AS final_url,
    CASE WHEN doc_id % 50 = 0 THEN '' ELSE 'https://news.example.com/' || CASE WHEN doc_id % 3 = 0 THEN 'front' ELSE (doc_id // 8 * 4 + doc_id % 4)::VARCHAR END END AS normalized_url,
    text AS article_text, lang AS article_language, {sql_grade('text')} AS extraction_quality,
    CASE WHEN doc_id % 17 <> 0 THEN strftime(DATE '2024-01-01' + (doc_id % 30)::INT, '%Y-%m-%d') || ' 10:00:00' END AS csv_date,
    CASE WHEN doc_id % 5 <> 0 THEN source ELSE '' END AS csv_location, 'k' || (doc_id % 7) AS csv_keyword
  FROM documents)"""

SQL_RANK = "CASE extraction_quality WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END"

# ---------------------------------------------------------------- request log from events

MESSAGES = [
    "HTTPSConnectionPool: Max retries exceeded", "SSL: UNEXPECTED_EOF", "Connection aborted",
    "Read timed out", "403 Client Error: Forbidden", "404 page not found", "boom",
]


def event_number() -> Column:
    return F.regexp_extract("props", r"(\d+)", 1).cast("int")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    message = F.element_at(F.array(*map(F.lit, MESSAGES)), event_number() % len(MESSAGES) + 1)
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("state_key"),
        (~failed).alias("success"),
        F.when(failed, message).alias("message"),
        F.when(failed, classify_error(message)).alias("error_type"),
        F.col("value").alias("response_time"),
    )


SQL_MESSAGE = f"{sql_list(MESSAGES)}[regexp_extract(props, '(\\d+)', 1)::INT % {len(MESSAGES)} + 1]"
SQL_CLASSES = ["rate_limit", "ssl_error", "connection_error", "timeout_error", "access_denied", "not_found", "unknown_error"]
LOG = f"""log AS (
  SELECT event_id AS request_id, ts, user_id::VARCHAR AS state_key, event_type <> 'error' AS success,
    CASE WHEN event_type = 'error' THEN {sql_list(SQL_CLASSES)}[regexp_extract(props, '(\\d+)', 1)::INT % 7 + 1] END AS error_type,
    CASE WHEN event_type = 'error' THEN {SQL_MESSAGE} END AS message
  FROM events)"""

# ---------------------------------------------------------------- configurations from customers


def raw_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per customer, in the shape of the JSON file (dates as text)."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    # A row becomes hundreds of queries, and a small file is read by a single task: rows are dealt out before they grow.
    rows = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    )
    k = F.col("c_custkey")
    key = k.cast("string")
    segment = F.col("c_mktsegment")
    words = lambda *xs: F.array(*xs)
    lists = lambda *pairs: F.map_concat(F.create_map().cast("map<string,array<string>>"), *pairs)
    no_lists = F.create_map().cast("map<string,array<string>>")
    maybe = lambda cond, lang, arr: F.when(cond, F.create_map(F.lit(lang), arr)).otherwise(no_lists)
    english_kw = F.array(*[F.concat(F.lit(f"kw{i}-"), (k % 5).cast("string")) for i in range(1, 13)])
    hindi_kw = F.array(*[F.lit(f"शब्द{i}") for i in range(1, 4)])
    city = F.concat(segment, F.lit(" City"))
    district_map = lambda m: F.struct(m.alias("districts"))
    locations = F.create_map(
        F.col("r_name"), district_map(F.create_map(F.col("n_name"), words(city, F.col("n_name")))),
        F.lit("Coast"), district_map(F.create_map(
            F.lit("North"), words(F.concat(F.lit("Port "), key), city), F.lit("South"), F.array().cast("array<string>"))),
        F.lit("Island"), district_map(F.lit(None).cast("map<string,array<string>>")),
    ).cast(CONFIG["locations"].dataType)
    paper = lambda name, link: F.array(F.struct(name.alias("name"), link.alias("link")))
    no_papers = F.create_map().cast(CONFIG["newspapers"].dataType)
    times = F.create_map(F.lit("en"), paper(F.concat(segment, F.lit(" Times")), F.concat(F.lit("https://times"), (k % 9).cast("string"), F.lit(".example.com"))))
    blatt = F.create_map(F.lit("de"), paper(F.concat(F.lit("Blatt "), key), F.lit("https://blatt.example.com")))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
    end = F.date_add(start, (k % 40).cast("int") - F.when(k % 50 == 0, 100).otherwise(0))
    return rows.select(
        F.concat(F.lit("ev-"), key).alias("disaster_id"),
        F.when(k % 97 != 0, F.date_format(start, "dd/MM/yyyy")).alias("start_date"),
        F.date_format(end, "dd/MM/yyyy").alias("end_date"),
        F.when(k % 53 == 0, no_lists).otherwise(
            lists(
                F.create_map(F.lit("en"), words(F.concat(segment, F.lit(" storm")), F.concat(F.lit("Cyclone "), F.col("c_name")))),
                maybe(k % 3 == 0, "hi", words(F.concat(F.lit("चक्रवात "), key))),
            )
        ).alias("hazard_names"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(
            lists(F.create_map(F.lit("en"), english_kw), maybe(k % 4 == 0, "hi", hindi_kw))
        ).alias("keywords"),
        F.when(k % 6 != 0, locations).alias("locations"),
        F.map_concat(
            F.when(k % 2 == 0, times).otherwise(no_papers), F.when(k % 5 == 0, blatt).otherwise(no_papers)
        ).alias("newspapers"),
        F.when(k % 3 == 0, F.array(F.lit("US"), F.lit("IN"))).alias("country_codes"),
        F.when(
            k % 10 == 0,
            F.array(F.concat(F.lit("https://a.example.com/"), key), F.concat(F.lit(" https://b.example.com/"), key, F.lit(" "))),
        ).alias("specific_links"),
    )


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslake.operators.config import with_defaults

    return with_defaults(raw_configs(spark, sf_dir))


CONFIGS = """cfg AS (
  SELECT c_custkey AS k, 'ev-' || c_custkey AS disaster_id, c_mktsegment AS seg, c_name, n_name, r_name,
    CASE WHEN c_custkey % 97 <> 0 THEN DATE '2024-01-01' + (c_custkey % 300)::INT END AS start_date,
    DATE '2024-01-01' + (c_custkey % 300)::INT + (c_custkey % 40)::INT - CASE WHEN c_custkey % 50 = 0 THEN 100 ELSE 0 END AS end_date,
    CASE WHEN c_custkey % 6 = 0 THEN []::VARCHAR[] ELSE [r_name, n_name, c_mktsegment || ' City', n_name,
      'Coast', 'North', 'Port ' || c_custkey, c_mktsegment || ' City', 'South', 'Island'] END AS flat,
    CASE WHEN c_custkey % 6 = 0 THEN []::VARCHAR[] ELSE [c_mktsegment || ' City', n_name, 'Port ' || c_custkey, c_mktsegment || ' City',
      'North', 'South', r_name, 'Coast', 'Island'] END AS prio,
    list_sort(list_distinct(list_concat(['en'],
      CASE WHEN (c_custkey % 53 <> 0 AND c_custkey % 3 = 0) OR (c_custkey % 7 <> 0 AND c_custkey % 4 = 0) THEN ['hi'] ELSE []::VARCHAR[] END,
      CASE WHEN c_custkey % 5 = 0 THEN ['de'] ELSE []::VARCHAR[] END))) AS langs
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
per_lang AS (
  SELECT *, year(start_date)::VARCHAR AS yr,
    CASE WHEN k % 53 = 0 THEN []::VARCHAR[] WHEN lang_code = 'hi' AND k % 3 = 0 THEN ['चक्रवात ' || k]
      ELSE [seg || ' storm', 'Cyclone ' || c_name] END AS hazards,
    CASE WHEN k % 7 = 0 THEN []::VARCHAR[] WHEN lang_code = 'hi' AND k % 4 = 0 THEN ['शब्द1', 'शब्द2', 'शब्द3']
      ELSE list_transform(range(1, 13), lambda i: 'kw' || i || '-' || (k % 5)) END AS kws,
    CASE WHEN lang_code = 'en' AND k % 2 = 0 THEN [seg || ' Times'] WHEN lang_code = 'de' AND k % 5 = 0 THEN ['Blatt ' || k] ELSE []::VARCHAR[] END AS papers
  FROM (SELECT *, unnest(langs) AS lang_code FROM cfg))"""

# ---------------------------------------------------------------- links from orders

_DAY = "yyyy/MM/dd"


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose address carries the order date in one of twelve shapes."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    k = key.cast("string")
    f = lambda fmt: F.date_format(F.col("o_orderdate").cast("date"), fmt)
    shapes = [
        F.concat(F.lit("/news/x/"), f("yyyy/M/d"), F.lit("/s")),
        F.concat(F.lit("/"), f("yyyy-MM-dd"), F.lit("/s")),
        F.concat(F.lit("/s"), f("yyyyMMdd"), F.lit("x")),
        F.concat(F.lit("/article"), f("yyyyMMdd"), F.lit(".html")),
        F.concat(F.lit("/"), f("dd-MM-yyyy"), F.lit("/s")),
        F.concat(F.lit("/"), f("ddMMyyyy"), F.lit("/s")),
        F.concat(F.lit("/news/"), f("yyyy/MM/dd"), F.lit("/s")),
        F.concat(F.lit("/s_"), f("d_M_yyyy")),
        F.concat(F.lit("/a-"), f("yyyyMMdd"), F.lit("-b")),
        F.concat(F.lit("/"), f("yyyy/MMMM/d"), F.lit("/s")),
        F.concat(F.lit("/s/"), k),
        F.concat(F.lit("/2025/02/30/"), k),
    ]
    path = F.element_at(F.array(*shapes), (key % 12 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("ord"),
        day.alias("ts"),
        F.concat(F.lit("https://n"), (key % 5).cast("string"), F.lit(".example.com"), path).alias("link"),
    )


LINKS = """links AS (
  SELECT o_orderkey AS ord, o_orderdate AS ts, 'https://n' || (o_orderkey % 5) || '.example.com' || CASE (o_orderkey % 12)::INT
    WHEN 0 THEN '/news/x/' || strftime(o_orderdate, '%Y/%-m/%-d') || '/s'
    WHEN 1 THEN '/' || strftime(o_orderdate, '%Y-%m-%d') || '/s'
    WHEN 2 THEN '/s' || strftime(o_orderdate, '%Y%m%d') || 'x'
    WHEN 3 THEN '/article' || strftime(o_orderdate, '%Y%m%d') || '.html'
    WHEN 4 THEN '/' || strftime(o_orderdate, '%d-%m-%Y') || '/s'
    WHEN 5 THEN '/' || strftime(o_orderdate, '%d%m%Y') || '/s'
    WHEN 6 THEN '/news/' || strftime(o_orderdate, '%Y/%m/%d') || '/s'
    WHEN 7 THEN '/s_' || strftime(o_orderdate, '%-d_%-m_%Y')
    WHEN 8 THEN '/a-' || strftime(o_orderdate, '%Y%m%d') || '-b'
    WHEN 9 THEN '/' || strftime(o_orderdate, '%Y/%B/%-d') || '/s'
    WHEN 10 THEN '/s/' || o_orderkey
    ELSE '/2025/02/30/' || o_orderkey END AS link
  FROM orders)"""
