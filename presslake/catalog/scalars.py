"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.inputs import LINKS, MESSAGES, SQL_CLASSES, SQL_MESSAGE, event_number, links, sql_list
from presslake.catalog.registry import query, table
from presslake.functions import dates as D, language as L, regions as R, text as T

# ---------------------------------------------------------------- languages

SAMPLES = ["मानसून", "বর্ষা", "மழை", "వరద", "ಮಳೆ", "മഴ", "વરસાદ", "ਮੀਂਹ", "день"]
RANGES = [("hi", "0900-097F"), ("bn", "0980-09FF"), ("ta", "0B80-0BFF"), ("te", "0C00-0C7F"),
          ("kn", "0C80-0CFF"), ("ml", "0D00-0D7F"), ("gu", "0A80-0AFF"), ("pa", "0A00-0A7F")]
MIXED = f"mixed AS (SELECT doc_id, text || repeat({sql_list(SAMPLES)}[(doc_id % 9 + 1)::INT], (doc_id * 7 % 400)::INT) AS t FROM documents)"


def _range(r: str) -> str:
    a, b = r.split("-")
    return f"[\\x{{{a}}}-\\x{{{b}}}]"


def _counts() -> str:
    return ", ".join(
        f"length(t) - length(regexp_replace(t, '{_range(r)}', '', 'g')) AS {code}" for code, r in RANGES
    )


def _first_top() -> str:
    top = "greatest(" + ", ".join(c for c, _ in RANGES) + ")"
    return "CASE " + " ".join(f"WHEN {c} = {top} THEN '{c}'" for c, _ in RANGES) + " END"


def mixed(spark, sf_dir):
    i = F.col("doc_id")
    sample = F.element_at(F.array(*map(F.lit, SAMPLES)), (i % 9 + 1).cast("int"))
    return table(spark, sf_dir, "documents").withColumn("_s", sample).select(
        "doc_id", F.concat("text", F.expr("repeat(_s, int(doc_id * 7 % 400))")).alias("t")
    )


_PLAIN_SQL = "regexp_replace(t, '[A-Za-z\\s\\p{Nd}²³¹.,;:!?''\"()\\[\\]{}]', '', 'g')"


@query(f"""WITH {MIXED}, c AS (SELECT doc_id, length(t) AS n, length({_PLAIN_SQL}) AS foreign_chars, {_counts()} FROM mixed)
  SELECT doc_id, CASE WHEN n >= 50 AND foreign_chars > n * 0.15 AND greatest({', '.join(c for c, _ in RANGES)}) > n * 0.1
    THEN {_first_top()} ELSE 'en' END AS lang FROM c""")
def detect_language(spark, sf_dir):
    return mixed(spark, sf_dir).select("doc_id", L.detect_language(F.col("t")).alias("lang"))


@query(f"""WITH {MIXED}, c AS (SELECT doc_id, length(t) AS n, {_counts()} FROM mixed)
  SELECT doc_id, CASE WHEN n < 50 THEN 'en' {' '.join(f"WHEN {c} > n * 0.15 THEN '{c}'" for c, _ in RANGES[:6])} ELSE 'en' END AS lang FROM c""")
def detect_language_simple(spark, sf_dir):
    return mixed(spark, sf_dir).select("doc_id", L.detect_language_simple(F.col("t")).alias("lang"))


@query(f"WITH {MIXED}, c AS (SELECT doc_id, {_counts()} FROM mixed) SELECT doc_id, {_first_top()} AS script FROM c")
def dominant_script(spark, sf_dir):
    return mixed(spark, sf_dir).select("doc_id", L.dominant_script(F.col("t")).alias("script"))


# ---------------------------------------------------------------- addresses

URLS = """urls AS (SELECT page_id, CASE (page_id % 6)::INT
    WHEN 0 THEN url
    WHEN 1 THEN split_part(url, '#', 1) || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END || 'b=2&a=x%20Y&b=3&fbclid=Z&e=&f'
    WHEN 2 THEN replace(url, 'example', 'Example') || '//'
    WHEN 3 THEN 'https://news.google.com/rss/articles/CBMi' || repeat('Ab', (page_id % 200)::INT) || '?oc=5'
    WHEN 4 THEN 'https://m.YouTube.com:8080/watch?v=' || page_id
    ELSE 'ftp://www.files.example.org/' || page_id END AS u FROM pages)"""


def urls(spark, sf_dir):
    i, url = F.col("page_id"), F.col("url")
    sep = F.when(url.contains("?"), "&").otherwise("?")
    shapes = [
        url,
        F.concat(F.substring_index(url, "#", 1), sep, F.lit("b=2&a=x%20Y&b=3&fbclid=Z&e=&f")),
        F.concat(F.replace(url, F.lit("example"), F.lit("Example")), F.lit("//")),
        F.concat(F.lit("https://news.google.com/rss/articles/CBMi"), F.expr("repeat('Ab', int(page_id % 200))"), F.lit("?oc=5")),
        F.concat(F.lit("https://m.YouTube.com:8080/watch?v="), i.cast("string")),
        F.concat(F.lit("ftp://www.files.example.org/"), i.cast("string")),
    ]
    return table(spark, sf_dir, "pages").select(
        i, F.element_at(F.array(*shapes), (i % 6 + 1).cast("int")).alias("u")
    )


# The parameters of these addresses: b, a, v, page and the tracking ones utm_source, ref, fbclid.
SQL_NORMAL = """CASE WHEN u LIKE '%news.google.com/rss/articles/%' THEN 'google_news_' || regexp_extract(u, '/articles/([^?]+)', 1)
    ELSE rtrim(lower(base || CASE WHEN ordered <> '' THEN '?' || replace(ordered, '%20', '+') ELSE '' END), '/') END"""
NORMAL = f"""parts AS (SELECT page_id, u, split_part(split_part(u, '#', 1), '?', 1) AS base,
      list_filter(string_split(substring(split_part(u, '#', 1), length(split_part(split_part(u, '#', 1), '?', 1)) + 2), '&'),
        lambda p: regexp_matches(p, '^[^=]*=.') AND split_part(p, '=', 1) NOT IN ('utm_source', 'ref', 'fbclid')) AS ps FROM urls),
  grouped AS (SELECT *, list_distinct(list_transform(ps, lambda p: split_part(p, '=', 1))) AS ks FROM parts),
  joined AS (SELECT *,
    array_to_string(flatten(list_transform(list_filter(['page', 'v', 'b', 'a'], lambda k: list_contains(ks, k)),
      lambda k: list_filter(ps, lambda p: split_part(p, '=', 1) = k))), '&') AS ordered FROM grouped),
  normal AS (SELECT page_id, u, {SQL_NORMAL} AS normalized_url FROM joined)"""


@query(f"WITH {URLS}, {NORMAL} SELECT page_id, normalized_url FROM normal")
def normalize_url(spark, sf_dir):
    return urls(spark, sf_dir).select("page_id", T.normalize_url(F.col("u")).alias("normalized_url"))


@query(f"""WITH {URLS} SELECT page_id, regexp_replace(regexp_extract(u, '^[a-z]+://([^/?#]*)', 1), '^www\\.', '') AS domain,
    regexp_matches(u, '^https?://') AS is_http,
    (u LIKE '%news.google.com/rss/articles/CBMi%' AND length(u) > 350) OR lower(u) LIKE '%youtube.com%' AS skip FROM urls""")
def url_domain(spark, sf_dir):
    u = F.col("u")
    return urls(spark, sf_dir).select(
        "page_id", T.url_domain(u).alias("domain"), T.is_http_url(u).alias("is_http"), T.skip_url(u).alias("skip")
    )


@query(f"""WITH {URLS}, {NORMAL} SELECT page_id, md5(normalized_url || coalesce(CASE WHEN page_id % 3 > 0 THEN u END, '')) AS id FROM normal""")
def article_id(spark, sf_dir):
    u = F.col("u")
    title = F.when(F.col("page_id") % 3 > 0, u)
    return urls(spark, sf_dir).select("page_id", T.article_id(T.normalize_url(u), title).alias("id"))


# ---------------------------------------------------------------- texts


@query(f"""WITH t AS (SELECT p_partkey, p_name || {sql_list(T.TITLE_SUFFIXES)}[(p_partkey % 5 + 1)::INT]
      || CASE WHEN p_partkey % 4 = 0 THEN {sql_list(T.TITLE_SUFFIXES)}[(p_partkey % 3 + 1)::INT] ELSE '' END AS t FROM part),
  s0 AS (SELECT *, t AS s FROM t), {', '.join(f"s{i + 1} AS (SELECT p_partkey, t, CASE WHEN suffix(s, '{x}') THEN trim(substring(s, 1, length(s) - {len(x)})) ELSE s END AS s FROM s{i})" for i, x in enumerate(T.TITLE_SUFFIXES))}
  SELECT p_partkey, s AS title, length(s) > 10 AND length(s) < 300 AS valid, substring(t, 1, 12) AS head FROM s5""")
def clean_title(spark, sf_dir):
    k = F.col("p_partkey")
    pick = lambda n: F.element_at(F.array(*map(F.lit, T.TITLE_SUFFIXES)), (k % n + 1).cast("int"))
    t = F.concat("p_name", pick(5), F.when(k % 4 == 0, pick(3)).otherwise(""))
    rows = table(spark, sf_dir, "part").select(k, t.alias("t"), T.clean_title(t).alias("title"))
    return rows.select(k, "title", T.valid_title(F.col("title")).alias("valid"), T.truncate(F.col("t"), 12).alias("head"))


QUERY_TEXTS = """q AS (SELECT p_partkey, CASE (p_partkey % 4)::INT
    WHEN 0 THEN array_to_string(list_transform(range(0, (p_partkey % 11 + 1)::INT), lambda i: p_brand || i), ' OR ')
    WHEN 1 THEN array_to_string(list_transform(range(0, (p_partkey % 7 + 1)::INT), lambda i: '("' || p_type || i || '")'), ' OR ')
    WHEN 2 THEN repeat('STORM OR ', (p_partkey % 9)::INT) || p_name
    ELSE p_name END AS query FROM part)"""


def query_texts(spark, sf_dir):
    k = F.col("p_partkey")
    seq = lambda n: F.sequence(F.lit(0), (k % n).cast("int"))
    shapes = [
        F.array_join(F.transform(seq(11), lambda i: F.concat("p_brand", i.cast("string"))), " OR "),
        F.array_join(F.transform(seq(7), lambda i: F.concat(F.lit('("'), F.col("p_type"), i.cast("string"), F.lit('")'))), " OR "),
        F.concat(F.expr("repeat('STORM OR ', int(p_partkey % 9))"), F.col("p_name")),
        F.col("p_name"),
    ]
    return table(spark, sf_dir, "part").select(k, F.element_at(F.array(*shapes), (k % 4 + 1).cast("int")).alias("query"))


@query(f"""WITH {QUERY_TEXTS}, c AS (SELECT *, list_filter(list_transform(regexp_split_to_array(translate(query, '()"', ''), '\\bOR\\b'), lambda p: trim(p)), lambda p: p <> '') AS clean FROM q)
  SELECT p_partkey, CASE WHEN len(regexp_extract_all(query, '\\bOR\\b')) > 6 AND len(string_split(query, ' OR ')) > 6 THEN array_to_string(string_split(query, ' OR ')[1:4], ' OR ')
    WHEN (length(query) - length(replace(query, '(', '')) > 4 OR length(query) - length(replace(query, '"', '')) > 4) AND len(clean) > 0 THEN array_to_string(clean[1:3], ' OR ')
    ELSE query END AS simple, substring(md5(query || '_en'), 1, 8) AS ban_key FROM c""")
def simplify_query(spark, sf_dir):
    q = F.col("query")
    return query_texts(spark, sf_dir).select(
        "p_partkey", T.simplify_query(q).alias("simple"), T.ban_key(q, F.lit("en")).alias("ban_key")
    )


@query("""SELECT p_partkey, concat_ws(' ', p_type, nullif(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END, ''),
    CASE WHEN p_partkey % 3 = 0 THEN p_name END) AS query FROM part""")
def query_text(spark, sf_dir):
    k = F.col("p_partkey")
    brand = F.when(k % 2 == 0, F.col("p_brand")).otherwise("")
    return table(spark, sf_dir, "part").select(
        k, T.query_text(F.col("p_type"), brand, F.when(k % 3 == 0, F.col("p_name"))).alias("query")
    )


HAZARDS = ["The Storm", "onon of", "thatxx", ""]
_SQL_HAZARD = f"lower({sql_list(HAZARDS)}[(page_id % 4 + 1)::INT])"


@query(f"""WITH p AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, html, {_SQL_HAZARD} AS h FROM pages),
  t AS (SELECT *, lower(title || ' ' || html) AS body FROM p)
  SELECT page_id, h = '' OR contains(body, h) OR len(list_filter(string_split(h, ' '), lambda w: length(w) > 3 AND contains(body, w))) > 0 AS hazard,
    length(title) > 0 AND (h = '' OR contains(lower(title), h)) AS keyword FROM t""")
def mentions_hazard(spark, sf_dir):
    hazard = F.element_at(F.array(*map(F.lit, HAZARDS)), (F.col("page_id") % 4 + 1).cast("int"))
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        T.mentions_hazard(title, F.col("html"), hazard).alias("hazard"),
        T.mentions_keyword(title, hazard).alias("keyword"),
    )


# ---------------------------------------------------------------- request errors


@query(f"""WITH e AS (SELECT event_id, regexp_extract(props, '(\\d+)', 1)::INT % 7 AS m, {SQL_MESSAGE} AS message, event_type <> 'error' AS success FROM events)
  SELECT event_id, {sql_list(SQL_CLASSES)}[m + 1] AS error_type, m = 4 AS fatal, NOT success AND m IN (1, 2) AS blocking FROM e""")
def classify_error(spark, sf_dir):
    message = F.element_at(F.array(*map(F.lit, MESSAGES)), event_number() % len(MESSAGES) + 1)
    error = T.classify_error(message)
    return table(spark, sf_dir, "events").select(
        "event_id", error.alias("error_type"), T.is_fatal(message).alias("fatal"),
        T.is_blocking(F.col("event_type") != "error", error).alias("blocking"),
    )


@query(f"""WITH e AS (SELECT event_id, regexp_extract(props, '(\\d+)', 1)::INT AS k, {SQL_MESSAGE} AS message, hour(ts) AS h FROM events),
  m AS (SELECT *, k % 9 AS streak, [5.0, 3.0, 4.0, 2.0, 2.0, 2.0, 2.0][k % 7 + 1]::DOUBLE AS factor FROM e)
  SELECT event_id, CASE WHEN streak = 0 THEN 2.0 ELSE least(120.0, 2.0 * pow(CASE WHEN k % 7 = 0 THEN 4.0 ELSE factor END, streak)) END
    * CASE WHEN h BETWEEN 9 AND 17 THEN 1.5 WHEN h BETWEEN 20 AND 23 THEN 2.0 ELSE 1.0 END AS seconds FROM m""")
def backoff_seconds(spark, sf_dir):
    k = event_number()
    message = F.element_at(F.array(*map(F.lit, MESSAGES)), k % len(MESSAGES) + 1)
    return table(spark, sf_dir, "events").select(
        "event_id", T.backoff_seconds(k % 9, message, F.hour("ts")).alias("seconds")
    )


# ---------------------------------------------------------------- dates


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, year(o_orderdate)::VARCHAR AS year,
    greatest((o_orderkey % 60 + 14)::INT, 30) AS lookback,
    o_orderdate::DATE BETWEEN DATE '1997-01-01' - 7 AND DATE '1997-03-01' + 7 AS inside FROM orders""")
def within_window(spark, sf_dir):
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    day = D.parse_dmy(text)
    start, end = F.lit("1997-01-01").cast("date"), F.lit("1997-03-01").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), D.query_year(day).alias("year"),
        D.lookback_days(day, F.date_add(day, (F.col("o_orderkey") % 60).cast("int"))).alias("lookback"),
        D.within_window(day, start, end).alias("inside"),
    )


@query("""WITH f AS (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey * 977 % 86400) AS t FROM orders)
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S') ELSE strftime(t + INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S') END AS ist FROM f""")
def gmt_to_ist(spark, sf_dir):
    k = F.col("o_orderkey")
    t = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 977 % 86400)")
    text = F.when(k % 10 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    return table(spark, sf_dir, "orders").select(k, D.gmt_to_ist(text).alias("ist"))


@query(f"""WITH {LINKS} SELECT ord, CASE WHEN year(ts) >= 2000 AND ord % 12 < 10 THEN strftime(ts, '%Y-%m-%d') END AS day FROM links""")
def date_from_url(spark, sf_dir):
    """Years before 2000 are not accepted, so such links have no date."""
    return links(spark, sf_dir).select("ord", F.date_format(D.date_from_url(F.col("link")), "yyyy-MM-dd").alias("day"))


WRITTEN = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("MMMM d, yyyy", "%B %-d, %Y"), ("d MMM yyyy", "%-d %b %Y"),
    ("dd.MM.yyyy", "%d.%m.%Y"), ("yyyy/MM/dd", "%Y/%m/%d"), ("d MMMM, yyyy", "%-d %B, %Y"),
]


@query("""SELECT o_orderkey, CASE (o_orderkey % 9)::INT WHEN 6 THEN strftime(DATE '2025-11-10' - (o_orderkey % 8)::INT, '%Y-%m-%d')
    WHEN 7 THEN '2025-11-03' WHEN 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def parse_date_text(spark, sf_dir):
    k = F.col("o_orderkey")
    texts = [F.date_format("o_orderdate", f) for f, _ in WRITTEN] + [
        F.concat((k % 8).cast("string"), F.lit(" days ago")), F.lit("1 week ago"), F.lit("no date"),
    ]
    text = F.element_at(F.array(*texts), (k % 9 + 1).cast("int"))
    as_of = F.lit("2025-11-10").cast("date")
    return table(spark, sf_dir, "orders").select(k, F.date_format(D.parse_date_text(text, as_of), "yyyy-MM-dd").alias("day"))


@query(f"""WITH {LINKS} SELECT ord, CASE WHEN ord % 3 = 0 THEN strftime(ts + INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S')
    WHEN year(ts) >= 2000 AND ord % 12 < 10 THEN strftime(ts, '%Y-%m-%d') || ' 12:00:00' ELSE '2025-11-10 12:00:00' END AS stamp FROM links""")
def entry_date(spark, sf_dir):
    published = F.when(F.col("ord") % 3 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(F.col("ord") % 3 == 1, "soon")
    return links(spark, sf_dir).select("ord", D.entry_date(published, F.col("link"), F.lit("2025-11-10").cast("date")).alias("stamp"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day, strftime(o_orderdate, '%Y-%m-%d') AS key FROM orders""")
def date_from_path(spark, sf_dir):
    k = F.col("o_orderkey")
    path = F.concat(F.lit("/data/x/"), F.when(k % 4 > 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("latest"), F.lit("/results.csv"))
    return table(spark, sf_dir, "orders").select(
        k, F.date_format(D.date_from_path(path), "yyyy-MM-dd").alias("day"),
        D.date_key(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("key"),
    )


# ---------------------------------------------------------------- regions and languages

REGIONS = [*R.REGION_LANGUAGES, "atlantis", "delhi"]
_CODES = ["en", "hi", "mni", "xx"]
_GUJARATI = {"hi": ["बाढ़", "वर्षा"], "gu": ["પૂર"]}


def _sql_map(values: dict) -> str:
    item = lambda v: sql_list(v) if isinstance(v, list) else f"'{v}'"
    return "MAP {" + ", ".join(f"'{k}': {item(v)}" for k, v in values.items()) + "}"


_PRIMARY = R.PRIMARY_LANGUAGE


@query(f"""WITH r AS (SELECT c_custkey, {sql_list(REGIONS)}[(c_custkey % {len(REGIONS)} + 1)::INT] AS region FROM customer),
  p AS (SELECT c_custkey, region, coalesce({_sql_map(_PRIMARY)}[region], 'en') AS primary_lang,
      unnest(coalesce({_sql_map(R.REGION_LANGUAGES)}[region], ['en'])) AS lang FROM r)
  SELECT c_custkey, region, primary_lang, lang, coalesce({_sql_map(R.LANGUAGE_NAMES)}[lang], lang) AS name FROM p""")
def languages_of(spark, sf_dir):
    region = F.element_at(F.array(*map(F.lit, REGIONS)), (F.col("c_custkey") % len(REGIONS) + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", region.alias("region"))
    langs = rows.select(
        "c_custkey", "region", R.primary_language(F.col("region")).alias("primary_lang"),
        F.explode(R.languages_of(F.col("region"))).alias("lang"),
    )
    return langs.withColumn("name", R.language_name(F.col("lang")))


@query(f"""WITH c AS (SELECT c_custkey, {sql_list(['en', 'hi', 'gu', 'ta'])}[(c_custkey % 4 + 1)::INT] AS code FROM customer)
  SELECT c_custkey, code, unnest(coalesce({_sql_map({'en': R.ENGLISH_TERMS, **_GUJARATI})}[code], {sql_list(R.ENGLISH_TERMS)})) AS term FROM c""")
def impact_terms(spark, sf_dir):
    code = F.element_at(F.array(*map(F.lit, ["en", "hi", "gu", "ta"])), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", code.alias("code")).select(
        "c_custkey", "code", F.explode(R.impact_terms(F.col("code"), _GUJARATI)).alias("term")
    )
