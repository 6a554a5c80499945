"""Configurations, locations and query generation over ``customer``, ``nation``, ``region``, ``supplier``."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.catalog.inputs import CONFIGS, configs, raw_configs, sql_list
from presslake.catalog.registry import query, table
from presslake.functions.regions import DEFAULT_KEYWORD_LANGUAGES, ENGLISH_TERMS
from presslake.operators import config as C, querygen as Q, registry as R
from presslake.sources.readers import read_config, read_links, read_registry, read_terms
from presslake.sources.workspace import new_path
from presslake.sources.writers import write_config
from presslake.functions.text import ban_key

_FMT = "'%Y-%m-%d'"


@query(f"""WITH {CONFIGS} SELECT disaster_id, strftime(start_date, {_FMT}) AS start_date, strftime(end_date, {_FMT}) AS end_date,
    CASE WHEN k % 53 = 0 THEN 0 ELSE 2 + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END END AS hazards,
    CASE WHEN k % 3 = 0 THEN 'US,IN' ELSE 'IN' END AS countries, CASE WHEN k % 10 = 0 THEN 2 ELSE 0 END AS links,
    CASE WHEN k % 6 = 0 THEN 0 ELSE 3 END AS states FROM cfg""")
def read_config_files(spark, sf_dir):
    """Configurations written as JSON records and read back with defaults filled in."""
    path = new_path(spark, "configs")
    raw_configs(spark, sf_dir).write.json(path)
    out = read_config(spark, path, multi_line=False)
    return out.select(
        "disaster_id", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end_date", "yyyy-MM-dd").alias("end_date"),
        F.aggregate(F.map_values("hazard_names"), F.lit(0), lambda a, v: a + F.size(v)).alias("hazards"),
        F.array_join("country_codes", ",").alias("countries"),
        F.size("specific_links").alias("links"), F.size("locations").alias("states"),
    )


@query(f"""WITH {CONFIGS} SELECT disaster_id, strftime(start_date, '%d/%m/%Y') AS start_date, strftime(end_date, '%d/%m/%Y') AS end_date FROM cfg""")
def write_config_files(spark, sf_dir):
    path = new_path(spark, "configs")
    write_config(configs(spark, sf_dir), path)
    return spark.read.schema("disaster_id STRING, start_date STRING, end_date STRING").json(path)


@query("""WITH f AS (SELECT 'g' || (p_partkey % 20) AS grp, p_type AS lang, p_name AS term FROM part)
  SELECT grp, lang, count(*) AS n, count(DISTINCT term) AS terms FROM f GROUP BY ALL""")
def read_terms_files(spark, sf_dir):
    """Term files, one JSON map per group of parts, written and read back."""
    path = new_path(spark, "terms")
    grp = F.concat(F.lit("g"), (F.col("p_partkey") % 20).cast("string"))
    # A file takes at most 500 terms, so a large group has several files.
    part = F.floor(F.col("p_partkey") / 10000)
    lists = (
        table(spark, sf_dir, "part").groupBy(grp.alias("grp"), part.alias("part"), F.col("p_type").alias("lang"))
        .agg(F.collect_list("p_name").alias("terms"))
        .groupBy("grp", "part").agg(F.map_from_entries(F.collect_list(F.struct("lang", "terms"))).alias("m"))
    )
    lists.select("grp", "part", F.to_json("m").alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("grp", "part").text(path)
    read = read_terms(spark, path + "/*/*/*.txt").select(
        F.regexp_extract("file", "grp=([^/]*)", 1).alias("grp"), F.explode("terms").alias("lang", "terms")
    )
    return read.select("grp", "lang", F.explode("terms").alias("term")).groupBy("grp", "lang").agg(
        F.count("term").alias("n"), F.countDistinct("term").alias("terms")
    )


@query("SELECT page_id, url AS link FROM pages")
def read_links_files(spark, sf_dir):
    """Link lists, as lines or as a JSON array, one file per 100 pages."""
    path = new_path(spark, "links")
    grp = F.floor(F.col("page_id") / 100)
    item = F.concat(F.lit(" "), "url", F.lit("?id="), F.col("page_id").cast("string"), F.lit(" "))
    lists = table(spark, sf_dir, "pages").groupBy(grp.alias("grp")).agg(F.collect_list(item).alias("urls"))
    text = F.when(F.col("grp") % 2 == 0, F.array_join("urls", "\n\n")).otherwise(F.to_json("urls"))
    lists.select("grp", text.alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("grp").text(path)
    found = read_links(spark, path + "/*/*.txt")
    return found.select(
        F.regexp_extract("link", r"\?id=(\d+)$", 1).cast("long").alias("page_id"),
        F.regexp_replace("link", r"\?id=\d+$", "").alias("link"),
    )


@query(f"""WITH {CONFIGS}, c AS (SELECT *, CASE WHEN k % 89 = 0 THEN '' ELSE disaster_id END AS id FROM cfg), e AS (
    SELECT k, '{C.ERRORS['id']}' AS error FROM c WHERE id = '' UNION ALL SELECT k, '{C.ERRORS['hazards']}' FROM c WHERE k % 53 = 0
    UNION ALL SELECT k, '{C.ERRORS['start']}' FROM c WHERE start_date IS NULL UNION ALL SELECT k, '{C.ERRORS['order']}' FROM c WHERE end_date < start_date)
  SELECT CASE WHEN k % 89 = 0 THEN '' ELSE 'ev-' || k END AS disaster_id, error FROM e""")
def validate_config(spark, sf_dir):
    rows = configs(spark, sf_dir)
    key = F.substring("disaster_id", 4, 20).cast("long")
    return C.validate_config(rows.withColumn("disaster_id", F.when(key % 89 == 0, "").otherwise(F.col("disaster_id"))))


@query(f"WITH {CONFIGS} SELECT disaster_id, unnest(langs) AS lang_code, generate_subscripts(langs, 1) - 1 AS lang_ord FROM cfg")
def config_languages(spark, sf_dir):
    return C.languages_per_config(configs(spark, sf_dir))


@query(f"""WITH {CONFIGS} SELECT disaster_id, len(langs) AS n_languages, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS n_countries,
    CASE WHEN k % 53 = 0 THEN 0 WHEN k % 3 = 0 THEN 3 ELSE 2 END AS n_hazard_names,
    CASE WHEN k % 7 = 0 THEN 0 WHEN k % 4 = 0 THEN 15 ELSE 12 END AS n_keywords, CASE WHEN k % 7 = 0 THEN 0 WHEN k % 4 = 0 THEN 2 ELSE 1 END AS n_keyword_languages,
    len(flat) AS n_locations, (CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) AS n_newspapers,
    CASE WHEN k % 10 = 0 THEN 2 ELSE 0 END AS n_links FROM cfg""")
def config_summary(spark, sf_dir):
    return C.config_summary(configs(spark, sf_dir)).drop("start_date", "end_date")


@query(f"WITH {CONFIGS} SELECT disaster_id, unnest(flat) AS location, generate_subscripts(flat, 1) - 1 AS ord FROM cfg")
def flatten_locations(spark, sf_dir):
    return C.flatten_locations(configs(spark, sf_dir))


@query(f"WITH {CONFIGS} SELECT disaster_id, unnest(prio) AS location, generate_subscripts(prio, 1) - 1 AS ord FROM cfg")
def priority_locations(spark, sf_dir):
    return C.priority_locations(configs(spark, sf_dir))


@query(f"""WITH {CONFIGS}, c AS (SELECT * FROM cfg WHERE k % 6 <> 0)
  SELECT disaster_id, r_name AS state, n_name AS district, seg || ' City' AS city FROM c UNION ALL SELECT disaster_id, r_name, n_name, n_name FROM c
  UNION ALL SELECT disaster_id, 'Coast', 'North', 'Port ' || k FROM c UNION ALL SELECT disaster_id, 'Coast', 'North', seg || ' City' FROM c""")
def location_hierarchy(spark, sf_dir):
    return C.location_hierarchy(configs(spark, sf_dir))


@query(f"WITH {CONFIGS} SELECT disaster_id, lang_code, array_to_string(hazards, '|') AS hazards, array_to_string(kws, '|') AS keywords FROM per_lang")
def localized(spark, sf_dir):
    rows = configs(spark, sf_dir).select("*", F.explode(C.config_languages()).alias("lang_code"))
    pick = lambda c: F.array_join(C.localized(F.col(c), F.col("lang_code")), "|")
    return rows.select("disaster_id", "lang_code", pick("hazard_names").alias("hazards"), pick("keywords").alias("keywords"))


_DEFAULTS = {"hi": ["बाढ़", "वर्षा"]}


@query(f"""WITH {CONFIGS}, d AS (SELECT unnest({sql_list(DEFAULT_KEYWORD_LANGUAGES)}) AS lang)
  SELECT disaster_id, lang, CASE WHEN lang = 'hi' THEN 2 ELSE {len(ENGLISH_TERMS)} END AS n FROM cfg, d WHERE k % 7 = 0
  UNION ALL SELECT disaster_id, 'en', 12 FROM cfg WHERE k % 7 <> 0 UNION ALL SELECT disaster_id, 'hi', 3 FROM cfg WHERE k % 7 <> 0 AND k % 4 = 0""")
def default_keywords(spark, sf_dir):
    rows = C.with_default_keywords(configs(spark, sf_dir), _DEFAULTS)
    return rows.select("disaster_id", F.explode("keywords").alias("lang", "kws")).select("disaster_id", "lang", F.size("kws").alias("n"))


# ---------------------------------------------------------------- queries

_ORD = "SELECT *, unnest({0}) AS {1}, generate_subscripts({0}, 1) - 1 AS {2} FROM {3}"
ALL_QUERIES = f"""base AS (SELECT disaster_id, lang_code, yr, hazards, kws, papers, CASE WHEN len(flat) = 0 THEN [''] ELSE flat END AS locs FROM per_lang),
  b1 AS ({_ORD.format('hazards', 'hazard', 'h', 'base')}), b2 AS ({_ORD.format('kws', 'keyword', 'kk', 'b1')}),
  b3 AS ({_ORD.format('locs', 'location', 'l', '(SELECT * FROM b2 WHERE kk < 10)')}), b4 AS ({_ORD.format('papers', 'paper', 'p', '(SELECT * FROM b3 WHERE kk < 5 AND l < 5)')}),
  q AS (SELECT disaster_id, lang_code, 'broad' AS type, concat_ws(' ', hazard, keyword, nullif(location, ''), yr) AS query, hazard, keyword, location, '' AS paper, 0 AS kind, h, kk, l, 0 AS p FROM b3
    UNION ALL SELECT disaster_id, lang_code, 'targeted', concat_ws(' ', hazard, keyword, nullif(location, ''), paper, yr), hazard, keyword, location, paper, 1, h, kk, l, p FROM b4),
  all_queries AS (SELECT *, row_number() OVER (PARTITION BY disaster_id, lang_code ORDER BY kind, h, kk, l, p) - 1 AS ord FROM q)"""


@query(f"WITH {CONFIGS}, {ALL_QUERIES} SELECT disaster_id, lang_code, ord, type, query, hazard, keyword, location, paper FROM all_queries")
def expand_all_queries(spark, sf_dir):
    out = Q.expand_all_queries(configs(spark, sf_dir))
    return out.select(
        "disaster_id", "lang_code", "ord", "type", "query", "hazard", "keyword", "location",
        F.coalesce("newspaper.name", F.lit("")).alias("paper"),
    )


def smart_sql(q: int) -> str:
    """The budgets as running counts: a kind stops once the list has reached the sum of the shares so far."""
    return f"""sb AS (SELECT disaster_id, lang_code, hazards, kws[1:5] AS kws, CASE WHEN len(prio) = 0 THEN [''] ELSE prio[1:5] END AS locs FROM per_lang),
  s1 AS (SELECT * FROM ({_ORD.format('hazards', 'hazard', 'h', 'sb')}) WHERE h < greatest(1, {q // 5})),
  n1 AS (SELECT disaster_id, lang_code, count(*) AS n1 FROM s1 GROUP BY ALL),
  s2a AS ({_ORD.format('hazards', 'hazard', 'h', 'sb JOIN n1 USING (disaster_id, lang_code)')}),
  s2b AS (SELECT *, row_number() OVER (PARTITION BY disaster_id, lang_code ORDER BY h, kk) AS rn FROM ({_ORD.format('kws', 'keyword', 'kk', 's2a')}) WHERE kk < {q // 4} - n1),
  s2 AS (SELECT * FROM s2b WHERE rn <= greatest(1, {q // 5 + q // 4} - n1)),
  n2 AS (SELECT disaster_id, lang_code, n1, coalesce(any_value(c), 0) AS n2 FROM n1 LEFT JOIN (SELECT disaster_id, lang_code, count(*) AS c FROM s2 GROUP BY ALL) USING (disaster_id, lang_code) GROUP BY ALL),
  s3a AS ({_ORD.format('hazards', 'hazard', 'h', 'sb JOIN n2 USING (disaster_id, lang_code)')}),
  s3b AS (SELECT *, row_number() OVER (PARTITION BY disaster_id, lang_code ORDER BY h, l) AS rn FROM ({_ORD.format('locs', 'location', 'l', 's3a')}) WHERE l < {q // 5} AND location <> ''),
  s3 AS (SELECT * FROM s3b WHERE rn <= greatest(1, {2 * (q // 5) + q // 4} - n1 - n2)),
  s4a AS ({_ORD.format('hazards', 'hazard', 'h', 'sb')}), s4b AS ({_ORD.format('kws', 'keyword', 'kk', 's4a')}), s4c AS ({_ORD.format('locs', 'location', 'l', '(SELECT * FROM s4b WHERE kk < 2)')}),
  s4 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY disaster_id, lang_code ORDER BY h, kk, l) AS rn FROM s4c WHERE l < 3 AND location <> '') WHERE rn <= greatest(1, {q * 35 // 100})),
  su AS (SELECT disaster_id, lang_code, 'hazard_only' AS type, 1 AS kind, h AS rn, hazard AS query FROM s1
    UNION ALL SELECT disaster_id, lang_code, 'broad_priority', 2, rn, concat_ws(' ', hazard, keyword) FROM s2
    UNION ALL SELECT disaster_id, lang_code, 'location_only', 3, rn, concat_ws(' ', hazard, location) FROM s3
    UNION ALL SELECT disaster_id, lang_code, 'location_priority', 4, rn, concat_ws(' ', hazard, keyword, location) FROM s4),
  smart AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY disaster_id, lang_code ORDER BY kind, rn) - 1 AS ord FROM su) WHERE ord < {q})"""


@query(f"WITH {CONFIGS}, {smart_sql(50)} SELECT disaster_id, lang_code, ord, type, query FROM smart")
def smart_queries(spark, sf_dir):
    return Q.smart_queries(configs(spark, sf_dir), 50).select("disaster_id", "lang_code", "ord", "type", "query")


@query(f"WITH {CONFIGS}, {smart_sql(12)} SELECT disaster_id, lang_code, ord, type, query FROM smart")
def smart_queries_small_budget(spark, sf_dir):
    return Q.smart_queries(configs(spark, sf_dir), 12).select("disaster_id", "lang_code", "ord", "type", "query")


@query(f"""WITH {CONFIGS}, {smart_sql(50)}, g AS (SELECT lang_code, type, grouping(lang_code) AS gl, grouping(type) AS gt, count(*) AS n FROM smart GROUP BY GROUPING SETS ((lang_code), (type), ()))
  SELECT CASE WHEN gl = 0 THEN 'language' WHEN gt = 0 THEN 'type' ELSE 'total' END AS dimension, coalesce(lang_code, type, 'all') AS key, n, n * 5.0::DOUBLE AS seconds FROM g""")
def query_summary(spark, sf_dir):
    return Q.query_summary(Q.smart_queries(configs(spark, sf_dir), 50))


@query(f"WITH {CONFIGS}, {smart_sql(50)} SELECT type, disaster_id, lang_code, ord, query FROM smart")
def group_queries(spark, sf_dir):
    return Q.group_queries(Q.smart_queries(configs(spark, sf_dir), 50), "type").select("type", "disaster_id", "lang_code", "ord", "query")


@query(f"""WITH {CONFIGS}, {smart_sql(50)}, banned AS (SELECT substring(md5(c_mktsegment || ' storm' || '_en'), 1, 8) AS ban_key FROM customer
    UNION SELECT substring(md5('Cyclone ' || c_name || '_en'), 1, 8) FROM customer WHERE c_acctbal < 0)
  SELECT disaster_id, lang_code, ord, query FROM smart WHERE substring(md5(query || '_' || lang_code), 1, 8) NOT IN (SELECT ban_key FROM banned)""")
def drop_banned(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    names = customer.select(F.concat("c_mktsegment", F.lit(" storm")).alias("q")).distinct().unionByName(
        customer.filter("c_acctbal < 0").select(F.concat(F.lit("Cyclone "), "c_name").alias("q"))
    )
    banned = names.select(ban_key(F.col("q"), F.lit("en")).alias("ban_key"))
    queries = Q.smart_queries(configs(spark, sf_dir), 50).select("disaster_id", "lang_code", "ord", "query")
    return Q.drop_banned(queries, banned)


# ---------------------------------------------------------------- registry

_LANGS = ["English", "English, Hindi", "Malayalam/English", "Khasi", "Mizo"]


def _registry(spark, sf_dir):
    """A registry file with one newspaper per supplier, written as CSV and read back."""
    path = new_path(spark, "registry")
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    k = F.col("s_suppkey")
    rows = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.initcap("r_name").alias("State/UT"), F.col("s_name").alias("Newspaper Name"),
            F.element_at(F.array(*map(F.lit, _LANGS)), (k % 5 + 1).cast("int")).alias("Language(s)"),
            F.concat(F.lit("https://s"), k.cast("string"), F.lit(".example.com")).alias("Website"),
        )
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_registry(spark, path)


REGISTRY = f"""reg AS (SELECT s_suppkey, s_name AS name, replace(lower(r_name), ' ', '-') AS region, 'https://s' || s_suppkey || '.example.com' AS link,
    unnest(regexp_split_to_array({sql_list(_LANGS)}[(s_suppkey % 5 + 1)::INT], '\\s*[/,]\\s*')) AS language
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  coded AS (SELECT *, MAP {{'English': 'en', 'Hindi': 'hi', 'Malayalam': 'ml', 'Mizo': 'lus'}}[language] AS lang_code FROM reg)"""


@query(f"WITH {REGISTRY} SELECT name, region, language, lang_code FROM coded")
def split_languages(spark, sf_dir):
    return R.split_languages(_registry(spark, sf_dir)).select("name", "region", "language", "lang_code")


@query(f"""WITH {REGISTRY}, {CONFIGS} SELECT disaster_id, lang_code, region, count(*) AS papers, min(name) AS first_name FROM cfg JOIN coded ON region = replace(lower(r_name), ' ', '-')
  WHERE k % 6 <> 0 GROUP BY ALL""")
def registry_newspapers(spark, sf_dir):
    aggregates = F.count(F.lit(1)).alias("papers"), F.min("name").alias("first_name")
    return R.registry_newspapers(_registry(spark, sf_dir), configs(spark, sf_dir), *aggregates)
