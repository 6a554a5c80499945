"""Search queries from configurations.

Each configuration row is expanded in place by a chain of explodes over prefix-cut arrays: no join and no
shuffle. The budgets of ``smart_queries`` are closed-form, so a query's place follows from its positions
and the surplus is filtered before the next explode widens it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslake.functions.dates import query_year
from presslake.functions.text import ban_key, query_text
from presslake.operators.config import config_languages, flat_locations, localized, ranked_locations
from presslake.sources.schemas import NEWSPAPER

# Prefix lengths of the exhaustive products and of the budgeted ones.
BROAD_KEYWORDS, TARGETED_KEYWORDS, TARGETED_LOCATIONS = 10, 5, 5
SMART_KEYWORDS, SMART_LOCATIONS, PAIR_KEYWORDS, PAIR_LOCATIONS = 5, 5, 2, 3

COLUMNS = ["disaster_id", "lang_code", "ord", "query", "has_newspaper", "hazard", "keyword", "location", "newspaper", "type"]


def _per_language(configs: DataFrame, locations: Column) -> DataFrame:
    with_lang = configs.select("*", F.explode(config_languages()).alias("lang_code"))
    lang = F.col("lang_code")
    return with_lang.select(
        "disaster_id",
        "lang_code",
        query_year(F.col("start_date")).alias("year"),
        localized(F.col("hazard_names"), lang).alias("hazards"),
        localized(F.col("keywords"), lang).alias("kws"),
        F.when(F.size("locations") > 0, locations).otherwise(F.array(F.lit(""))).alias("locs"),
        F.coalesce(
            F.try_element_at(F.col("newspapers"), lang),
            F.array().cast(f"array<{NEWSPAPER.simpleString()}>"),
        ).alias("papers"),
    )


def _rows(df: DataFrame, kind: str, *text: Column) -> DataFrame:
    paper = F.col("newspaper") if "newspaper" in df.columns else F.lit(None).cast(NEWSPAPER)
    keyword = F.col("keyword") if "keyword" in df.columns else F.lit("")
    location = F.col("location") if "location" in df.columns else F.lit("")
    return df.select(
        "disaster_id",
        "lang_code",
        F.col("ord").cast("long").alias("ord"),
        query_text(*text).alias("query"),
        paper.isNotNull().alias("has_newspaper"),
        "hazard",
        keyword.alias("keyword"),
        location.alias("location"),
        paper.alias("newspaper"),
        F.lit(kind).alias("type"),
    )


def expand_all_queries(configs: DataFrame) -> DataFrame:
    """Every hazard x keyword x location, and every hazard x keyword x location x newspaper.

    Ten keywords and all locations without newspapers, five and five with them. ``ord`` is the place of
    the query within its disaster and language.
    """
    base = _per_language(configs, flat_locations())
    broad = (
        base.withColumn("kws", F.slice("kws", 1, BROAD_KEYWORDS))
        .select("*", F.posexplode("hazards").alias("h", "hazard"))
        .select("*", F.posexplode("kws").alias("k", "keyword"))
        .select("*", F.posexplode("locs").alias("l", "location"))
        .withColumn("ord", (F.col("h").cast("long") * F.size("kws") + F.col("k")) * F.size("locs") + F.col("l"))
    )
    n_broad = F.size("hazards").cast("long") * F.least(F.size("kws"), F.lit(BROAD_KEYWORDS)) * F.size("locs")
    targeted = (
        base.filter(F.size("papers") > 0)
        .withColumn("n_broad", n_broad)
        .withColumn("kws", F.slice("kws", 1, TARGETED_KEYWORDS))
        .withColumn("locs", F.slice("locs", 1, TARGETED_LOCATIONS))
        .select("*", F.posexplode("hazards").alias("h", "hazard"))
        .select("*", F.posexplode("kws").alias("k", "keyword"))
        .select("*", F.posexplode("locs").alias("l", "location"))
        .select("*", F.posexplode("papers").alias("p", "newspaper"))
        .withColumn(
            "ord",
            F.col("n_broad")
            + ((F.col("h").cast("long") * F.size("kws") + F.col("k")) * F.size("locs") + F.col("l")) * F.size("papers")
            + F.col("p"),
        )
    )
    hazard, keyword, location, year = (F.col(c) for c in ("hazard", "keyword", "location", "year"))
    return _rows(broad, "broad", hazard, keyword, location, year).unionByName(
        _rows(targeted, "targeted", hazard, keyword, location, F.col("newspaper.name"), year)
    )


def smart_queries(configs: DataFrame, max_queries: int = 50) -> DataFrame:
    """At most ``max_queries`` per disaster and language, spread over four kinds of query.

    Hazard alone, hazard + keyword, hazard + location, hazard + keyword + location; each kind has a share
    of the budget, a kind with any candidate gets at least one query, and unused budget moves on.
    """
    q = max_queries
    fifth, quarter, third_share = q // 5, q // 4, q * 35 // 100
    base = (
        _per_language(configs, ranked_locations())
        .withColumn("kws", F.slice("kws", 1, SMART_KEYWORDS))
        .withColumn("locs", F.slice("locs", 1, SMART_LOCATIONS))
        .withColumn("nh", F.size("hazards"))
        .withColumn("n1", F.least(F.col("nh"), F.lit(max(1, fifth))))
        # The keyword prefix may be negative for tiny budgets and then counts from the end.
        .withColumn("cut", F.lit(quarter) - F.col("n1"))
        .withColumn(
            "kw2",
            F.when(F.col("cut") >= 0, F.least(F.size("kws"), F.col("cut"))).otherwise(
                F.greatest(F.lit(0), F.size("kws") + F.col("cut"))
            ),
        )
        .withColumn("n2", F.least(F.col("nh") * F.col("kw2"), F.greatest(F.lit(1), F.lit(fifth + quarter) - F.col("n1"))))
        .withColumn("loc3", F.filter(F.slice("locs", 1, fifth), lambda x: x != ""))
        .withColumn(
            "n3",
            F.least(
                F.col("nh") * F.size("loc3"),
                F.greatest(F.lit(1), F.lit(2 * fifth + quarter) - F.col("n1") - F.col("n2")),
            ),
        )
        .withColumn("kw4", F.slice("kws", 1, PAIR_KEYWORDS))
        .withColumn("loc4", F.filter(F.slice("locs", 1, PAIR_LOCATIONS), lambda x: x != ""))
        .withColumn("n4", F.least(F.col("nh") * F.size("kw4") * F.size("loc4"), F.lit(max(1, third_share))))
        # No kind uses more hazards than the budget has queries.
        .withColumn("hazards", F.slice("hazards", 1, max(1, q)))
    )
    by_hazard = base.select("*", F.posexplode("hazards").alias("h", "hazard"))
    hazard, keyword, location = (F.col(c) for c in ("hazard", "keyword", "location"))
    offset2 = F.col("n1")
    offset3 = F.col("n1") + F.col("n2")
    offset4 = F.col("n1") + F.col("n2") + F.col("n3")

    def capped(df: DataFrame, place: Column, cap: str, offset: Column) -> DataFrame:
        return df.filter(place < F.col(cap)).withColumn("ord", offset + place).filter(F.col("ord") < q)

    only_hazard = capped(by_hazard, F.col("h"), "n1", F.lit(0))
    with_keyword = capped(
        by_hazard.filter(F.col("h") * F.col("kw2") < F.col("n2")).select(
            "*", F.posexplode(F.slice(F.col("kws"), F.lit(1), F.col("kw2"))).alias("k", "keyword")
        ),
        F.col("h") * F.col("kw2") + F.col("k"),
        "n2",
        offset2,
    )
    with_location = capped(
        by_hazard.filter(F.col("h") * F.size("loc3") < F.col("n3")).select(
            "*", F.posexplode("loc3").alias("l", "location")
        ),
        F.col("h") * F.size("loc3") + F.col("l"),
        "n3",
        offset3,
    )
    with_both = capped(
        by_hazard.filter(F.col("h") * F.size("kw4") * F.size("loc4") < F.col("n4"))
        .select("*", F.posexplode("kw4").alias("k", "keyword"))
        .select("*", F.posexplode("loc4").alias("l", "location")),
        (F.col("h") * F.size("kw4") + F.col("k")) * F.size("loc4") + F.col("l"),
        "n4",
        offset4,
    )
    return (
        _rows(only_hazard, "hazard_only", hazard)
        .unionByName(_rows(with_keyword, "broad_priority", hazard, keyword))
        .unionByName(_rows(with_location, "location_only", hazard, location))
        .unionByName(_rows(with_both, "location_priority", hazard, keyword, location))
    )


def query_id(disaster_id: Column, lang: Column, ord_: Column) -> Column:
    return F.concat_ws("/", disaster_id, lang, ord_.cast("string"))


def query_summary(queries: DataFrame, seconds_per_query: float = 5.0) -> DataFrame:
    """Number of queries and estimated seconds in total, per language and per type."""
    counted = queries.select("lang_code", "type").groupingSets(
        [["lang_code"], ["type"], []], "lang_code", "type"
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping("lang_code").alias("gl"), F.grouping("type").alias("gt"))
    return counted.select(
        F.when(F.col("gl") == 0, "language").when(F.col("gt") == 0, "type").otherwise("total").alias("dimension"),
        F.when(F.col("gl") == 0, F.col("lang_code")).when(F.col("gt") == 0, F.col("type")).otherwise("all").alias("key"),
        "n",
        (F.col("n") * seconds_per_query).alias("seconds"),
    )


def group_queries(queries: DataFrame, by: str) -> DataFrame:
    """Queries laid out group by group in list order, for ``by`` = ``type`` or ``lang_code``.

    A range sort: a group that holds most rows spreads over several partitions instead of one list.
    """
    return queries.orderBy(by, "disaster_id", "lang_code", "ord")


def drop_banned(queries: DataFrame, banned: DataFrame) -> DataFrame:
    """Queries whose key is not in ``banned(ban_key)``."""
    keyed = queries.withColumn("_key", ban_key(F.col("query"), F.col("lang_code")))
    return keyed.join(banned.select(F.col("ban_key").alias("_key")), "_key", "left_anti").drop("_key")
