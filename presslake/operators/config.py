"""Event configurations: one row per disaster, everything inside it reached with array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslake.functions.dates import parse_dmy
from presslake.functions.regions import DEFAULT_KEYWORD_LANGUAGES, ENGLISH_TERMS, list_map
from presslake.sources.schemas import CONFIG

ERRORS = {
    "id": "Disaster ID is required",
    "hazards": "At least one hazard name is required",
    "start": "Start date is required",
    "end": "End date is required",
    "order": "End date must be after or equal to start date",
}


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def with_defaults(configs: DataFrame) -> DataFrame:
    """Missing maps and lists become empty, a missing country list becomes ``['IN']``, dates are parsed."""
    def empty(name: str) -> Column:
        kind = CONFIG[name].dataType.simpleString()
        blank = F.create_map() if kind.startswith("map") else F.array()
        return F.coalesce(F.col(name), blank.cast(kind))

    return configs.select(
        "disaster_id",
        parse_dmy(F.col("start_date")).alias("start_date"),
        parse_dmy(F.col("end_date")).alias("end_date"),
        *[empty(c).alias(c) for c in ("hazard_names", "keywords", "locations", "newspapers")],
        F.coalesce("country_codes", F.array(F.lit("IN"))).alias("country_codes"),
        empty("specific_links").alias("specific_links"),
    )


def with_default_keywords(configs: DataFrame, terms: dict[str, list[str]] | None = None) -> DataFrame:
    """Impact terms for configurations without keywords; languages absent from ``terms`` get English ones."""
    table = terms or {}
    default = {code: table.get(code, table.get("en", ENGLISH_TERMS)) for code in DEFAULT_KEYWORD_LANGUAGES}
    return configs.withColumn(
        "keywords", F.when(F.size("keywords") == 0, list_map(default)).otherwise(F.col("keywords"))
    )


def localized(mapping: Column, lang: Column, fallback: str = "en") -> Column:
    """Value of ``lang``, else of the fallback language, else empty."""
    return F.coalesce(
        F.try_element_at(mapping, lang), F.try_element_at(mapping, F.lit(fallback)), empty_strings()
    )


def config_languages() -> Column:
    """Sorted languages of hazards, keywords and newspapers, plus English."""
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.map_keys("hazard_names"), F.map_keys("keywords"), F.map_keys("newspapers"), F.array(F.lit("en"))
            )
        )
    )


def validate_config(configs: DataFrame) -> DataFrame:
    """One row ``(disaster_id, error)`` per violated rule; a valid configuration gives none."""
    start, end = F.col("start_date"), F.col("end_date")
    checks = F.array(
        F.when(F.coalesce("disaster_id", F.lit("")) == "", ERRORS["id"]),
        F.when(F.size("hazard_names") == 0, ERRORS["hazards"]),
        F.when(start.isNull(), ERRORS["start"]),
        F.when(end.isNull(), ERRORS["end"]),
        F.when(end < start, ERRORS["order"]),
    )
    return configs.select("disaster_id", F.explode(F.array_compact(checks)).alias("error"))


# ---------------------------------------------------------------- locations


def _state_entries() -> Column:
    return F.map_entries("locations")


def _district_map(state: Column) -> Column:
    return F.coalesce(state["value"]["districts"], F.create_map().cast("map<string,array<string>>"))


def all_cities() -> Column:
    return F.flatten(
        F.flatten(F.transform(_state_entries(), lambda s: F.map_values(_district_map(s))))
    )


def all_districts() -> Column:
    return F.flatten(F.transform(_state_entries(), lambda s: F.map_keys(_district_map(s))))


def flat_locations() -> Column:
    """State, then each of its districts followed by the district's cities; repeats stay."""
    return F.flatten(
        F.transform(
            _state_entries(),
            lambda s: F.concat(
                F.array(s["key"]),
                F.flatten(
                    F.transform(
                        F.map_entries(_district_map(s)), lambda d: F.concat(F.array(d["key"]), d["value"])
                    )
                ),
            ),
        )
    )


def ranked_locations() -> Column:
    """Cities with repeats, then districts not yet named, then states not yet named."""
    cities, districts = all_cities(), all_districts()
    new_districts = F.array_except(districts, cities)
    states = F.array_except(F.map_keys("locations"), F.concat(cities, new_districts))
    return F.concat(cities, new_districts, states)


def flatten_locations(configs: DataFrame) -> DataFrame:
    return configs.select("disaster_id", F.posexplode(flat_locations()).alias("ord", "location"))


def priority_locations(configs: DataFrame) -> DataFrame:
    return configs.select("disaster_id", F.posexplode(ranked_locations()).alias("ord", "location"))


def location_hierarchy(configs: DataFrame) -> DataFrame:
    """(state, district, city); branches without a city give no row."""
    states = configs.select("disaster_id", F.explode("locations").alias("state", "_s"))
    districts = states.select("disaster_id", "state", F.explode("_s.districts").alias("district", "_cities"))
    return districts.select("disaster_id", "state", "district", F.explode("_cities").alias("city"))


def languages_per_config(configs: DataFrame) -> DataFrame:
    return configs.select("disaster_id", F.posexplode(config_languages()).alias("lang_ord", "lang_code"))


def config_summary(configs: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.aggregate(
            F.map_values(name), F.lit(0), lambda acc, v: acc + F.coalesce(F.size(v), F.lit(0))
        )

    return configs.select(
        "disaster_id",
        "start_date",
        "end_date",
        F.size(config_languages()).alias("n_languages"),
        F.size("country_codes").alias("n_countries"),
        total("hazard_names").alias("n_hazard_names"),
        total("keywords").alias("n_keywords"),
        F.size("keywords").alias("n_keyword_languages"),
        F.size(flat_locations()).alias("n_locations"),
        total("newspapers").alias("n_newspapers"),
        F.size("specific_links").alias("n_links"),
    )
