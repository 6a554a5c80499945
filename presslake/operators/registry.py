"""Newspapers of a registry table, per configuration and language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslake.functions.regions import language_code, region_slug


NATIONAL = "national"


def split_languages(registry: DataFrame) -> DataFrame:
    """One row per newspaper and language; a cell may hold several languages (``A/B`` or ``A, B``)."""
    return registry.select(
        F.trim("`State/UT`").alias("state"),
        region_slug(F.col("`State/UT`")).alias("region"),
        F.trim("`Newspaper Name`").alias("name"),
        F.trim("Website").alias("link"),
        F.posexplode(F.split("`Language(s)`", r"\s*[/,]\s*")).alias("lang_ord", "language"),
    ).withColumn("language", F.trim("language")).withColumn("lang_code", language_code(F.col("language")))


def registry_newspapers(registry: DataFrame, configs: DataFrame, *aggregates: Column) -> DataFrame:
    """Newspapers of each configuration's states: ``(disaster_id, lang_code, region, name, link)``.

    National ones belong to every configuration. With ``aggregates`` one row per configuration, language and region that has
    these over its newspapers: all configurations of a region have the same ones, so they are taken once per region and
    language, and no configuration meets single newspapers.
    """
    states = configs.select(
        "disaster_id", F.explode(F.array_distinct(F.map_keys("locations"))).alias("_state")
    ).select("disaster_id", region_slug(F.col("_state")).alias("region"))
    everywhere = configs.select("disaster_id", F.lit(NATIONAL).alias("region"))
    papers = split_languages(registry).select("lang_code", "region", "name", "link")
    if aggregates:
        papers = papers.groupBy("lang_code", "region").agg(*aggregates)
    return states.unionByName(everywhere).distinct().join(papers, "region").select("disaster_id", *papers.columns)
