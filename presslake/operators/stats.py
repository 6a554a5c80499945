"""Article statistics, distributions and stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from presslake.functions.dates import date_key

STAT_DIMENSIONS = ["language", "quality", "date", "location", "keyword"]


def _filled(c: Column) -> Column:
    return F.nullif(F.nullif(c, F.lit("")), F.lit("NaN"))


def article_statistics(articles: DataFrame) -> DataFrame:
    """``(disaster_id, dimension, key, n)``: total and counts by language, grade, date, location and keyword.

    One pass with grouping sets over five short columns; counts are combined before the shuffle. A missing
    date, location or keyword is not counted; a missing language or grade counts as ``unknown``.
    """
    narrow = articles.select(
        "disaster_id",
        F.coalesce("article_language", F.lit("unknown")).alias("language"),
        F.coalesce("extraction_quality", F.lit("unknown")).alias("quality"),
        date_key(_filled(F.col("metadata.csv_date"))).alias("date"),
        _filled(F.col("metadata.csv_location")).alias("location"),
        _filled(F.col("metadata.csv_keyword")).alias("keyword"),
    )
    sets = [["disaster_id", d] for d in STAT_DIMENSIONS] + [["disaster_id"]]
    counted = narrow.groupingSets(sets, "disaster_id", *STAT_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.grouping(d).alias(f"_{d}") for d in STAT_DIMENSIONS],
    )
    dimension = F.coalesce(*[F.when(F.col(f"_{d}") == 0, d) for d in STAT_DIMENSIONS], F.lit("total"))
    key = F.when(F.col("dimension") == "total", "all").otherwise(F.coalesce(*STAT_DIMENSIONS))
    return (
        counted.withColumn("dimension", dimension)
        .withColumn("key", key)
        .filter(F.col("key").isNotNull())
        .select("disaster_id", "dimension", "key", "n")
    )


def stats_to_map(stats: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One row per disaster with a ``key -> n`` map per dimension.

    The maps hold one entry per distinct value (languages, grades, days, configured places and keywords),
    never one per article.
    """
    def counts(name: str) -> Column:
        entry = F.when(F.col("dimension") == name, F.struct("key", "n"))
        return F.map_from_entries(F.collect_list(entry)).alias(f"by_{name}")

    stamp = F.lit(None).cast("string") if extracted_at is None else extracted_at
    return (
        stats.groupBy("disaster_id")
        .agg(
            F.max(F.when(F.col("dimension") == "total", F.col("n"))).alias("total_articles"),
            *[counts(d) for d in STAT_DIMENSIONS],
        )
        .withColumn("extraction_timestamp", stamp)
        .select(
            "disaster_id", "extraction_timestamp", "total_articles", *[f"by_{d}" for d in STAT_DIMENSIONS]
        )
    )


def find_duplicates(df: DataFrame, column: str, *scope: str) -> DataFrame:
    """Non-empty values that occur more than once (within each ``scope``), with their counts."""
    value = F.col(column)
    return (
        df.filter(value.isNotNull() & (value != ""))
        .groupBy(*scope, value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value, most frequent first; a missing value counts as ``unknown``."""
    value = F.coalesce(F.col(column), F.lit("unknown")).alias("value")
    total = df.select(F.count(F.lit(1)).alias("total")).scalar()
    return (
        df.groupBy(value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("percentage", F.col("n") * 100.0 / total)
        .orderBy(F.desc("n"), "value")
    )


def funnel(df: DataFrame, stages: dict[str, Column], *scope: str) -> DataFrame:
    """Rows that satisfy each stage's condition, one column per stage."""
    return df.groupBy(*scope).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in stages.items()])


def observe_funnel(df: DataFrame, name: str | Observation, stages: dict[str, Column]) -> DataFrame:
    """The same counters as live metrics of the running query; the rows pass unchanged."""
    return df.observe(name, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in stages.items()])
