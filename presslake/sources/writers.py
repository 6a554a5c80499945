"""Writers. Each output is a partitioned folder written by all tasks, never one file through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from presslake.functions.dates import format_dmy
from presslake.operators.dedup import dedup_links_per_day
from presslake.operators.stats import stats_to_map
from presslake.sources.schemas import ARTICLE, METADATA_COLUMNS
from presslake.sources.workspace import materialize


def config_records(configs: DataFrame) -> DataFrame:
    """Configurations with their dates as ``dd/MM/yyyy`` text again."""
    return configs.withColumns({c: format_dmy(F.col(c)) for c in ("start_date", "end_date")})


def write_config(configs: DataFrame, path: str) -> None:
    """One JSON object per line; ``read_config(..., multi_line=False)`` reads it back."""
    config_records(configs).write.mode("overwrite").json(path)


def daily_rows(rows: DataFrame) -> DataFrame:
    """Rows with a readable date, unique by disaster, day and link, plus their ``day``."""
    stamped = rows.withColumn("day", F.try_to_timestamp("date", F.lit("yyyy-MM-dd HH:mm:ss")).cast("date"))
    return dedup_links_per_day(stamped.filter(F.col("day").isNotNull()), F.col("day"))


def write_metadata(rows: DataFrame, root: str, max_records_per_file: int = 1_000_000) -> None:
    """CSV under ``disaster_id=.../day=...``; only the days that occur are replaced.

    Rows are range-partitioned by disaster, day and link, so a day with most rows is written by several
    tasks and a quiet day by one.
    """
    out = daily_rows(rows)
    (
        out.select(*METADATA_COLUMNS, "day")
        .repartitionByRange("disaster_id", "day", "link")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("header", True)
        .option("escape", '"')
        .partitionBy("disaster_id", "day")
        .csv(root)
    )


def write_articles(articles: DataFrame, root: str) -> None:
    """JSON records under ``event=.../grade=...``; only the folders that occur are replaced, other events stay."""
    records = articles.select(*ARTICLE.names, F.col("disaster_id").alias("event"), F.col("extraction_quality").alias("grade"))
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event", "grade").json(root)


def read_written_articles(spark: SparkSession, root: str, output: str = "all") -> DataFrame:
    """One of the outputs ``all``, ``combined`` (high and medium), ``high``, ``medium``, ``low``.

    Only the folders of the wanted grades are listed and read.
    """
    grades = {"all": ["high", "medium", "low"], "combined": ["high", "medium"]}.get(output, [output])
    schema = T.StructType([*ARTICLE.fields, T.StructField("event", T.StringType()), T.StructField("grade", T.StringType())])
    return spark.read.schema(schema).json(root).filter(F.col("grade").isin(grades)).drop("event")


def combined(articles: DataFrame) -> DataFrame:
    """High, then medium articles. Written first: a sort reads its input twice, and a filter and a column each grade a text anew."""
    return materialize(articles, "graded").filter(F.col("extraction_quality").isin("high", "medium")).orderBy("extraction_quality", "ord")


def write_stats(stats: DataFrame, path: str, extracted_at: Column | None = None) -> None:
    """One JSON object per disaster, under ``event=...``; the objects of other events stay."""
    maps = stats_to_map(stats, extracted_at).withColumn("event", F.col("disaster_id"))
    maps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event").json(path)
