"""Incremental collection: feed entries to deduplicated day partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from presslake.functions.dates import entry_date
from presslake.functions.text import mentions_hazard, normalize_url
from presslake.operators.articles import metadata_projection
from presslake.operators.matching import attach_query, window_join
from presslake.operators.stats import observe_funnel
from presslake.sources.schemas import METADATA_COLUMNS


def stream_rows(entries: DataFrame, queries: DataFrame, configs: DataFrame, as_of: Column, late: str = "7 days") -> DataFrame:
    """Metadata rows of a stream of entries, one per disaster and normalized address.

    The first copy wins: a better later copy cannot replace an emitted row. State is kept for ``late``
    after a row's event time; rows older than that are dropped.
    """
    dated = entries.withColumn("date", entry_date(F.col("published"), F.col("link"), as_of))
    found = attach_query(dated, queries.drop("ord"))
    relevant = found.filter(mentions_hazard(F.col("title"), F.col("summary"), F.col("hazard")))
    rows = metadata_projection(window_join(relevant, configs))
    return (
        rows.withColumn("event_ts", F.try_to_timestamp("date", F.lit("yyyy-MM-dd HH:mm:ss")))
        .withColumn("normalized_url", normalize_url(F.col("link")))
        .withWatermark("event_ts", late)
        .dropDuplicatesWithinWatermark(["disaster_id", "normalized_url"])
    )


def write_days(rows: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Append each micro-batch under its days; a batch that is repeated after a failure replaces itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("day", F.to_date("event_ts")).withColumn("batch", F.lit(batch_id))
        (
            out.select(*METADATA_COLUMNS, "day", "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("header", True)
            .option("escape", '"')
            .partitionBy("day", "batch")
            .csv(root)
        )

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def write_counted(rows: DataFrame, root: str, checkpoint: str, stages: dict[str, Column]) -> DataStreamWriter:
    """Append rows below ``root`` as Parquet and, in the same pass, count how many satisfy each stage's condition.

    Counts are taken where a micro-batch is written, so rows are not read again, and stand in a folder of the batch's own:
    a batch that is repeated replaces its rows and its counts, and none counts twice.
    """
    schema = ", ".join(f"`{n}` BIGINT" for n in stages)

    def save(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        observe_funnel(batch, seen, stages).write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")
        counts = batch.sparkSession.createDataFrame([tuple(seen.get[n] for n in stages)], schema).coalesce(1)
        counts.write.mode("overwrite").parquet(f"{root}/counts/batch={batch_id}")

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def live_counts(spark: SparkSession, root: str, stages: dict[str, Column]) -> DataFrame:
    """The counts of each micro-batch that ``write_counted`` has finished: ``batch`` and one column per stage."""
    schema = ", ".join(f"`{n}` BIGINT" for n in stages)
    return spark.read.schema(f"{schema}, batch BIGINT").parquet(f"{root}/counts").select("batch", *stages)
