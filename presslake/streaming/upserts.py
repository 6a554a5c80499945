"""A table with one row per key that later, better copies replace, kept up to date by micro-batches.

Rows lie in hash buckets of their key. A micro-batch reads the buckets that it touches, keeps the best row of each key and
writes those buckets into a folder of its own; then a manifest says which folder holds which bucket now. Readers
go by the last manifest, so they see a batch wholly or not at all, and a batch that is repeated starts from the manifest
before it and ends where it ended the first time. No row is too late: an old one takes part like a new one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from presslake.operators.dedup import keep_top


def _manifest(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """The batch that wrote each bucket last, as of the batches before ``before``; at most one row per bucket."""
    try:
        all_ = spark.read.schema("bucket INT, written BIGINT, batch BIGINT").parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    held = all_ if before is None else all_.filter(F.col("batch") < before)
    last = held.agg(F.max("batch")).first()[0]
    return {} if last is None else {r["bucket"]: r["written"] for r in held.filter(F.col("batch") == last).collect()}


def _read(spark: SparkSession, root: str, schema: T.StructType, places: dict[int, int]) -> DataFrame:
    paths = [f"{root}/rows/batch={written}/bucket={bucket}" for bucket, written in sorted(places.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stored(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows as of the last whole batch."""
    return _read(spark, root, schema, _manifest(spark, root))


def rewrite(rows: DataFrame, number: int, root: str, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, schema: str | None = None) -> None:
    """Put a batch's ``rows`` into the table below ``root``: each touched bucket becomes ``combine(its rows, the batch's)``.

    ``schema`` is the table's, where the batch's rows have another. The driver gets one row per touched bucket. ``rows``
    is read twice: persist it, or make it cheap.
    """
    spark, kept_as = rows.sparkSession, T.StructType.fromDDL(schema) if schema else rows.schema
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = {r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()}
    places = _manifest(spark, root, number)
    old = _read(spark, root, kept_as, {b: w for b, w in places.items() if b in touched})
    kept = combine(old, rows)
    kept.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/batch={number}")
    now = places | {b: number for b in touched}
    manifest = spark.createDataFrame(sorted(now.items()), "bucket INT, written BIGINT").coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{root}/manifest/batch={number}")


def merge(batch: DataFrame, number: int, root: str, keys: list[str], order: list[Column], buckets: int = 64) -> None:
    """Put one batch into the table below ``root``: of each key (nulls are equal) the first row by ``order`` stays.

    ``order`` must tell a key's rows apart for a repeatable result. A row that is already in the table competes with the
    batch's rows by the same order.
    """
    # Only the best of a key leaves a task, so a key with most of the rows costs a row per task.
    top = lambda rows: keep_top(rows, [F.col(k) for k in keys], order, 1)
    rewrite(top(batch), number, root, keys, lambda old, new: top(new.unionByName(old)), buckets)


def upsert(rows: DataFrame, root: str, checkpoint: str, keys: list[str], order: list[Column], buckets: int = 64) -> DataStreamWriter:
    """A stream of rows into the table below ``root``; bound the micro-batch at the source."""

    def save(batch: DataFrame, number: int) -> None:
        merge(batch.persist(), number, root, keys, order, buckets)
        batch.unpersist()

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
