"""Readers with declared schemas. A missing value is NULL; a bare ``NaN`` text is missing too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from presslake.functions.dates import date_from_path
from presslake.functions.text import strip
from presslake.operators.config import with_default_keywords, with_defaults
from presslake.sources.schemas import ARTICLE, CONFIG, FEED, METADATA, PAGE, REGISTRY, STATISTICS, TERMS


def read_config(
    spark: SparkSession, path: str | list[str], multi_line: bool = True,
    default_keywords: dict[str, list[str]] | bool = False,
) -> DataFrame:
    """Configurations, one JSON object per file (or per line), with defaults filled in and dates parsed.

    ``default_keywords`` fills in impact terms where a configuration names no keywords.
    """
    raw = spark.read.schema(CONFIG).option("multiLine", multi_line).json(path)
    configs = with_defaults(raw)
    if default_keywords is False:
        return configs
    return with_default_keywords(configs, default_keywords if isinstance(default_keywords, dict) else None)


def read_terms(spark: SparkSession, path: str, schema: T.DataType = TERMS) -> DataFrame:
    """``(file, terms)``: one map per JSON file; ``schema`` for locations or newspapers instead of lists."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.from_json("value", schema).alias("terms")
    )


def split_links(text: Column, separator: str) -> Column:
    """Links of one list: a JSON array when it starts with ``[``, else separated text; blanks go."""
    trimmed = strip(text)
    items = F.when(trimmed.startswith("["), F.from_json(trimmed, T.ArrayType(T.StringType()))).otherwise(
        F.split(trimmed, separator)
    )
    return F.filter(F.transform(items, lambda x: strip(x)), lambda x: x != "")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``(file, ord, link)`` of link-list files: a JSON array or one link per line."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.posexplode(split_links(F.col("value"), "\n")).alias("ord", "link")
    )


def read_feed(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Feed entries; absent summaries and sources become empty texts."""
    raw = spark.read.schema(FEED).format(file_format).load(path)
    return raw.withColumn("summary", F.coalesce("summary", F.lit(""))).withColumn(
        "source", F.struct(F.coalesce(F.col("source.title"), F.lit("")).alias("title"))
    )


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw pages; where a table has a ``status``, only 200 goes on."""
    pages = spark.read.parquet(path)
    return fetched(pages)


def fetched(pages: DataFrame) -> DataFrame:
    return pages.filter("status = 200") if "status" in pages.columns else pages.select(
        *[c for c in PAGE.names if c in pages.columns]
    )


def _metadata_csv(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
        .option("enforceSchema", False)
    )


def _empty_is_null(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in METADATA.names})


def read_metadata(spark: SparkSession, root: str, date_range: tuple[str, str] | None = None) -> DataFrame:
    """Metadata rows of all ``*.csv`` below ``root`` with their ``file``, their ``ord`` (unique, in
    the order of the file, as ``extract`` takes it) and, from the path, their ``day``.

    Columns go by the names in each file's header, in any order; absent ones are NULL, others are left out. A file without a
    ``link`` column has no rows here; ``metadata_errors`` names it. A range keeps only the files of those days and drops
    files whose path has no date. Of a root that ``write_metadata`` wrote, ``read_metadata_days`` prunes the directories.
    """
    rows = _metadata_rows(spark, root, date_range).filter(F.array_contains("header", "link"))
    found = {c: F.try_element_at(F.col("value"), F.lit(c)) for c in METADATA.names}
    # What a folder says counts where the file has no such column.
    folder = F.nullif(F.regexp_extract("file", "/disaster_id=([^/]*)/", 1), F.lit(""))
    found["disaster_id"] = F.coalesce(found["disaster_id"], folder)
    return _empty_is_null(rows.select(*[v.alias(c) for c, v in found.items()], "file", "ord", "day"))


def metadata_errors(spark: SparkSession, root: str, date_range: tuple[str, str] | None = None) -> DataFrame:
    """``file, header`` of the CSV files below ``root`` that have no ``link`` column and are not read."""
    rows = _metadata_rows(spark, root, date_range, headers=True)
    return rows.filter(~F.array_contains("header", "link")).select("file", "header")


def _widest(spark: SparkSession, root: str) -> int:
    """How many columns the first line of any CSV file below ``root`` may name; one line per file and task is shuffled."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
    numbered = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    first = numbered.filter("block = 0").groupBy("file").agg(F.min_by("value", "n").alias("value"))
    return max(1, first.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 0)


def _metadata_rows(spark: SparkSession, root: str, date_range: tuple[str, str] | None, headers: bool = False) -> DataFrame:
    """``file, day, header, value`` of CSV rows, ``value`` a map by the names in the file's own first row.

    A file is read by one task, in order, as rows may span lines; its first row is therefore the one with the least number.
    Names in a header hold no line break.
    """
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(_widest(spark, root))])
    path = F.col("_metadata.file_path")
    day = F.coalesce(date_from_path(path), F.try_to_date(F.regexp_extract(path, r"/day=(\d{4}-\d{2}-\d{2})/", 1), "yyyy-MM-dd"))
    raw = (
        spark.read.schema(cells).option("multiLine", True).option("escape", '"')
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(root)
        .select(path.alias("file"), day.alias("day"), F.array(*[F.col(c) for c in cells.names]).alias("cells"))
    )
    if date_range is not None:
        raw = raw.filter(F.col("day").between(*[F.lit(d).cast("date") for d in date_range]))
    numbered = raw.withColumn("n", F.monotonically_increasing_id())
    first = numbered.groupBy("file").agg(F.min(F.struct("n", "cells")).alias("h"))
    names = F.transform("h.cells", lambda c: F.lower(strip(F.regexp_replace(c, "^\ufeff", ""))))
    first = first.select("file", F.col("h.n").alias("first"), names.alias("names"))
    if headers:
        return first.select("file", F.array_compact("names").alias("header"))
    pairs = F.filter(F.arrays_zip(F.col("names").alias("k"), F.col("cells").alias("v")), lambda p: F.coalesce(p["k"] != "", F.lit(False)))
    value = F.map_from_entries(F.filter(pairs, lambda p: p["k"].isin(METADATA.names)))
    joined = numbered.join(first, "file").filter(F.col("n") > F.col("first"))
    return joined.select("file", F.col("n").alias("ord"), "day", F.array_compact("names").alias("header"), value.alias("value"))


def read_metadata_days(spark: SparkSession, root: str, date_range: tuple[str, str] | None = None) -> DataFrame:
    """Rows of ``write_metadata``; a date range becomes a filter on the partition column ``day``."""
    rows = _metadata_csv(spark, T.StructType([*METADATA.fields, T.StructField("day", T.DateType())])).csv(root)
    if date_range is not None:
        rows = rows.filter(F.col("day").between(*[F.lit(d).cast("date") for d in date_range]))
    return _empty_is_null(rows)


def read_articles(spark: SparkSession, path: str | list[str], multi_line: bool = False, prefix: str = "") -> DataFrame:
    """Articles from JSON files with their ``file``; ``multi_line`` for files that hold one array.

    ``prefix`` keeps only files in a folder whose name starts with it.
    """
    raw = spark.read.schema(ARTICLE).option("multiLine", multi_line).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.json"
    ).json(path)
    out = raw.select("*", F.col("_metadata.file_path").alias("file"))
    clean = {c: F.nullif(F.col(f"metadata.{c}"), F.lit("NaN")) for c in ARTICLE["metadata"].dataType.names}
    out = out.withColumn("metadata", F.struct(*[v.alias(k) for k, v in clean.items()]))
    if prefix:
        out = out.filter(F.element_at(F.split("file", "/"), -2).startswith(prefix))
    # An object that is not a list of articles has none of their fields.
    return out.filter(F.col("id").isNotNull() | F.col("final_url").isNotNull() | F.col("article_text").isNotNull())


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATISTICS).json(path).select(*STATISTICS.names)


def latest_stats(spark: SparkSession, root: str) -> DataFrame:
    """The JSON file below ``root`` that was modified last and has ``stats`` in its name, as ``(file, modified, stats)``.

    A part file that Spark wrote goes by the name of its folder, partition folders aside. The file is chosen by its listing
    alone; no other file is read. Without such a file there is no row.
    """
    folder = F.element_at(F.filter(F.split("file", "/"), lambda p: ~p.contains("=") & ~p.startswith("part-")), -1)
    below = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")]
    listed = below.format("binaryFile").load(root).select(*place).filter(F.lower(folder).contains("stats"))
    newest = listed.agg(F.max_by("file", F.struct("modified", "file"))).first()[0]
    texts = below.text(root, wholetext=True).filter(F.col("_metadata.file_path") == F.lit(newest))
    return texts.select(*place, F.col("value").alias("stats"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY).option("header", True).option("escape", '"').csv(path)
