"""First-wins and best-wins deduplication.

Every table carries a unique ordinal (``ord``); "first" always means the smallest one. A group of copies may
hold a large share of the table, so no operator gathers a group: ``row_number() = 1`` is planned with a
per-task group limit before the shuffle, and the flags come from map-side combined minima that are joined
back on the unique ordinal instead of the repeated key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.functions.text import content_fingerprint, quality_rank, skip_url, strip


def keep_top(df: DataFrame, keys: list[Column], order: list[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def dedup_links_per_day(rows: DataFrame, day: Column | None = None, order: str = "ord") -> DataFrame:
    """First row per disaster, day and link; the same link on two days survives."""
    day = F.substring("date", 1, 10) if day is None else day
    return keep_top(rows, [F.col("disaster_id"), day, F.col("link")], [F.col(order)])


def _url_key() -> list[Column]:
    url = F.coalesce(F.col("normalized_url"), F.lit(""))
    # A row without an address is its own group, so these rows do not meet in one task.
    return [url, F.when(url == "", F.col("ord"))]


def dedup_url(articles: DataFrame, mode: str = "best", scope: tuple[str, ...] = ("disaster_id",)) -> DataFrame:
    """One article per normalized address and scope; rows without an address pass.

    ``best`` keeps the best grade, the first among equals. ``running`` keeps the first row and every later
    row whose grade is above all earlier ones.
    """
    rank = quality_rank(F.col("extraction_quality"))
    if mode == "best":
        return articles.join(_best_by_url(articles, scope).select("ord"), "ord", "left_semi")
    # A grade is above all earlier ones exactly when its row is the first of that grade or better.
    firsts = (
        articles.select(*scope, *[c.alias(f"k{i}") for i, c in enumerate(_url_key())], "ord", rank.alias("rank"))
        .groupBy(*scope, "k0", "k1")
        .agg(*[F.min(F.when(F.col("rank") >= r, F.col("ord"))).alias(f"m{r}") for r in (1, 2, 3)])
    )
    kept = firsts.select(
        F.explode(F.array_distinct(F.array_compact(F.array("m1", "m2", "m3")))).alias("ord")
    )
    return articles.join(kept, "ord", "left_semi")


def dedup_content(
    articles: DataFrame, prefix: int | None = 500, min_length: int = 100, scope: tuple[str, ...] = ("disaster_id",)
) -> DataFrame:
    """First article per scope and fingerprint of its lower-cased beginning; shorter texts pass.

    Articles that agree in their first ``prefix`` characters count as copies even if they differ later;
    ``prefix=None`` compares whole texts.
    """
    narrow = articles.select(*scope, "ord", _fingerprint(prefix, min_length))
    return articles.join(_first_by_text(narrow, scope), "ord", "left_semi")


def dedup_articles(
    articles: DataFrame, prefix: int | None = 500, min_length: int = 100, scope: tuple[str, ...] = ("disaster_id",)
) -> DataFrame:
    """``dedup_content`` of ``dedup_url``, decided on narrow rows; texts are only read for their fingerprints before the
    one semi join that keeps the articles."""
    best = _best_by_url(articles, scope, _fingerprint(prefix, min_length))
    return articles.join(_first_by_text(best, scope), "ord", "left_semi")


def _fingerprint(prefix: int | None, min_length: int) -> Column:
    text = F.col("article_text")
    whole = F.md5(F.lower(text).cast("binary")) if prefix is None else content_fingerprint(text, prefix)
    return F.when(F.length(text) >= min_length, whole).alias("fp")


def _best_by_url(articles: DataFrame, scope: tuple[str, ...], *more: Column) -> DataFrame:
    """``scope, ord`` (and ``fp``) of the best article of each address, summed up in the tasks first."""
    narrow = articles.select(
        *scope, *[c.alias(f"k{i}") for i, c in enumerate(_url_key())], "ord", quality_rank(F.col("extraction_quality")).alias("rank"), *more
    )
    fields = ["ord", *(["fp"] if more else [])]
    best = narrow.groupBy(*scope, "k0", "k1").agg(F.min(F.struct(-F.col("rank"), *fields)).alias("b"))
    return best.select(*scope, *[F.col(f"b.{c}").alias(c) for c in fields])


def _first_by_text(narrow: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """``ord`` of the first row of each fingerprint; rows without one are groups of their own."""
    own = F.when(F.col("fp").isNull(), F.col("ord")).alias("own")
    return narrow.groupBy(*scope, "fp", own).agg(F.min("ord").alias("ord")).select("ord")


def dedup_batch_urls(rows: DataFrame) -> DataFrame:
    """``status`` of each link within its file: ``skipped``, ``duplicate`` or ``process``; no row is dropped."""
    skipped = F.coalesce(skip_url(F.col("link")), F.lit(True))
    firsts = (
        rows.filter(~skipped)
        .groupBy("file", F.lower(strip(F.col("link"))).alias("_key"))
        .agg(F.min("ord").alias("ord"))
        .select("ord", F.lit(True).alias("_first"))
    )
    status = F.when(skipped, "skipped").when(F.col("_first"), "process").otherwise("duplicate")
    return rows.join(firsts, "ord", "left").withColumn("status", status).drop("_first")


def dedup_report(articles: DataFrame, prefix: int = 500, min_length: int = 100) -> DataFrame:
    """Counts before and after, per disaster: removed by address, then by content; repeated titles are counted.

    Combined aggregations over narrow rows; no article text is shuffled.
    """
    text = F.col("article_text")
    fingerprint = F.when(F.length(text) >= min_length, content_fingerprint(text, prefix))
    rank = quality_rank(F.col("extraction_quality"))
    narrow = articles.select(
        "disaster_id",
        *[c.alias(f"k{i}") for i, c in enumerate(_url_key())],
        "ord",
        rank.alias("rank"),
        fingerprint.alias("fp"),
        F.nullif(F.col("title"), F.lit("")).alias("title"),
    )
    survivors = (
        narrow.groupBy("disaster_id", "k0", "k1")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(-F.col("rank"), "ord", "fp", "title")).alias("best"),
        )
        .select(
            "disaster_id",
            "copies",
            F.col("best.fp").alias("fp"),
            F.col("best.title").alias("title"),
        )
    )
    # Fingerprints and titles are counted side by side, so the texts are read once.
    both = survivors.select(
        "disaster_id",
        "copies",
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (("text", "fp"), ("title", "title"))])
        ),
    )
    per_value = both.groupBy("disaster_id", "kind", "value").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")
    )
    is_text, empty = F.col("kind") == "text", F.col("value").isNull()
    counts = per_value.groupBy("disaster_id").agg(
        F.sum(F.when(is_text, F.col("copies"))).alias("original_count"),
        F.sum(F.when(is_text, F.col("n"))).alias("after_url"),
        F.sum(F.when(is_text & empty, F.col("n")).when(is_text, 1)).alias("final_count"),
        F.sum(F.when(~is_text & ~empty, F.col("n") - 1)).alias("title_duplicates"),
    )
    return counts.select(
        "disaster_id",
        "original_count",
        "final_count",
        (F.col("original_count") - F.col("after_url")).alias("url_duplicates_removed"),
        F.coalesce("title_duplicates", F.lit(0)).alias("title_duplicates"),
        (F.col("after_url") - F.col("final_count")).alias("content_duplicates_removed"),
        ((F.col("original_count") - F.col("final_count")) * 100.0 / F.col("original_count")).alias("removal_percentage"),
    )
