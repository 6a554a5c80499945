"""Queries against a corpus, and what happens to the entries they find."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from presslake.functions.dates import entry_date, within_window
from presslake.functions.text import SPACE_CLASS, ban_key, mentions_hazard, words
from presslake.operators.articles import metadata_projection
from presslake.operators.dedup import keep_top
from presslake.operators.health import failure_streak
from presslake.sources.workspace import materialize

SALTS = 32
#: Days that share a key in the join of dated queries, and the most date ranges that the corpus is read by.
SPAN_DAYS, MOST_RANGES = 16, 32


# What is no letter, mark or digit, where a word begins or ends; inside a word it stays.
_AROUND = rf"(?<=^|[{SPACE_CLASS}])[^\p{{L}}\p{{M}}\p{{N}}{SPACE_CLASS}]+|[^\p{{L}}\p{{M}}\p{{N}}{SPACE_CLASS}]+(?=[{SPACE_CLASS}]|$)"


def match_words(text: Column) -> Column:
    """Lower-cased words without the punctuation around them."""
    return words(_bare(text))


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), _AROUND, "")


def _alternatives(queries: DataFrame, phrase: bool, *keep: str) -> DataFrame:
    """One row per ``OR`` alternative with its distinct words and, for phrases, all of them in order."""
    alts = queries.select("query_id", *keep, F.posexplode(F.split("query", " OR ")).alias("alt", "_text"))
    words_ = match_words(F.col("_text"))
    phrases = words_ if phrase else F.lit(None).cast("array<string>")
    return alts.select("query_id", *keep, "alt", F.array_distinct(words_).alias("terms"), phrases.alias("phrase")).filter(F.size("terms") > 0)


def _shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` whose join is a sort-merge join. Files of few distinct words, and rows not yet exploded, take a small part of
    the memory that their rows do, so Spark's size check would take millions of them for small enough to send through the driver."""
    return rows.hint("merge")


def match_queries(queries: DataFrame, corpus: DataFrame, mode: str = "all", salts: int = SALTS) -> DataFrame:
    """``(query_id, doc_id)`` for every document that satisfies a query.

    Words are compared without the punctuation around them. ``all``: every word of one ``OR`` alternative occurs as a word. ``phrase``: the words occur next to each
    other in order. ``queries(query_id, query[, since, until])``, ``corpus(doc_id, text[, date])``; with
    ``since`` and ``until`` (dates or timestamps) only documents between them count. Of such a corpus only the spans of days are
    read that some query asks for: a range filter on ``date``, which reaches the scan. In the join, a window meets the
    postings of its own spans only.

    Each alternative is looked up by its rarest word only, an equi-join on the word; a frequent word is
    spread over ``salts`` keys on the corpus side. The other words of a candidate are looked up among the
    postings of query words; no text is shuffled. For phrases, postings have the places of a word: a phrase is found where
    the places of all its words, each shifted back by its number in the phrase, have one in common.
    """
    phrase = mode == "phrase"
    dated = "since" in queries.columns
    window = ["since", "until"] if dated else []
    alts = _alternatives(queries, phrase, *window)
    if dated:
        first, last, spans = _asked_spans(queries, corpus)
        corpus = corpus.filter(_in_spans(F.col("date"), spans))
    wanted = alts.select(F.explode("terms").alias("token")).distinct()
    day = ["date"] if dated else []
    # Three uses below: the corpus is split into words once, and only the words of queries are kept.
    if phrase:
        # Texts that share an id are told apart by their hash.
        placed = corpus.select("doc_id", F.xxhash64("text").alias("copy"), *day, F.posexplode(match_words(F.col("text"))).alias("place", "token"))
        met = placed.join(wanted, "token", "left_semi")
        relevant = materialize(met.groupBy("doc_id", "copy", *day, "token").agg(F.collect_list("place").alias("places")), "postings")
    else:
        postings = corpus.select("doc_id", *day, F.explode(F.array_distinct(match_words(F.col("text")))).alias("token"))
        relevant = materialize(postings.join(wanted, "token", "left_semi"), "postings")
    frequency = relevant.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # An alternative with a word that occurs nowhere has no match and is dropped by the count.
    drivers = (
        alts.select("query_id", *window, "alt", "terms", "phrase", F.explode("terms").alias("token"))
        .join(_shuffled(frequency), "token")
        .groupBy("query_id", *window, "alt", "terms", "phrase")
        .agg(F.min(F.struct("df", "token")).alias("rarest"), F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == F.size("terms"))
        .select("query_id", *window, "alt", "terms", "phrase", F.col("rarest.token").alias("token"))
    )
    spread = drivers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = relevant.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    if dated:
        # A document has one span, so it meets a query once.
        met = salted.withColumn("span", _span(F.col("date"))).join(_shuffled(_with_spans(spread, first, last)), ["token", "salt", "span"])
        candidates = met.filter(F.col("date").between(F.col("since"), F.col("until")))
    else:
        candidates = salted.join(_shuffled(spread), ["token", "salt"])
    if phrase:
        return _phrases(candidates.select("query_id", "alt", "doc_id", "copy", "phrase"), relevant.select("doc_id", "copy", "token", "places"))
    rest = F.array_except("terms", F.array("token"))
    pairs = candidates.select("query_id", "alt", "doc_id", rest.alias("rest"))
    single = pairs.filter(F.size("rest") == 0).select("query_id", "doc_id")
    several = (
        pairs.select("query_id", "alt", "doc_id", F.size("rest").alias("n"), F.explode("rest").alias("token"))
        .join(_shuffled(relevant.select("doc_id", "token")), ["doc_id", "token"])
        .groupBy("query_id", "alt", "doc_id", "n")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == F.col("n"))
        .select("query_id", "doc_id")
    )
    return single.unionByName(several).distinct()


def _span(day: Column) -> Column:
    return F.floor(F.unix_date(day.cast("date")) / SPAN_DAYS).cast("int")


def _with_spans(rows: DataFrame, first: int, last: int) -> DataFrame:
    """``rows`` once for each ``span`` from ``first`` to ``last`` that their window ``since`` to ``until`` meets."""
    low, high = F.greatest(_span(F.col("since")), F.lit(first)), F.least(_span(F.col("until")), F.lit(last))
    # Without these conditions, a window turned round would count downwards and one without an end would count.
    open_ = F.col("since").isNull() | F.col("until").isNull()
    return rows.filter(~open_ & (low <= high)).withColumn("span", F.explode(F.sequence(low, high)))


def _asked_spans(queries: DataFrame, corpus: DataFrame) -> tuple[int, int, list[int]]:
    """The first and last span of the corpus, and those between them that a query's window meets.

    Spans are bounded by the calendar, not by the number of queries or documents.
    """
    first, last = corpus.agg(F.min(_span(F.col("date"))), F.max(_span(F.col("date")))).first()
    if first is None:
        return 0, -1, []
    asked = _with_spans(queries.select("since", "until").distinct(), first, last).select("span").distinct()
    return first, last, sorted(r["span"] for r in asked.collect())


def _in_spans(date: Column, spans: list[int]) -> Column:
    """Whether a date lies in one of at most MOST_RANGES ranges that cover the spans; the narrowest gaps are covered too."""
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(spans, spans[1:]), 1) if b > a + 1), reverse=True)
    cuts = [0, *sorted(i for _, i in gaps[: MOST_RANGES - 1]), len(spans)]
    epoch, found = dt.date(1970, 1, 1).toordinal(), F.lit(False)
    for start, end in zip(cuts, cuts[1:]):
        if start == end:
            continue
        # Days before the first or behind the last that a date can have bound nothing.
        low, high = epoch + spans[start] * SPAN_DAYS, epoch + (spans[end - 1] + 1) * SPAN_DAYS
        inside = date.isNotNull()
        if low >= dt.date.min.toordinal():
            inside = inside & (date >= F.lit(dt.date.fromordinal(low)))
        if high <= dt.date.max.toordinal():
            inside = inside & (date < F.lit(dt.date.fromordinal(high)))
        found = found | inside
    return found


def _phrases(candidates: DataFrame, postings: DataFrame) -> DataFrame:
    """``query_id, doc_id`` of candidates in which the words of ``phrase`` stand next to each other.

    A group has one list of places per word of the phrase, so the phrase bounds it.
    """
    keys = ["query_id", "alt", "doc_id", "copy"]
    own = candidates.distinct().select(*keys, F.size("phrase").alias("n"), F.posexplode("phrase").alias("number", "token"))
    shifted = F.transform("places", lambda p: p - F.col("number")).alias("starts")
    met = own.join(_shuffled(postings.dropDuplicates(["doc_id", "copy", "token"])), ["doc_id", "copy", "token"]).select(*keys, "n", shifted)
    lists = met.groupBy(*keys, "n").agg(F.collect_list("starts").alias("lists")).filter(F.size("lists") == F.col("n"))
    common = F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), lambda acc, x: F.array_intersect(acc, x))
    return lists.filter(F.size(common) > 0).select("query_id", "doc_id").distinct()


def attach_query(entries: DataFrame, queries: DataFrame) -> DataFrame:
    """Entries with the columns of the query that found them."""
    return entries.join(queries, "query_id")


def window_join(entries: DataFrame, configs: DataFrame, buffer: int = 7) -> DataFrame:
    """Entries whose ``date`` lies in their disaster's window, widened by ``buffer`` days on both sides."""
    windows = configs.select("disaster_id", "start_date", "end_date")
    day = F.to_date(F.substring("date", 1, 10))
    return (
        entries.join(windows, "disaster_id")
        .filter(within_window(day, F.col("start_date"), F.col("end_date"), buffer))
        .drop("start_date", "end_date")
    )


def first_country_with_results(entries: DataFrame) -> DataFrame:
    """Per query only the entries of the first country, in list order, that has any."""
    first = entries.groupBy("query_id").agg(F.min("country_ord").alias("country_ord"))
    return entries.join(first, ["query_id", "country_ord"], "left_semi")


def collect_entries(entries: DataFrame, queries: DataFrame, configs: DataFrame, as_of: Column) -> DataFrame:
    """Metadata rows of the entries that are in their event's window and mention its hazard.

    ``entries`` follow the feed schema; ``queries`` carry ``query_id`` and the query columns.
    """
    dated = entries.withColumn("date", entry_date(F.col("published"), F.col("link"), as_of))
    found = attach_query(dated, queries.drop("ord"))
    relevant = found.filter(mentions_hazard(F.col("title"), F.col("summary"), F.col("hazard")))
    return metadata_projection(window_join(relevant, configs), "ord")


def query_coverage(queries: DataFrame, hits: DataFrame, samples: int = 3) -> DataFrame:
    """Per query and country: number of hits and the first titles; queries without a hit keep a row per country.

    ``queries(query_id, query, country)``, ``hits(query_id, country, ord, title)``.
    """
    keys = ["query_id", "country"]
    counted = hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    first = (
        keep_top(hits, [F.col(k) for k in keys], [F.col("ord")], samples)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("ord", "title"))).alias("_s"))
        .select(*keys, F.transform("_s", lambda s: s["title"]).alias("samples"))
    )
    return (
        queries.join(counted, keys, "left")
        .join(first, keys, "left")
        .select(
            *keys, "query", F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("samples", F.array().cast("array<string>")).alias("samples"),
        )
    )


def coverage_totals(coverage: DataFrame) -> DataFrame:
    """Successful query/country pairs, distinct successful queries and the countries that gave any result."""
    return coverage.filter("n > 0").agg(
        F.count(F.lit(1)).alias("combinations"),
        F.countDistinct("query").alias("queries"),
        F.array_sort(F.collect_set("country")).alias("countries"),
    )


def banned_queries(attempts: DataFrame, min_streak: int = 3) -> DataFrame:
    """Keys of queries whose last attempt failed while their state key had ``min_streak`` failures in a row.

    ``attempts`` is a request log with the ``query`` and ``lang_code`` of each request and ``last_attempt``.
    """
    streaks = failure_streak(attempts)
    return (
        streaks.filter(F.col("last_attempt") & ~F.col("success") & (F.col("streak") >= min_streak))
        .select(ban_key(F.col("query"), F.col("lang_code")).alias("ban_key"))
        .distinct()
    )
