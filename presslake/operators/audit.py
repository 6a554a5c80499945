"""Near-duplicate audit: titles and texts that are similar but not equal.

Similarity is the Jaccard ratio of token sets: character trigrams for titles, word five-grams for whole texts. Equal sets
are one member from the start. The join is exact. Of word five-grams, two sets that reach the ratio share one of the rarest
tokens of both, as many as the ratio allows to miss, so only these prefixes are joined, block by block; sizes and places
of the token exclude most pairs of blocks inside the join, and whole sets are compared for the rest. Which texts share
enough tokens at all is found on packed arrays (``shingles.members``). Titles share trigrams and letters with most others,
so such an index would list nearly all pairs; they are compared in cells (``cells.dense_pairs``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from presslake.functions.blocks import ratio_of_least
from presslake.functions.text import let
from presslake.operators.cells import dense_pairs
from presslake.operators.shingles import MARKS, blocks, members, prefix, rated
from presslake.sources.workspace import materialize

ROWS_PER_SALT = 20_000


def trigrams(text: Column) -> Column:
    """Distinct character trigrams of a text with two end marks on either side; none for an empty one."""
    # Bound once: inside a lambda, the characters would be cut anew for every trigram.
    grams = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2)))
    marked = F.split(F.concat(F.lit("\u0002\u0002"), text, F.lit("\u0003\u0003")), "")
    return F.when(text != "", F.array_distinct(let(marked, grams))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Ratio of common to all elements of two sets; 0 for two empty ones."""
    all_ = F.size(F.array_union(a, b))
    return F.when(all_ > 0, F.size(F.array_intersect(a, b)) / all_).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard ratio of two titles' character trigrams."""
    return jaccard(trigrams(a), trigrams(b))


def _candidates(held: DataFrame, low: float) -> DataFrame:
    """Pairs ``row, col`` of different blocks that may have a pair of sets with the ratio; all that do are among them."""
    marks = [f"m{m}" for m in range(MARKS)]
    rows = held.select("block", "n", *marks, F.size("own").alias("shared"), F.posexplode(F.arrays_zip(prefix("own").alias("token"), prefix("df").alias("df"))).alias("at", "p"))
    # Of a block: the sizes of its sets, what may follow the n-gram, and the bits that all and that any of them have.
    sums = [F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("shared") - F.col("at")).alias("rest"), F.max("p.df").alias("df")]
    sums += [f(m).alias(f"{k}{m}") for m in marks for k, f in (("all_", F.bit_and), ("any_", F.bit_or))]
    placed = rows.groupBy("block", F.col("p.token").alias("token")).agg(*sums).withColumn("salts", F.ceil(F.col("df") / ROWS_PER_SALT).cast("int"))
    left = placed.withColumn("salt", F.pmod(F.xxhash64("block"), F.col("salts")).cast("int")).alias("x")
    right = placed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("y")
    sizes = f"x.high >= y.low * {low!r} - 1e-9 AND y.high >= x.low * {low!r} - 1e-9"
    # At a pair's first common n-gram, no more than what follows it can be common; later ones may not reject a pair, so it
    # is kept when any passes. A bit that only one of two sets has is an n-gram that they have not in common.
    need = f"(x.low + y.low) * {low!r} - 1e-9"
    reach = f"least(x.rest, y.rest) * {1 + low!r} >= {need}"
    alone = lambda x, y: " + ".join(f"bit_count({x}.all_{m} & ~{y}.any_{m})" for m in marks)
    bound = f"least(x.high - ({alone('x', 'y')}), y.high - ({alone('y', 'x')})) * {1 + low!r} >= {need}"
    met = left.join(right, F.expr(f"x.token = y.token AND x.salt = y.salt AND x.block < y.block AND {sizes} AND {reach} AND {bound}"))
    return met.select(F.col("x.block").alias("row"), F.col("y.block").alias("col")).distinct()


def distinct_titles(articles: DataFrame, *scope: str) -> DataFrame:
    """Lower-cased titles with their number of articles and first article."""
    return (
        articles.filter(F.coalesce(F.col("title"), F.lit("")) != "")
        .groupBy(*scope, F.lower("title").alias("t"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("id"))
    )


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Instead of ``t`` the ``tokens``: its ``trigrams``, as numbers that have 21 bits for each character."""
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            texts = part.column("t").to_pylist()
            codes = np.frombuffer("".join(f"\u0002\u0002{t}\u0003\u0003" for t in texts).encode("utf-32-le"), "<u4").astype(np.int64)
            grams = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
            ends = np.cumsum([len(t) + 4 for t in texts]).tolist()
            sets = [np.unique(grams[e - len(t) - 4 : e - 2]) if t else grams[:0] for t, e in zip(texts, ends, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(s) for s in sets])), pa.int32()), pa.array(np.concatenate(sets)))
            kept = [name for name in part.schema.names if name != "t"]
            yield pa.RecordBatch.from_arrays([*[part.column(name) for name in kept], lists], names=[*kept, "tokens"])


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every character of ``t`` with the number of its occurrences so far, so that a set of them is the multiset."""
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            part = batch.slice(first, 200)
            sets = [[f"{c}{k}" for c, n in Counter(t).items() for k in range(n)] for t in part.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sets, pa.list_(pa.string()))], names=[*part.schema.names, "tokens"])


def _rated(batches: Iterator[pa.RecordBatch], low: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("title_a").to_pylist(), batch.column("title_b").to_pylist()
        found = pa.array([ratio_of_least(x, y, low) for x, y in zip(a, b, strict=True)], pa.float64())
        out = pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "similarity"])
        yield out.filter(found.is_valid())


def similar_titles(articles: DataFrame, low: float | None = None, scope: tuple[str, ...] = (), metric: str = "trigrams") -> DataFrame:
    """Pairs of different titles with a similarity of ``low`` or more.

    ``trigrams``: the Jaccard ratio of character trigrams, 0.6 if nothing else is said. ``blocks``: the ratio of matching
    blocks (``matching_ratio``) of the earlier title to the later one, 0.8. Equal titles are counted first (``n_a``,
    ``n_b``), so copies never pair with each other. ``a`` is the title that appears first; titles are compared in lower
    case.

    Matching blocks are common letters, so titles that reach a ratio ``s`` share that part of their letters: a Jaccard
    ratio of ``s / (2 - s)`` of the multisets, and have a common subsequence of that part; only such pairs are compared.
    """
    if metric not in ("trigrams", "blocks"):
        raise ValueError(f"unknown metric: {metric}")
    titles = materialize(distinct_titles(articles, *scope), "titles")
    if metric == "blocks":
        return _similar_blocks(titles, 0.8 if low is None else low, list(scope))
    texts = titles.select(*scope, "id", "t")
    fields = [*[f for f in texts.schema.fields if f.name != "t"], T.StructField("tokens", T.ArrayType(T.LongType()))]
    grams = materialize(texts.mapInArrow(_trigrams, T.StructType(fields)), "sets")
    found = dense_pairs(grams, list(scope), 0.6 if low is None else low)
    pairs = found.select(*scope, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
    side = lambda k: titles.select(*scope, F.col("id").alias(k), F.col("t").alias(f"title_{k}"), F.col("n").alias(f"n_{k}"))
    named = pairs.join(side("a"), [*scope, "a"]).join(side("b"), [*scope, "b"])
    return named.select(*scope, F.col("a").alias("id_a"), F.col("b").alias("id_b"), "title_a", "title_b", "n_a", "n_b", "similarity")


def _similar_blocks(titles: DataFrame, low: float, scope: list[str]) -> DataFrame:
    share = low / (2 - low)
    texts = titles.select(*scope, "id", "t")
    sets = texts.mapInArrow(_letters, T.StructType([*texts.schema.fields, T.StructField("tokens", T.ArrayType(T.StringType()))]))
    hashed = sets.select(*texts.columns, F.transform("tokens", lambda c: F.xxhash64(c)).alias("tokens"))
    found = dense_pairs(hashed, scope, share, letters=low)
    pairs = found.select(*scope, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    side = lambda k: titles.select(*scope, F.col("id").alias(f"id_{k}"), F.col("t").alias(f"title_{k}"), F.col("n").alias(f"n_{k}"))
    named = pairs.withColumnsRenamed({"a": "id_a", "b": "id_b"}).join(side("a"), [*scope, "id_a"]).join(side("b"), [*scope, "id_b"])
    wanted = named.select(*scope, "id_a", "id_b", "title_a", "title_b", "n_a", "n_b")
    return wanted.mapInArrow(lambda b: _rated(b, low), T.StructType([*wanted.schema.fields, T.StructField("similarity", T.DoubleType())]))


def similar_content(articles: DataFrame, low: float = 0.8, n: int = 5, scope: tuple[str, ...] = ("disaster_id",)) -> DataFrame:
    """Pairs of different article texts, over all articles of a scope, with a Jaccard ratio of ``low`` or more.

    Whole texts are compared by runs of ``n`` words. Articles of the same text are one (``n_a``, ``n_b`` count them,
    ``id`` is the first), so a group of copies costs one row. Texts are told apart by their MD5, so none is shuffled.
    Articles without a scope pair with none.
    """
    named = [F.col(c).isNotNull() for c in scope]
    rows = articles.filter(reduce(Column.__and__, named, F.coalesce("article_text", F.lit("")) != "")).select(*scope, "ord", F.lower("article_text").cast("binary").alias("text"))
    rows = rows.withColumn("digest", F.md5("text"))
    key = F.xxhash64(*scope, "digest").alias("key")
    distinct = rows.groupBy(*scope, "digest").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("id"), F.max(F.octet_length("text")).alias("size"))
    texts = materialize(distinct.select(*scope, key, "n", "id", "size"), "texts")
    fit = members(rows.select(key, F.xxhash64(*scope, F.lit(n)).alias("scope"), "text"), n, low, texts.agg(F.sum("size")).first()[0] or 0)
    held = blocks(fit)
    pairs = materialize(rated(held, _candidates(held, low), low), "pairs")
    side = lambda k: texts.select(*scope, F.col("key").alias(k), F.col("id").alias(f"id_{k}"), F.col("n").alias(f"n_{k}"))
    both = pairs.join(side("a"), "a").join(side("b").drop(*scope), "b")
    earlier = F.col("id_a") <= F.col("id_b")
    first = lambda c: F.when(earlier, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(f"{c}_a")
    second = lambda c: F.when(earlier, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(f"{c}_b")
    return both.select(*scope, first("id"), second("id"), first("n"), second("n"), "similarity")
