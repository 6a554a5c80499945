"""Target-distribution importance resampling with hashed n-gram features, computed by Arrow kernels.

Features are counted in hash buckets for the raw corpus and for the target. A bucket's gain is the logarithm of its
share in the target over its share in the corpus; a document's weight is the mean gain of its features. Adding Gumbel
noise, a hash of the document's id, to the weights and keeping the largest sums draws documents without replacement in
proportion to the exponential of their weights.

A batch of texts goes through ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``;
n-grams are pairs of shifted dictionary indices, of which only distinct ones are hashed; gains are taken by index and
summed by segment. Nothing is done word by word in Python.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from presslake.llm.common import positions, raw, text_slices
from presslake.sources.workspace import materialize

#: Everything in ASCII but digits and small letters parts words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass
class Features:
    """The features of some texts: each one's document (ascending) and bucket, and the number of words per document."""

    document: np.ndarray
    bucket: np.ndarray
    words: np.ndarray


def features(texts: pa.Array, longest: int, buckets: int) -> Features:
    """All runs of 1 to ``longest`` words of each text, joined by one space, repeats counted; none for a null."""
    n = len(texts)
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")), GAPS)
    owner = pc.list_parent_indices(split).to_numpy()
    flat = pc.list_flatten(split)
    real = pc.not_equal(flat, "")  # a text that starts or ends with a gap has an empty piece there
    owner, words = owner[real.to_numpy(zero_copy_only=False)], pc.dictionary_encode(flat.filter(real))
    at = words.indices.to_numpy().astype(np.int64)
    known = [w.encode() for w in words.dictionary.to_pylist()]
    hashes = np.fromiter(map(zlib.crc32, known), np.int64, len(known))
    joined = [b" " + w for w in known]
    owners, found, number = [owner], [hashes[at] % buckets], at
    for size in range(2, longest + 1):
        # A run of ``size`` words is a run of one word less and the word behind it, in the same text.
        same = owner[: 1 - size] == owner[size - 1 :] if len(owner) >= size else np.zeros(0, bool)
        pairs = number[: len(same)] * len(known) + at[size - 1 :][: len(same)]
        distinct, spot = np.unique(pairs[same], return_inverse=True)
        before, last = np.divmod(distinct, max(1, len(known)))
        hashes = np.fromiter((zlib.crc32(joined[w], int(hashes[b])) for b, w in zip(before, last, strict=True)), np.int64, len(distinct))
        owners.append(owner[: len(same)][same])
        found.append(hashes[spot] % buckets)
        number = np.zeros(len(same), np.int64)
        number[same] = spot
    document, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(document, kind="stable") if longest > 1 else slice(None)
    return Features(document[order], bucket[order], np.bincount(owner, minlength=n))


def _counted(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in text_slices(batches):
        total += np.bincount(features(batch.column("text"), longest, buckets).bucket, minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """``bucket, n``: how often features of all texts of ``docs`` fall in each bucket; each task sends a row per bucket."""
    counted = docs.select("text").mapInArrow(lambda b: _counted(b, longest, buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """The gain of each bucket in thousandths; the driver gets at most ``buckets`` rows of either side."""
    counts = []
    for side in (docs, target):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(side, longest, buckets).collect():
            n[row["bucket"]] = row["n"]
        counts.append(n.tolist())
    held, wanted = counts
    all_held, all_wanted = float(sum(held) + buckets), float(sum(wanted) + buckets)
    return np.array([math.floor(1000 * math.log((t + 1) * all_held / ((s + 1) * all_wanted))) for s, t in zip(held, wanted, strict=True)], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], longest: int, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        found = features(batch.column("text"), longest, len(gains))
        ends = np.cumsum(np.bincount(found.document, minlength=batch.num_rows))
        running = np.concatenate([[0], np.cumsum(gains[found.bucket])])
        n = np.diff(ends, prepend=0)
        weight = (running[ends] - running[ends - n]) // np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.words), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])


def weights(docs: DataFrame, gains: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``docs``; ``weight`` is the floored mean gain, 0 for no features."""
    return raw(docs).withColumn("text", F.col("text").cast("string")).mapInArrow(lambda b: _weighed(b, longest, gains), "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id (a null id is the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: str = "2024"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the N rows with at least ``least_words`` words, ``floor(percent * N / 100)`` with the highest scores are drawn,
    ties to the smaller ``doc_id`` (null first); ``rank`` is 1, 2, 3 ... among them and null for the rest. A null or
    empty text has no features and weight 0. Rows that share a ``doc_id`` stay separate and share its noise; those that
    also agree in all numbers are equal rows, so which of them is drawn makes no difference. An empty target gives gains
    that only say how rare a bucket is. Other columns are ignored.
    """
    weighed = weights(docs, bucket_gains(docs, target, longest, buckets), longest)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    long_enough = F.col("n_words") >= least_words
    draw = scored.filter(long_enough).count() * percent // 100
    order = (F.when(long_enough, 0).otherwise(1), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("weight"))
    placed = positions(scored, *order)
    rank = F.when(long_enough & (F.col("position") < draw), F.col("position") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns. Rows that share a ``doc_id`` are drawn together, each once."""
    ids = resample(docs, target, **settings).filter("rank IS NOT NULL").select(F.col("doc_id").alias("d")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("d")), "left_semi")
