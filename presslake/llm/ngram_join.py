"""Jaccard join of documents on word n-grams with vertical partitioning.

The global order of n-grams is cut into fragments (ranges of their 64-bit hashes). A document is cut into segments,
one per fragment, and each fragment is worked on by itself. Two passes use this:

1. In each fragment the document frequency of its n-grams is counted. N-grams of one document alone cannot be shared
   and end here; documents that keep too few of them to reach the threshold with anyone drop out.
2. Of candidate pairs, the overlap is counted in each fragment separately and summed per pair.

Candidates share one of the rarest n-grams of both, as many as the threshold allows to miss. Documents with equal sets are
one member from the start. Groups of near copies do not give all their pairs: first, the documents of an n-gram are
compared with one of them, each document with one such hub a round, twice, and then with all hubs of other components; then only pairs that are still in different components, and whose n-grams counted per
fragment allow enough in common, are compared. So the components are exact, and the links found connect them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import lower_words, raw, release, rows_of
from presslake.llm.components import components
from presslake.sources.workspace import materialize

#: N-grams in a fragment of the first pass, and those cut at once: bounds on what a task holds.
FRAGMENT, TOGETHER = 500_000, 150_000
#: Fragments of the second pass: the three upper bits of a hash.
SLICES = 8
#: Fragments that a set's shared n-grams are counted in, for a bound on overlaps; a power of two.
PARTS = 64
#: Words whose hashes a Python worker remembers, and sets it has seen before it starts anew: bounds on memory only.
REMEMBERED, SEEN = 200_000, 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:  # the first words met include the frequent ones
            self[word] = got
        return got


_hash = _Hashes()


def ngram_set(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of fewer words the whole sequence counts as one."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    ids = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    mixed = ids[: len(ids) - n + 1].copy()
    for k in range(1, n):
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed += ids[k : len(ids) - n + 1 + k]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    return np.unique(mixed)


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set, equal for equal sets."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes)) - (1 << 63)


def _keyed(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in rows_of(batches, "doc_id", "text"):
        sizes, keys = [], []
        for text in texts:
            found = ngram_set(lower_words(text), n)
            sizes.append(len(found))
            keys.append(set_key(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], names=["doc_id", "n", "key"])


def _segments(batches: Iterator[pa.RecordBatch], n: int, fragments: int) -> Iterator[pa.RecordBatch]:
    """Per fragment, the segments of about TOGETHER n-grams' worth of new sets, packed."""
    seen: set[int] = set()
    sets, keys, held = [], [], 0
    for (texts,) in rows_of(batches, "text"):
        for text in texts:
            found = ngram_set(lower_words(text), n)
            if len(found) and (key := set_key(found)) not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                sets.append(found)
                keys.append(key)
                held += len(found)
                if held >= TOGETHER:
                    yield _cut(sets, keys, fragments)
                    sets, keys, held = [], [], 0
    if sets:
        yield _cut(sets, keys, fragments)
    _hash.clear()
    release()


def _cut(sets: list[np.ndarray], keys: list[int], fragments: int) -> pa.RecordBatch:
    hashes, sizes = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    fragment = ((hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(fragment, kind="stable")
    owner, hashes, key = owner[order], hashes[order], np.array(keys, np.int64)
    present, starts = np.unique(fragment[order], return_index=True)
    rows = []
    for f, a, b in zip(present, starts, np.append(starts, len(order))[1:], strict=True):
        who, counts = np.unique(owner[a:b], return_counts=True)
        rows.append({"fragment": int(f), "keys": key[who].tobytes(), "sizes": sizes[who].tobytes(), "counts": counts.astype(np.int32).tobytes(), "hashes": hashes[a:b].tobytes()})
    return pa.RecordBatch.from_pylist(rows, PACKED)


PACKED = pa.schema([("fragment", pa.int32())] + [(c, pa.binary()) for c in ("keys", "sizes", "counts", "hashes")])
PACKED_SQL = "fragment int, keys binary, sizes binary, counts binary, hashes binary"
SHARED = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("keys", "sizes", "counts", "hashes", "frequencies")])
SHARED_SQL = "bucket int, keys binary, sizes binary, counts binary, hashes binary, frequencies binary"


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(table: pa.Table, buckets: int) -> pa.Table:
    """Of one fragment: the n-grams that several sets have, with their frequency, packed by bucket of the set."""
    keys, sizes, counts, hashes = (_joined(table, c, k) for c, k in (("keys", "<i8"), ("sizes", "<i8"), ("counts", "<i4"), ("hashes", "<u8")))
    _, first = np.unique(keys, return_index=True)  # a set that several tasks met counts once
    once = np.zeros(len(keys), bool)
    once[first] = True
    owner = np.repeat(np.arange(len(keys)), counts)
    use = once[owner]
    owner, hashes = owner[use], hashes[use]
    order = np.argsort(hashes, kind="stable")
    owner, hashes = owner[order], hashes[order]
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    runs = np.diff(np.append(heads, len(hashes)))
    frequency = np.repeat(runs, runs)
    many = frequency > 1
    owner, hashes, frequency = owner[many], hashes[many], frequency[many]
    bucket = (keys[owner] % buckets).astype(np.int32)
    order = np.lexsort((owner, bucket))
    owner, hashes, frequency, bucket = owner[order], hashes[order], frequency[order], bucket[order]
    present, starts = np.unique(bucket, return_index=True)
    rows = []
    for k, a, b in zip(present, starts, np.append(starts, len(bucket))[1:], strict=True):
        who, n = np.unique(owner[a:b], return_counts=True)
        rows.append(
            {"bucket": int(k), "keys": keys[who].tobytes(), "sizes": sizes[who].tobytes(), "counts": n.astype(np.int32).tobytes(), "hashes": hashes[a:b].tobytes(), "frequencies": frequency[a:b].astype(np.int32).tobytes()}
        )
    out = pa.Table.from_pylist(rows, SHARED)
    release()
    return out


MEMBERS = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("prefix", pa.int32()), ("hashes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])
MEMBERS_SQL = "key long, n long, shared long, prefix int, hashes array<long>, counts array<int>"


def _members(table: pa.Table, percent: int) -> pa.Table:
    """The sets of a bucket that share enough n-grams with others to link at all; their shared ones, rarest first."""
    keys, sizes, counts, hashes, frequency = (
        _joined(table, c, k) for c, k in (("keys", "<i8"), ("sizes", "<i8"), ("counts", "<i4"), ("hashes", "<u8"), ("frequencies", "<i4"))
    )
    names, back = np.unique(keys, return_inverse=True)
    size = np.zeros(len(names), np.int64)
    size[back] = sizes
    owner = np.repeat(back, counts)
    shared = np.bincount(owner, minlength=len(names))
    need = -(-percent * size // 100)
    fit = shared >= need
    use = fit[owner]
    owner, hashes, frequency = owner[use], hashes[use], frequency[use]
    order = np.lexsort((hashes, frequency, owner))
    owner, hashes = owner[order], hashes[order].view(np.int64)
    which = np.flatnonzero(fit)
    offsets = np.append(0, np.cumsum(shared[which])).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes, pa.int64()))
    place = np.cumsum(fit) - 1
    counts = np.bincount(place[owner] * PARTS + (hashes.view(np.uint64) >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=len(which) * PARTS)
    parts = pa.ListArray.from_arrays(pa.array(np.arange(len(which) + 1) * PARTS, pa.int32()), pa.array(counts.astype(np.int32), pa.int32()))
    prefix = (shared[which] - need[which] + 1).astype(np.int32)
    return pa.Table.from_arrays([pa.array(names[which]), pa.array(size[which]), pa.array(shared[which].astype(np.int64)), pa.array(prefix), lists, parts], schema=MEMBERS)


def _reach(a: str, b: str, percent: int) -> str:
    """SQL: two sets of these sizes, with this many shared n-grams, may reach the threshold."""
    both = f"({a}.n + {b}.n)"
    return f"{100 + percent} * least({a}.shared, {b}.shared) >= {percent} * {both}"


def verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose overlap, counted per fragment and summed, reaches the threshold: ``a, b, overlap``."""
    # The three upper bits of the signed hash number the fragments.
    part = lambda i: F.filter("hashes", lambda h: F.shiftright(h, 61) == i - SLICES // 2)
    cut = members.select("key", "n", F.array(*[part(i) for i in range(SLICES)]).alias("segments"))
    side = lambda k: cut.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("segments").alias(f"segments_{k}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    partial = F.zip_with("segments_a", "segments_b", lambda p, q: F.size(F.array_intersect(p, q)))
    total = met.select("a", "b", "n_a", "n_b", F.aggregate(partial, F.lit(0), lambda acc, x: acc + x).alias("overlap"))
    return total.filter(f"100 * overlap >= {percent} * (n_a + n_b - overlap)").select("a", "b", "overlap")


def _bound(columns: list[str], percent: int) -> str:
    """SQL: sets can have no more in common in a fragment than the one with less has there."""
    most = " + ".join(f"least(x.{c}, y.{c})" for c in columns)
    return f"{100 + percent} * ({most}) >= {percent} * (x.n + y.n)"


def _in_components(prefixes: DataFrame, named: DataFrame | None) -> DataFrame:
    """``prefixes`` with the component of each key, itself where it has none yet."""
    if named is None:
        return prefixes.withColumn("component", F.col("key"))
    return prefixes.join(named, prefixes["key"] == named["id"], "left").select("gram", "key", "n", "shared", F.coalesce("component", "key").alias("component"))


def jaccard_links(docs: DataFrame, n: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, links, classes)`` of ``docs`` (``doc_id, text``).

    ``documents``: ``doc_id, n, key`` per row, ``key`` naming the set (null for an empty one, which links with nothing).
    ``links``: verified pairs ``a, b`` of keys that connect every component. ``classes``: ``id, component`` of linked keys.
    """
    rows = raw(docs)
    documents = materialize(rows.mapInArrow(lambda b: _keyed(b, n), "doc_id long, n long, key long"), "sets")
    total = documents.agg(F.sum("n")).first()[0] or 0
    fragments = max(1, math.ceil(total / FRAGMENT))
    packed = rows.select("text").mapInArrow(lambda b: _segments(b, n, fragments), PACKED_SQL)
    shared = packed.groupBy("fragment").applyInArrow(lambda t: _shared(t, fragments), SHARED_SQL)
    members = materialize(shared.groupBy("bucket").applyInArrow(lambda t: _members(t, percent), MEMBERS_SQL), "members")

    prefixes = materialize(members.select("key", "n", "shared", F.explode(F.slice("hashes", 1, F.col("prefix"))).alias("gram")), "prefixes")
    links = named = None
    for every in (False, False, True):
        held = _in_components(prefixes, named)
        hub = held.groupBy("gram").agg(F.min(F.struct("component", "key", "n", "shared")).alias("hub"), F.max("component").alias("highest")).filter("hub.component <> highest")
        stars = held.alias("x").join(hub.select("gram", "hub.*").alias("y"), "gram").filter(f"x.component <> y.component AND {_reach('x', 'y', percent)}")
        pairs = stars.select(F.col("y.key").alias("a"), F.col("x.key").alias("b"))
        # A near copy has another hub for nearly each n-gram; one joins it to the rest, so that few pairs are left for all.
        pairs = pairs.distinct() if every else pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        found = materialize(verified(pairs, members, percent), "links")
        links = found if links is None else links.unionByName(found)
        named = components(links)

    placed = _in_components(prefixes, named)
    mixed = placed.groupBy("gram").agg(F.min("component").alias("lowest"), F.max("component").alias("highest")).filter("lowest <> highest")
    fine = [F.col("counts")[i].alias(f"f{i}") for i in range(PARTS)]
    coarse = [sum((F.col("counts")[i] for i in range(j + 1, j + 8)), F.col("counts")[j]).alias(f"c{j}") for j in range(0, PARTS, 8)]
    bounds = members.select("key", F.slice("hashes", 1, F.col("prefix")).alias("grams"), *coarse, *fine)
    open_ = materialize(placed.join(mixed, "gram", "left_semi").join(bounds, "key"), "open")
    # Cheap bounds first; a pair counts at its first common n-gram only, so it is made once.
    coarse_bound, fine_bound = (_bound([c for c in open_.columns if c[0] == kind and c[1:].isdigit()], percent) for kind in "cf")
    once = "array_intersect(x.grams, y.grams)[0] = x.gram"
    wanted = f"x.gram = y.gram AND x.component < y.component AND {_reach('x', 'y', percent)} AND {coarse_bound} AND {fine_bound} AND {once}"
    apart = open_.alias("x").join(open_.alias("y"), F.expr(wanted))
    second = materialize(verified(apart.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct(), members, percent), "links")
    links = links.unionByName(second)
    return documents, links, components(links)


def similar_documents(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` that is reachable over links, the row's own included. A document with
    fewer than ``n`` words has its whole sequence as its only n-gram; without words it has none and stands alone. A null
    ``doc_id`` takes part; it is a component's name only where nothing else is. Other columns are ignored.
    """
    documents, _, classes = jaccard_links(docs, n, percent)
    grouped = documents.join(classes, documents["key"] == classes["id"], "left").select("doc_id", "n", F.coalesce("component", "key").alias("group"))
    # Summed up per task first, so a large group costs a row per task.
    least = grouped.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"))
    named = grouped.alias("g").join(least.alias("l"), F.col("g.group") == F.col("l.group"), "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("g.group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that link to an earlier document.

    One document of each component stays, the one with the smallest ``doc_id``; rows that share it stay together. Rows
    without an id, and documents without words, stay.
    """
    found = similar_documents(docs, n, percent)
    gone = materialize(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*docs.columns)
