"""Word n-grams of whole texts as sets of hashes, and what they share with others, without a row per n-gram.

N-grams are named by 64-bit hashes and cut into fragments, ranges of these hashes. A text is cut into segments, one per
fragment, packed into arrays, and each fragment is worked on by itself: it counts in how many sets an n-gram is. N-grams of
one set alone cannot be shared and end here. What is left is dealt by set, and sets that keep too little to reach the
ratio with any other drop out. Fragments and buckets grow in number with the input, not in size.

Of groups of near copies, all pairs are wanted. So pairs are looked for between blocks, sets that have one of their rare
n-grams in common, and two blocks that may have a pair are a cell, whose pairs come from a product of two matrices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from presslake.sources.workspace import materialize

#: N-grams in a fragment, about, and those that a task cuts at once; fragments for a bucket of sets. Bounds on what a task holds.
FRAGMENT, TOGETHER, GATHERED = 1_000_000, 400_000, 8
#: Bytes of text for a word, about; only the number of fragments follows from it.
WORD_BYTES = 6
#: Words whose hashes a Python worker remembers, and texts it has seen before it starts anew: bounds on memory only.
REMEMBERED, SEEN = 200_000, 200_000
#: Numbers of 64 bits that say which hashes a set has; a bound on what two sets have in common.
MARKS = 16
#: Sets in a block, about; sets of cells that a task gets at once, about.
BLOCK, DEALT = 1024, 4096
#: Columns of the matrices that are multiplied at once.
COLUMNS = 4096

PACKED = pa.schema([("fragment", pa.int32())] + [(c, pa.binary()) for c in ("keys", "sizes", "counts", "hashes")])
PACKED_SQL = "fragment int, keys binary, sizes binary, counts binary, hashes binary"
SHARED = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("keys", "sizes", "counts", "hashes", "frequencies")])
SHARED_SQL = "bucket int, keys binary, sizes binary, counts binary, hashes binary, frequencies binary"
MEMBERS = pa.schema(
    [("key", pa.int64()), ("n", pa.int64()), ("need", pa.int64()), ("own", pa.list_(pa.int64())), ("df", pa.list_(pa.int32()))] + [(f"m{m}", pa.int64()) for m in range(MARKS)]
)
MEMBERS_SQL = "key long, n long, need long, own array<long>, df array<int>, " + ", ".join(f"m{m} long" for m in range(MARKS))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:  # the first words met include the frequent ones
            self[word] = got
        return got


_hash = _Hashes()


def ngrams(words: list[bytes], n: int, scope: int = 0) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; of fewer words the whole sequence, of none nothing."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        mixed = np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    else:
        ids = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
        mixed = ids[: len(ids) - n + 1].copy()
        for k in range(1, n):
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed += ids[k : len(ids) - n + 1 + k]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    # The same n-gram of another scope is another one.
    mixed ^= np.uint64(scope % (1 << 64))
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _segments(batches: Iterator[pa.RecordBatch], n: int, fragments: int) -> Iterator[pa.RecordBatch]:
    """Per fragment, the segments of about TOGETHER n-grams' worth of texts, packed."""
    seen: set[int] = set()
    sets, keys, held = [], [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            for key, scope, text in zip(*(part.column(c).to_pylist() for c in ("key", "scope", "text")), strict=True):
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                found = ngrams(text.split(), n, scope)
                if len(found):
                    sets.append(found)
                    keys.append(key)
                    held += len(found)
                if held >= TOGETHER:
                    yield _cut(sets, keys, fragments)
                    sets, keys, held = [], [], 0
    if sets:
        yield _cut(sets, keys, fragments)
    _hash.clear()


def _runs(names: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of a sorted array, with the places where it starts and ends."""
    present, starts = np.unique(names, return_index=True)
    yield from zip(present.tolist(), starts.tolist(), np.append(starts, len(names))[1:].tolist(), strict=True)


def _cut(sets: list[np.ndarray], keys: list[int], fragments: int) -> pa.RecordBatch:
    hashes, sizes = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    fragment = ((hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(fragment, kind="stable")
    owner, hashes, key = owner[order], hashes[order], np.array(keys, np.int64)
    rows = []
    for f, a, b in _runs(fragment[order]):
        who, counts = np.unique(owner[a:b], return_counts=True)
        rows.append({"fragment": f, "keys": key[who].tobytes(), "sizes": sizes[who].tobytes(), "counts": counts.astype(np.int32).tobytes(), "hashes": hashes[a:b].tobytes()})
    return pa.RecordBatch.from_pylist(rows, PACKED)


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(table: pa.Table, buckets: int) -> pa.Table:
    """Of one fragment: the n-grams that several sets have, with their frequency, packed by bucket of the set."""
    keys, sizes, counts, hashes = (_joined(table, c, k) for c, k in (("keys", "<i8"), ("sizes", "<i8"), ("counts", "<i4"), ("hashes", "<u8")))
    _, first = np.unique(keys, return_index=True)  # a text that several tasks met counts once
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
    rows = []
    for k, a, b in _runs(bucket):
        who, n = np.unique(owner[a:b], return_counts=True)
        rows.append(
            {"bucket": k, "keys": keys[who].tobytes(), "sizes": sizes[who].tobytes(), "counts": n.astype(np.int32).tobytes(), "hashes": hashes[a:b].tobytes(), "frequencies": frequency[a:b].astype(np.int32).tobytes()}
        )
    return pa.Table.from_pylist(rows, SHARED)


def _members(table: pa.Table, low: float) -> pa.Table:
    """The sets of a bucket that share enough n-grams with others to reach the ratio with any."""
    keys, sizes, counts, hashes, frequency = (
        _joined(table, c, k) for c, k in (("keys", "<i8"), ("sizes", "<i8"), ("counts", "<i4"), ("hashes", "<u8"), ("frequencies", "<i4"))
    )
    names, back = np.unique(keys, return_inverse=True)
    size = np.zeros(len(names), np.int64)
    size[back] = sizes
    owner = np.repeat(back, counts)
    shared = np.bincount(owner, minlength=len(names))
    need = np.ceil(size * low - 1e-9).astype(np.int64)
    fit = shared >= need
    use = fit[owner]
    owner, hashes, frequency = (np.cumsum(fit) - 1)[owner[use]], hashes[use], frequency[use]
    order = np.lexsort((hashes, frequency, owner))
    owner, hashes, frequency = owner[order], hashes[order], frequency[order]
    which = np.flatnonzero(fit)
    ends = np.append(0, np.cumsum(shared[which]))
    offsets = pa.array(ends.astype(np.int32))
    marks = np.zeros((len(which), MARKS), np.uint64)
    bit = (hashes % np.uint64(64 * MARKS)).astype(np.int64)
    for a in range(0, len(which), 4096):
        b = min(a + 4096, len(which))
        have = np.zeros((b - a, 64 * MARKS), bool)
        have[owner[ends[a] : ends[b]] - a, bit[ends[a] : ends[b]]] = True
        marks[a:b] = np.packbits(have, axis=1, bitorder="little").view("<u8")
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (hashes.view(np.int64), frequency.astype(np.int32))]
    return pa.Table.from_arrays([pa.array(names[which]), pa.array(size[which]), pa.array(need[which]), *lists, *[pa.array(marks[:, m].view(np.int64)) for m in range(MARKS)]], schema=MEMBERS)


def members(texts: DataFrame, n: int, low: float, size: int) -> DataFrame:
    """``key, n, need, own, df, m0, m1 ...`` of the texts that may reach a Jaccard ratio of ``low`` with another of their scope.

    ``texts``: ``key``, ``scope`` (numbers), ``text`` (lower-cased, as UTF-8), of about ``size`` bytes in all; rows with the
    same key are the same text. ``own`` are the shared n-grams, rarest first, ``df`` in how many sets each of them is, ``n``
    the size of the whole set, ``need`` how many of its n-grams a set has to share; ``m0, m1 ...`` have the bit of each one.
    """
    fragments = max(1, math.ceil(size / (WORD_BYTES * FRAGMENT)))
    buckets = max(1, fragments // GATHERED)
    packed = texts.select("key", "scope", "text").mapInArrow(lambda b: _segments(b, n, fragments), PACKED_SQL)
    shared = packed.groupBy("fragment").applyInArrow(lambda t: _shared(t, buckets), SHARED_SQL)
    found = shared.groupBy("bucket").applyInArrow(lambda t: _members(t, low), MEMBERS_SQL)
    return materialize(found.repartition(F.col("key")), "members")


def prefix(column: str) -> Column:
    """What stands first in a set's shared n-grams: two sets that reach the ratio have one of these in common."""
    return F.slice(column, F.lit(1), F.size("own") - F.col("need") + 1)


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``x`` has in common with each of ``y``."""
    out = np.zeros((len(x), len(y)), np.float32)
    names, number = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    who = np.repeat(np.arange(len(x) + len(y)), [len(k) for k in (*x, *y)])
    first = who < len(x)
    both = (np.bincount(number[first], minlength=len(names)) > 0) & (np.bincount(number[~first], minlength=len(names)) > 0)
    use = both[number]
    number, who = (np.cumsum(both) - 1)[number[use]], who[use]
    order = np.argsort(number, kind="stable")
    number, who = number[order], who[order]
    for a in range(0, int(both.sum()), COLUMNS):
        part = slice(*np.searchsorted(number, [a, a + COLUMNS]))
        has = np.zeros((len(x) + len(y), COLUMNS), np.float32)
        has[who[part], number[part] - a] = 1
        out += has[: len(x)] @ has[len(x) :].T
    return out


def _rated(table: pa.Table, low: float) -> pa.Table:
    """Pairs ``a, b, similarity`` of the cells of a table."""
    table = table.sort_by([("row", "ascending"), ("col", "ascending"), ("side", "ascending")]).combine_chunks()
    row, col, side, key, n = (table.column(c).to_numpy() for c in ("row", "col", "side", "key", "n"))
    lists = table.column("own").combine_chunks()
    data, ends = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    sets = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (col[1:] != col[:-1])))
    found = []
    for a, b in zip(heads.tolist(), np.append(heads[1:], len(row)).tolist(), strict=True):
        one = row[a] == col[a]
        cut = b if one else a + int(np.searchsorted(side[a:b], 1))
        start = a if one else cut
        common = _common(sets[a:cut], sets[start:b]).astype(np.float64)
        ratio = common / (n[a:cut, None] + n[None, start:b] - common)
        i, j = np.nonzero(np.triu(ratio >= low - 1e-12, 1) if one else ratio >= low - 1e-12)
        found.append((key[a + i], key[start + j], ratio[i, j]))
    return pa.table({name: np.concatenate([f[k] for f in found]) for k, name in enumerate(("a", "b", "similarity"))})


def blocks(fit: DataFrame) -> DataFrame:
    """``members`` with a ``block``; sets of a block have a rare n-gram in common, and a large block is dealt to several."""
    rare = fit.withColumn("rare", F.array_min(prefix("own")))
    many = rare.groupBy("rare").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    named = rare.join(many, "rare").withColumn("block", F.xxhash64("rare", F.pmod(F.xxhash64("key"), F.col("parts")))).drop("rare", "parts")
    return materialize(named.repartition("block"), "blocks")


def rated(held: DataFrame, met: DataFrame, low: float) -> DataFrame:
    """All pairs ``a, b, similarity`` with a Jaccard ratio of ``low`` or more inside ``blocks`` and of the blocks ``row, col`` that met.

    A cell's sets are sent once for all its pairs.
    """
    sizes = held.groupBy("block").agg(F.count(F.lit(1)).alias("sets"))
    alone = sizes.filter("sets > 1").select(F.col("block").alias("row"), F.col("block").alias("col"))
    cells = materialize(met.unionByName(alone), "cells")
    load = cells.join(sizes.withColumnRenamed("block", "row"), "row").agg(F.sum("sets")).first()[0] or 0
    dealt = cells.withColumn("task", F.pmod(F.xxhash64("row", "col"), F.lit(max(1, math.ceil(2 * load / DEALT)))))
    sides = [held.join(c.withColumn("block", F.col(at)), "block").select("task", "row", "col", F.lit(side).alias("side"), "key", "n", "own") for side, at, c in ((0, "row", dealt), (1, "col", dealt.filter("row <> col")))]
    return sides[0].unionByName(sides[1]).groupBy("task").applyInArrow(lambda t: _rated(t, low), "a long, b long, similarity double")
