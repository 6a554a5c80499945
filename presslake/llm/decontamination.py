"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow batch of documents is a shard: its words become one sequence of numbers, and the suffixes that start like
some benchmark window are sorted into a suffix array. Every benchmark suffix is then looked up by binary search;
neighbouring finds are joined into the longest verbatim matches with their places. No document leaves its task.
The benchmark is the stated query set. It is cut into blocks of bounded size; several are searched one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from presslake.llm.common import slices
from presslake.sources.workspace import materialize

#: Words: A-Z lower-cased, then runs of ASCII letters and digits and of anything beyond ASCII.
CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of benchmark text in a block, which is sent to every task.
BLOCK_BYTES = 32 << 20
#: Words of documents that are sorted at once.
SHARD_WORDS = 2_000_000

MATCH = "struct<item_id:string,item_start:long,start:long,length:long>"


def words(data: bytes | None) -> list[bytes]:
    return data.translate(CLEAN).split() if data else []


class Block:
    """The windows of some benchmark items, numbered and packed for binary search."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.names = [name for name, _ in items]
        for item, (_, text) in enumerate(items):
            ids = [number(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if size else 0):
                places.setdefault(tuple(ids[start : start + size]), []).append((item, start))
        self.bits = (len(self.vocabulary) + 1).bit_length()
        self.sizes = np.array([len(w) for w in places], np.int64)
        grid = np.zeros((len(places), window), np.int64)
        for row, w in enumerate(places):
            grid[row, : len(w)] = w
        high = np.where(np.arange(window) < self.sizes[:, None], grid, (1 << self.bits) - 1)
        self.low, self.high = self.pack(grid), self.pack(high)
        # What a suffix must start with to be worth sorting: a first pair of words, or the word of a one-word window.
        self.pairs = np.unique((grid[:, 0] << 32 | grid[:, min(1, window - 1)])[self.sizes > 1])
        self.single = np.unique(grid[:, 0][self.sizes == 1])
        counts = [len(p) for p in places.values()]
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        flat = [p for found in places.values() for p in found]
        self.item = np.array([p[0] for p in flat], np.int64)
        self.start = np.array([p[1] for p in flat], np.int64)

    def pack(self, grid: np.ndarray) -> list[np.ndarray]:
        """Columns of word numbers as few sortable integers, the first words in the first."""
        each = 62 // self.bits
        keys = []
        for at in range(0, self.window, each):
            key = np.zeros(len(grid), np.int64)
            for column in range(at, min(at + each, self.window)):
                key = key << self.bits | grid[:, column]
            keys.append(key)
        return keys

    def find(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in a sequence of word numbers; 0 matches nothing."""
        following = np.append(sequence[1:], 0)
        at = np.flatnonzero((sequence > 0) & (following > 0))
        pair = sequence[at] << 32 | following[at]
        known = np.zeros(len(at), bool)
        if len(self.pairs):
            spot = np.searchsorted(self.pairs, pair)
            known = self.pairs[np.minimum(spot, len(self.pairs) - 1)] == pair
        at = at[known]
        if len(self.single):
            at = np.union1d(at, np.flatnonzero(np.isin(sequence, self.single)))
        if not len(at) or not len(self.sizes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.append(sequence, np.zeros(self.window, np.int64))
        keys = self.pack(padded[at[:, None] + np.arange(self.window)])
        order = np.lexsort(keys[::-1])
        suffixes, keys = at[order], [k[order] for k in keys]
        low, high = _bisect(keys, self.low, False), _bisect(keys, self.high, True)
        n = high - low
        rows = np.repeat(np.arange(len(n)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return rows, suffixes[low[rows] + inside]


def _bisect(keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """For each wanted tuple, how many of the sorted tuples are less (``right``: less or equal)."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.minimum(middle, len(keys[0]) - 1)
        before, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
        for have, want in zip(keys, wanted, strict=True):
            got = have[at]
            before |= equal & (got < want)
            equal &= got == want
        before |= equal & right
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def _shards(texts: list[bytes | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Consecutive documents' words, about SHARD_WORDS at a time, with the number of the first."""
    first, part, held = 0, [], 0
    for n, text in enumerate(texts):
        part.append(words(text))
        held += len(part[-1])
        if held >= SHARD_WORDS:
            yield first, part
            first, part, held = n + 1, [], 0
    if part:
        yield first, part


def search(texts: list[bytes | None], block: Block, places: bool = True) -> tuple[list[int], list[np.ndarray], list[list[dict]]]:
    """For each text: its number of words, the positions inside matches, and, with ``places``, the longest matches."""
    sizes, hits, matches = [], [], []
    get = block.vocabulary.get
    for _, shard in _shards(texts):
        n = np.array([len(w) for w in shard], np.int64)
        starts = np.cumsum(n + 1) - n - 1
        sequence = np.zeros(int((n + 1).sum()), np.int64)
        for start, doc in zip(starts, shard, strict=True):
            sequence[start : start + len(doc)] = list(map(get, doc, repeat(0)))
        rows, at = block.find(sequence)
        cover = np.zeros(len(sequence) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + block.sizes[rows], -1)
        covered = np.cumsum(cover)[:-1] > 0
        found: list[list[dict]] = [[] for _ in shard]
        for doc, item, item_start, start, length in _longest(block, rows, at, starts) if places else ():
            found[doc].append({"item_id": block.names[item], "item_start": item_start, "start": start, "length": length})
        sizes += n.tolist()
        hits += [np.flatnonzero(covered[s : s + k]) for s, k in zip(starts, n, strict=True)]
        matches += found
    return sizes, hits, matches


def _longest(block: Block, rows: np.ndarray, at: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, ...]]:
    """(document, item, item start, start, length) of the maximal runs along one alignment of an item and a document."""
    if not len(rows):
        return
    copies = block.first[rows + 1] - block.first[rows]
    each = np.repeat(np.arange(len(rows)), copies)
    spot = block.first[rows][each] + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    item, item_start, at, size = block.item[spot], block.start[spot], at[each], block.sizes[rows][each]
    order = np.lexsort((at, at - item_start, item))
    item, item_start, at, size = item[order], item_start[order], at[order], size[order]
    # No run crosses documents: a separator stands between them, so neighbouring finds are in one document.
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (at[1:] - item_start[1:] != at[:-1] - item_start[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    docs = np.searchsorted(starts, at[head], side="right") - 1
    length = at[tail] + size[tail] - at[head]
    yield from zip(docs.tolist(), item[head].tolist(), item_start[head].tolist(), (at[head] - starts[docs]).tolist(), length.tolist(), strict=True)


FOUND_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))


def _found(batches: Iterator[pa.RecordBatch], block: Block, only_hit: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2_000):
        sizes, hits, matches = search(batch.column("text").cast(pa.binary()).to_pylist(), block)
        new = [pa.array(sizes, pa.int64()), pa.array([h.astype(np.int64) for h in hits], pa.list_(pa.int64())), pa.array(matches, FOUND_ARROW)]
        out = pa.RecordBatch.from_arrays([batch.column(0), *new], names=[batch.schema.names[0], "n_words", "hits", "matches"])
        yield out.filter(pa.array([len(h) > 0 for h in hits], pa.bool_())) if only_hit else out


def _clean(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2_000):
        _, hits, _ = search(batch.column("text").cast(pa.binary()).to_pylist(), block, places=False)
        yield batch.filter(pa.array([len(h) == 0 for h in hits], pa.bool_()))


def n_blocks(benchmark: DataFrame) -> int:
    total = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    return max(1, math.ceil(total / BLOCK_BYTES))


def blocks_of(benchmark: DataFrame, window: int, n: int = 1) -> Iterator[Block]:
    """The benchmark in ``n`` blocks, made one after the other; items without words are left out."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    for part in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part).collect()
        yield Block(sorted((r["item_id"], bytes(r["text"])) for r in rows), window)


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, n_words, hits, matches`` of every row of ``docs``; ``hits`` are word positions.

    A benchmark of one block is searched in the scan of the documents. One of several is searched block by block, each in
    a job of its own that writes only what it found, so the driver and a task hold one block at a time.
    """
    schema = f"n_words long, hits array<long>, matches array<{MATCH}>"
    rows = docs.select("doc_id", "text")
    n = n_blocks(benchmark)
    if n == 1:
        block = next(blocks_of(benchmark, window))
        return rows.mapInArrow(lambda b: _found(b, block, False), StructType([rows.schema["doc_id"], *StructType.fromDDL(schema).fields]))
    numbered = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    texts = numbered.select("row", "text")
    none = Block([], window)
    counted = texts.mapInArrow(lambda b: _found(b, none, False), f"row long, {schema}").select("row", "n_words")
    parts = None
    for block in blocks_of(benchmark, window, n):
        part = materialize(texts.mapInArrow(lambda b, block=block: _found(b, block, True), f"row long, {schema}"), "found")
        parts = part if parts is None else parts.unionByName(part)
    joined = lambda c: F.flatten(F.collect_list(c))
    per_row = parts.groupBy("row").agg(F.array_sort(F.array_distinct(joined("hits"))).alias("hits"), joined("matches").alias("matches"))
    out = numbered.select("row", "doc_id").join(counted, "row").join(per_row, "row", "left")
    nothing = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return out.select("doc_id", "n_words", nothing("hits", "array<long>"), nothing("matches", f"array<{MATCH}>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items, matches, contaminated``.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A word
    of a document is hit when it is inside an occurrence of a window. ``items`` are the distinct ids of items with
    an occurrence (a null id counts as the empty text), sorted as strings; ``matches`` the longest verbatim matches.
    A null or empty text has no words; rows that share a ``doc_id`` stay separate; other columns are ignored.
    """
    found = occurrences(docs, benchmark, window)
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        "matches",
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no word is hit.

    Hit rows go in the worker, and nothing is added to the others. What one block leaves is written before the next.
    """
    n = n_blocks(benchmark)
    for number, block in enumerate(blocks_of(benchmark, window, n), 1):
        docs = docs.mapInArrow(lambda b, block=block: _clean(b, block), docs.schema)
        docs = materialize(docs, "clean") if number < n else docs
    return docs
