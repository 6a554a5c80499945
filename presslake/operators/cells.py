"""Pairs of similar sets over a small alphabet, such as letters or letter trigrams, compared in cells.

Such sets share tokens with most others, also rare ones, so an index of tokens lists nearly all pairs, many of them
several times. Here each pair is looked at once. Sets are dealt to blocks by size; two blocks whose sizes allow the ratio
are a cell, and Spark spreads the cells. In a cell, sets that have as many tokens of each kind lie together in tiles, and
two tiles whose numbers of a kind differ by too much are left out. Of two others, the sets are rows of two matrices whose
product bounds what each pair has in common: several tokens share a column, so products count too much and never too
little. What passes is counted exactly, by a bit for each frequent token and by lists of the rest. A cell holds its sets,
their counts and one tile at a time, and hands its pairs on as it finds them, so memory depends on neither input nor cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from presslake.sources.workspace import materialize

#: The most frequent tokens have a number of 16 bits; others travel as they are.
NUMBERS = 1 << 16
#: Sets in a block, at least and at most, and tokens at most; between them, BLOCKS blocks in a scope.
LEAST, MOST, TOKENS, BLOCKS = 16_384, 65_536, 10_000_000, 12
#: Sets in a tile, at most, and tokens that are looked at together.
TILE, TOGETHER = 1024, 1_000_000
#: Columns of the matrices, one of these, and how many of a cell's most frequent tokens may have none; which, a few rows tell.
COLUMNS, LEFT_OUT, TRIED = (64, 96, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048), (0, 128, 256), 192
#: Nanoseconds for a pair and column, and for a pair that passes; cells of fewer pairs take what their sizes suggest.
COLUMN_NS, PASSED_NS, SMALL = 0.006, 200.0, 150_000_000
#: Tokens of a cell that have a bit, and kinds of tokens as a power of 2.
BITS, KINDS = 4096, 3
#: Pairs that are handed on at once.
HANDED = 100_000
#: Texts of so many characters are compared letter by letter inside a cell, with one word of bits.
WORD = 64


def _numbers(batches: Iterator[pa.RecordBatch], names: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``tokens`` packed: the places of those among ``names`` (sorted) as ``numbers``, the rest as ``others``."""
    for batch in batches:
        lists = batch.column("tokens")
        data, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(names, data), max(len(names) - 1, 0))
        known = names[at] == data if len(names) else np.zeros(len(data), bool)
        ends = np.cumsum(sizes, dtype=np.int64)
        arrays = {name: batch.column(name) for name in batch.schema.names if name != "tokens"}
        for name, part, values in (("numbers", known, at.astype("<u2")), ("others", ~known, data.astype("<i8"))):
            cuts = np.append(0, np.cumsum(part))[np.append(0, ends)].tolist()
            values = values[part]
            arrays[name] = pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def _packed(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    values = table.column(name).to_pylist()
    return np.frombuffer(b"".join(values), kind), np.append(0, np.cumsum([len(v) for v in values], dtype=np.int64) // np.dtype(kind).itemsize)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows, of TILE rows and TOGETHER tokens at most, but for a row that has more."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, min(a + TILE, int(np.searchsorted(ends, ends[a] - sizes[a] + TOGETHER, "right"))))
        yield a, b
        a = b


class _Side:
    """One block of a cell."""

    def __init__(self, table: pa.Table):
        self.ids, self.n = table.column("id").combine_chunks(), table.column("n").to_numpy().astype(np.int64)
        self.texts = table.column("t") if "t" in table.column_names else None
        (self.flat, self.ends), (self.others, self.other_ends) = _packed(table, "numbers", "<u2"), _packed(table, "others", "<i8")

    def name(self, names: np.ndarray) -> None:
        """``names``: tokens without a number that the cell has more than once. They get the numbers behind the others."""
        at = np.minimum(np.searchsorted(names, self.others), max(len(names) - 1, 0))
        have = names[at] == self.others if len(names) else np.zeros(len(self.others), bool)
        if have.any():
            owner = np.repeat(np.arange(len(self.n)), np.diff(self.other_ends))[have]
            self.flat = np.insert(self.flat.astype(np.int32), self.ends[owner + 1], NUMBERS + at[have].astype(np.int32))
            self.ends = self.ends + np.append(0, np.cumsum(np.bincount(owner, minlength=len(self.n))))
        self.others = None

    def counted(self, rows: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
        """How many tokens of each column the sets have."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(np.arange(len(rows)) * width, sizes) + column[self.flat[_ranges(self.ends[rows], sizes)]]
        return np.bincount(at, minlength=len(rows) * width).reshape(len(rows), width)

    def sort(self, kind: np.ndarray) -> None:
        """Tiles of sets with like numbers of tokens of each kind; the largest and smallest of a tile."""
        every = np.arange(len(self.n))
        self.kinds = np.vstack([self.counted(every[a:b], kind, 1 << KINDS).astype(np.int32) for a, b in _parts(np.diff(self.ends))])
        parts, leaves = [every], []
        while parts:
            rows = parts.pop()
            if len(rows) <= TILE:
                leaves.append(rows)
                continue
            values = self.kinds[rows]
            order = np.argsort(values[:, np.argmax(values.var(0))], kind="stable")
            parts += [rows[order[len(rows) // 2 :]], rows[order[: len(rows) // 2]]]
        self.rows = np.concatenate(leaves)
        self.kinds, self.size = self.kinds[self.rows], self.n[self.rows]
        self.cuts = np.append(0, np.cumsum([len(x) for x in leaves]))
        self.least, self.most = (f.reduceat(self.kinds, self.cuts[:-1]) for f in (np.minimum, np.maximum))
        self.largest = np.maximum.reduceat(self.size, self.cuts[:-1])

    def near(self, a: int, b: int, least: np.ndarray, most: np.ndarray, largest: int, apart: float) -> np.ndarray:
        """Which rows from ``a`` to ``b`` may be near a set of a tile."""
        gap = np.maximum(0, np.maximum(self.kinds[a:b] - most, least - self.kinds[a:b])).sum(1)
        return a + np.flatnonzero(gap <= apart * (self.size[a:b] + largest) + 1e-6)

    def fill(self, column: np.ndarray, width: int, share: float) -> None:
        """The matrix of counts, and the common tokens that each row needs in its columns: half of what a pair does."""
        self.counts, left = np.zeros((len(self.rows), width), np.uint8), []
        for a, b in _parts(np.diff(self.ends)[self.rows]):
            part = self.counted(self.rows[a:b], column, width + 2)
            if part[:, :width].max(initial=0) > np.iinfo(self.counts.dtype).max:
                self.counts = self.counts.astype(np.uint32 if part.max() >= 1 << 16 else np.uint16)
            self.counts[a:b] = part[:, :width]
            left.append(part[:, width + 1])
        # Less by what products of 32 bits may be rounded.
        self.needs = (share - 2e-4) * self.size - 0.5 * np.concatenate(left) - 0.01

    def matrix(self, rows: np.ndarray | slice, first: bool) -> np.ndarray:
        """Roots of the counts of some rows, as the smaller of two counts is their roots' product at most. The last two columns add minus
        the common tokens that a pair needs."""
        needs = self.needs[rows]
        out = np.empty((len(needs), self.counts.shape[1] + 2), np.float32)
        np.sqrt(self.counts[rows], out=out[:, :-2], dtype=np.float32)
        out[:, -2 if first else -1], out[:, -1 if first else -2] = -needs, 1
        return out

    def mark(self, bit: np.ndarray) -> None:
        """Per row, the bits of its tokens, and sorted keys of row and token for those that have none (``bit`` BITS)."""
        self.bits, keys = np.zeros((len(self.rows), BITS // 64), np.uint64), []
        for a, b in _parts(np.diff(self.ends)[self.rows]):
            rows = self.rows[a:b]
            sizes = self.ends[rows + 1] - self.ends[rows]
            tokens = self.flat[_ranges(self.ends[rows], sizes)]
            owner, at = np.repeat(np.arange(len(rows)), sizes), bit[tokens]
            have = np.zeros((len(rows), BITS), bool)
            some = at < BITS
            have[owner[some], at[some]] = True
            self.bits[a:b] = np.packbits(have, axis=1).view(np.uint64)
            rest = at == BITS
            keys.append(np.sort((a + owner[rest]) * len(bit) + tokens[rest]))
        self.keys = np.concatenate(keys)
        self.starts = np.searchsorted(self.keys, np.arange(len(self.rows) + 1) * len(bit))


def _common(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray, share: float, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs ``i, j`` with as many tokens in common as the ratio needs, and how many they are."""
    out = []
    lost_x, lost_y = np.diff(x.starts), np.diff(y.starts)
    for a in range(0, len(i), 8192):
        p, q = i[a : a + 8192], j[a : a + 8192]
        need = share * (x.size[p] + y.size[q]) - 1e-6
        common = np.bitwise_count(x.bits[p] & y.bits[q]).sum(1, dtype=np.int64)
        keep = common + np.minimum(lost_x[p], lost_y[q]) >= need
        p, q, need, common = p[keep], q[keep], need[keep], common[keep]
        for b in range(0, len(p), 1024):
            rows = q[b : b + 1024]
            pair = np.repeat(np.arange(len(rows)), lost_y[rows])
            key = y.keys[_ranges(y.starts[rows], lost_y[rows])] % tokens + p[b + pair] * tokens
            at = np.searchsorted(x.keys, key)
            hit = x.keys[np.minimum(at, len(x.keys) - 1)] == key if len(x.keys) else np.zeros(len(key), bool)
            common[b : b + 1024] += np.bincount(pair[hit], minlength=len(rows))
        keep = common >= need
        out.append((p[keep], q[keep], common[keep]))
    return tuple(np.concatenate([f[k] for f in out]) if out else np.zeros(0, np.int64) for k in range(3))


def _codes(texts: list[str]) -> np.ndarray:
    """Characters as numbers, a row per text, filled up with -1."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.full((len(texts), max(int(sizes.max(initial=0)), 1)), -1, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _alike(x: list[str], y: list[str], i: np.ndarray, j: np.ndarray, low: float) -> np.ndarray:
    """Which pairs ``x[i], y[j]`` have a common subsequence of ``low`` of their letters; none is ruled out if ``x[i]`` is long.

    The same bits as in ``blocks.common_letters``, for many pairs at once.
    """
    size_x, size_y = (np.array([len(t) for t in s], np.int64) for s in (x, y))
    short = size_x[i] <= WORD
    keep = ~short
    if not short.any():
        return keep
    use = np.flatnonzero(size_x <= WORD)
    codes = _codes([x[k] for k in use])
    letters = np.unique(codes[codes >= 0])
    places = np.zeros((len(x), len(letters) + 1), np.uint64)  # the last column: letters that no short text has
    for k in range(codes.shape[1]):
        have = codes[:, k] >= 0
        places[use[have], np.searchsorted(letters, codes[have, k])] |= np.uint64(1 << k)
    pairs = np.flatnonzero(short)
    # By length, so that the steps of a part are as many as its texts have letters.
    pairs = pairs[np.argsort(size_y[j[pairs]], kind="stable")]
    for first in range(0, len(pairs), 100_000):
        part = pairs[first : first + 100_000]
        a, b = i[part], j[part]
        rows, back = np.unique(b, return_inverse=True)
        other = _codes([y[k] for k in rows])
        at = np.minimum(np.searchsorted(letters, other), max(len(letters) - 1, 0))
        other = np.where(letters[at] == other, at, len(letters)) if len(letters) else np.zeros_like(other)
        full = np.array([(1 << n) - 1 for n in range(WORD + 1)], np.uint64)[size_x[a]]
        free = full.copy()
        for k in range(other.shape[1]):
            hit = free & places[a, other[back, k]]
            free = (free + hit | free - hit) & full
        common = size_x[a] - np.bitwise_count(free)
        keep[part] = 2 * common >= low * (size_x[a] + size_y[b]) - 1e-9
    return keep


def _columns(tokens: np.ndarray, masses: np.ndarray, width: int, left: int) -> np.ndarray:
    """A column for each token: ``tokens``, the most frequent first, to ``width`` columns of like sums in each class of sets; column
    ``width + 1`` has the first ``left`` of them, column ``width`` those that are not among them, which no pair has in common."""
    column = np.full(len(masses), width, np.int64)
    column[tokens[:left]] = width + 1
    rest, load, half = tokens[left:], np.zeros((width, masses.shape[1])), width // 2
    mostly, even = masses[rest].argmax(1), min(len(rest), 2048 + width)
    for a in range(0, even, half):
        part, of = rest[a : min(a + half, even)], mostly[a : min(a + half, even)]
        for c in np.unique(of).tolist():
            some = part[of == c]
            light = np.argsort(load[:, c], kind="stable")[: len(some)]
            column[some] = light
            load[light] += masses[some]
    column[rest[even:]] = np.arange(len(rest) - even) % width
    return column


def _laid(x: _Side, y: _Side, tokens: np.ndarray, masses: np.ndarray, share: float) -> tuple[np.ndarray, int]:
    """The columns that should take the least time."""
    mean = (x.n.mean() + y.n.mean()) / 2
    guess = min(sum(c < 1.1 * mean for c in COLUMNS), len(COLUMNS) - 1)
    if len(x.n) * len(y.n) < SMALL:
        return _columns(tokens, masses, COLUMNS[guess], 0), COLUMNS[guess]
    best = None
    rows = [np.unique(np.linspace(0, len(s.n) - 1, TRIED).astype(np.int64)) for s in (x, y)]
    for width in COLUMNS[max(guess - 2, 0) : guess + 2]:
        for left in LEFT_OUT:
            column = _columns(tokens, masses, width, left)
            a, b = (s.counted(r, column, width + 2) for s, r in zip((x, y), rows, strict=True))
            needs = [share * s.n[r] - 0.5 * c[:, -1] for s, r, c in zip((x, y), rows, (a, b), strict=True)]
            passed = np.sqrt(a[:, :width], dtype=np.float32) @ np.sqrt(b[:, :width], dtype=np.float32).T >= needs[0][:, None] + needs[1]
            if x is y:
                np.fill_diagonal(passed, False)
            cost = width * COLUMN_NS + passed.mean() * PASSED_NS
            if best is None or cost < best[0]:
                best = cost, column, width
    return best[1:]


def _kinds(x: _Side, y: _Side, tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A kind for each token, such that tokens of a kind are often in the same sets, and how often it is in each class of sets that
    share many. Which they are changes the time only."""
    column = np.full(size, 256, np.int64)
    column[tokens[:256]] = np.arange(min(256, len(tokens)))
    sides = [(s, np.unique(np.linspace(0, len(s.n) - 1, max(TRIED, min(2048, int(TOGETHER / s.n.mean())))).astype(np.int64))) for s in ([x] if x is y else [x, y])]
    have = np.vstack([s.counted(r, column, 257)[:, :256] for s, r in sides]).astype(np.float64)
    have -= have.mean(0)
    main = np.linalg.eigh(have.T @ have)[1][:, -KINDS:]
    at = have @ main
    drawn = [s.ends[r + 1] - s.ends[r] for s, r in sides]
    flat = np.concatenate([s.flat[_ranges(s.ends[r], n)] for (s, r), n in zip(sides, drawn, strict=True)])
    owner = np.repeat(np.arange(len(at)), np.concatenate(drawn))
    number = lambda signs: sum(s.astype(np.int64) << k for k, s in enumerate(signs))
    kind = number([np.bincount(flat, weights=at[owner, k], minlength=size) > 0 for k in range(KINDS)])
    group = number([at[:, k] > 0 for k in range(KINDS)])
    return kind, np.bincount(flat * np.int64(1 << KINDS) + group[owner], minlength=size << KINDS).reshape(size, 1 << KINDS)


def _pairs(x: _Side, y: _Side, low: float, letters: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of two blocks, or of one, with the similarity of their sets."""
    one, share, apart = x is y, low / (1 + low), (1 - low) / (1 + low)
    sides = [x] if one else [x, y]
    names, often = np.unique(np.concatenate([s.others for s in sides]), return_counts=True)
    for s in sides:
        s.name(names[often > 1])
    size = NUMBERS + int((often > 1).sum())
    seen = [np.bincount(s.flat, minlength=size) for s in sides]
    counts = sum(seen) * (seen[0] > 1 if one else (seen[0] > 0) & (seen[1] > 0))
    tokens = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    kind, masses = _kinds(x, y, tokens, size)
    column, width = _laid(x, y, tokens, masses, share)
    bit = np.full(size, BITS + 1, np.int64)
    bit[tokens] = np.minimum(np.arange(len(tokens)), BITS)
    for s in sides:
        s.sort(kind)
        s.fill(column, width, share)
        s.mark(bit)
    gap = np.maximum(0, np.maximum(x.least[:, None] - y.most, y.least - x.most[:, None])).sum(2)
    for p, q in np.argwhere(gap <= apart * (x.largest[:, None] + y.largest) + 1e-6).tolist():
        if one and q < p:
            continue
        (a, b), (c, d) = x.cuts[p : p + 2].tolist(), y.cuts[q : q + 2].tolist()
        rows, cols = x.near(a, b, y.least[q], y.most[q], y.largest[q], apart), y.near(c, d, x.least[p], x.most[p], x.largest[p], apart)
        if not len(rows) or not len(cols):
            continue
        i, j = np.divmod(np.flatnonzero(x.matrix(rows, True) @ y.matrix(cols, False).T >= 0), len(cols))
        i, j = rows[i], cols[j]
        if one and p == q:
            later = i < j
            i, j = i[later], j[later]
        if not len(i):
            continue
        i, j, common = _common(x, y, i, j, share, size)
        if letters is None:
            ratio = common / (x.size[i] + y.size[j] - common)
            keep = ratio >= low - 1e-12
        elif len(i):
            ratio = common / (x.size[i] + y.size[j] - common)
            (some, i_at), (more, j_at) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
            keep = _alike(x.texts.take(pa.array(x.rows[some])).to_pylist(), y.texts.take(pa.array(y.rows[more])).to_pylist(), i_at, j_at, letters)
        if len(i):
            yield x.rows[i[keep]], y.rows[j[keep]], ratio[keep]


def _cell(batches: Iterator[pa.RecordBatch], scope: list[str], low: float, letters: float | None) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches))
    names = {s: table.column(s).take(pa.array([0])) for s in scope}
    one = table.column("row")[0] == table.column("col")[0]
    x = _Side(table if one else table.filter(pc.equal(table["side"], 0)))
    y = x if one else _Side(table.filter(pc.equal(table["side"], 1)))
    del table
    pa.default_memory_pool().release_unused()
    found, held = [], 0
    if len(x.n) and len(y.n):
        for i, j, ratio in _pairs(x, y, low, letters):
            found.append((i, j, ratio))
            held += len(i)
            if held >= HANDED:
                yield _handed(found, names, x, y)
                found, held = [], 0
    yield _handed(found, names, x, y)


def _handed(found: list, names: dict[str, pa.ChunkedArray], x: _Side, y: _Side) -> pa.RecordBatch:
    i, j, ratio = (np.concatenate([np.zeros(0, kind), *[f[k] for f in found]]) for k, kind in enumerate((np.int64, np.int64, np.float64)))
    scope = [n.take(pa.array(np.zeros(len(i), np.int64))).combine_chunks() for n in names.values()]
    return pa.RecordBatch.from_arrays([*scope, x.ids.take(pa.array(i)), y.ids.take(pa.array(j)), pa.array(ratio)], names=[*names, "a", "b", "similarity"])


def dense_pairs(sets: DataFrame, scope: list[str], low: float, letters: float | None = None) -> DataFrame:
    """All pairs ``scope, a, b, similarity`` of ``scope, id, tokens`` (64-bit numbers) with a Jaccard ratio of ``low`` or more.

    With ``letters``, ``sets`` have a text ``t`` too, and of texts of up to WORD letters only the pairs with that part of their letters as a
    common subsequence are listed.
    """
    sized = sets.withColumn("n", F.size("tokens")).filter("n > 0")
    counted = sized.select(F.explode("tokens").alias("token")).groupBy("token").count().filter("count > 1")
    # At most NUMBERS rows, however large the input.
    names = np.sort(np.array([r["token"] for r in counted.orderBy(F.desc("count"), "token").limit(NUMBERS).collect()], np.int64))
    fields = [f for f in sized.schema.fields if f.name != "tokens"] + [T.StructField(c, T.BinaryType()) for c in ("numbers", "others")]
    rows = materialize(sized.mapInArrow(lambda b: _numbers(b, names), T.StructType(fields)), "numbers")

    inside = Window.partitionBy(*scope)
    sizes = rows.groupBy(*scope, "n").agg(F.count(F.lit(1)).alias("_many"))
    block_of = F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.ceil(F.sum("_many").over(inside) / BLOCKS)))
    # The part of a block that a set takes.
    parts = sizes.withColumn("_part", F.greatest(1 / block_of, F.col("n") / F.lit(TOKENS)))
    before = F.coalesce(F.sum(F.col("_many") * F.col("_part")).over(inside.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = rows.join(parts.select(*scope, "n", "_many", "_part", before.alias("_before")), [*scope, "n"])
    number = F.floor(F.col("_before") + F.pmod(F.xxhash64("id"), F.col("_many")) * F.col("_part")).cast("int")
    blocks = materialize(placed.select(*rows.columns, number.alias("block")), "blocks")

    ranges = blocks.groupBy(*scope, "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    left = ranges.select(*scope, F.col("block").alias("row"), "most")
    right = ranges.select(*scope, F.col("block").alias("col"), "least")
    met = left.join(right, scope) if scope else left.crossJoin(right)
    cells = materialize(met.filter(f"row <= col AND most >= least * {low!r} - 1e-9").select(*scope, "row", "col"), "cells")
    sides = [blocks.join(c.withColumn("block", F.col(key)), [*scope, "block"]).withColumn("side", F.lit(side)) for side, key, c in ((0, "row", cells), (1, "col", cells.filter("row < col")))]
    kinds = {f.name: f for f in blocks.schema.fields}
    schema = T.StructType([*[kinds[s] for s in scope], *[T.StructField(k, kinds["id"].dataType) for k in "ab"], T.StructField("similarity", T.DoubleType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cell(batches, scope, low, letters)

    dealt = sides[0].unionByName(sides[1]).repartition(max(1, min(2 * cells.count(), 10_000)), *scope, "row", "col")
    return materialize(dealt.groupBy(*scope, "row", "col").applyInArrow(compare, schema), "pairs")
