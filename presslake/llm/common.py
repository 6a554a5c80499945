"""What several operators of this subpackage share: word rules, folds, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.sources.workspace import materialize

#: Words are what stands between these; ``bytes.split`` and ``bytes.lower`` follow the same ASCII rules.
WORD = r"[^\x20\x09-\x0D]+"


def lower_words(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; none for a null."""
    return data.lower().split() if data else []


def remainder(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def raw(docs: DataFrame, *more: str | Column) -> DataFrame:
    """``doc_id``, the text as UTF-8 bytes and further columns: all that a Python stage is sent."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)


def unused(taken: list[str], *names: str) -> list[str]:
    """``names`` with underscores in front, as many as make them differ from all ``taken`` column names."""
    held = {t.lower() for t in taken}
    mark = "_"
    while any((mark + n).lower() in held for n in names):
        mark += "_"
    return [mark + n for n in names]


_libc = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back to the system: workers stay alive, idle, beside stages that need the memory themselves."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into smaller ones, so that few texts are Python objects at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
        release()


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[list]]:
    """The named columns of each Arrow batch, in slices, as Python lists."""
    for batch in slices(batches):
        yield [batch.column(name).to_pylist() for name in names]


def to_batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def text_slices(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows with about ``size`` bytes of ``text``; a longer text is a run of its own.

    Runs are copies, not views: some text kernels (``ascii_lower``) give wrong bytes for an array that starts inside its buffer.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        # A cut where the running size enters another multiple of ``size``, and at 20,000 rows.
        run = (np.cumsum(lengths) - lengths) // size
        cuts = np.flatnonzero((np.diff(run, prepend=run[:1]) != 0) | (np.arange(len(run)) % 20_000 == 0))
        for first, last in zip(cuts, np.append(cuts[1:], len(run)), strict=True):
            yield batch.take(pa.array(np.arange(first, last)))


def positions(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``position``: 0, 1, 2 ... in the given order, without one task that sees all rows.

    Rows are dealt by ranges of the order and sorted inside each; a range's rows before it are a running sum with one
    row per range. The order must tell rows apart, or rows that it does not tell apart may change places. Written once,
    so the ranges are the same whenever the positions are read.
    """
    held = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(held, "ordered").withColumns({"_range": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before = F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = placed.groupBy("_range").count().select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(ranges, "_range").select(*rows.columns, (F.col("_before") + F.col("_row")).alias("position"))
