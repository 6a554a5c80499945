"""Packing token sequences: large items are matched in pairs, small ones best-fit the gaps that remain.

A document is its token ids and an end id; one longer than a sequence is cut into whole sequences and a first, shorter
piece. At most two pieces above a third of the capacity share a sequence, so these are matched first, greedily: each
piece above half takes the longest other large piece that fits, the rest pair among themselves. The smaller pieces
then go, from long to short, where the least room is left over.

Lengths are whole numbers up to the capacity, so the plan is made on the histogram of lengths: runs of equal sequences
instead of single ones, a few entries for each length however many documents there are. Pieces are then sorted by
length across the cluster, and a piece's place in that order says which entry, sequence and offset it gets.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from presslake.llm.common import positions, raw, text_slices
from presslake.sources.workspace import materialize

#: Chunks whose ids a Python worker remembers before it starts anew: a bound on memory, not on input.
REMEMBERED = 800_000
#: Texts that may not be cut at every blank: a special token, a blank after white space that more of it or the end
#: follows, and white space outside ASCII, or control characters that only some libraries count as such.
WHOLE = r"<\||[\s\x0B] (?:[\s\x0B]|$)|[\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


class ChunkIds:
    """Token ids of many texts at once.

    The byte-level tokenizer never joins text across the beginning of white space, and a single blank belongs to what
    follows it, so a text may be cut before each single blank. Arrow cuts a batch and finds its distinct chunks; each new
    one is encoded by the tokenizers library. Texts for which the cut could matter are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = array(self.code)  # of all chunks in a row
        self.ends = array("q", [0])

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """Numbers of distinct chunks; new ones are encoded together."""
        get = self.number.get
        found = [get(c, -1) for c in chunks]
        new = [c for c, n in zip(chunks, found, strict=True) if n < 0]
        for first in range(0, len(new), 10_000):
            part = new[first : first + 10_000]
            for chunk, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.learn(chunk, got.ids)
        return np.array([get(c) for c in chunks] if new else found, np.int64)

    def learn(self, chunk: str, ids: list[int]) -> int:
        number = self.number[chunk] = len(self.ends) - 1
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return number

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with the end id, and the number of ids per text."""
        if len(self.ends) > REMEMBERED:
            self.forget()
        end = f"\0{end_id}"  # texts with that character are not cut, so no chunk is called so
        end = self.number[end] if end in self.number else self.learn(end, [end_id])
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.or_(pc.match_substring_regex(texts, WHOLE), pc.match_substring(texts, "\0")).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        words = pc.dictionary_encode(pc.list_flatten(split))
        at, names = words.indices.to_numpy(), words.dictionary
        sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
        first = np.cumsum(sizes) - sizes
        later = self.numbers(_strings(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), names, pa.scalar(" ", pa.large_string()))))[at]
        begins, spot = np.unique(at[first], return_inverse=True)
        later[first] = self.numbers(_strings(names.take(pa.array(begins))))[spot]
        # An empty text has one empty chunk, which has no ids; then the end.
        return self._joined(texts, whole, np.insert(later, first + sizes, end), sizes + 1, end_id)

    def _joined(self, texts: pa.Array, whole: np.ndarray, chunk: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        held, until = np.array(self.ids, self.code), np.array(self.ends, np.int64)
        begin, n = until[chunk], until[chunk + 1] - until[chunk]
        ends = np.cumsum(n)
        ids = held[np.repeat(begin - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        per_text = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])])
        if not whole.any():
            return ids, per_text
        parts = np.split(ids, np.cumsum(per_text)[:-1])
        for k in np.flatnonzero(whole):
            own = self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids
            parts[k] = np.array([*own, end_id], self.code)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


def _strings(array_: pa.Array) -> list[str]:
    return array_.to_numpy(zero_copy_only=False).tolist()


_encoders: dict[str, ChunkIds] = {}


def _encoder(path: str) -> ChunkIds:
    if path not in _encoders:
        _encoders[path] = ChunkIds(path)
    return _encoders[path]


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    for batch in text_slices(batches):
        ids, n = encoder.encode(batch.column("text"), end_id)
        pieces = -(-n // capacity)
        doc = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        # Counted from the document's end, every piece but the first is whole.
        stop = n[doc] - (pieces[doc] - 1 - piece) * capacity
        start = np.maximum(stop - capacity, 0)
        base = (np.cumsum(n) - n)[doc]
        wide = ids.astype("<u4")
        crc = [zlib.crc32(wide[a:b]) for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)]
        columns = {"doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": start, "length": stop - start, "ids_crc32": pa.array(crc, pa.int64())}
        if keep_ids:
            columns["ids"] = pa.array([wide[a:b].view(np.int32) for a, b in zip(base + start, base + stop, strict=True)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(columns)


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and ``ids`` of all documents, none longer than ``capacity`` tokens.

    Texts are encoded whole by the tokenizers library's rules, a null or empty one as the end id only. Of a document
    that is too long only the first piece is shorter than ``capacity``. The CRC is over the ids as little-endian u32.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    texts = raw(docs).withColumn("text", F.col("text").cast("string"))
    return texts.mapInArrow(lambda b: _cut(b, tokenizer, end_id, capacity, keep_ids), schema)


@dataclass
class Plan:
    """Where pieces go: entries by length and, inside a length, by the number of the piece.

    Entry ``e`` covers the pieces of length ``length[e]`` from number ``first[e]`` on. They fill the sequences from
    ``sequence[e]`` on, ``each[e]`` pieces in a row per sequence, the first of them at ``offset[e]``.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int


def plan_sequences(histogram: dict[int, int], capacity: int) -> Plan:
    """Entries for ``histogram`` (pieces by length). Their number depends on the capacity, not on the pieces.

    A run is a range of sequences with the same gap. Each length splits one run at most, and a run's gap at least halves
    whenever pieces are put into it.
    """
    entries: list[tuple[int, int, int, int, int]] = []
    left = {n: k for n, k in histogram.items() if k}
    taken = dict.fromkeys(left, 0)
    used = 0

    def put(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        entries.append((length, taken[length], sequence, each, offset))
        taken[length] += count
        left[length] -= count

    runs: dict[int, list[tuple[int, int]]] = {}  # gap: ranges of sequences

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            runs.setdefault(gap, []).append((first, count))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    middle = [n for n in large if 2 * n <= capacity]
    for n in large:
        while left[n]:
            # The longest other large piece that fits; a piece up to half may pair with its own length.
            mate = next((m for m in middle if n + m <= capacity and left[m] >= (2 if m == n else 1)), None)
            if mate is None:
                count = left[n]
                put(n, count, used, 1, 0)
                leave(capacity - n, used, count)
            elif mate == n:
                count = left[n] // 2
                put(n, 2 * count, used, 2, 0)
                leave(capacity - 2 * n, used, count)
            else:
                count = min(left[n], left[mate])
                put(n, count, used, 1, 0)
                put(mate, count, used, 1, n)
                leave(capacity - n - mate, used, count)
            used += count
    gaps = list(runs)
    heapq.heapify(gaps)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        waiting: list[int] = []
        while left[n]:
            while gaps and gaps[0] < n:
                waiting.append(heapq.heappop(gaps))  # too small for this length
            if gaps:
                gap = gaps[0]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap]
                    heapq.heappop(gaps)
            else:
                gap, first = capacity, used
                count = -(-left[n] // (capacity // n))
                used += count
            each = gap // n
            full = min(count, left[n] // each)
            rest = min(each, left[n] - full * each) if full < count else 0
            for at, many, inside in ((first, full, each), (first + full, int(rest > 0), rest)):
                if many:
                    put(n, many * inside, at, inside, capacity - gap)
                    room = gap - inside * n
                    if room and room not in runs:
                        waiting.append(room) if room < n else heapq.heappush(gaps, room)
                    leave(room, at, many)
            touched = full + int(rest > 0)
            if touched < count:
                if gap not in runs:
                    heapq.heappush(gaps, gap)
                leave(gap, first + touched, count - touched)
        for gap in waiting:
            heapq.heappush(gaps, gap)
    columns = np.array(sorted(entries), np.int64).reshape(-1, 5).T
    return Plan(*columns, used)


def _placed(batches: Iterator[pa.RecordBatch], plan: Plan, before: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of pieces, which are numbered by length; ``before``: how many pieces are shorter, by length."""
    starts = before[plan.length] + plan.first
    for batch in batches:
        position = batch.column("position").to_numpy()
        entry = np.searchsorted(starts, position, side="right") - 1
        sequence, inside = np.divmod(position - starts[entry], plan.each[entry])
        kept = [c for c in batch.schema.names if c != "position"]
        new = [pa.array(plan.sequence[entry] + sequence), pa.array(plan.offset[entry] + inside * plan.length[entry])]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=[*kept, "sequence_id", "offset"])


def place(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``cut`` (``doc_id, piece, start, length, ids_crc32``) with ``sequence_id`` and ``offset`` of every piece.

    The driver gets one count per length. Pieces are ordered by length, document, piece and checksum; equal rows may
    change places with each other.
    """
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = plan_sequences(histogram, capacity)
    counts = np.bincount(list(histogram), list(histogram.values()), capacity + 1).astype(np.int64)
    before = np.cumsum(counts) - counts
    ordered = positions(cut.select("doc_id", "piece", "start", "length", "ids_crc32"), *map(F.col, ("length", "doc_id", "piece", "start", "ids_crc32")))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ordered.mapInArrow(lambda b: _placed(b, plan, before), schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Per piece of ``docs`` (``doc_id``, ``text``): ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every token of every document is in one piece; a sequence's pieces follow each other from 0 without a gap. A null or
    empty text is the end id only; a null id stays null; rows that share a ``doc_id`` are packed each; no rows give none.
    Other columns are ignored.
    """
    return place(materialize(pieces(docs, tokenizer, end_id, capacity, keep_ids=False), "pieces"), capacity)


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids, doc_ids, lengths``, pieces in order of their offsets.

    ``lengths`` tells a loader where attention must not cross. A sequence holds at most ``capacity`` tokens, which
    bounds the group that one task gathers.
    """
    cut = materialize(pieces(docs, tokenizer, end_id, capacity), "pieces")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Equal pieces of repeated rows are told apart by their number, so that each gets a place of its own.
    each = Window.partitionBy(*key).orderBy(F.lit(0))
    held = cut.withColumn("copy", F.row_number().over(each)).alias("c")
    where = place(cut, capacity).withColumn("copy", F.row_number().over(each)).alias("p")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in (*key, "copy")]
    rows = held.join(where, same).select("c.doc_id", "c.length", "c.ids", "p.sequence_id", "p.offset")
    parts = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.length").alias("lengths"))
