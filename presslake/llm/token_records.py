"""Token ids as length-delimited binary records with masked checksums, beside an offset index for shuffled reads.

A data file is a run of records. A record is ``length`` (u64), the masked checksum of those eight bytes (u32), the
payload, and the payload's masked checksum (u32), all little-endian. The payload is one document: its id (i64), a
flag byte (1: the id is null), the bytes per token id (u8: 2 or 4) and the token ids. The index file has, for each
record, its offset (u64) and its number of ids (u64), so that a loader can read records in any order.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from presslake.llm.common import raw, rows_of
from presslake.sources.workspace import materialize, new_path

LENGTH, CHECK, HEAD, ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB"), struct.Struct("<QQ")
#: Words whose ids a Python worker remembers before it starts anew: a bound on memory, not on input.
REMEMBERED = 1_000_000
#: Documents whose new pieces are encoded together.
TOGETHER = 200
#: After a letter, one of these always starts a piece of its own for the tokenizer, so ``word,`` is ``word`` and ``,``.
ENDS = re.compile(rb"[a-z][.,;:!?]\Z").search


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted so that checksums of data that hold checksums stay meaningful."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def unframe(stream) -> Iterator[bytes]:
    """Payloads of a data file; a record that was cut off or changed raises ValueError."""
    while length := stream.read(8):
        check = stream.read(4)
        if len(length) < 8 or len(check) < 4 or CHECK.unpack(check)[0] != masked(length):
            raise ValueError("the length of a record is damaged")
        payload, check = stream.read(LENGTH.unpack(length)[0]), stream.read(4)
        if len(check) < 4 or CHECK.unpack(check)[0] != masked(payload):
            raise ValueError("the payload of a record is damaged")
        yield payload


class WordIds(dict):
    """Token ids of a blank-free piece of text, as little-endian bytes.

    The tokenizer drops white space and never joins text across it, so a text's ids are those of its pieces in
    turn; most pieces repeat, so most are looked up. Each miss asks the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"

    def encode(self, text: bytes) -> bytes:
        """Only ASCII blanks cut the text; other white space stays inside a piece, where the tokenizer drops it."""
        # Lower-casing A-Z first lets more pieces repeat; a text that may hold a special token keeps its case.
        return b"".join(map(self.__getitem__, self.pieces(text)))

    @staticmethod
    def pieces(text: bytes) -> list[bytes]:
        return (text if b"<|" in text else text.lower()).split()

    def learn(self, texts: list[bytes]) -> None:
        """Encode the new pieces of some texts at one go, which is cheaper than one by one."""
        new = {w for text in texts for w in self.pieces(text) if w not in self}
        new = [w for w in {w[:-1] if ENDS(w) else w for w in new} if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
        for start in range(0, len(new), 10_000):
            part = new[start : start + 10_000]
            for word, got in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                self[word] = array(self.code, got.ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if ENDS(word):
            got = self[word[:-1]] + self[word[-1:]]
        else:
            got = array(self.code, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        self[word] = got
        return got


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def _write_part(batches: Iterator[pa.RecordBatch], root: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    encoder = _encoder(tokenizer)
    store, base = fs.FileSystem.from_uri(root)
    number = context.partitionId()
    final = f"{base}/part-{number:06d}"
    own = f"{base}/_{number:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
    end = end_id.to_bytes(encoder.width, "little")
    index, offset, tokens = [], 0, 0
    store.create_dir(base, recursive=True)
    out = None
    for docs, texts in rows_of(batches, "doc_id", "text"):
        texts = [text or b"" for text in texts]
        for at, (doc_id, text) in enumerate(zip(docs, texts, strict=True)):
            if at % TOGETHER == 0:
                encoder.learn(texts[at : at + TOGETHER])
            if out is None:
                out = store.open_output_stream(f"{own}.rec")
            ids = encoder.encode(text) + end
            record = frame(HEAD.pack(doc_id or 0, doc_id is None, encoder.width) + ids)
            out.write(record)
            index.append(ENTRY.pack(offset, len(ids) // encoder.width))
            offset += len(record)
            tokens += len(ids) // encoder.width
    if out is not None:
        out.close()
        with store.open_output_stream(f"{own}.idx") as side:
            side.write(b"".join(index))
        store.move(f"{own}.idx", f"{final}.idx")
        store.move(f"{own}.rec", f"{final}.rec")
        names = ["file", "path", "records", "tokens", "bytes"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, (number, f"{root}/part-{number:06d}", len(index), tokens, offset), strict=True))])


def write_records(docs: DataFrame, root: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write all of ``docs`` (``doc_id``, ``text``) below ``root`` and return the files, one row each.

    Rows: ``file`` (its number; files follow each other in ascending ``doc_id``), ``path``, ``records``, ``tokens``,
    ``bytes``. Documents are dealt by ranges of ``doc_id`` and sorted inside each; a null id comes first, rows that
    share an id are ordered by text, and each stays a record of its own. A null or empty text has the end id only.
    A task writes under a name of its own and renames it when complete, so a repeated task replaces its file.
    """

    ordered = raw(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # Written at once: a manifest that is computed twice would write the files twice.
    return materialize(ordered.mapInArrow(lambda b: _write_part(b, root, tokenizer, end_id), "file long, path string, records long, tokens long, bytes long"), "manifest")


def _read_part(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] if digest else ["doc_id", "start", "ids"]
    for path, place in ((row["path"], row["start"]) for batch in batches for row in batch.to_pylist()):
        store, base = fs.FileSystem.from_uri(f"{path}.rec")
        rows = []
        with store.open_input_stream(base, buffer_size=1 << 20) as stream:
            for payload in unframe(stream):
                doc_id, null, width = HEAD.unpack_from(payload)
                ids = np.frombuffer(payload, f"<u{width}", offset=HEAD.size)
                tail = (len(ids), zlib.crc32(ids.astype("<u4").tobytes())) if digest else (ids.astype(np.int32),)
                rows.append((None if null else doc_id, place, *tail))
                place += len(ids)
                if len(rows) == 2_000:
                    yield _table(rows, names)
                    rows = []
        if rows:
            yield _table(rows, names)


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def _placed(files: DataFrame) -> DataFrame:
    # One row per file, so the running total stays small; then a task for each file.
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("path", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    return placed.repartition(max(1, files.count()))


def read_digests(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every record, read from the files with all checksums verified.

    ``start`` counts the ids of all earlier records; the CRC is over the ids as little-endian u32.
    """
    return _placed(files).mapInArrow(lambda b: _read_part(b, True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(files: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every record."""
    return _placed(files).mapInArrow(lambda b: _read_part(b, False), "doc_id long, start long, ids array<int>")


def read_record(path: str, number: int) -> tuple[int | None, list[int]]:
    """Record ``number`` of one file, found through its index: what a loader that reads in shuffled order does."""
    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{base}.idx") as side:
        offset, n = ENTRY.unpack(side.read_at(ENTRY.size, number * ENTRY.size))
    with store.open_input_file(f"{base}.rec") as data:
        data.seek(offset)
        payload = next(unframe(data))
    doc_id, null, width = HEAD.unpack_from(payload)
    ids = np.frombuffer(payload[HEAD.size :], f"<u{width}").tolist()
    assert len(ids) == n
    return (None if null else doc_id), ids


def records_root(spark) -> str:
    path = new_path(spark, "records")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
