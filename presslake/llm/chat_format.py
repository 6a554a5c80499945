"""Chat formatting of records in mixed layouts, through fingerprints of their schemas.

A record is a JSON object. The hash of its sorted nested field paths selects a declarative mapping, which names where
the turns are and how their roles are called; so layouts are told apart once per shape, not by trying each in turn.
Canonical turns are ``conv_id, turn, role, text``. Formatting is per turn, so no conversation has to fit in memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"

#: Layouts: the field paths, then a list of (role or role path, text path) for single turns or a list path with names.
#: Fixed values.
LAYOUTS: dict[str, dict[str, Any]] = {
    "turn rows": {"paths": ["conv_id", "role", "text", "turn"], "turns": [("$role", "text")]},
    "prompt and response": {"paths": ["conv_id", "prompt", "response"], "turns": [("user", "prompt"), ("assistant", "response")]},
    "question and answer": {"paths": ["answer", "conv_id", "question"], "turns": [("user", "question"), ("assistant", "answer")]},
    "instruction": {"paths": ["conv_id", "instruction", "output"], "turns": [("user", "instruction"), ("assistant", "output")]},
    "instruction with input": {"paths": ["conv_id", "input", "instruction", "output"], "turns": [("user", ("instruction", "input")), ("assistant", "output")]},
    "system, prompt and response": {"paths": ["conv_id", "prompt", "response", "system"], "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
    "messages": {"paths": ["conv_id", "messages[].content", "messages[].role"], "list": "messages", "role": "role", "text": "content"},
    "from and value": {"paths": ["conv_id", "conversations[].from", "conversations[].value"], "list": "conversations", "role": "from", "text": "value"},
}
#: Other names of roles. Fixed values.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(value: Any, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; elements of a list share the path ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: set[str] | list[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


BY_SHAPE = {fingerprint(layout["paths"]): layout for layout in LAYOUTS.values()}


def turns_of(record: str | None) -> tuple[str | None, list[tuple[str, str]] | None]:
    """The fingerprint of a JSON record and its (role, text) turns; None for a shape that no mapping covers."""
    try:
        value = json.loads(record) if record else None
    except ValueError:
        value = None
    if not isinstance(value, dict):
        return None, None
    shape = fingerprint(field_paths(value))
    layout = BY_SHAPE.get(shape)
    if layout is None:
        return shape, None
    text = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if "list" in layout:
        named = [(text(m.get(layout["role"])), text(m.get(layout["text"]))) for m in value[layout["list"]]]
        return shape, [(ROLES.get(role, role), t) for role, t in named]
    turns = []
    for role, path in layout["turns"]:
        parts = [text(value[p]) for p in (path if isinstance(path, tuple) else (path,))]
        role = text(value[role[1:]]) if role.startswith("$") else role
        turns.append((ROLES.get(role, role), "\n".join(p for p in parts if p)))
    return shape, turns


TURN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("shape", pa.string())])


def _canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, turn, record in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "record")), strict=True):
            shape, turns = turns_of(record)
            for n, (role, text) in enumerate(turns if turns is not None else [(None, None)]):
                rows.append({"conv_id": conv_id, "turn": n if turn is None else turn, "role": role, "text": text, "shape": shape})
        yield pa.RecordBatch.from_pylist(rows, TURN)


def canonical_turns(records: DataFrame) -> DataFrame:
    """Turns ``conv_id, turn, role, text, shape`` of JSON ``record`` rows with ``conv_id`` and ``turn``.

    ``turn`` of the row is kept where it is given, and counts inside the record where it is null. A record that is
    broken or whose shape no mapping covers gives one row with null role and text, and its shape, for a report.
    """
    rows = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("record").cast("string").alias("record"))
    return rows.mapInArrow(_canonical, "conv_id long, turn long, role string, text string, shape string")


def turn_records(turns: DataFrame) -> DataFrame:
    """Rows by turn as JSON records of the layout ``turn rows``; null role and text become empty ones."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    # A missing turn number stands after all others.
    order = F.coalesce(F.col("turn").cast("long"), F.lit(2**62)).alias("turn")
    record = F.to_json(F.struct("conv_id", order, empty("role"), empty("text")), {"ignoreNullFields": "false"})
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), order, record.alias("record"))


def escape(text: Column) -> Column:
    """Reversible: backslashes are doubled and ``<|`` becomes ``<\\|``, so no marker can appear inside."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns: ``conv_id, turn, piece, loss_start, loss_length``, clustered by conversation and in order.

    ``piece`` is ``<|im_start|>role\\ntext<|im_end|>\\n`` with role and text escaped (a newline in a role as ``\\n``).
    The loss mask covers the text of assistant turns: code points ``loss_start`` to ``loss_start + loss_length``.
    A conversation's training text is its pieces one after the other. Ties of ``turn`` go by the piece.
    """
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    text = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit(NEWLINE))
    loss = F.coalesce(F.col("role") == "assistant", F.lit(False))
    formatted = turns.select(
        "conv_id",
        "turn",
        F.concat(head, text, F.lit(END + NEWLINE)).alias("piece"),
        F.when(loss, F.char_length(head)).cast("long").alias("loss_start"),
        F.when(loss, F.char_length(text)).cast("long").alias("loss_length"),
    )
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")


ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not piece.startswith(START) or not piece.endswith(END + NEWLINE):
        raise ValueError("a formatted turn lacks its marks")
    role, _, text = piece[len(START) : -len(END + NEWLINE)].partition(NEWLINE)
    return unescape(role), unescape(text)


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over ordered pieces; of a conversation only running sums and hash states are held."""
    now: list[Any] | None = None
    close = lambda: {"conv_id": now[0], "n_turns": now[1], "turns_sha256": now[2].hexdigest(), "loss_chars": now[3], "loss_sha256": now[4].hexdigest(), "formatted_chars": now[5]}
    for batch in batches:
        rows = []
        for conv_id, piece, start, length in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_length")), strict=True):
            if now is None or now[0] != conv_id:
                if now is not None:
                    rows.append(close())
                now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_piece(piece)
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            if start is not None:
                loss = unescape(piece[start : start + length])
                now[3] += len(loss)
                now[4].update(loss.encode())
            now[5] += len(piece)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, DIGEST)
    if now is not None:
        yield pa.RecordBatch.from_pylist([close()], DIGEST)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation of a table written from ``format_turns``: what its pieces and loss mask hold.

    A conversation's hash runs over its turns in order, so a conversation is streamed through one task, in constant
    memory. Its order is that of ``format_turns``.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")
    return ordered.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
