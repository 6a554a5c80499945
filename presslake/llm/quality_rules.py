"""Quality rules by the divergence of a document's distributions from references of its language.

The references are character-class and common-word histograms of all documents of a language. A document is kept when
the base rules pass and the Jensen-Shannon distances to its references are small; short texts are spared the distances.
A text without any common word is at a distance that depends on the language, so the limit for words does too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from presslake.llm.common import raw, rows_of
from presslake.llm.decontamination import words as clean_words
from presslake.sources.workspace import materialize

#: Limits of the distances, from 0 (equal) to 1 (disjoint). That of words is lower where the language's own limit is.
MOST_CLASSES, MOST_WORDS = 0.3, 0.5
#: A language's own limit for words: this part of the distance of a text without common words, but not below so many
#: times the median distance of the language's documents (where common words are few, most texts are far from them).
PART, TIMES = 0.75, 1.25
#: Steps that distances are counted in for the median.
STEPS = 1_000
#: Characters and words from which on a histogram says something.
LEAST_CHARS, LEAST_WORDS = 200, 80
COMMON = 60

#: Classes of characters, by the first byte of their UTF-8 form; continuation bytes count nothing.
CLASSES = ("lower", "upper", "digit", "blank", "newline", "mark", "symbol", "beyond ASCII")
_SKIP = len(CLASSES)


def _class(byte: int) -> int:
    c = chr(byte)
    if byte >= 0x80:
        return _SKIP if byte < 0xC0 else 7
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c == "\n":
        return 4
    if byte <= 0x20:
        return 3
    return 5 if c in ".,;:!?'\"()-" else 6


CLASS_OF = np.array([_class(b) for b in range(256)], np.uint8)
SYMBOLS = b"#*$%&|<>"
#: Not code points of words: white space, and bytes that continue a character.
NOT_COUNTED = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=_SKIP + 1)[:_SKIP]


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words inside 3-word windows found more than once."""
    found = text.split()
    n = len(found)
    chars = len(text.translate(None, NOT_COUNTED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in found], np.int64)
    repeated = 0
    if n >= 4:
        k = len(number)
        pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
        _, back, times = np.unique(pairs[:-1] * k + ids[2:], return_inverse=True, return_counts=True)
        again = times[back] > 1
        inside = np.zeros(n, bool)
        for shift in range(3):
            inside[shift : n - 2 + shift] |= again
        repeated = int(inside.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return float(np.sqrt(max(0.0, (half(p) + half(q)) / 2)))


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray  # of the common words, and of all others last
    most_words: float = 1.0  # the language's own limit of the words' distance


def word_distance(text: bytes, reference: Reference) -> float | None:
    """Distance of the text's common words; None where the text is too short."""
    found = clean_words(text)
    if len(found) < LEAST_WORDS or not reference.words:
        return None
    histogram = np.zeros(len(reference.words) + 1)
    for word, n in Counter(found).items():
        histogram[reference.words.get(word, -1)] += n
    return distance(histogram, reference.shares)


def divergences(text: bytes, reference: Reference) -> tuple[float | None, float | None]:
    """Distances of the text's character classes and common words; None where the text is too short."""
    counts = class_counts(text)
    classes = distance(counts, reference.classes) if counts.sum() >= LEAST_CHARS else None
    return classes, word_distance(text, reference)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) with the word null and the class in ``class`` for character counts, summed per task in parts."""
    schema = pa.schema([("lang", pa.string()), ("class", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
    classes: dict[str | None, np.ndarray] = {}
    found: dict[str | None, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counter in found.items():
            if counter:
                keys = list(counter)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.nulls(len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array(list(counter.values()), pa.int64())], schema=schema)
        found.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text:
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                found.setdefault(lang, Counter()).update(clean_words(text))
        if sum(map(len, found.values())) > 400_000:
            yield from out()
    yield from out()
    rows = [{"lang": lang, "class": k, "word": None, "n": int(n)} for lang, counts in classes.items() for k, n in enumerate(counts)]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def learn(docs: DataFrame, common: int = COMMON) -> dict[str | None, Reference]:
    """References of every language, from all documents; a null language is one of its own.

    Words are counted in the tasks first, so the shuffle has a row per task and distinct word. The driver gets, per
    language, the class counts, the words in total and the ``common`` most frequent words (ties by the word). A second
    pass counts the words' distances of all documents in steps, for the limits.
    """
    rows = raw(docs, F.col("lang").cast("string").alias("lang")).select("lang", "text")
    counted = rows.mapInArrow(_counted, "lang string, class int, word binary, n long")
    table = materialize(counted.groupBy("lang", "class", "word").agg(F.sum("n").alias("n")), "histograms")
    by_lang = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = table.filter("word IS NOT NULL").withColumn("rank", F.row_number().over(by_lang)).filter(F.col("rank") <= common).collect()
    totals = {r["lang"]: r["n"] for r in table.filter("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    references = {}
    for row in table.filter("word IS NULL").collect():
        made = references.setdefault(row["lang"], Reference(np.zeros(_SKIP), {}, np.zeros(1)))
        made.classes[row["class"]] += row["n"]
    for lang, made in references.items():
        words = sorted(((r["rank"], bytes(r["word"]), r["n"]) for r in top if r["lang"] == lang))
        made.words = {w: k for k, (_, w, _) in enumerate(words)}
        made.shares = np.array([n for _, _, n in words] + [totals.get(lang, 0) - sum(n for _, _, n in words)], float)
    steps: dict[str | None, Counter] = {}
    found = rows.mapInArrow(lambda b: _steps(b, references), "lang string, step int, n long").groupBy("lang", "step").agg(F.sum("n").alias("n"))
    for row in found.collect():
        steps.setdefault(row["lang"], Counter())[row["step"]] += row["n"]
    for lang, made in references.items():
        if made.words:
            made.most_words = word_limit(made, steps.get(lang, Counter()))
    return references


def word_limit(reference: Reference, steps: Counter) -> float:
    """The language's own limit, from its reference and the distances of its documents, counted in steps."""
    without = np.zeros(len(reference.shares))
    without[-1] = 1
    limit = PART * distance(without, reference.shares)
    seen, half = 0, (sum(steps.values()) + 1) // 2
    for step, n in sorted(steps.items()):
        seen += n
        if seen >= half:
            return max(limit, TIMES * step / STEPS)
    return limit


def _steps(batches: Iterator[pa.RecordBatch], references: dict) -> Iterator[pa.RecordBatch]:
    """(lang, step, n): how many texts of a language have a word distance in a step."""
    found: Counter = Counter()
    for langs, texts in rows_of(batches, "lang", "text"):
        for lang, text in zip(langs, texts, strict=True):
            strange = word_distance(text, references[lang]) if text else None
            if strange is not None:
                found[lang, round(strange * STEPS)] += 1
    if found:
        langs, steps = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(steps, pa.int32()), pa.array(list(found.values()), pa.int64())], names=["lang", "step", "n"])


def judge(text: bytes | None, lang: str | None, references: dict[str | None, Reference], most_classes: float, most_words: float) -> tuple:
    text = text or b""
    n, chars, symbols, lines, repeated = base_counts(text)
    failed = n < 50 or 100 * repeated > 50 * n
    reference = references.get(lang)
    far, strange = divergences(text, reference) if reference else (None, None)
    kept = not failed and (far is None or far <= most_classes) and (strange is None or strange <= min(most_words, reference.most_words))
    return n, chars, symbols, lines, repeated, failed, far, strange, kept


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"


def _judged(batches: Iterator[pa.RecordBatch], references: dict, most_classes: float, most_words: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *[part.split()[0] for part in RULES.split(", ")]]
    types = [pa.int64(), *[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
    for batch in batches:
        ids, langs, texts = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
        rows = [(i, *judge(t, lang, references, most_classes, most_words)) for i, lang, t in zip(ids, langs, texts, strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def grade(docs: DataFrame, references: dict[str | None, Reference] | None = None, most_classes: float = MOST_CLASSES, most_words: float = MOST_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the base counts and verdict, the two distances, and ``kept``.

    ``kept`` is false when the base rules fail or a distance to the reference of the row's own language is above its
    limit; for words that is ``most_words`` or the language's own, whichever is less. A null or empty text has no words and fails. A distance is null, and passes, for texts under the length guards.
    Rows that share a ``doc_id`` stay separate; other columns are ignored.
    """
    references = learn(docs) if references is None else references
    rows = raw(docs, F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(lambda b: _judged(b, references, most_classes, most_words), f"doc_id long, {RULES}")
