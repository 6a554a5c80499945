"""Language identification with error-correcting output codes.

Every language has a codeword. One linear classifier over hashed character n-grams predicts each bit; a text gets
the language whose codeword is nearest under a loss that weighs each bit by how well it does for that language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, BooleanType, StringType, StructField, StructType

from presslake.llm.common import remainder, rows_of, slices

BUCKETS = 4096
#: A text is ambiguous when the best language has less than this share of the decoded weight.
AMBIGUOUS = 0.5
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of one to three characters over the whole text, lower-cased, runs of non-letters as one gap.

    None when the text has no letter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(_is_letter()[codes], codes, 0)
    codes = codes[(codes != 0) | np.append(True, codes[:-1] != 0)] if len(codes) else codes
    if not codes.any():
        return None
    codes = np.concatenate([[0], codes, [0]])
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] * 0x9E3779B1 + codes[2:] * 0x85EBCA77
    keys = np.concatenate([codes * 0xC2B2AE3D, two * 0x27D4EB2F, three * 0x165667B1])
    return np.bincount((keys >> 15 ^ keys >> 29) & BUCKETS - 1, minlength=BUCKETS)


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares, so that no frequent n-gram drowns the rest; the length is 1."""
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of -1/1 bits for each of ``n`` languages: every division for few, well separated random ones for many."""
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 7:
        kinds = np.arange(1, 1 << n - 1)
        bits = kinds[None, :] >> np.arange(n)[:, None] & 1
    else:
        rng = np.random.default_rng(seed)
        width = int(np.ceil(10 * np.log2(n)))
        tries = (rng.integers(0, 2, (n, width)) for _ in range(200))
        apart = lambda b: min((b[i] != b[i + 1 :]).sum(1).min() for i in range(n - 1))
        bits = max(tries, key=apart)
        bits = bits[:, (bits.min(0) != bits.max(0))]
    return (bits * 2 - 1).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest language, and its share of the decoded weight, for each row of features."""
        n = len(self.languages)
        if n == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -self.codes[None] * margin[:, None, :])
        far = (loss * self.trust[None]).sum(2) * self.codes.shape[1]
        near = np.exp(far.min(1, keepdims=True) - far)
        return far.argmin(1), near.max(1) / near.sum(1)


def fit(x: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 200) -> Model:
    """Logistic classifiers for all bits at once, by full-batch Adam; the trust in a bit is its accuracy per language."""
    codes = codewords(len(languages))
    width = codes.shape[1]
    w, b = np.zeros((x.shape[1], width), np.float32), np.zeros(width, np.float32)
    if not width:
        return Model(languages, codes, w, b, np.ones((len(languages), 0)))
    target = codes[labels]
    share = 1 / (np.bincount(labels, minlength=len(languages))[labels] * len(languages))  # each language counts alike
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, b)]
    for step in range(1, steps + 1):
        pull = -target / (1 + np.exp(target * (x @ w + b))) * share[:, None].astype(np.float32)
        for p, g, m in ((w, x.T @ pull + 1e-5 * w, moments[0]), (b, pull.sum(0), moments[1])):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            p -= 0.2 * (m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    right = (np.sign(x @ w + b) == target).astype(float)
    trust = np.stack([right[labels == k].mean(0) for k in range(len(languages))]) + 1e-3
    return Model(languages, codes, w, b, trust / trust.sum(1, keepdims=True))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in rows_of(batches, "lang", "order", "text"):
        rows = []
        for lang, order, text in zip(*part, strict=True):
            if (counts := ngram_counts(text)) is not None:
                rows.append({"lang": lang, "order": order, "x": features(counts).tobytes()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("order", pa.int64()), ("x", pa.binary())]))


def train(docs: DataFrame, folds: int = 5, sample: int = 2_000) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the documents whose fold is not 0.

    At most about ``sample`` documents are fitted, the same number of each language, chosen by a hash of their row;
    the bound is on the rows that the driver gets, each a fixed-size vector of its whole text.
    """
    rows = docs.select(remainder(F.col("doc_id"), folds).alias("fold"), F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("order"))
    rows = rows.filter("fold <> 0 AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros((0, 0)))
    each = max(20, sample // len(sizes))
    shares = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, 1.5 * each / n + 10 / n))])
    chosen = rows.filter((F.pmod("order", F.lit(1_000_003)) / 1_000_003) < shares[F.col("lang")])
    got = chosen.select("lang", "order", "text").mapInArrow(_sampled, "lang string, order long, x binary").collect()
    kept: dict[str, list] = {}
    for row in sorted(got, key=lambda r: (r["lang"], r["order"], bytes(r["x"]))):
        if len(kept.setdefault(row["lang"], [])) < each:
            kept[row["lang"]].append(np.frombuffer(row["x"], np.float32))
    languages = sorted(kept)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros((0, 0)))
    labels = np.repeat(np.arange(len(languages)), [len(kept[k]) for k in languages])
    return fit(np.stack([x for k in languages for x in kept[k]]), labels, languages)


def predictions(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, list[bool]]:
    """Language, score and whether it is ambiguous, of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for first in range(0, len(texts) if model.languages else 0, 512):
        part = [(n, c) for n, t in enumerate(texts[first : first + 512], first) if t and (c := ngram_counts(t)) is not None]
        if part:
            best, score = model.decode(np.stack([features(c) for _, c in part]))
            for (n, _), k, s in zip(part, best, score, strict=True):
                names[n], scores[n] = model.languages[k], s
    return names, scores, [bool(name == UNKNOWN or score < AMBIGUOUS) for name, score in zip(names, scores, strict=True)]


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        names, scores, unsure = predictions(batch.column("text").to_pylist(), model)
        new = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *new], names=["doc_id", "lang_pred", "score", "ambiguous"])


def _clear(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        _, _, unsure = predictions(batch.column("text").to_pylist(), model)
        yield batch.filter(pa.array([not u for u in unsure], pa.bool_()))


def identify(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score, ambiguous``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a null text, one without a letter, or when
    nothing was learned. Nothing but the text is an input. Rows that share a ``doc_id`` stay separate.
    """
    rows = docs.select("doc_id", "text")
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
    found = rows.mapInArrow(lambda batches: _predict(batches, model), StructType([rows.schema["doc_id"], *added]))
    return found.select("doc_id", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is clear; the others go in the worker, nothing is added."""
    return docs.mapInArrow(lambda batches: _clear(batches, model), docs.schema)
