"""Token counts of a unigram tokenizer without making tokens: a count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character. The dynamic program carries
the best score and its number of pieces only. Ties go as in the tokenizers library's unigram model: at the same score
the piece that starts earliest wins, and the unknown character is tried last.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import to_batch

SPACE = "▁"
#: What an unknown character costs below the lowest score. Fixed value of the library.
UNKNOWN_PENALTY = 10.0
#: Words that a Python worker remembers before it starts anew: a bound on memory, not on input.
REMEMBERED = 1_000_000


def pieces_of(path: str) -> list[tuple[str, float]]:
    """Vocabulary pieces and scores of a sentencepiece model file, as they are stored."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Score and number of tokens of a word, remembered."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = {}
        for piece, score in pieces:
            scores[piece] = score  # of a repeated piece the last counts, as in the library
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))

    def __missing__(self, word: str) -> tuple[float, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        got = self[word] = self.viterbi(SPACE + word)
        return got

    def viterbi(self, text: str) -> tuple[float, int]:
        n = len(text)
        best, count, strange = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(text):
            ends[end + 1].append(match)
        for end in range(1, n + 1):
            top, at, single = None, 0, False
            for length, score in sorted(ends[end], reverse=True):  # longest first: the earliest start
                if top is None or best[end - length] + score > top:
                    top, at = best[end - length] + score, end - length
                single = single or length == 1
            unknown = not single and (top is None or best[end - 1] + self.unknown > top)
            if unknown:
                top, at = best[end - 1] + self.unknown, end - 1
                # An unknown character is its bytes; without byte pieces a run of them is one token.
                more = len(text[at].encode()) if self.bytes else not strange[at]
            else:
                more = 1
            best[end], count[end], strange[end] = top, count[at] + more, unknown
        return best[n], count[n]


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(pieces_of(path))
    return _counters[path]


def words_of(text: str) -> list[str]:
    """The words that the model sees one by one; each gets the space mark in front, none is given twice."""
    if not text:
        return []
    marked = text.replace(SPACE, " ")
    return (marked[1:] if marked[0] == " " else marked).split(" ")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])


def _counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = _counter(path)
    for batch in batches:
        ids, chars, sizes, tokens, scores = [], [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = words_of(text or "")
            found = list(map(counter.__getitem__, words))
            ids.append(doc_id)
            chars.append(len(text or ""))
            sizes.append(len(words))
            tokens.append(sum(n for _, n in found))
            scores.append(float(sum(s for s, _ in found)))
        yield to_batch(SCHEMA, [ids, chars, sizes, tokens, scores])


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_chars, n_words, n_tokens, score`` of the whole text.

    ``score`` is the sum of the best segmentation's piece scores. A null or empty text has no tokens. Rows that share
    a ``doc_id`` stay separate; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda b: _counts(b, model_path), "doc_id long, n_chars long, n_words long, n_tokens long, score double")
