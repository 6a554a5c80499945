"""Token counts, language ID, quality rules and decontamination against plain versions, and the awkward inputs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from presslake.llm import catalog, decontamination, language_id, quality_rules, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(1, None, None, None), (2, "", "en", "a"), (None, "A text with no id.", "en", None), (3, "x" * 60_000, "en", "a"), (3, "x" * 60_000, "en", "a"), (4, "12 34 !?", None, "b")]


# ---------------------------------------------------------------- token counts


def unigram(pieces, bytes_=True):
    tokenizer = Tokenizer(models.Unigram(pieces, 0, bytes_))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return tokenizer


def test_counts_match_the_library(spark, sf_dir, texts):
    tokenizer = unigram(token_counts.pieces_of(MODEL))
    for r in catalog.op3_token_counts(spark, sf_dir).collect():
        assert r.n_tokens == len(tokenizer.encode(texts[r.doc_id].text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("bytes_", [True, False])
def test_ties_and_unknowns_match_the_library(bytes_):
    # Integer scores tie often; with few pieces many characters are unknown.
    pieces = [("<unk>", 0.0), ("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -4.0), ("aba", -6.0), ("▁a", -5.0), ("é", -1.0)]
    pieces += [(f"<0x{b:02X}>", -9.0) for b in range(256)] if bytes_ else []
    counter, tokenizer = token_counts.Counter(pieces), unigram(pieces, bytes_)
    rng = np.random.default_rng(5)
    cases = ["", " ", "  a", "a  ", "▁▁a", "zz", "a\nb", "💥a💥💥b"] + ["".join(rng.choice(list("abé z\n"), 12)) for _ in range(300)]
    for text in cases:
        assert sum(counter[w][1] for w in token_counts.words_of(text)) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_awkward_rows(make):
    got = token_counts.token_counts(make(ROWS).withColumnRenamed("n_chars", "n_tokens"), MODEL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got)[:2] == [(False, 1, 0), (False, 2, 0)] and len(got) == 6
    assert token_counts.token_counts(make([]), MODEL).count() == 0


# ---------------------------------------------------------------- language


def test_held_out_accuracy(spark, sf_dir, texts):
    held = [r for r in catalog.op6_language_id(spark, sf_dir).collect() if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_awkward_rows(spark, make, docs):
    model = language_id.train(docs)
    got = language_id.identify(make(ROWS).withColumnRenamed("n_chars", "score"), model).collect()
    assert Counter(r.lang_pred for r in got)["und"] == 3  # null, empty, no letter
    assert all(r.score == 0 and r.ambiguous for r in got if r.lang_pred == "und")
    kept = language_id.keep_identified(make(ROWS), model)
    assert kept.columns == make(ROWS).columns and kept.filter("doc_id IN (1, 2, 4)").count() == 0


def test_no_or_one_language(make):
    nothing = language_id.train(make([]))
    assert [r.lang_pred for r in language_id.identify(make([(1, "word")]), nothing).collect()] == ["und"]
    one = language_id.train(make([(k, "some words", "en") for k in range(20)]))
    assert [(r.lang_pred, r.score) for r in language_id.identify(make([(1, "word")]), one).collect()] == [("en", 1.0)]


@pytest.mark.parametrize("n", [2, 4, 7, 30])
def test_codewords_are_distinct(n):
    codes = language_id.codewords(n)
    apart = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= (1 if n < 4 else 3)


# ---------------------------------------------------------------- quality


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_counts_and_labels(spark, sf_dir, texts):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = catalog.op7_quality_rules(spark, sf_dir).collect()
    for r in got:
        expected = plain_counts(texts[r.doc_id].text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    good = [r.kept for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.98 * len(good)


@pytest.mark.parametrize("text", ["", "a", "a b c a b c", "a a a a", "x y\n\n \nx y", "é ü b\x1cc #|", "a b c d"])
def test_base_counts_of_small_texts(text):
    assert quality_rules.base_counts(text.encode()) == plain_counts(text)


def test_symbols_are_far_from_prose(make):
    prose = "The quick brown fox jumps over the lazy dog, and then it rests. " * 3
    rows = [(k, " ".join(f"{w}{k}{i}" if i % 7 == 0 else w for i, w in enumerate(prose.split() * 2)), "en", "s") for k in range(30)]
    junk = (99, " ".join(f"### $$$ %%% {i} &&&" for i in range(80)), "en", "s")
    got = {r.doc_id: r for r in quality_rules.grade(make([*rows, junk, (100, None), (101, "")])).collect()}
    assert got[99].class_distance > quality_rules.MOST_CLASSES and not got[99].kept
    assert all(got[k].class_distance < 0.2 for k in range(30))
    assert got[100].base_failed and got[101].n_words == 0 and got[101].class_distance is None
    assert quality_rules.grade(make([])).count() == 0


def test_other_languages_and_texts_without_common_words_go(spark, sf_dir, make, docs, texts):
    graded = quality_rules.grade(docs).filter("kept AND word_distance IS NOT NULL").collect()
    langs = sorted({texts[r.doc_id].lang for r in graded})
    moved = [(k, r.doc_id, lang) for k, (r, lang) in enumerate((r, lang) for r in graded for lang in langs if lang != texts[r.doc_id].lang)]
    strange = [(10**6 + k, " ".join(f"q{k}z{i}" for i in range(200)) + " qzq" * 20, lang) for k, lang in enumerate(langs)]
    rows = [(k, texts[i].text, lang, "s") for k, i, lang in moved] + [(*row, "s") for row in strange]
    references = quality_rules.learn(docs)
    got = {r.doc_id: r for r in quality_rules.grade(make(rows), references).collect()}
    assert len(langs) > 1 and len(got) == len(rows)
    assert sum(not got[k].kept for k, _, _ in moved) >= 0.98 * len(moved)
    assert all(got[k].word_distance > references[lang].most_words and not got[k].kept for k, _, lang in strange)


def test_limit_for_words_follows_the_language():
    rare = quality_rules.Reference(np.ones(8), {b"a": 0}, np.array([1.0, 999.0]))
    common = quality_rules.Reference(np.ones(8), {b"a": 0}, np.array([600.0, 400.0]))
    # Where common words are few, texts without them are usual and stay.
    assert quality_rules.word_limit(rare, Counter({20: 6, 30: 5})) >= 0.024 > quality_rules.distance(np.array([0, 1.0]), rare.shares)
    without = quality_rules.distance(np.array([0, 1.0]), common.shares)
    assert quality_rules.word_limit(common, Counter({200: 90, 500: 9})) == pytest.approx(0.75 * without) and quality_rules.word_limit(common, Counter()) < without


def test_distance_is_a_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0.0, 2, 0])
    assert quality_rules.distance(p, p) == 0 and quality_rules.distance(p, q) == pytest.approx(1)


# ---------------------------------------------------------------- decontamination


def plain_hits(text, windows):
    words, hit, items = ITEM_WORD.findall((text or "").translate(LOWER)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            found = windows.get(tuple(words[i : i + size]))
            if found:
                items |= found
                hit |= set(range(i, i + size))
    return len(words), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


def windows_of(items):
    out = {}
    for item_id, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - 9) if words else 0):
            out.setdefault(tuple(words[i : i + 10]), set()).add("" if item_id is None else str(item_id))
    return out


def check(spark, found, windows, texts):
    for r in found.selectExpr("doc_id", "n_words", "n_hit", "n_items", "sha2(concat_ws(',', items), 256) AS sha", "contaminated").collect():
        assert tuple(r)[1:] == plain_hits(texts[r.doc_id], windows)


def test_hits_match_a_plain_search(spark, sf_dir, texts):
    windows = windows_of([tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()])
    got = catalog.op8_decontamination(spark, sf_dir).collect()
    assert any(r.contaminated for r in got)
    for r in got:
        assert tuple(r)[1:] == plain_hits(texts[r.doc_id].text, windows)


def test_short_repeated_and_overlapping_items_in_blocks(spark, make, monkeypatch):
    rng = np.random.default_rng(2)
    words = [chr(97 + k) for k in range(6)]
    say = lambda n: " ".join(rng.choice(words, n))
    items = [(k, say(int(rng.integers(1, 25)))) for k in range(30)] + [(3, "a b"), (90, None), (91, "..."), (None, "b c d"), (7, "a a a a a a a a a a a a")]
    docs = {k: say(int(rng.integers(0, 200))) for k in range(40)} | {40: "A. B, c-d", 41: "a " * 50, 42: None, 43: ""}
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = make(list(docs.items())).withColumnRenamed("n_chars", "_hits")
    check(spark, decontamination.contamination(rows, bench), windows_of(items), docs)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 50)
    check(spark, decontamination.contamination(rows, bench), windows_of(items), docs)


def test_longest_matches_and_removal(spark, make):
    item = " ".join(f"w{i}" for i in range(20))
    docs = make([(1, f"x y {item} z"), (2, " ".join(f"w{i}" for i in range(5, 17))), (3, "clean words"), (4, None), (5, " ".join(f"w{i}" for i in range(9)))])
    bench = spark.createDataFrame([("q", item)], "item_id string, text string")
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: [("q", 0, 2, 20)], 2: [("q", 5, 0, 12)], 3: [], 4: [], 5: []}
    kept = decontamination.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5}
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontamination.remove_contaminated(docs, none).count() == 5
    assert decontamination.contamination(make([]), bench).count() == 0


def test_blocks_are_searched_one_after_the_other(spark, make, monkeypatch):
    """Several blocks: what one leaves is written before the next, so no plan holds two of them."""
    items = [f"word{k} " * 3 + " ".join(f"w{k}x{j}" for j in range(12)) for k in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = make([(k, f"before {items[k % 9]} after" if k % 3 else "clean text here " * 5) for k in range(30)] + [(99, "w " * 100_000), (99, "w " * 100_000)])
    one = sorted(map(repr, decontamination.contamination(docs, bench).drop("matches").collect()))
    left = sorted(map(repr, decontamination.remove_contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    assert decontamination.n_blocks(bench) > 3
    many = decontamination.contamination(docs, bench).drop("matches")
    kept = decontamination.remove_contaminated(docs, bench)
    assert sorted(map(repr, many.collect())) == one and sorted(map(repr, kept.collect())) == left
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
