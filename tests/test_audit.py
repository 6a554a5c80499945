"""Similarity joins against brute force."""

import functools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presslake.catalog import QUERIES
from presslake.functions import blocks as B
from presslake.functions.html import page_title
from presslake.operators import audit as A, cells as C, shingles as S


def variants(seed: int, n: int) -> list[str]:
    """Titles with near copies, exact copies, tiny strings and several scripts."""
    rng = random.Random(seed)
    syllables = ["flo", "od", "sto", "rm", "ra", "in", "cy", "clone", "dam", "re", "lief", " ", " ", "बाढ़", "é"]
    out = ["ab", "acb", "ba", "abc", "a", "aa", "aaa", "aaaa", "Ab"]
    while len(out) < n:
        base = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 22))).strip() or "x"
        out.append(base)
        for _ in range(rng.randint(0, 3)):
            chars = list(base)
            for _ in range(rng.randint(0, max(1, len(chars) // 4))):
                spot = rng.randrange(len(chars) + 1)
                if rng.random() < 0.5 and chars:
                    chars.pop(min(spot, len(chars) - 1))
                else:
                    chars.insert(spot, rng.choice("abcdeinost "))
            out.append("".join(chars).strip() or "y")
    return out[:n]


def grams(text):
    marked = f"\x02\x02{text}\x03\x03"
    return {marked[i : i + 3] for i in range(len(marked) - 2)} if text else set()


def ratio(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.mark.parametrize("low", [0.4, 0.6, 0.8])
def test_similar_titles(spark, low):
    titles = variants(7, 220)
    table = spark.createDataFrame(list(enumerate(titles)), "ord long, title string")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in A.similar_titles(table, low=low).collect()}
    first = {}
    for i, t in enumerate(titles):
        first.setdefault(t.lower(), i)
    distinct = sorted(first.items(), key=lambda x: x[1])
    expected = {}
    for x, (a, i) in enumerate(distinct):
        for b, j in distinct[x + 1 :]:
            if (found := ratio(grams(a), grams(b))) >= low:
                expected[(i, j)] = found
    assert len(expected) > 10
    assert got == pytest.approx(expected)


def test_copies_are_counted_not_paired(spark):
    titles = ["the same headline again"] * 300 + ["the same headlines again"] * 200
    table = spark.createDataFrame(list(enumerate(titles)), "ord long, title string")
    rows = A.similar_titles(table).collect()
    assert [(r["id_a"], r["id_b"], r["n_a"], r["n_b"]) for r in rows] == [(0, 300, 300, 200)]


def test_scope_and_salt(spark, monkeypatch):
    monkeypatch.setattr(A, "ROWS_PER_SALT", 5)
    titles = variants(3, 120)
    table = spark.createDataFrame(
        [(i, t, s) for s in ("x", "y") for i, t in enumerate(titles)], "ord long, title string, file string"
    )
    plain = {(r["id_a"], r["id_b"]) for r in A.similar_titles(table.filter("file = 'x'")).collect()}
    scoped = [(r["file"], r["id_a"], r["id_b"]) for r in A.similar_titles(table, scope=("file",)).collect()]
    assert len(scoped) == len(set(scoped))
    assert {(a, b) for f, a, b in scoped if f == "x"} == plain == {(a, b) for f, a, b in scoped if f == "y"}


def test_similar_content_compares_all_articles_and_whole_texts(spark):
    rng = random.Random(1)
    rows = []
    for k in range(40):
        words = [rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.randint(3, 400))]
        rows.append(("d", 2 * k, " ".join(words)))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append(("d", 2 * k + 1, "\n".join(words).upper()))
    rows += [("d", 100, None), ("d", 101, ""), ("d", 102, " \n"), ("other", 103, rows[0][2])]
    table = spark.createDataFrame(rows, "disaster_id string, ord long, article_text string")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in A.similar_content(table).collect()}

    def shingles(text):
        words = re.split(r"\s+", (text or "").lower().strip())
        return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words != [""] else set()

    expected = {}
    for x, (s, i, a) in enumerate(rows):
        for t, j, b in rows[x + 1 :]:
            if s == t and (a or "").lower() != (b or "").lower() and (found := ratio(shingles(a), shingles(b))) >= 0.8:
                expected[(i, j)] = found
    assert got == pytest.approx(expected) and len(expected) > 10


def test_similar_content_in_many_fragments_keeps_no_tokens_of_texts_without_a_near_copy(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(2, 120))]
        rows += [("x", 10 * k, " ".join(words)), ("x", 10 * k + 1, " ".join(words)), ("y", 10 * k + 2, " ".join(words)), (None, 10 * k + 3, " ".join(words))]
        if k % 3 == 0:
            words[rng.randrange(len(words))] = "other"
            rows += [("x", 10 * k + 4, "  ".join(words)), ("x", 10 * k + 5, "\u00a0".join(words)), (None, 10 * k + 6, " ".join(words))]
    table = spark.createDataFrame(rows, "disaster_id string, ord long, article_text string").repartition(3)
    written = []
    for module in (A, S):
        monkeypatch.setattr(module, "materialize", lambda df, name, write=module.materialize: written.append(write(df, name)) or written[-1])
    for name, value in (("FRAGMENT", 300), ("TOGETHER", 500), ("GATHERED", 2), ("SEEN", 7), ("BLOCK", 1), ("DEALT", 6), ("COLUMNS", 5)):
        monkeypatch.setattr(S, name, value)
    got = {(r.disaster_id, r.id_a, r.id_b): (r.n_a, r.n_b, r.similarity) for r in A.similar_content(table).collect()}

    def shingles(text):
        words = re.split(r"\s+", text, flags=re.ASCII)
        return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    groups = {}
    for scope, i, text in rows:
        groups.setdefault((scope, text), []).append(i)
    texts = [(scope, min(ids), len(ids), shingles(text)) for (scope, text), ids in groups.items() if scope]
    expected = {}
    for s, i, n, x in texts:
        for t, j, m, y in texts:
            if s == t and i < j and (found := ratio(x, y)) >= 0.8:
                expected[s, i, j] = (n, m, pytest.approx(found))
    assert got == expected and len(expected) > 5 and {n for n, _, _ in got.values()} == {2}
    held = [t for t in written if any(f.dataType.typeName() == "array" for f in t.schema)]
    assert held and sum(t.count() for t in held) < len(texts) / 2


def test_a_group_of_near_copies_meets_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for k in range(200):
        words = list(base)
        for _ in range(1 + k % 4):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
        texts.append(words)
    table = spark.createDataFrame([("d", k, " ".join(t)) for k, t in enumerate(texts)], "disaster_id string, ord long, article_text string")
    made, search = [], A._candidates
    monkeypatch.setattr(A, "_candidates", lambda *args: made.append(search(*args)) or made[-1])
    got = {(r.id_a, r.id_b): r.similarity for r in A.similar_content(table).collect()}
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    expected = {(i, j): found for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and (found := ratio(x, y)) >= 0.8}
    assert got == pytest.approx(expected) and len(expected) > 15_000
    assert made[0].count() < len(expected) / 4


def test_similarity_is_symmetric(spark):
    pair = spark.createDataFrame([("abcd", "bcde"), ("", ""), ("", "a"), ("x", "x")], "a string, b string")
    there = [r[0] for r in pair.select(A.similarity(F.col("a"), F.col("b"))).collect()]
    back = [r[0] for r in pair.select(A.similarity(F.col("b"), F.col("a"))).collect()]
    assert there == back == [pytest.approx(ratio(grams("abcd"), grams("bcde"))), 0.0, 0.0, 1.0]


def test_prefix_join_is_no_all_pairs_work(spark, sf_dir):
    """Candidates stay a small share of all pairs of distinct first lines."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = docs.select(F.col("doc_id").alias("ord"), F.substring_index("text", "\n", 1).alias("title"))
    titles = A.distinct_titles(lines)
    n = titles.count()
    assert A.similar_titles(lines).count() <= 0.05 * n * (n - 1) / 2


def test_plan_has_no_python(spark):
    table = spark.createDataFrame([(0, "a title")], "ord long, title string")
    assert "Python" not in A.similar_titles(table)._jdf.queryExecution().toString()


# ---------------------------------------------------------------- matching blocks


def plain_matched(a, b, places):
    """Longest common block first, then both sides; by trying all starts."""
    best = (0, 0, 0)
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and b[j + n] in places:
                n += 1
            if n > best[2]:
                best = (i, j, n)
    i, j, n = best
    while i > 0 and j > 0 and a[i - 1] == b[j - 1]:
        i, j, n = i - 1, j - 1, n + 1
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n + plain_matched(a[:i], b[:j], places) + plain_matched(a[i + n :], b[j + n :], places) if n else 0


def plain_ratio(a, b):
    places = {c for c in b if len(b) < 200 or b.count(c) <= len(b) // 100 + 1}
    return 2 * plain_matched(a, b, places) / (len(a) + len(b)) if a or b else 1.0


def test_matching_ratio_equals_the_plain_one(monkeypatch):
    plain = functools.cache(plain_ratio)
    rng = random.Random(3)
    texts = variants(11, 60) + ["", "tide", "diet", "abab", "baba"]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(600)] + [("tide", "diet"), ("diet", "tide"), ("", ""), ("", "a")]
    for size, alphabet in ((230, "abcdefghij klmnop"), (210, "ab"), (199, "abc"), (200, "abc"), (420, "".join(map(chr, range(33, 230))))):
        text = "".join(rng.choice(alphabet) for _ in range(size))
        other = text[: size // 3] + "#" + text[size // 2 :] + "qz"
        pairs += [(text, other), (other, text), (other[::-1], text)]
    for many in (B.MANY, 0, 300):  # by bits, by the automaton, by both
        monkeypatch.setattr(B, "MANY", many)
        for a, b in pairs:
            assert B.matching_ratio(a, b) == pytest.approx(plain(a, b)), (a, b)
    for a, b in pairs:
        assert 2 * B.common_letters(a, b) >= B.matching_ratio(a, b) * (len(a) + len(b)) - 1e-9 or not a + b
    assert B.matching_ratio("tide", "diet") != B.matching_ratio("diet", "tide")


@pytest.mark.parametrize("low", [0.5, 0.8])
def test_similar_titles_by_blocks(spark, low):
    titles = variants(5, 500 if low == 0.8 else 150)
    table = spark.createDataFrame([(k, t, "x") for k, t in enumerate(titles)] + [(9000, None, "x"), (9001, "", "x")], "ord long, title string, similarity string")
    got = {(r.id_a, r.id_b): r.similarity for r in A.similar_titles(table, low=low, metric="blocks").collect()}
    first = {}
    for i, t in enumerate(titles):
        first.setdefault(t.lower(), i)
    distinct = sorted(first.items(), key=lambda x: x[1])
    expected = {}
    for x, (a, i) in enumerate(distinct):
        for b, j in distinct[x + 1 :]:
            if 2 * min(len(a), len(b)) >= low * (len(a) + len(b)) and (found := B.matching_ratio(a, b)) >= low:
                expected[(i, j)] = found
    assert got == pytest.approx(expected) and len(expected) > 30


def test_blocks_meet_no_all_pairs(spark, sf_dir):
    found = QUERIES["similar_titles_blocks"](spark, sf_dir)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", page_title(F.col("html")).alias("t")).filter("t <> ''").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.t.lower(), r.page_id)
    distinct = sorted(first.items(), key=lambda x: x[1])
    expected = {(i, j) for x, (a, i) in enumerate(distinct) for b, j in distinct[x + 1 :] if B.ratio_of_least(a, b, 0.8)}
    assert {(r.id_a, r.id_b) for r in found.collect()} == expected


def test_a_very_long_title(spark):
    rng = random.Random(9)
    text = " ".join(rng.choice(["storm", "relief", "river", "Ünion", "x9"]) + str(rng.randrange(50)) for _ in range(12_000))
    table = spark.createDataFrame([(0, text), (1, text[:-9] + "!"), (2, text[:5000])], "ord long, title string")
    rows = A.similar_titles(table, metric="blocks").collect()
    assert [(r.id_a, r.id_b) for r in rows] == [(0, 1)] and rows[0].similarity > 0.99


# ---------------------------------------------------------------- cells


def syllable_titles(seed: int, n: int) -> list[str]:
    """Titles of one small alphabet, so that also their rarest trigrams and letters are in many of them; some are near copies."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        title = "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", " "]) for _ in range(rng.randint(4, 60)))
        out += [title, title[: len(title) // 8] + "q" + title[len(title) // 8 :], title[3:] + "on"]
    return out[:n]


@pytest.mark.parametrize("metric,low", [("trigrams", 0.6), ("blocks", 0.8)])
def test_titles_of_a_small_alphabet_meet_in_cells(spark, monkeypatch, metric, low):
    monkeypatch.setattr(C, "LEAST", 8)  # many cells
    monkeypatch.setattr(A, "_candidates", None)  # an index of tokens lists nearly all of these pairs
    titles = syllable_titles(2, 240)
    table = spark.createDataFrame(list(enumerate(titles)), "ord long, title string")
    got = {(r.id_a, r.id_b): r.similarity for r in A.similar_titles(table, metric=metric).collect()}
    first = {}
    for i, t in enumerate(titles):
        first.setdefault(t.lower(), i)
    rate = (lambda a, b: ratio(grams(a), grams(b))) if metric == "trigrams" else B.matching_ratio
    distinct = list(first.items())
    expected = {(i, j): found for x, (a, i) in enumerate(distinct) for b, j in distinct[x + 1 :] if (found := rate(a, b)) >= low}
    assert got == pytest.approx(expected) and len(expected) > 50


def test_common_letters_of_many_pairs():
    texts = variants(4, 120) + syllable_titles(5, 60) + ["", "x" * 64, "x" * 65, "xy" * 50]
    i, j = (k.ravel() for k in np.indices((len(texts), len(texts))))
    for low in (0.5, 0.8):
        got = C._alike(texts, texts, i, j, low)
        expected = [len(texts[a]) > 64 or 2 * B.common_letters(texts[a], texts[b]) >= low * (len(texts[a]) + len(texts[b])) - 1e-9 for a, b in zip(i.tolist(), j.tolist())]
        assert got.tolist() == expected


def rare_titles(seed: int, n: int) -> list[str]:
    """Near copies in two alphabets, some words in one title only, long runs of the same few letters."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        parts = rng.choice([["th", "er", "on", "an", "re", "he", "in", " "], ["бу", "ря", "на", "ре", "ке", "во", "да", " "]])
        title = "".join(rng.choice(parts) for _ in range(rng.randint(4, 60))) + chr(0x4E00 + rng.randrange(3000)) * rng.randint(0, 3)
        out += [title, title[: len(title) // 8] + "q" + title[len(title) // 8 :], title[3:] + "on", title * 2]
    return out[:n]


def cell_sides(texts: list[str], known: int):
    """A block with those of its trigrams that ``known`` sets or more have as numbers, the others as hashes."""
    sets = [sorted(grams(t)) for t in texts]
    often = sorted({g for s in sets for g in s if sum(g in other for other in sets) >= known})
    names, code = {g: k for k, g in enumerate(often)}, {g: k for k, g in enumerate(sorted({g for s in sets for g in s}))}
    numbers = [np.array([names[g] for g in s if g in names], "<u2").tobytes() for s in sets]
    others = [np.array([code[g] - 50 for g in s if g not in names], "<i8").tobytes() for s in sets]
    return pa.table({"id": list(range(len(sets))), "n": [len(s) for s in sets], "numbers": pa.array(numbers, pa.binary()), "others": pa.array(others, pa.binary())})


@pytest.mark.parametrize("low", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("small", [True, False])
def test_a_cell_finds_all_pairs(monkeypatch, low, small):
    if small:  # many tiles, few columns and bits, columns that are tried out
        for name, value in (("TILE", 8), ("TOGETHER", 200), ("BITS", 64), ("SMALL", 0), ("TRIED", 20), ("COLUMNS", (8, 16, 32)), ("LEFT_OUT", (0, 5))):
            monkeypatch.setattr(C, name, value)
    texts = rare_titles(8, 200)
    sets, table = [grams(t) for t in texts], cell_sides(texts, 3)
    one, even, odd = C._Side(table), C._Side(table.take(list(range(0, 200, 2)))), C._Side(table.take(list(range(1, 200, 2))))
    for x, y, allowed in ((one, one, lambda i, j: i < j), (even, odd, lambda i, j: i < j and (i + j) % 2)):
        got = {}
        for i, j, similarity in C._pairs(x, y, low, None):
            for a, b, r in zip(i.tolist(), j.tolist(), similarity.tolist(), strict=True):
                key = tuple(sorted((x.ids[a].as_py(), y.ids[b].as_py())))
                assert key not in got
                got[key] = r
        assert got == {(i, j): pytest.approx(r) for i, s in enumerate(sets) for j, t in enumerate(sets) if allowed(i, j) and (r := ratio(s, t)) >= low}
        assert len(got) > 10


def test_titles_with_rare_trigrams_in_small_blocks(spark, monkeypatch):
    for name, value in (("LEAST", 8), ("NUMBERS", 40), ("TOKENS", 300)):
        monkeypatch.setattr(C, name, value)
    texts = [*rare_titles(9, 160), "\U0001f600 ab" * 3, "\U0001f600 ab" * 3 + "c", "\U00020000ab\U00020000", "\U00020000", "Ab", "ab"]
    table = spark.createDataFrame(list(enumerate(texts)), "ord long, title string")
    got = {(r.id_a, r.id_b): r.similarity for r in A.similar_titles(table).collect()}
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(t.lower(), k)
    distinct = list(first.items())
    expected = {(i, j): found for x, (a, i) in enumerate(distinct) for b, j in distinct[x + 1 :] if (found := ratio(grams(a), grams(b))) >= 0.6}
    assert got == pytest.approx(expected) and len(expected) > 30


def test_sets_do_not_travel_with_each_pair(spark):
    """What a pair has in common is counted in its cell; no trigrams are joined to the pairs afterwards."""
    table = spark.createDataFrame(list(enumerate(syllable_titles(3, 60))), "ord long, title string")
    plan = A.similar_titles(table)._jdf.queryExecution().toString()
    assert "tokens" not in plan and "array_intersect" not in plan


def test_few_pairs_of_unlike_sets_are_multiplied(monkeypatch):
    """Titles of two alphabets have no near copies in the other one, and most sizes exclude each other."""
    rng = random.Random(12)
    alphabets = [["th", "er", "on", "an", "re", "he", "in", " "], ["бу", "ря", "на", "ре", "ке", "во", "да", " "]]
    texts = ["".join(rng.choice(alphabets[k % 2]) for _ in range(rng.randint(4, 60))) for k in range(600)]
    monkeypatch.setattr(C, "TILE", 32)
    rows, matrix = [], C._Side.matrix
    monkeypatch.setattr(C._Side, "matrix", lambda self, *args: rows.append(len(got := matrix(self, *args))) or got)
    side = C._Side(cell_sides(texts, 1))
    list(C._pairs(side, side, 0.6, None))
    assert sum(a * b for a, b in zip(rows[::2], rows[1::2], strict=True)) < 0.45 * 600 * 599 / 2
