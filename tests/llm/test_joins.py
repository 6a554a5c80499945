"""Line dedup and the n-gram join against brute force, and the awkward inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from presslake.llm import catalog, components, line_dedup, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def vary(rng, text, n, letters):
    out = list(text)
    for _ in range(n):
        at, kind = int(rng.integers(0, len(out) + 1)), rng.integers(0, 3)
        if kind == 0 or at == len(out):
            out.insert(at, str(rng.choice(letters)))
        elif kind == 1:
            del out[at]
        else:
            out[at] = str(rng.choice(letters))
    return "".join(out)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_distance_matches_the_full_matrix(spark, k):
    rng = np.random.default_rng(k)
    letters = list("abç𝒳")
    pairs = [("", ""), ("a", ""), ("", "ab"), ("abc", "abc")]
    for _ in range(600):
        a = "".join(rng.choice(letters, int(rng.integers(0, 15))))
        pairs.append((a, vary(rng, a, int(rng.integers(0, 5)), letters)))
    for r in line_dedup.edit_distance(spark.createDataFrame(pairs, "a string, b string"), "a", "b", k).collect():
        assert min(k + 1, r.distance) == min(k + 1, edits(r.a, r.b)), r


def plain_report(rows, k, least):
    first, places = {}, defaultdict(list)
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for no, line in enumerate((text or "").split("\n")):
            line = line.rstrip(" \t\r")
            if line.strip(" \t\r"):
                first.setdefault(line, (doc_id, no))
                places[doc_id].append((no, line))
    long = [line for line in first if len(line) >= least]
    near = {b for i, b in enumerate(long) for a in long[:i] if abs(len(a) - len(b)) <= k and edits(a, b) <= k}
    out = {}
    for doc_id, _ in rows:
        own = [(no, line) for no, line in places[doc_id] if first[line] == (doc_id, no)]
        kept = [hashlib.md5(line.encode()).hexdigest() for _, line in own if line not in near]
        out[doc_id] = (len(places[doc_id]), len(places[doc_id]) - len(own), len(own) - len(kept), len(kept), hashlib.md5("".join(kept).encode()).hexdigest())
    return out


def test_line_report_matches_brute_force(make):
    rng = np.random.default_rng(9)
    letters = list("abcdé ")
    base = ["".join(rng.choice(letters, int(rng.integers(5, 60)))) + "." for _ in range(12)]
    rows = []
    for doc_id in range(40):
        lines = [vary(rng, str(rng.choice(base)), int(rng.integers(0, 4)), letters) for _ in range(4)]
        rows.append((doc_id, "\n".join([*lines, "", " \t", "a common line that every document has in it\r"])))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "z" * 50_000), (None, "line without an id of its document")]
    got = line_dedup.line_report(make(rows).withColumnRenamed("n_chars", "near")).collect()
    expected = plain_report(rows, line_dedup.EDITS, line_dedup.LEAST)
    assert sum(v[2] for v in expected.values()) > 10
    for r in got:
        assert (r.n_lines, r.n_exact, r.n_near, r.n_kept, r.kept_md5) == expected[r.doc_id], r
    assert len(got) == len(rows)


def test_a_group_of_near_lines_is_not_compared_in_pairs(spark, make):
    line = "the same long line of words that many documents have with one letter changed"
    rows = [(k, line[: k % 70] + "#" + line[k % 70 + 1 :] + "") for k in range(70)] + [(70, line)]
    got = {r.doc_id: r.n_kept for r in line_dedup.line_report(make(rows)).collect()}
    assert got[0] == 1 and sum(got.values()) == 1  # any two are within two edits


def test_dedup_lines_and_no_rows(make):
    docs = make([(1, "one line\n\ntwo"), (2, "two\nthree"), (3, None)])
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {1: "one line\n\ntwo", 2: "three", 3: None}
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.line_report(make([])).count() == 0


def test_line_plan_has_no_python(spark, sf_dir):
    plan = catalog.op1_line_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


# ---------------------------------------------------------------- n-gram join


def plain_groups(rows, n=4, percent=85):
    sets = []
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    index = defaultdict(list)
    for k, found in enumerate(sets):
        for other, both in Counter(o for g in found for o in index[g]).items():
            if 100 * both >= percent * (len(found) + len(sets[other]) - both):
                parent[root(k)] = root(other)
        for g in found:
            index[g].append(k)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(rows[k][0])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    return sorted(((doc_id, len(s), least[root(k)]) for k, ((doc_id, _), s) in enumerate(zip(rows, sets))), key=str)


def as_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_join_query_matches_brute_force(spark, sf_dir, texts):
    assert as_rows(catalog.op5_ngram_join(spark, sf_dir)) == plain_groups([(k, r.text) for k, r in texts.items()])


def test_chains_near_misses_and_awkward_rows(make, monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, doc_id = [], 10
    for _ in range(6):
        words = list(rng.choice(vocabulary, 150))
        for _ in range(15):  # each a little further from the first, about the threshold
            words = list(words)
            for at in rng.integers(0, len(words), int(rng.integers(0, 4))):
                words[at] = str(rng.choice(vocabulary))
            rows.append((doc_id, " ".join(words)))
            doc_id += 1
    passage = " ".join(rng.choice(vocabulary, 60))
    rows += [(500 + k, passage + " " + " ".join(rng.choice(vocabulary, 200))) for k in range(20)]  # a shared passage links nothing
    rows += [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "x " * 30_000), (7, "x " * 30_000), (None, "one two"), (None, "alone here")]
    expected = plain_groups(rows)
    assert len({c for _, _, c in expected}) < len(rows) - 40
    assert as_rows(ngram_join.similar_documents(make(rows).withColumnRenamed("n_chars", "key"))) == expected
    monkeypatch.setattr(ngram_join, "FRAGMENT", 900)
    assert as_rows(ngram_join.similar_documents(make(rows))) == expected


def test_one_of_each_group_stays_and_no_rows(make):
    docs = make([(3, "a b c d e"), (1, "A b c d e"), (2, "other words stand in here"), (4, None), (None, "a b c d e")])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "4", "None"]
    assert ngram_join.similar_documents(make([])).count() == 0 and ngram_join.keep_one(make([])).count() == 0


def test_pipeline_keeps_one_of_documents_with_four_fifths_of_five_words_in_common(spark, sf_dir, make):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(30):  # one word changed of 45 to 75: five-word similarities from 0.78 to 0.87
        words = list(rng.choice(vocabulary, 45 + group))
        changed = [*words[:20], "other", *words[21:]]
        rows += [(2 * group + 1, " ".join(words)), (2 * group + 2, " ".join(changed))]
    expected = {doc_id for doc_id, _, least in plain_groups(rows, 5, 80) if doc_id == least}
    assert expected != {doc_id for doc_id, _, least in plain_groups(rows) if doc_id == least}
    kept = corpus_pipeline.near_copies(spark, make(rows), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_keeps_clashing_columns(make):
    from presslake.llm import line_dedup

    docs = make([(k, f"line {k % 2}\nown line number {k} of this text") for k in range(6)]).selectExpr("*", "doc_id AS _kept", "doc_id AS _own", "doc_id AS _doc_id")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert all(r._kept == r._own == r._doc_id == r.doc_id for r in out.collect())


def test_links_of_a_group_of_near_copies_grow_with_its_documents(spark):
    """Copies share their changed n-grams with few others each, so their n-grams have many hubs; one link or two a document are enough."""
    rng = random.Random(8)
    texts = []
    for _ in range(240):
        words = [f"w{k}" for k in range(900)]
        for spot in rng.sample(range(0, 880, 11), 8):
            words[spot] = f"x{spot}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    documents, links, classes = ngram_join.jaccard_links(docs, 5, 80)
    assert documents.count() == 240 and links.distinct().count() <= 3 * 240
    assert classes.count() == 240 and classes.select("component").distinct().count() == 1
