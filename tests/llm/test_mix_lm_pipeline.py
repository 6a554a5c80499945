"""Source mixing, language model scores and the pipeline."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from presslake.llm import catalog, language_id, lm_scoring, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- mixing


def plain_targets(sizes, share=1.5, most=2.0):
    """Targets by handing on the excess, round after round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def test_mix_query(spark, sf_dir, texts):
    got = catalog.op2_source_mix(spark, sf_dir).collect()
    sizes = defaultdict(int)
    for r in texts.values():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets, taken = plain_targets(sizes), defaultdict(int)
    assert len(got) == len(texts)
    for r in got:
        source = texts[r.doc_id].source
        assert r.size == len(WORD.findall(texts[r.doc_id].text or "")) and r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source]) and r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert sum(taken.values()) >= 0.95 * sum(targets.values())
    assert all(taken[s] <= targets[s] + 1e-6 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, catalog.op2_source_mix(spark, sf_dir).collect()))


def test_mix_in_many_blocks_and_shards(make):
    rng = np.random.default_rng(3)
    rows = [(k, "w " * int(rng.integers(0, 40)), None, ["big", "mid", "small", None][min(3, int(rng.exponential(0.7)))]) for k in range(3000)]
    sizes, goals, taken = mixing.mix(make(rows), block_rows=40, shard_rows=300)
    targets = {r.source: (r.target, r.source_size) for r in goals.collect()}
    expected = plain_targets({s: n for s, (_, n) in targets.items()})
    assert {s: t for s, (t, _) in targets.items()} == pytest.approx(expected)
    got = taken.collect()
    assert max(Counter((r.doc_id, r["round"]) for r in got).values()) == 1
    words = Counter()
    for r in got:
        words[r.source] += r["size"]
    for source, target in expected.items():
        assert target - 3 <= words[source] <= target
    shards = Counter(r.shard for r in got)
    assert len(shards) == 15 and max(shards.values()) < 2 * min(shards.values())


@pytest.mark.parametrize("seed", ["mix", "a", "b"])
def test_a_long_document_does_not_end_a_source(make, seed):
    # The largest source makes blocks; "tall" has a document that is most of its words.
    rows = [(k, "w " * 60, None, "big") for k in range(2000)] + [(k, "w " * (20 + k % 7), None, "tall") for k in range(3000, 3200)] + [(4000, "w " * 60_000, None, "tall")]
    for block_rows in (20, 4000):
        sizes, goals, taken = mixing.mix(make(rows), seed=seed, block_rows=block_rows)
        targets = {r.source: r.target for r in goals.collect()}
        size = {(r.doc_id, r.source): r["size"] for r in sizes.collect()}
        copies = Counter((r.doc_id, r.source) for r in taken.collect())
        assert max(copies.values()) <= 2
        for source, target in targets.items():
            got = sum(n * size[key] for key, n in copies.items() if key[1] == source)
            left_out = [n for key, n in size.items() if key[1] == source and copies[key] < 2]
            assert got <= target and all(got + n > target for n in left_out), (source, got, target)


def test_splits_are_exact_and_hypergeometric(spark):
    quotas = spark.createDataFrame([("a", 700), ("b", 250), (None, 50), ("none", 0)], "source string, quota long")
    got = mixing.split_quotas(quotas, 10, "s").collect()
    per = defaultdict(Counter)
    for r in got:
        per[r.source][r.shard] = r.n
        assert r.offset == sum(x.n for x in got if x.source == r.source and x.shard < r.shard)
    assert {s: sum(c.values()) for s, c in per.items()} == {"a": 700, "b": 250, None: 50, "none": 0}
    assert all(sum(per[s][k] for s in per) == 100 for k in range(10))
    draws = spark.range(4000).select(mixing._hypergeometric((F.col("id") + 0.5) / 4000, F.lit(60), F.lit(20), F.lit(15)).alias("k")).groupBy("k").count().collect()
    for r in draws:
        p = math.comb(20, r.k) * math.comb(40, 15 - r.k) / math.comb(60, 15)
        assert abs(r["count"] / 4000 - p) < 2e-3


def test_mix_of_awkward_rows(make):
    docs = make([(1, None, None, "a"), (2, "", None, None), (None, "x y", None, "a"), (3, "w " * 50_000, None, "b"), (4, "p q", None, "b"), (4, "p q", None, "b")])
    got = {(r.doc_id, r.source): r for r in mixing.mix_report(docs.withColumnRenamed("n_chars", "bucket")).collect()}
    assert got[(1, "a")]["size"] == 0 and got[(4, "b")]["size"] == 4 and len(got) == 5
    assert mixing.mix_report(make([])).count() == 0
    assert mixing.mix_report(make([(1, None), (2, "")])).count() == 2
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(make([])).collect() == []


def test_mixed_rows_keep_clashing_columns(make):
    docs = make([(k, "w " * (k % 5), None, ["a", "b", None][k % 3]) for k in range(90)]).selectExpr("*", "doc_id * 2 AS _shard", "doc_id AS _position", "doc_id AS shard")
    rows = mixing.mixed_documents(docs).collect()
    assert rows and all(r._shard == 2 * r.doc_id and r._position == r["shard"] == r.doc_id for r in rows)


def test_mix_has_no_python(spark, sf_dir):
    plan = catalog.op2_source_mix(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


# ---------------------------------------------------------------- language model


def test_scores_beat_the_base_and_base_is_exact(spark, sf_dir, texts):
    words = {k: [*WORD.findall((r.text or "").translate(LOWER)), None] for k, r in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    counts = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    base = {k: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws) for k, ws in words.items()}
    got = {r.doc_id: r for r in catalog.op4_lm_scoring(spark, sf_dir).collect()}
    for k, r in got.items():
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[k], len(words[k]), total)
        assert r.n_known == sum(w in counts for w in words[k]) and r.base_score == pytest.approx(base[k])
    mine, plain = (sum(getattr(r, c) for r in got.values() if r.held_out) for c in ("score", "base_score"))
    assert mine > plain


def small_network(rng):
    net = lm_scoring.Network.new(9, 4, 3, rng.integers(1, 50, 9).astype(float))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) + rng.standard_normal(net.p[k].shape) * 0.3
    return net


def test_probabilities_sum_to_one_and_lanes_do_not_matter():
    rng = np.random.default_rng(0)
    net = small_network(rng)
    states = rng.standard_normal((1, 4))
    logs = [net.log_probabilities(states, np.array([k]))[0][0] for k in range(9)]
    assert np.exp(logs).sum() == pytest.approx(1)
    docs = [rng.integers(1, 9, n).astype(np.int32) for n in (0, 5, 40, 3, 3, 17)]
    alone = [lm_scoring.score_docs(net, [d])[0] for d in docs]
    assert lm_scoring.score_docs(net, docs) == pytest.approx(alone, rel=1e-4)


def test_gradients_match_differences(monkeypatch):
    rng = np.random.default_rng(1)
    net = small_network(rng)
    monkeypatch.setattr(lm_scoring.np, "float32", np.float64)
    inputs, targets = rng.integers(0, 9, (3, 6)), rng.integers(0, 9, (3, 6))
    fresh, real = np.zeros((3, 6), bool), np.ones((3, 6), bool)
    fresh[:, 0], fresh[1, 3], real[2, 4:] = True, True, False
    h = np.zeros((3, 4))
    _, gradients, _ = net.window(inputs, targets, fresh, real, h)
    for name, g in gradients.items():
        at = tuple(int(rng.integers(0, n)) for n in g.shape)
        values = []
        for step in (1e-5, -1e-5):
            net.p[name][at] += step
            values.append(net.window(inputs, targets, fresh, real, h)[0])
            net.p[name][at] -= step
        assert g[at] * real.sum() == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-3, abs=1e-5)


def test_the_output_layer_works_on_little_more_than_its_tokens(monkeypatch):
    rng = np.random.default_rng(3)
    net = lm_scoring.Network.new(64, 4, 8, rng.integers(1, 50, 64).astype(float))
    # Of the neighbours 2 and 3, and of 4 to 7, one class has nearly all tokens.
    targets = np.concatenate([rng.integers(24, 32, 3_000), rng.integers(56, 64, 3_000), [16, 33, 41]])
    worked, exp = [], np.exp
    monkeypatch.setattr(lm_scoring.np, "exp", lambda x, **more: worked.append(np.size(x)) or exp(x, **more))
    states = rng.uniform(-1, 1, (len(targets), 4)).astype(np.float32)
    net.log_probabilities(states, targets, {k: np.zeros_like(v) for k, v in net.p.items()})
    assert sum(worked) < 1.1 * len(targets) * (8 + 8)


@pytest.mark.parametrize("large", [1, 100])
def test_output_layer_equals_a_plain_one(large):
    rng = np.random.default_rng(4)
    net = lm_scoring.Network.new(22, 4, 5, rng.integers(1, 50, 22).astype(float))  # the last class lacks three words
    p = net.p = {k: v.astype(np.float64) * large for k, v in net.p.items()}
    states, targets = rng.uniform(-1, 1, (300, 4)), np.minimum(rng.exponential(6, 300).astype(int), 21)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    logs, back = net.log_probabilities(states, targets, g)
    plain, slopes, to_w = [], [], np.zeros_like(p["w"])
    for h, target in zip(states, targets, strict=True):
        c, first = target // 5, target // 5 * 5
        tops, inner = h @ p["c"] + p["cb"], p["w"][first : first + 5] @ h + p["wb"][first : first + 5]
        tops, inner = tops - np.logaddexp.reduce(tops), inner - np.logaddexp.reduce(inner)
        plain.append(tops[c] + inner[target - first])
        off, wrong = np.exp(tops) - (np.arange(5) == c), np.exp(inner) - (np.arange(len(inner)) == target - first)
        slopes.append(p["c"] @ off + wrong @ p["w"][first : first + 5])
        to_w[first : first + 5] += wrong[:, None] * h
    assert logs == pytest.approx(np.array(plain)) and back == pytest.approx(np.array(slopes), abs=1e-9) and g["w"] == pytest.approx(to_w, abs=1e-9)


def test_sums_by_name_of_frequent_and_of_rare_names():
    rng = np.random.default_rng(6)
    for names in (np.minimum(rng.exponential(9, 900).astype(int), 70), np.arange(40), np.zeros(200, int), np.arange(64) // 16):
        names = np.unique(names, return_inverse=True)[1]
        rows = rng.standard_normal((3, len(names), 4))
        got = lm_scoring.summed(rows, names, int(names.max()) + 1)
        assert got == pytest.approx(np.stack([rows[:, names == k].sum(1) for k in range(names.max() + 1)], axis=1))


def test_scores_of_awkward_rows(make):
    rows = [(k, f"some words of text {k % 3}") for k in range(30)] + [(100, None), (None, ""), (101, "y" * 50_000), (101, "y" * 50_000)]
    got = lm_scoring.score_documents(make(rows).withColumnRenamed("n_chars", "score")).collect()
    assert len(got) == len(rows) and all(r.score < 0 and math.isfinite(r.score) for r in got if r.doc_id != 100 and r.n_tokens > 1)
    assert {r.n_tokens for r in got if r.doc_id in (None, 100)} == {1}
    assert lm_scoring.score_documents(make([])).count() == 0
    unseen = [r for r in lm_scoring.score_documents(make([(None, "held out only")])).collect()]
    assert unseen[0].train_tokens == 0 and unseen[0].n_known == 0 and unseen[0].base_score == pytest.approx(0)


def plain_score(net, tokens):
    """Natural log-probability of a document's tokens, the end included, one step after the other."""
    p, width = {k: v.astype(float) for k, v in net.p.items()}, net.width
    h, before, out = np.zeros(p["u"].shape[0]), lm_scoring.END, 0.0
    size = len(h)
    for token in [*tokens, lm_scoring.END]:
        a = p["x"][before] + p["b"]
        gates = 1 / (1 + np.exp(-(a[: 2 * size] + h @ p["u"])))
        z, r = gates[:size], gates[size:]
        h = (1 - z) * np.tanh(a[2 * size :] + (r * h) @ p["v"]) + z * h
        classes = np.exp(h @ p["c"] + p["cb"])
        first = token // width * width
        words = np.exp(p["w"][first : first + width] @ h + p["wb"][first : first + width])
        out += math.log(classes[token // width] / classes.sum()) + math.log(words[token - first] / words.sum())
        before = token
    return out


def test_scores_equal_a_plain_loop_and_do_not_depend_on_the_layout(make, monkeypatch):
    import functools

    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[min(59, int(x))] for x in rng.exponential(9, int(rng.integers(0, 60))))) for k in range(120)]
    rows += [(200, "new words only"), (201, None), (202, "W1 w2\tw59 unseen unseen")]
    # 14 words in the head cut a class of counts; 8 of them are the network's own; the rest is joined.
    monkeypatch.setattr(lm_scoring, "lexicon", functools.partial(lm_scoring.lexicon, head=14, size=10))
    monkeypatch.setattr(lm_scoring, "SHARE", 300)
    docs = make(rows)
    one = {r.doc_id: r for r in lm_scoring.score_documents(docs.coalesce(1)).collect()}
    several = {r.doc_id: r for r in lm_scoring.score_documents(docs.repartition(5, F.rand(1))).collect()}
    for k, r in one.items():
        assert several[k].score == pytest.approx(r.score, rel=1e-5) and several[k].base_score == pytest.approx(r.base_score)

    learnt = [(k, t) for k, t in rows if zlib.crc32(str(k).encode()) % 10]
    counts = Counter(w for _, t in learnt for w in WORD.findall((t or "").translate(LOWER)))
    training = make(learnt).selectExpr("doc_id", "CAST(text AS binary) AS text")
    lex, _ = lm_scoring.lexicon(training)
    own = lex.text.decode().split()
    assert len(own) == 14 and lex.vocabulary == 8 and min(counts[w] for w in own) * 1.2 > max(n for w, n in counts.items() if w not in own)
    net, ids = lm_scoring.train(training, lex), {w: k + 2 for k, w in enumerate(own[:8])}
    rest = {w: n for w, n in counts.items() if w not in ids}
    total = sum(rest.values()) + 0.1 * (len(rest) + 1)
    for k, text in rows:
        found = WORD.findall((text or "").translate(LOWER))
        logs = plain_score(net, [ids.get(w, lm_scoring.OTHER) for w in found])
        logs += sum(math.log((rest.get(w, 0) + 0.1) / total) for w in found if w not in ids)
        assert one[k].score == pytest.approx(logs / math.log(10), rel=1e-4)


def test_a_class_of_counts_larger_than_the_head_is_cut(make):
    training = make([(k, f"same{k}") for k in range(300)]).selectExpr("doc_id", "CAST(text AS binary) AS text")
    lex, _ = lm_scoring.lexicon(training, head=20, size=12)
    assert lex.vocabulary == 10 and 15 <= len(lex.counts) <= 20


def test_every_training_row_is_fitted_however_many_there_are(make, monkeypatch):
    training = make([(k, f"some words of text {k}") for k in range(400)] + [(400, None), (None, "no id"), (7, "some words of text 7")])
    lex, _ = lm_scoring.lexicon(training)
    tokens, seen, write = lex.tokens, [], lm_scoring.materialize

    def watched(df, name):
        out = write(df, name)
        seen.extend(r.tokens for r in out.collect())
        return out

    monkeypatch.setattr(lm_scoring, "materialize", watched)
    lex.tokens = 10**9  # as of a large corpus
    lm_scoring.train(training.selectExpr("doc_id", "CAST(text AS binary) AS text"), lex)
    assert sum(seen) == tokens


def test_texts_become_numbers_once_and_training_reads_only_these(make, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"W{k}" for k in range(40)] + ["\u00c4b", "x\u00a0y"]
    texts = [None, "", " \t\n", "  zz zz\x0bnew ", "\x1cW1\x1c W2"] + [" ".join(words[int(x)] for x in rng.integers(0, 42, int(n))) for n in rng.integers(0, 30, 60)]
    training = make(list(enumerate(texts))).selectExpr("doc_id", "CAST(text AS binary) AS text")
    lex, table = lm_scoring.lexicon(training, head=30, size=14)
    plain = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    counts = Counter(w for found in plain for w in found)
    assert {bytes(r.word).decode(): r.n for r in table.collect()} == counts
    head = lex.text.decode().split()
    own = {w: k + 2 for k, w in enumerate(head[: lex.vocabulary])}
    got = {r.doc_id: r for r in lm_scoring.coded(training.repartition(3), lex).collect()}
    for k, found in enumerate(plain):
        assert np.frombuffer(got[k].ids, lex.kind).tolist() == [own.get(w, lm_scoring.OTHER) for w in found]
        assert {bytes(r.word).decode(): r.k for r in got[k].rare} == Counter(w for w in found if w not in head)
        assert (got[k].n_tokens, got[k].known) == (len(found) + 1, sum(w in head for w in found) + 1)
    numbers = lm_scoring.coded(training, lex)
    assert "text" not in numbers.columns
    alone, whole = lm_scoring.fit(numbers, lex), lm_scoring.train(training, lex)
    assert all(np.array_equal(alone.p[k], whole.p[k]) for k in whole.p)


# ---------------------------------------------------------------- pipeline


def plain_kept(texts, model, benchmark):
    """What the three filtering stages leave, by all pairs and by windows in a set."""
    words = {k: (r.text or "").translate(LOWER).split() for k, r in texts.items()}
    clear = [k for k in sorted(texts) if not language_id.predictions([texts[k].text], model)[2][0]]
    grams = {k: {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words[k]) else set() for k in clear}
    first = {k: k for k in clear}

    def root(k):
        while first[k] != k:
            k = first[k]
        return k

    for a in clear:
        for b in clear:
            if a < b and grams[a] and grams[b] and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
                low, high = sorted((root(a), root(b)))
                first[high] = low
    item_word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: item_word.findall((t or "").translate(LOWER))
    windows = {tuple(w[i : i + 10]) for w in map(split, benchmark) if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    leaks = lambda w: any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    return [k for k in clear if root(k) == k and not leaks(split(texts[k].text))]


def test_pipeline_equals_a_plain_version(spark, sf_dir, docs, texts):
    kept, model = docs, language_id.train(docs)
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = plain_kept(texts, model, benchmark)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == expected
    # The mix takes those alone, each source near its target; the files hold them in order, token for token.
    sizes = Counter()
    for k in expected:
        sizes[texts[k].source] += len(WORD.findall(texts[k].text or ""))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, sf_dir).collect())
    ids = [r[1] for r in got]
    assert ids == sorted(ids) and max(Counter(ids).values()) <= 2 and set(ids) <= set(expected)
    taken = Counter()
    for k in ids:
        taken[texts[k].source] += len(WORD.findall(texts[k].text or ""))
    for source, target in plain_targets(sizes).items():
        left_out = [n for k in expected if texts[k].source == source and Counter(ids)[k] < 2 and (n := len(WORD.findall(texts[k].text or "")))]
        assert taken[source] <= target and all(taken[source] + n > target for n in left_out)
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for at, doc_id, n, crc in got:
        own = [*tokenizer.encode(texts[doc_id].text or "", add_special_tokens=False).ids, 1]
        assert (at, n, crc) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += n


def test_pipeline_of_awkward_rows_and_of_none(spark, make, sf_dir, tmp_path):
    prose = "the wind was cold and the people of the village went home before the rain came over the hills"
    rows = [(k, f"{prose} number {k} " * 3, "en", ["a", "b", None][k % 3]) for k in range(60)]
    rows += [(100, None, "en", "a"), (101, "", None, "b"), (102, "1 2 3", "en", "a"), (103, prose * 2000, None, None), (None, prose, "en", "a"), (7, rows[7][1], "en", "b")]
    for number, part in enumerate((rows, [])):
        folder = f"{tmp_path}/{number}"
        extra = make(part).selectExpr("*", "doc_id AS _score", "doc_id AS _hits", "doc_id AS _shard", "doc_id AS _gone", "doc_id AS component")
        extra.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:4]:
            kept = stage(spark, kept, folder)
            assert kept.columns == extra.columns
            assert all(r.doc_id == r._score == r._hits == r._shard == r._gone == r.component for r in kept.collect())
        found = corpus_pipeline.run(spark, folder).collect()
        assert bool(found) == bool(part) and all(r.n_tokens > 1 for r in found)
