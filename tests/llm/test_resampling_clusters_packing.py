"""Importance resampling, centroid clustering and packing, each against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from presslake.llm import bisectors, catalog, common, packing, resampling

# ---------------------------------------------------------------- resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
AWKWARD = ["", None, "...", "one", " Two words ", "ÀÉ über straße", "a b c", "x" * 300_000, "the cat " * 60_000, "İI ı 日本 語", "a\x00b \x7f c"]


def plain_features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def plain_resample(rows, target, percent=10, least_words=20, longest=1, buckets=10_000, seed="2024"):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    held = Counter(bucket(f) for _, t in rows for f in plain_features(t, longest)[1])
    wanted = Counter(bucket(f) for t in target for f in plain_features(t, longest)[1])
    s, t = sum(held.values()) + buckets, sum(wanted.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s / ((held[b] + 1) * t)))
    out = []
    for doc_id, text in rows:
        words, found = plain_features(text, longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    fit = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    drawn = len(fit) * percent // 100
    ranked = [(*r, n + 1 if n < drawn else None) for n, r in enumerate(fit)] + [(*r, None) for r in out if r[1] < least_words]
    return sorted(ranked, key=repr)


def found_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_features_are_runs_of_words(longest):
    got = resampling.features(pa.array([*AWKWARD, "cat sat the cat sat"]), longest, 977)
    for k, text in enumerate([*AWKWARD, "cat sat the cat sat"]):
        words, found = plain_features(text, longest)
        assert got.words[k] == len(words)
        assert sorted(got.bucket[got.document == k]) == sorted(zlib.crc32(f.encode()) % 977 for f in found)
    assert (np.diff(got.document) >= 0).all()


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_a_plain_version(make, longest):
    rng = random.Random(longest)
    rows = [(k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 60)))) for k in range(300)]
    rows += [(1000 + k, t) for k, t in enumerate(AWKWARD)] + [(None, "no id " * 9), (None, "no id " * 9), (7, rows[7][1]), (7, "other text " * 12)]
    target = ["a b c a b", None, "", "cat the"]
    settings = {"percent": 30, "longest": longest, "buckets": 500}
    got = resampling.resample(make(rows).withColumnRenamed("n_chars", "score"), make([(k, t) for k, t in enumerate(target)]), **settings)
    assert found_rows(got) == plain_resample(rows, target, **settings)
    drawn = resampling.drawn_documents(make(rows).withColumnRenamed("n_chars", "rank"), make([(0, target[0])]), **settings)
    assert drawn.columns == ["doc_id", "text", "lang", "source", "rank"] and drawn.count() >= 30


def test_resampling_of_nothing(make):
    assert resampling.resample(make([]), make([(1, "a b")])).collect() == []
    rows = [(k, "word " * 25) for k in range(20)]
    assert found_rows(resampling.resample(make(rows), make([]))) == plain_resample(rows, [])


def test_resampling_query(spark, sf_dir, texts):
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = plain_resample([(k, r.text) for k, r in texts.items()], target)
    assert found_rows(catalog.op12_importance_resampling(spark, sf_dir)) == sorted([(r[0], *r[2:]) for r in expected], key=repr)


def test_positions_are_a_sorted_numbering(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 5), k) for k in range(5000)]
    got = common.positions(spark.createDataFrame(rows, "a long, b long").repartition(7), *map(common.F.col, "ab")).collect()
    assert sorted((r.position, r.a, r.b) for r in got) == [(n, *r) for n, r in enumerate(sorted(rows))]


def test_slices_keep_every_row():
    texts = pa.array([None, "", "x" * 50, "y", "z" * 200, "", "w" * 99, None])
    for size in (1, 60, 100, 10_000):
        parts = list(common.text_slices([pa.RecordBatch.from_arrays([texts], names=["text"])], size))
        assert [t for p in parts for t in p.column("text").to_pylist()] == texts.to_pylist()
    assert list(common.text_slices([pa.RecordBatch.from_arrays([texts[:0]], names=["text"])])) == []


def test_slices_are_whole_characters():
    texts = pa.array([f"É{k} straße 日本 😀 x{k}" for k in range(500)])
    parts = list(common.text_slices([pa.RecordBatch.from_arrays([texts], names=["text"])], 700))
    got = np.concatenate([resampling.features(p.column("text"), 1, 9973).bucket for p in parts])
    assert len(parts) > 10 and (got == resampling.features(texts, 1, 9973).bucket).all()
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.ChunkIds(PATH)
    ids = np.concatenate([encoder.encode(p.column("text"), 0)[0] for p in parts])
    assert ids.tolist() == [t for text in texts.to_pylist() for t in [*tokenizer.encode(text, add_special_tokens=False).ids, 0]]


# ---------------------------------------------------------------- clustering


def plain_clusters(rows, k=16, rounds=3, width=64):
    kept = [(i, [math.floor(max(-(1 << 26), min(1 << 26, 64 * x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((apart(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in last:
        inertia[n] += d
    return sorted([(i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in last], key=repr)


def test_tournament_equals_all_distances():
    rng = np.random.default_rng(4)
    for k in (1, 2, 16, 40):
        centroids, vectors = rng.integers(-3, 4, (k, 5)), rng.integers(-4, 5, (3000, 5))
        centroids[k // 2] = centroids[0]  # equal centroids tie everywhere
        all_ = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
        best, distance = bisectors.Tournament(centroids).nearest(vectors)
        assert (best == all_.argmin(1)).all() and (distance == all_.min(1)).all()


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(x) for x in rng.standard_normal(64).astype(np.float32)]) for k in range(n)]


def test_clusters_of_awkward_rows(spark):
    good = vectors(80)
    rows = good + [(200, None), (201, []), (202, good[0][1][:63]), (203, [*good[0][1], 0.0]), (204, [None, *good[0][1][1:]]), (205, [math.nan, *good[0][1][1:]]), (206, [math.inf, *good[0][1][1:]])]
    rows += [good[3], good[3], (None, good[5][1]), (None, good[6][1]), (207, [0.0] * 64), (208, [-0.0] * 64), (209, [3e38, *good[1][1][1:]]), (210, [-1 / 64] * 64)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, cluster int")
    got = found_rows(bisectors.cluster(table))
    assert got == plain_clusters(rows) and len(got) == 88
    assert found_rows(bisectors.cluster(table.repartition(5))) == got


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    table = spark.createDataFrame(vectors(n), "vec_id long, embedding array<float>")
    assert found_rows(bisectors.cluster(table)) == plain_clusters(vectors(n))


def test_empty_centroids_stay(spark):
    rows = [(k, [1.0] * 64) for k in range(40)]  # all alike: the smallest number takes every vector
    got = found_rows(bisectors.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert got == plain_clusters(rows) and {r[1] for r in got} == {0}


def test_cluster_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found_rows(catalog.op13_centroid_clustering(spark, sf_dir)) == plain_clusters(rows)


# ---------------------------------------------------------------- packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
BLANKS = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \nb", "a\n b", "a\n  b", "a\t b ", "　 b", "　  b", "\xa0 a", "a<|endoftext|> b", "\0 end", "é 日本 語", "\x1c a \x1c", "a\x85 b"]


def check(rows, got, capacity=2048):
    """Every token in one place: pieces as cut by the contract, sequences without gaps, at most two large pieces in each."""
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % capacity + 1
        for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
            start = 0 if piece == 0 else stop - capacity
            expected[(doc_id, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity and sum(3 * n > capacity for _, n in parts) <= 2
    return len(sequences)


def test_chunks_equal_the_library():
    rng = random.Random(5)
    texts = [*BLANKS, "w " * 40_000, *("".join(rng.choice(" \n\ta1.'　\xa0\x1cé\x0b") for _ in range(rng.randint(0, 12))) for _ in range(5000))]
    encoder, tokenizer = packing.ChunkIds(PATH), Tokenizer.from_file(PATH)
    ids, n = encoder.encode(pa.array(texts), 0)
    for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], repr(text)[:80]


def test_a_worker_that_forgets_gives_the_same(monkeypatch):
    texts = pa.array([f"word{k} and word{k % 7}" for k in range(50)])
    expected = packing.ChunkIds(PATH).encode(texts, 0)
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    encoder = packing.ChunkIds(PATH)
    for _ in range(3):
        for a, b in zip(encoder.encode(texts, 0), expected, strict=True):
            assert (a == b).all()


def filled(plan, histogram):
    sequences = defaultdict(list)
    for n, count in histogram.items():
        entries = [e for e in range(len(plan.length)) if plan.length[e] == n]
        stops = [*plan.first[entries][1:], count]
        for e, stop in zip(entries, stops, strict=True):
            for k in range(stop - plan.first[e]):
                sequence, inside = divmod(k, plan.each[e])
                sequences[plan.sequence[e] + sequence].append((plan.offset[e] + inside * n, n))
    return sequences


@pytest.mark.parametrize("seed", range(16))
def test_plans_fill_sequences_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100, 2048])
    histogram = Counter()
    for _ in range(rng.randint(1, 300)):
        histogram[rng.choice([rng.randint(1, capacity), rng.randint(1, capacity // 3), 1])] += rng.choice([1, 1, 4, 300])
    plan = packing.plan_sequences(histogram, capacity)
    sequences = filled(plan, histogram)
    assert set(sequences) == set(range(plan.sequences))
    for parts in sequences.values():
        parts.sort()
        assert all(offset == sum(n for _, n in parts[:k]) for k, (offset, _) in enumerate(parts))
        assert sum(n for _, n in parts) <= capacity and sum(3 * n > capacity for _, n in parts) <= 2
    # Best fit one by one, largest first: the plan is that, so it needs no more sequences.
    gaps = []
    for n in sorted(histogram.elements(), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] -= n
    assert plan.sequences <= len(gaps) + 1


def test_plan_does_not_grow_with_the_pieces():
    small = {n: 3 + n % 5 for n in range(1, 2049)}
    plans = [packing.plan_sequences({n: k * many for n, k in small.items()}, 2048) for many in (1, 1000, 1_000_000)]
    assert max(len(p.length) for p in plans) <= 30_000
    assert plans[2].sequences <= 1_000_000 * plans[0].sequences


def test_packing_of_awkward_rows(make):
    rows = [*enumerate(BLANKS), (None, "no id"), (None, None), (3, "same"), (3, "same"), (3, "same"), (90, "long " * 50_000), (91, "two " * 2047), (92, "two " * 2048)]
    got = packing.pack(make(rows).withColumnRenamed("n_chars", "length"), PATH).collect()
    assert check(rows, got) == -(-sum(r.length for r in got) // 2048)
    assert packing.pack(make([]), PATH).collect() == []


def test_sequences_hold_the_ids(make):
    rows = [(k, "some words " * (k % 9)) for k in range(60)] + [(5, "some words " * 5), (100, "long " * 5000)]
    tokenizer = Tokenizer.from_file(PATH)
    held = defaultdict(list)
    for k, text in rows:
        held[k].append([*tokenizer.encode(text, add_special_tokens=False).ids, 0])
    got = packing.packed_sequences(make(rows), PATH, capacity=128).collect()
    assert all(sum(r.lengths) == len(r.ids) <= 128 for r in got)
    assert Counter(t for r in got for t in r.ids) == Counter(t for lists in held.values() for ids in lists for t in ids)
    for r in got:
        at = 0
        for doc_id, n in zip(r.doc_ids, r.lengths, strict=True):
            part = r.ids[at : at + n]
            assert any(part == ids[k : k + n] for ids in held[doc_id] for k in range(len(ids)))
            at += n


def test_packing_query(spark, sf_dir, texts):
    rows = [(k, r.text) for k, r in texts.items()]
    got = catalog.op11_best_fit_packing(spark, sf_dir).collect()
    assert check(rows, got) <= 1.02 * -(-sum(r.length for r in got) // 2048) + 1
