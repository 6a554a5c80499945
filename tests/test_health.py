"""Chunked windows against a plain loop over each key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslake.operators import health as H

START = dt.datetime(2024, 1, 1)


def make_log(seed=1, n=600):
    rng = random.Random(seed)
    rows, clock = [], START
    for i in range(n):
        clock += dt.timedelta(seconds=rng.choice([0, 1, 20, 400, 4000, 20000]))
        key = "hot" if i % 3 else f"k{rng.randrange(5)}"
        ok = rng.random() < 0.35
        rows.append((i, clock, key, ok, None if ok else rng.choice(["ssl_error", "connection_error", "rate_limit", "not_found"]), 0.1))
    return rows


SCHEMA = "request_id long, ts timestamp, state_key string, success boolean, error_type string, response_time double"


@pytest.fixture(scope="module", params=[60, 3600, 10**7])
def chunk(request):
    return request.param


@pytest.fixture(scope="module")
def rows():
    return make_log()


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        out.setdefault(r[2], []).append(r)
    return out


def test_streak(log, rows, chunk):
    expected = {}
    for rs in by_key(rows).values():
        streak = 0
        for r in rs:
            streak = 0 if r[3] else streak + 1
            expected[r[0]] = streak
    got = {r["request_id"]: r["streak"] for r in H.failure_streak(log, chunk).collect()}
    assert got == expected


@pytest.mark.parametrize("k", [1, 3, 10])
def test_recent(log, rows, chunk, k):
    expected = {}
    for rs in by_key(rows).values():
        for i, r in enumerate(rs):
            last = rs[max(0, i - k + 1): i + 1]
            expected[r[0]] = sum(not x[3] for x in last) if len(last) == k else None
    got = {r["request_id"]: r["recent_failures"] for r in H.recent_failure_rate(log, k, chunk).collect()}
    assert got == expected


def test_blocks(log, rows, chunk):
    severe = lambda r: not r[3] and r[4] in ("ssl_error", "connection_error")
    expected = {}
    for rs in by_key(rows).values():
        streak = 0
        for i, r in enumerate(rs):
            streak = 0 if r[3] else streak + 1
            if severe(r):
                end = r[1] + dt.timedelta(seconds=min(300, 30 * streak))
                later = next((x[1] for x in rs[i + 1:] if x[3] or severe(x)), None)
                expected[r[0]] = min(end, later) if later else end
    got = {r["request_id"]: r["blocked_until"] for r in H.block_intervals(log, chunk).collect()}
    assert got == expected


def test_statistics(spark, log, rows, chunk):
    as_of = max(r[1] for r in rows) + dt.timedelta(seconds=5)
    stats = {r["state_key"]: r for r in H.request_statistics(log, F.lit(as_of), chunk).collect()}
    assert stats["total"]["requests"] == len(rows)
    for key, rs in by_key(rows).items():
        tail = 0
        for r in reversed(rs):
            if r[3]:
                break
            tail += 1
        assert stats[key]["current_streak"] == tail
        assert stats[key]["success_rate"] == pytest.approx(100 * sum(r[3] for r in rs) / len(rs))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    total = H.request_statistics(empty).collect()
    assert [(r["state_key"], r["requests"], r["success_rate"]) for r in total] == [("total", 0, 0.0)]
