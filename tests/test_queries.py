"""Every registered query runs; those with a SQL twin give the same rows in DuckDB."""

import math

import duckdb
import pytest

from presslake.catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert rows == expected
    assert rows, "the twin must compare something"
