"""The SQL twins give the rows of the queries."""

import duckdb
import pytest

from presslake.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr) == expected
    con.close()
