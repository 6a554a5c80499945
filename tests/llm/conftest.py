import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) rows."""

    def build(rows, schema=SCHEMA):
        return spark.createDataFrame([(*r, *[None] * (4 - len(r)), 0) if schema is SCHEMA else r for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r for r in docs.collect()}
