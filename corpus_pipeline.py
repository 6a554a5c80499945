"""From raw documents to token files: five stages, each written as Parquet and read again by the next.

``run`` applies them to ``documents``. Its rows are those that the last stage reads back from the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from presslake.llm import decontamination, language_id, mixing, ngram_join, token_records
from presslake.sources.workspace import materialize


#: Rows that travel to a Python worker at once. Whole rows with whole texts do here, so fewer than Spark's 10,000.
ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    """From now on in this session, Arrow batches have at most ROWS rows, or fewer where the session says so."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS:
        spark.conf.set(setting, str(ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear: those without a letter, or between languages, go."""
    _small_batches(spark)
    return language_id.keep_identified(docs, language_id.train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five words in a row, four fifths in common."""
    _small_batches(spark)
    return ngram_join.keep_one(docs, n=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    _small_batches(spark)
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each time that a document is taken, shuffled inside shards."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix in the shared folder; per record ``doc_id, start, n_tokens, ids_crc32`` as read back."""
    _small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_records.read_digests(token_records.write_records(docs, token_records.records_root(spark), path))


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mix", mixture),
    ("token_records", token_files),
]

#: The classifier and the tokenizer have no SQL form; the tests hold ``run`` against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
