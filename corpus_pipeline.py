"""Corpus preparation: five stages from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents; the last returns one row per document of the
token files. A stage handles an empty input, null fields, repeated rows and
extra columns as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import decontaminate, minhash_forest, mixing, tokens, toxicity
from cohortflow.llm.queries import table, tokenizer_path
from cohortflow.session import prepare_workers
from cohortflow.sources.scratch import materialize, scratch_path


#: Chunks that a token worker remembers: fewer than on its own, as the workers served other stages before.
CACHED_CHUNKS = 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five words, similarity 0.8."""
    prepare_workers(spark)
    return minhash_forest.deduplicated(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, read back: doc_id, start, n_tokens, ids_crc32."""
    prepare_workers(spark)
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, tokenizer_path(), cached=CACHED_CHUNKS)
    return tokens.read_tokens(spark, folder, manifest).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

#: A learned lexicon, min-hashes and a tokenizer are beyond SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
