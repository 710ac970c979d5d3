"""The corpus pipeline: five stages from raw documents to token shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last returns one row per document of the written
token shards.

Defined results: a null text is empty; an empty document has no perplexity and goes in the
first stage (alone, near-dedup and decontamination keep it); repeated rows stay together or go together but
for near-duplicates, where one id's equal rows are one document and all stay; rows with a
null id are documents of their own to the classifier and to decontamination; extra
columns are carried along to the last stage, which ignores them; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import decontamination, kneser_ney, mixing, near_dup, token_files
from assayframe.llm._common import ship_package, table, written
from assayframe.session import scratch_path

# A worker keeps its cache when its task is over, beside what other stages need.
TOKEN_CACHE = 150_000
TOKEN_CHUNK = 8 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text does not reject."""
    ship_package(spark)
    return kneser_ney.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id."""
    ship_package(spark)
    return near_dup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that tokens meet the target shares of source, language
    and form."""
    return mixing.sample_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Simple-8b shards, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    ship_package(spark)
    path = scratch_path(spark, "corpus-shards")
    token_files.write_token_files(docs, path, cache_entries=TOKEN_CACHE, chunk_bytes=TOKEN_CHUNK)
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token-ID output", token_output),
]

# The model, the signatures and the tokenizer are beyond SQL: tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "corpus-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
