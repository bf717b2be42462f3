"""The corpus pipeline: language ID, near-dedup, decontamination, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir), works on every row it gets, and
returns what the next one works on; all but the last return the columns of
their input.  ``run`` writes each stage's rows to the shared folder as Parquet
and reads them again.  No stage needs a row's place: repeated rows and null
ids are dealt with as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm.bagminhash import one_of_each
from zonalis.llm.common import stored
from zonalis.llm.decontaminate import clean
from zonalis.llm.langid import fit, told
from zonalis.llm.packing import pack
from zonalis.llm.pii import pseudonymise, session_key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or with a narrow margin go."""
    return told(docs, fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: the one of least doc_id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return clean(docs, benchmark)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; n_chars follows the new text."""
    got = pseudonymise(docs, session_key(spark))
    return got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else got


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    return pack(docs)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: SQL expresses neither compression nor signatures; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
