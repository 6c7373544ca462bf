"""The corpus pipeline: stages applied to `documents` one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import bpe, decontaminate, exact, jaccard, langid
from tidewater.llm.common import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in some language; the rest goes."""
    return langid.languages_kept(docs, langid.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the lowest doc_id."""
    return exact.repeats_removed(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the lowest doc_id."""
    return jaccard.near_duplicates_removed(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of `benchmark` occurs."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the text that the ids decode to."""
    return bpe.round_trip(docs)


STAGES = [("language ID", language), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmarks), ("byte-level BPE encoding and decoding", tokens)]

#: SQL expresses neither the network of the first stage nor the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole of `documents`; each stage's output is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
