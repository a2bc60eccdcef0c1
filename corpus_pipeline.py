"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

quality      documents whose probability of a fair grade is below one half go
near_dups    of each group of near duplicates (five words, similarity 0.8) the document with the smallest id stays
substrings   passages of 35 words or more that stand anywhere else are taken out of the texts
benchmark    documents in which a benchmark item stands go
mixing       documents are repeated so that sources reach their targets

All stages but the last return the columns of documents; the last does too, with a row for every copy. Nulls, empty and
long texts, ties, repeated rows and empty tables are treated as the operators say. ORACLE_SQL is None: SQL expresses neither
the trained classifier nor the joins on whole texts in reasonable time; the tests hold run() against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, mixing, ngram_join, quality, substrings
from martloom.operators.scratch import fresh_folder, passing_folders

ORACLE_SQL = None
SOURCE_WEIGHTS = [5, 2, 1]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, n=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(docs, length=35)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, SOURCE_WEIGHTS)


STAGES = [
    ("quality", keep_quality),
    ("near_dups", drop_near_duplicates),
    ("substrings", drop_repeated_passages),
    ("benchmark", drop_benchmark_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage stores for itself is deleted once its rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        with passing_folders(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(folder)
        docs = spark.read.schema(kept.schema).parquet(folder)
    return docs
