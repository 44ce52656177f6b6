"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import decontamination, line_dedup, packing, quality_cnn, simhash
from claimloom.llm.common import discard, written
from claimloom.llm.queries import tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_cnn.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that earlier documents hold; those left without a word go."""
    return line_dedup.deduplicated(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Line dedup has cut near copies down to what differs, so they are judged by their texts as they came
    first, and then what is left is judged by its own.
    """
    came = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.one_of_each(simhash.without_later_copies(docs, came))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their places in sequences."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_runs),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("benchmark_decontamination", without_benchmarks),
    ("best_fit_packing", packed),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after another, each through Parquet in the shared folder.

    What a stage wrote is deleted once the next one has been written, the last when the driver ends.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for n, (name, stage) in enumerate(STAGES):
        docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{n}-{name}")
        if before:
            discard(spark, before)
        before = path
    return docs
