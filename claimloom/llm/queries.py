"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import chat, decontamination, licences, line_dedup, minhash, packing, phrases, pii, quality_cnn, quality_rules, simhash, spelling, token_counts

#: For the synthetic tables alone, whose people do not exist; other data take spark.claimloom.pii.key.
TABLES_KEY = b"the synthetic tables"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _ORACLES


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file on the driver; executors get its content by broadcast."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@_query
def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.result(_table(spark, sf_dir, "documents"))


_ORACLES["op5_rules"] = quality_rules.oracle_sql()


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    return chat.read_back(chat.windows(told.unionByName(own)))


_ORACLES["op2_chat"] = chat.oracle_sql(
    "SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'"
)


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"))


_ORACLES["op3_line_dedup"] = line_dedup.oracle_sql()


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_line(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.claimloom.pii.key", None)
    return pii.pseudonymized(_table(spark, sf_dir, "documents"), key.encode() if key else TABLES_KEY)


@_query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


@_query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


_ORACLES["op11_phrases"] = phrases.oracle_sql()


@_query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


@_query
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


_ORACLES["op13_minhash"] = minhash.oracle_sql()
