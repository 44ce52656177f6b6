"""Candidate sections: topics, duplicates, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import content_hash, fingerprint
from claimloom.functions.vocabulary import CHANGE_KINDS

LEAST_FINGERPRINT = 40
MOST_CHARS = 6000


def nominated(sections: DataFrame, topics: Column) -> DataFrame:
    """Sections with a body whose versions are not out of range, and with topics, or of a kind that tells changes.

    Columns: text, kind, versions (null: no heading names any; empty: out of range), doc_versions.
    """
    named = F.when((F.size(topics) == 0) & F.col("kind").isin(*CHANGE_KINDS), F.array(F.lit("unclassified_change"))).otherwise(topics)
    in_range = F.col("versions").isNull() | (F.size("versions") > 0)
    text = F.trim(F.col("text"))
    kept = sections.filter((text != "") & in_range).withColumn("topics", named).filter(F.size("topics") > 0)
    return kept.withColumns(
        {
            "version_scope": F.when(F.col("versions").isNotNull(), "version_heading").otherwise("document_association"),
            "versions": F.coalesce("versions", "doc_versions"),
            "truncated": F.length(text) > MOST_CHARS,
            "text": F.substring(text, 1, MOST_CHARS),
        }
    )


def feeding_records(doc_versions: Column, kept_versions: Column, kind: Column) -> Column:
    """Whether a document feeds sections: registry records do only for milestones and the latest release."""
    return (kind != "registry_metadata") | F.arrays_overlap(doc_versions, kept_versions)


def with_duplicates(rows: DataFrame, candidate: str, *order: str, text: str = "text", least: int = LEAST_FINGERPRINT) -> DataFrame:
    """Adds ``duplicate_of``: the first row in ``order`` with the same fingerprint, null for that row and for short texts.

    The first row of each fingerprint is an aggregate with a partial step, joined back, so a
    passage that a third of the rows share is no group in one task.
    """
    marked = rows.withColumn("__fp", fingerprint(F.col(text))).withColumn("__key", F.when(F.length("__fp") >= least, F.sha2("__fp", 256))).drop("__fp")
    long = marked.filter("__key IS NOT NULL")
    # Ordered by itself alone, a plain minimum is the first.
    least = F.min(candidate) if set(order) <= {candidate} else F.min_by(candidate, F.struct(*order, candidate))
    first = long.groupBy("__key").agg(least.alias("__first"), F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    joined = marked.join(first, "__key", "left")
    return joined.withColumn("duplicate_of", F.when(F.col("__first") != F.col(candidate), F.col("__first"))).drop("__key", "__first")


def content_duplicates(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, content_sha256 and duplicate_content_of (the smallest key with the same text, null on itself)."""
    hashed = documents.select(key, content_hash(F.col(text)).alias("content_sha256"))
    first = hashed.groupBy("content_sha256").agg(F.min(key).alias("first"))
    return hashed.join(first, "content_sha256").select(key, "content_sha256", F.when(F.col("first") != F.col(key), F.col("first")).alias("duplicate_content_of"))


def topic_counts(rows: DataFrame, *by: str) -> DataFrame:
    """How many rows have each topic, by ``by``."""
    return rows.select(*by, F.explode("topics").alias("topic")).groupBy(*by, "topic").agg(F.count("*").alias("n"))


def top_topics(rows: DataFrame, by: str, position: str, most: int = 4) -> DataFrame:
    """The commonest topics of each ``by``; of equal ones the first seen."""
    each = rows.select(by, position, F.posexplode("topics").alias("k", "topic"))
    counted = each.groupBy(by, "topic").agg(F.count("*").alias("n"), F.min(F.struct(position, "k")).alias("seen"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "seen")).cast("bigint")
    return counted.withColumn("place", place).filter(F.col("place") <= most).drop("seen")


def counts_with_zeros(counted: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """``counted`` (name, n) for every row of ``names``, zero where there is none."""
    return names.join(counted, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))
