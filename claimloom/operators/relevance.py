"""Relevance of sections: attempts under a budget, labels, inheritance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.rubrics import relevance_label
from claimloom.operators import numbering


def budgeted(rows: DataFrame, most: int, *order: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``attempted``: whether a row that is no duplicate is among the first ``most`` in ``order``."""
    return numbering.within(rows, most, order, by, F.col("duplicate_of").isNull()).withColumnRenamed("within", "attempted")


def assessed(rows: DataFrame) -> DataFrame:
    """Adds status and label of attempted rows; a null score is a failed call, and not_scored is no verdict."""
    status = F.when(~F.col("attempted"), "not_scored").when(F.col("score").isNull(), "failed").otherwise("scored")
    return rows.withColumn("status", status).withColumn("label", F.when(F.col("status") == "scored", relevance_label(F.col("score"))))


def inherited(rows: DataFrame, key: str) -> DataFrame:
    """Duplicates take status, label and score from their originals."""
    roots = rows.filter("duplicate_of IS NULL").select(F.col(key).alias("root"), F.struct("status", "label", "score").alias("own"))
    joined = rows.join(roots, F.col("duplicate_of") == F.col("root"), "left")
    is_copy = F.col("duplicate_of").isNotNull()
    take = lambda c: F.when(is_copy, F.col(f"own.{c}")).otherwise(F.col(c))
    columns = {"status": F.coalesce(take("status"), F.lit("not_scored")), "label": take("label"), "score": take("score")}
    return joined.select(*(columns[c].alias(c) if c in columns else F.col(c) for c in rows.columns))


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """Counts of attempts by outcome and of labels over rows that are no duplicates, every name present."""
    own = rows.filter("duplicate_of IS NULL")
    names = [("scored", "status"), ("failed", "status"), ("not_scored", "status"), ("risk_candidate", "label"), ("context", "label"), ("not_relevant", "label")]
    counts = [F.count_if(F.col(c) == n).alias(n) for n, c in names]
    return own.groupBy(*by).agg(*counts) if by else own.agg(*counts)
