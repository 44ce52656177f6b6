"""Choosing a catalog by decision scores, and what a run and a batch of cases came to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.vocabulary import RISK_LEVELS, SEVERE, rank

LEAST_MATCH = LEAST_AUTHORITY = 3.0
AMBIGUITY = 0.25


def authority(kind: Column, mirror: Column, linked: Column, address: Column) -> Column:
    """How much a catalog's role says: tags and mirrors 1, registries and releases 3, linked release pages 4, named ones 3, others 2."""
    return (
        F.when((kind == "github_tags") | mirror, 1)
        .when(kind.isin("npm_release_catalog", "pypi_release_catalog", "github_releases"), 3)
        .when(linked, 4)
        .when(F.lower(address).rlike("release|changelog"), 3)
        .otherwise(2)
    )


def decided(choices: DataFrame, by: str) -> DataFrame:
    """The first eligible choice of each ``by``, and whether another identity comes too near to it.

    Columns: match, authority, interval_count, endpoints_found, detailed, complete, identity, url.
    """
    eligible = choices.filter((F.col("match") >= LEAST_MATCH) & (F.col("authority") >= LEAST_AUTHORITY) & (F.col("interval_count") > 0))
    flag = lambda c: F.when(F.col(c), 0).otherwise(1)
    order = Window.partitionBy(by).orderBy(F.desc("score"), flag("endpoints_found"), flag("detailed"), flag("complete"), "url")
    scored = eligible.withColumn("score", F.col("match") + F.col("authority"))
    placed = scored.withColumn("n", F.row_number().over(order))
    first = placed.filter("n = 1").select(by, "url", "identity", "score")
    rivals = placed.filter("n > 1").select(by, F.col("identity").alias("other"), F.col("score").alias("rival"))
    best = rivals.join(first.select(by, F.col("identity").alias("own")), by).filter("other <> own").groupBy(by).agg(F.max("rival").alias("rival"))
    near = F.coalesce(F.col("score") - F.col("rival") < AMBIGUITY, F.lit(False))
    return first.join(best, by, "left").select(by, "url", "score", F.when(near, "ambiguous").otherwise("resolved").alias("status"))


def run_summary(associations: DataFrame, versions: DataFrame, by: str) -> DataFrame:
    """Per case: documents, versions with direct evidence, by mention only, with records only, and with none.

    Associations: case, document, version, basis; versions: case, version.
    """
    each = associations.groupBy(by, "version").agg(
        F.bool_or(F.col("basis") == "direct").alias("direct"), F.bool_or(F.col("basis") == "text_mention").alias("mention")
    )
    joined = versions.join(each.withColumn("any", F.lit(True)), [by, "version"], "left").fillna(False, ["direct", "mention", "any"])
    counts = joined.groupBy(by).agg(
        F.count("*").alias("versions"),
        F.count_if("direct").alias("direct"),
        F.count_if(~F.col("direct") & F.col("mention")).alias("mention_only"),
        F.count_if(F.col("any") & ~F.col("direct") & ~F.col("mention")).alias("record_only"),
        F.count_if(~F.col("any")).alias("none"),
    )
    documents = associations.groupBy(by).agg(F.count_distinct("document").alias("documents"))
    return counts.join(documents, by, "left").fillna(0, ["documents"])


def batch_index(paths: DataFrame, by: str) -> DataFrame:
    """A row per case: its paths, severe ones, and how many are of high confidence."""
    return paths.groupBy(by).agg(
        F.count("*").alias("paths"),
        F.count_if(F.col("level").isin(*SEVERE)).alias("severe"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence"),
    )


def headline(paths: DataFrame, by: str) -> DataFrame:
    """A sentence per case: paths by level from the most severe, and the first three severe names."""
    levels = paths.groupBy(by, "level").agg(F.count("*").alias("n"))
    part = F.struct(rank(F.col("level"), RISK_LEVELS).alias("r"), F.concat_ws(" ", F.col("n").cast("string"), "level").alias("t"))
    told = levels.groupBy(by).agg(F.sum("n").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_set(part)), lambda x: x.t), ", ").alias("levels"))
    severe = paths.filter(F.col("level").isin(*SEVERE))
    place = F.row_number().over(Window.partitionBy(by).orderBy(rank(F.col("level"), RISK_LEVELS), "path"))
    named = severe.withColumn("p", place).filter("p <= 3").groupBy(by).agg(F.sort_array(F.collect_list(F.struct("p", "name"))).alias("names"))
    listed = F.array_join(F.transform("names", lambda x: x["name"]), "; ")
    text = F.concat(F.col("n").cast("string"), F.lit(" risk paths ("), F.col("levels"), F.lit(")."), F.coalesce(F.concat(F.lit(" Most severe: "), listed, F.lit(".")), F.lit("")))
    return told.join(named, by, "left").select(by, text.alias("headline"))


def split_notes(notes: DataFrame) -> DataFrame:
    """Old mixed notes with ``diagnostic``: whether they tell how a run went."""
    from claimloom.functions.text import diagnostic_note

    return notes.withColumn("diagnostic", diagnostic_note(F.col("note")))
