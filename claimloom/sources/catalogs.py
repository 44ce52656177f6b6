"""Release catalogs from registry answers (JSON text) and inventories recognized in pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FILE = "array<struct<upload_time:string,upload_time_iso_8601:string,yanked:boolean>>"


def pypi(answers: DataFrame, key: str = "catalog", body: str = "body") -> DataFrame:
    """key, version, published and yanked of releases with files; yanked only if all files are."""
    parsed = answers.select(key, F.from_json(F.get_json_object(body, "$.releases"), f"map<string,{_FILE}>").alias("releases"))
    files = parsed.select(key, F.explode("releases").alias("version", "files")).filter(F.size("files") > 0)
    times = F.transform("files", lambda f: F.coalesce(f.upload_time_iso_8601, f.upload_time))
    return files.select(key, "version", F.array_min(times).alias("published"), F.forall("files", lambda f: F.coalesce(f.yanked, F.lit(False))).alias("yanked"))


def pypi_skipped(answers: DataFrame, key: str = "catalog", body: str = "body") -> DataFrame:
    """Labels of releases without files."""
    parsed = answers.select(key, F.from_json(F.get_json_object(body, "$.releases"), f"map<string,{_FILE}>").alias("releases"))
    return parsed.select(key, F.explode("releases").alias("version", "files")).filter(F.size("files") == 0).select(key, "version")


def npm(answers: DataFrame, key: str = "catalog", body: str = "body") -> DataFrame:
    """key, version and published of every version."""
    times = F.from_json(F.get_json_object(body, "$.time"), "map<string,string>")
    versions = F.map_keys(F.from_json(F.get_json_object(body, "$.versions"), "map<string,string>"))
    each = answers.select(key, times.alias("times"), F.explode(versions).alias("version"))
    return each.select(key, "version", F.try_element_at("times", F.col("version")).alias("published"))


def github(answers: DataFrame, key: str = "catalog", page: str = "page", body: str = "body", most_pages: int = 10) -> tuple[DataFrame, DataFrame]:
    """(key, version, published) of final releases on all pages, and (key, complete) by the pages read and their errors."""
    shape = "array<struct<tag_name:string,name:string,draft:boolean,prerelease:boolean,published_at:string>>"
    # An object, as errors are answered with, is no page of releases, though it would parse as a list of one.
    parsed = answers.withColumn("items", F.when(F.ltrim(F.col(body)).startswith("["), F.from_json(body, shape)))
    each = parsed.select(key, F.explode("items").alias("r")).filter(~F.coalesce("r.draft", F.lit(False)) & ~F.coalesce("r.prerelease", F.lit(False)))
    complete = parsed.groupBy(key).agg((F.bool_and(F.col("items").isNotNull()) & (F.max(page) < most_pages)).alias("complete"))
    return each.select(key, F.coalesce("r.tag_name", "r.name").alias("version"), F.col("r.published_at").alias("published")), complete


def inventories(links: DataFrame, label: str = "label", key: str = "page", least: int = 2) -> DataFrame:
    """Pages that list releases: at least ``least`` links whose labels are versions."""
    from claimloom.functions.versions import numeric_label

    return links.filter(numeric_label(F.col(label)).isNotNull()).groupBy(key).agg(F.count_distinct(label).alias("releases")).filter(F.col("releases") >= least)
