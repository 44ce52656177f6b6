"""Landed HTTP answers as a table, and documents made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.text import content_hash

SCHEMA = "url string, accept string, status int, headers map<string,string>, body string, final_url string, retrieved_at string, content_sha256 string"
#: Bodies that a site shows to programs or strangers instead of its page.
REFUSALS = r"(?i)captcha|are you a robot|verify you are human|checking your browser|sign in to continue|log ?in to continue|enable javascript and cookies"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Landed answers under ``path`` (JSON lines or Parquet), one row per url and accept: the latest retrieved that is sound."""
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(SCHEMA).json(path)
    kept = sound(rows)
    rest = [c for c in kept.columns if c not in ("url", "accept")]
    last = kept.groupBy("url", "accept").agg(F.max_by(F.struct(*rest), F.struct("retrieved_at", "content_sha256")).alias("s"))
    return last.select("url", "accept", "s.*")


def cache_key(url: Column, accept: Column) -> Column:
    return F.sha2(F.concat(url, F.lit("\n"), accept), 256)


def sound(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose body is what was stored, with a status worth keeping, and no refusal."""
    kept = (F.col("status") < 400) | F.col("status").isin(404, 410)
    return snapshots.filter(kept & (content_hash(F.col("body")) == F.col("content_sha256")) & ~F.col("body").rlike(REFUSALS))


def looked_up(requests: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Requests (url, accept) with their snapshot, or ``cached`` false."""
    found = snapshots.select("url", "accept", "status", "body", "final_url", F.lit(True).alias("hit"))
    return requests.join(found, ["url", "accept"], "left").withColumn("cached", F.coalesce("hit", F.lit(False))).drop("hit")


def refreshed(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the answers of a conditional refresh: a 304 keeps the body and renews the time, others replace the row."""
    fresh = new.select("url", "accept", F.struct(*(c for c in old.columns if c not in ("url", "accept"))).alias("n"))
    joined = old.join(fresh, ["url", "accept"], "full")
    unchanged = F.col("n.status") == 304
    take = lambda c: F.when(F.col("n").isNull(), F.col(c)).when(unchanged & F.lit(c != "retrieved_at"), F.col(c)).otherwise(F.col(f"n.{c}"))
    return joined.select(*(F.col(c) if c in ("url", "accept") else take(c).alias(c) for c in old.columns))


def allowed(urls: DataFrame, policies: DataFrame) -> DataFrame:
    """URLs that no rule of their origin disallows. Policies: origin, prefix; a null prefix defers the whole origin."""
    origin = F.regexp_extract("url", "^([a-z]+://[^/]+)", 1)
    path = F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?#]*)", 1)
    keyed = urls.withColumns({"__o": origin, "__p": path})
    barred = F.col("prefix").isNull() | F.startswith("__p", F.col("prefix"))
    return keyed.join(policies, (F.col("__o") == F.col("origin")) & barred, "left_anti").drop("__o", "__p")


def from_api(answers: DataFrame) -> DataFrame:
    """url, title, text and kind from API answers: releases, issues and pull requests, files in base64, registry records."""
    at = lambda p: F.get_json_object("body", p)
    kind = (
        F.when(at("$.tag_name").isNotNull(), "github_release")
        .when(at("$.pull_request").isNotNull() | at("$.merged_at").isNotNull(), "github_pull_request")
        .when(at("$.issue_url").isNotNull() | at("$.number").isNotNull(), "github_issue")
        .when(at("$.encoding") == "base64", "repository_file")
        .when(at("$.info").isNotNull() | at("$.versions").isNotNull(), "registry_metadata")
    )
    file = F.decode(F.unbase64(F.regexp_replace(at("$.content"), r"\s", "")), "utf-8")
    text = F.when(F.col("kind") == "repository_file", file).when(F.col("kind") == "registry_metadata", F.coalesce(at("$.info.description"), at("$.description"))).otherwise(at("$.body"))
    title = F.coalesce(at("$.name"), at("$.title"), at("$.tag_name"), at("$.path"), at("$.info.name"), F.col("url"))
    return answers.withColumn("kind", kind).filter("kind IS NOT NULL").select("url", title.alias("title"), F.coalesce(text, F.lit("")).alias("text"), "kind")


def request_log(snapshots: DataFrame) -> DataFrame:
    """A row per request without its body."""
    number = F.concat(F.lit("source_"), F.substring(F.sha2("url", 256), 1, 12))
    return snapshots.select(number.alias("source_id"), "url", "final_url", "status", "retrieved_at", "content_sha256")


def case_inputs(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a JSON array with the required fields; family mode unless told otherwise."""
    shape = "project string, current_version string, target_version string, version_mode string, source_urls array<string>"
    rows = spark.read.json(path, schema=shape, multiLine=True)
    return rows.dropna(subset=["project", "current_version", "target_version"]).fillna("family", ["version_mode"])
