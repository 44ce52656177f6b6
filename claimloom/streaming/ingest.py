"""Arriving snapshots: each content once, upserted into a table of documents; equal to the batch result.

The table is a base and the changes since: each batch writes its own rows alone, and every
``COMPACT_EVERY`` batches the changes are folded into a new base. Reading takes the last arrival of each url.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.text import content_hash


def distinct_contents(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Arrivals (url, body, arrived) whose content was not seen within ``delay``."""
    marked = stream.withColumn("content_sha256", content_hash(F.col("body")))
    return marked.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["url", "content_sha256"])


def latest(arrivals: DataFrame) -> DataFrame:
    """The last arrival of each url."""
    return arrivals.groupBy("url").agg(F.max_by(F.struct("body", "content_sha256", "arrived"), F.struct("arrived", "content_sha256")).alias("d")).select("url", "d.*")


#: Batches whose changes are kept beside the base.
COMPACT_EVERY = 16


def _numbers(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """Numbers of the complete parts of a kind under ``folder``, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    place = path(f"{folder}/{kind}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    done = [n for n in names if re.fullmatch(r"v\d{12}", n) and files.exists(path(f"{folder}/{kind}/{n}/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def _part(folder: str, kind: str, number: int) -> str:
    return f"{folder}/{kind}/v{number:012d}"


def _drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _parts(spark: SparkSession, folder: str, number: int | None) -> list[str]:
    """The newest base up to ``number`` and the changes after it."""
    until = [n for n in _numbers(spark, folder, "base") if number is None or n <= number]
    base = until[-1] if until else -1
    changes = [n for n in _numbers(spark, folder, "changes") if n > base and (number is None or n <= number)]
    return [_part(folder, "base", n) for n in until[-1:]] + [_part(folder, "changes", n) for n in changes]


def current(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """The table after batch ``number``, or after all of them."""
    found = _parts(spark, folder.rstrip("/"), number)
    if not found:
        raise ValueError(f"no table under {folder}")
    return latest(spark.read.parquet(*found))


def upserting(spark: SparkSession, folder: str, compact_every: int = COMPACT_EVERY):
    """A function for foreachBatch that writes batch n's last arrivals as change n, and at times a new base.

    Nothing is kept between batches but the files, so a restart goes on, and a batch that runs again
    writes the same change. What a new base holds is deleted once the next base stands, so readers
    of the one before are not disturbed.
    """
    folder = folder.rstrip("/")

    def merge(batch: DataFrame, number: int) -> None:
        bases = _numbers(spark, folder, "base")
        if bases and number <= bases[-1]:
            return  # the base holds this batch already
        latest(batch.select("url", "body", "content_sha256", "arrived")).write.mode("overwrite").parquet(_part(folder, "changes", number))
        base = bases[-1] if bases else -1
        if len([n for n in _numbers(spark, folder, "changes") if n > base]) >= compact_every:
            current(spark, folder, number).write.mode("overwrite").parquet(_part(folder, "base", number))
            for n in bases:
                _drop(spark, _part(folder, "base", n))
            for n in _numbers(spark, folder, "changes"):
                if n <= base:
                    _drop(spark, _part(folder, "changes", n))

    return merge
