"""Session settings and table loading shared by queries, bench and tests."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; Catalyst prunes its columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``; on a local master a fresh one where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    found = tempfile.mkdtemp(prefix="claimloom-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder as Parquet and read again, and where it lies until the driver ends or it is discarded."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """``written``, where the result may be read as long as the folder stands: its lineage ends there."""
    return written(df, name)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes what ``written`` made, once nothing reads it any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
