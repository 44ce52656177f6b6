"""Sinks: a Parquet table per artifact, JSON lines, schema snapshots; pages are in ``reports``."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write(df: DataFrame, folder: str, name: str, by: Iterable[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{folder.rstrip('/')}/{name}")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def export_json(df: DataFrame, folder: str, name: str) -> None:
    """One JSON object a line, written by the executors."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{folder.rstrip('/')}/{name}")


def script_safe(value: object) -> str:
    """JSON that may stand inside a script element."""
    return json.dumps(value, ensure_ascii=False).translate({ord("<"): "\\u003c", ord(">"): "\\u003e", ord("&"): "\\u0026", 0x2028: "\\u2028", 0x2029: "\\u2029"})


def schema_snapshot(schema: StructType) -> str:
    return json.dumps(schema.jsonValue(), indent=1, sort_keys=True)


def schema_drift(schema: StructType, snapshot: str) -> list[str]:
    """Fields that differ from a snapshot."""
    have = {f["name"]: f for f in schema.jsonValue()["fields"]}
    want = {f["name"]: f for f in json.loads(snapshot)["fields"]}
    return sorted(n for n in have.keys() | want.keys() if have.get(n) != want.get(n))
