"""Runs of named stages and the manifest of what became of them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from claimloom.session import shared_folder

Stage = tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]
_ROWS = "place bigint, stage string, status string, rows bigint, seconds double, error string"


def run(spark: SparkSession, stages: Sequence[Stage], folder: str | None = None, optional: Sequence[str] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """The stages one after another, each written as Parquet and read again, and a manifest row for each.

    A stage gets the results of those before it by name. An optional stage that fails is recorded and left out;
    after any other failure the remaining stages are ``not_run``.
    """
    folder = (folder or f"{shared_folder(spark)}/run").rstrip("/")
    results: dict[str, DataFrame] = {}
    rows, broken = [], False
    for place, (name, stage) in enumerate(stages):
        if broken:
            rows.append((place, name, "not_run", None, 0.0, None))
            continue
        began = time.monotonic()
        try:
            stage(spark, results).write.mode("overwrite").parquet(f"{folder}/{name}")
            results[name] = spark.read.parquet(f"{folder}/{name}")
            rows.append((place, name, "done", results[name].count(), round(time.monotonic() - began, 3), None))
        except Exception as error:  # noqa: BLE001  whatever fails, the manifest tells it
            broken = name not in optional
            rows.append((place, name, "failed", None, round(time.monotonic() - began, 3), f"{type(error).__name__}: {error}".splitlines()[0][:500]))
    return results, spark.createDataFrame(rows, _ROWS)


def tenths(done: int, total: int) -> int:
    """Tenths of the work that are done, as progress is logged."""
    return 10 if total <= 0 else min(10, 10 * done // total)
