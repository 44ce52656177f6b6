"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of columns that operators add for their own use, so that columns of the input never clash.
OWN = "__llm_"


class Memo(dict):
    """A bounded map from a key to ``make(key)``.

    When it holds ``limit`` keys they become the older generation, which is asked before
    ``make``, and the one before that is let go. Keys longer than ``longest`` are not kept,
    so its memory is bounded whatever the texts hold.
    """

    def __init__(self, make: Callable, limit: int = 250_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value


_kept: list = []


def kept(key: object, make: Callable):
    """``make()``, kept in this worker from task to task until another key is asked for: one at a time."""
    if not _kept or _kept[0] != key:
        _kept.clear()
        _kept[:] = [key, make()]
    return _kept[1]


def _trim() -> None:
    """Gives freed memory back to the system, so that an idle worker does not hold what its last task used."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def portions(batches: Iterable[pa.RecordBatch], rows: int = 1000, holding: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that one slice's texts are Python objects at a time.

    Unless it is ``holding`` something ``kept``, the worker lets go of what an earlier operator kept.
    """
    if not holding and _kept:
        _kept.clear()
        _trim()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    _trim()


_WHITE = re.compile(rb"[ \t-\r]")


def segments(text: bytes, size: int = 1 << 20, ends: re.Pattern = _WHITE) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end before ASCII white space (or ``ends``), so that work on a very long one is bounded."""
    at = 0
    while len(text) - at > size:
        white = ends.search(text, at + size)
        if not white:
            break
        yield text[at : white.start()]
        at = white.start()
    yield text[at:] if at else text


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def merged(df: DataFrame) -> DataFrame:
    """``df``, marked so that a join with it is by sort and merge.

    Sizes are guessed from files, before rows are exploded, so Spark would otherwise broadcast, through the
    driver, tables that grow with the corpus.
    """
    return df.hint("merge")


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or on a local master a fresh one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimloom-"))
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder as Parquet and read again, and where it lies until the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """``written``, where the result may be read as long as the folder stands: its lineage ends there."""
    return written(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes what ``written`` made, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
