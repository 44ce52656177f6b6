"""Registry answers that were landed page by page, as a Spark data source.

A page is ``<path>/catalog=<name>/page=<number>/<any>.txt`` (or ``.json``) and holds a JSON array of releases a line; that is what
``land`` writes, and what any partitioned text writer does. Pages are read in ranges, a partition each. Filters on the
catalog choose folders, filters on the version choose rows while they are read; sessions ask for that with
``spark.sql.python.filterPushdown.enabled``, and Spark filters itself otherwise. A page that cannot be read is a row with an error, so a failing
page aborts nothing and its catalog is told to be incomplete.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from claimloom.session import shared_folder

MOST_PAGES, PAGES_A_PARTITION = 10, 20
SCHEMA = "catalog string, page int, version string, published string, final boolean, error string"


def _files(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match("[a-z0-9]+:", path) else f"file://{path}")


@dataclass
class Pages(InputPartition):
    """Files of some pages: (catalog, page, path)."""

    files: list[tuple[str, int, str]]


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"].rstrip("/"), int(options.get("pages_a_partition", PAGES_A_PARTITION))
        self.catalogs: set[str] | None = None
        self.versions: set[str] | None = None

    def partitions(self) -> list[Pages]:
        files, root = _files(self.path)
        found = []
        for folder in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name = re.fullmatch("catalog=(.*)", folder.base_name)
            if not name or self.catalogs is not None and unquote(name[1]) not in self.catalogs:
                continue
            for file in files.get_file_info(fs.FileSelector(folder.path, recursive=True)):
                page = re.search(r"/page=(\d+)/[^/._][^/]*\.(?:txt|json)$", file.path)
                if page and file.is_file:
                    found.append((unquote(name[1]), int(page[1]), file.path))
        found.sort()
        return [Pages(found[n : n + self.size]) for n in range(0, len(found), self.size)] or [Pages([])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        files, _ = _files(self.path)
        for catalog, page, path in partition.files:
            try:
                with files.open_input_stream(path) as stream:
                    rows = list(_releases(stream.read()))
            except (OSError, ValueError) as fault:
                if self.versions is None:
                    yield catalog, page, None, None, None, str(fault)[:200]
                continue
            if self.versions is None and not rows:
                yield catalog, page, None, None, None, None
            yield from ((catalog, page, *row, None) for row in rows if self.versions is None or row[0] in self.versions)


class _FilteringReader(_PageReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes equality and lists on catalog and version; all others are Spark's."""
        for one in filters:
            values = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            name = one.attribute[0] if values is not None and len(one.attribute) == 1 else None
            if name == "catalog":
                self.catalogs = values if self.catalogs is None else self.catalogs & values
            elif name == "version":
                self.versions = values if self.versions is None else self.versions & values
            else:
                yield one


def _releases(body: bytes) -> Iterator[tuple]:
    for line in body.split(b"\n"):
        items = json.loads(line) if line.strip() else []
        # An object, as errors are answered with, is no page of releases.
        if not isinstance(items, list) or not all(isinstance(item, dict) for item in items):
            raise ValueError("no array of releases")
        for item in items:
            yield item.get("tag_name") or item.get("name"), item.get("published_at"), not (item.get("draft") or item.get("prerelease"))


class RegistryPages(DataSource):
    """The format ``registry_pages``: a row for each release, for each page without any, and for each page that fails."""

    @classmethod
    def name(cls) -> str:
        return "registry_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return (_FilteringReader if self.options.get("pushdown") == "true" else _PageReader)(self.options)


def scan(spark: SparkSession, path: str, pages_a_partition: int = PAGES_A_PARTITION) -> DataFrame:
    """catalog, page, version, published, final and error of what lies under ``path``."""
    spark.dataSource.register(RegistryPages)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")  # sessions without it refuse readers that take filters
    return spark.read.format(RegistryPages.name()).options(path=path, pages_a_partition=str(pages_a_partition), pushdown=pushdown).load()


def land(pages: DataFrame, path: str | None = None) -> str:
    """Writes (catalog, page, body) as ``scan`` reads it, a file a page, into the shared folder unless told where; and tells where."""
    spark = pages.sparkSession
    if path is None:
        path = f"{shared_folder(spark).rstrip('/')}/pages-{uuid4().hex}"
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    body = F.regexp_replace(F.col("body"), r"[\r\n]+", " ")
    pages.select("catalog", "page", body.alias("body")).repartition("catalog", "page").write.partitionBy("catalog", "page").mode("append").text(path)
    return path


def releases(scanned: DataFrame) -> DataFrame:
    """catalog, version and published of final releases."""
    return scanned.filter("final").select("catalog", "version", "published")


def completeness(scanned: DataFrame, most_pages: int = MOST_PAGES) -> DataFrame:
    """(catalog, complete): no page failed, and the last one read is below the limit."""
    return scanned.groupBy("catalog").agg(((F.count("error") == 0) & (F.max("page") < most_pages)).alias("complete"))
