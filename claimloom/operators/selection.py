"""Choosing sections for extraction and packing them into batches."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from claimloom.operators import numbering
from claimloom.session import cut

MOST_SECTIONS = 150
BATCH_CHARS, BATCH_ITEMS = 6000, 8


def verdict_rank(scored_run: bool) -> Column:
    """Risk candidates first, then context or anything of a run without scores, then what could not be scored."""
    scored = F.col("status") == "scored"
    middle = F.lit(True) if not scored_run else scored & (F.col("label") == "context")
    return F.when(scored & (F.col("label") == "risk_candidate"), 0).when(middle, 1).otherwise(2)


def exclusion(scored_run: bool) -> Column:
    unwanted = F.lit(scored_run) & (F.col("status") == "scored") & ~F.coalesce(F.col("label").isin("risk_candidate", "context"), F.lit(False))
    return F.when(F.col("duplicate_of").isNotNull(), "duplicate").when(unwanted, "not_relevant")


def selected(rows: DataFrame, most: int = MOST_SECTIONS, scored_run: bool = True, by: tuple[str, ...] = (), source: str = "source_rank", key: str = "candidate_id") -> DataFrame:
    """Adds ``excluded`` (reason or null), ``place`` among the others, and ``chosen`` for the first ``most`` of them."""
    marked = rows.withColumn("excluded", exclusion(scored_run))
    order = [verdict_rank(scored_run), -F.coalesce(F.col("score"), F.lit(0.0)), source, key]
    open_ = numbering.placed(marked.filter("excluded IS NULL"), "place", by, order)
    rest = marked.filter("excluded IS NOT NULL").withColumn("place", F.lit(None).cast("bigint"))
    return open_.unionByName(rest).withColumn("chosen", F.coalesce(F.col("place") <= most, F.lit(False)))


def _packed(sizes: list[int], most_chars: int, most_items: int) -> list[int]:
    """For each place the place where the next batch begins if one begins there."""
    sums = [0, *accumulate(sizes)]
    # The batch ends before the row that would be too much, and holds one row at least.
    return [max(n + 1, min(n + most_items, bisect_right(sums, sums[n] + most_chars) - 1)) for n in range(len(sizes))]


def batches(rows: DataFrame, source: str, key: str, size: str, most_chars: int = BATCH_CHARS, most_items: int = BATCH_ITEMS) -> DataFrame:
    """source, key and batch (from 0): neighbours in key order share a batch until its size or its number of items is full.

    What a batch holds follows from the one before, but a batch takes less than ``most_items`` rows over the end of a range of rows.
    So rows are dealt by ranges, and a range tells for each number of rows that a batch before it may take
    how many the next range loses, and how many batches begin in it: a table of ``most_items`` entries, for
    which it sees the ``most_items`` rows behind it. The tables of a source, one a range, are
    followed in order, and each range then packs its rows from where it is told. No source is in one task.
    """
    kinds = dict(rows.dtypes)
    ordered = rows.select(source, key, F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("__size"))
    held = cut(ordered.repartitionByRange(source, key).withColumn("__range", F.spark_partition_id()), "batches")
    parts = held.groupBy(source).agg(F.min("__range").alias("__low"), F.max("__range").alias("__high")).filter("__low < __high").select(F.col(source).alias("__source"))
    several = held.join(F.broadcast(parts), F.col(source).eqNullSafe(F.col("__source")), "left_semi")
    head = Window.partitionBy("__range", source).orderBy(key)
    heads = several.withColumn("__n", F.row_number().over(head)).filter(F.col("__n") <= most_items).select("__range", source, "__n", "__size")
    behind = Window.partitionBy(source).orderBy("__range", "__n").rowsBetween(1, most_items)
    last = F.row_number().over(Window.partitionBy("__range", source).orderBy(F.desc("__n"))) == 1
    after = heads.withColumn("__after", F.collect_list("__size").over(behind)).withColumn("__last", last).filter("__last").select(F.col("__range").alias("__r"), F.col(source).alias("__source"), "__after")
    same = (F.col("__range") == F.col("__r")) & F.col(source).eqNullSafe(F.col("__source"))

    def tables(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, own), group in groupby(_rows(frames), itemgetter(0, 1)):
            sizes, behind_ = [], None
            for row in group:
                sizes.append(row[2])
                behind_ = row[3]
            count = len(sizes)
            following = _packed(sizes + behind_, most_chars, most_items)
            lost, begun = [0] * count, [0] * count
            for n in range(count - 1, -1, -1):
                then = following[n]
                lost[n], begun[n] = (lost[then], begun[then] + 1) if then < count else (then - count, 1)
            # A batch that takes more rows than there are goes on behind them.
            lost += [n - count for n in range(count, most_items)]
            begun += [0] * (most_items - count)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own], kind_of), pa.array([lost[:most_items]], pa.list_(pa.int32())), pa.array([begun[:most_items]], pa.list_(pa.int64()))], ["__range", source, "lost", "begun"])

    kind_of = to_arrow_type(rows.schema[source].dataType)
    asked = several.join(F.broadcast(after), same).repartition("__range", source).sortWithinPartitions("__range", source, key).select("__range", source, "__size", "__after")
    found = asked.mapInArrow(tables, f"__range int, `{source}` {kinds[source]}, lost array<int>, begun array<bigint>")
    start = F.struct(F.lit(0).alias("enter"), F.lit(0).cast("bigint").alias("base"), F.array().cast("array<struct<r:int,enter:int,base:bigint>>").alias("told"))
    step = lambda a, x: F.struct(
        F.get(x.lost, a.enter).alias("enter"), (a.base + F.get(x.begun, a.enter)).alias("base"), F.concat(a.told, F.array(F.struct(x["__range"].alias("r"), a.enter.alias("enter"), a.base.alias("base")))).alias("told")
    )
    told = found.groupBy(source).agg(F.sort_array(F.collect_list(F.struct("__range", "lost", "begun"))).alias("parts"))  # as many as a source has ranges
    entries = told.select(F.col(source).alias("__source"), F.explode(F.aggregate("parts", start, step, lambda a: a.told)).alias("t")).select("__source", F.col("t.r").alias("__r"), F.col("t.enter").alias("__enter"), F.col("t.base").alias("__base"))

    def walk(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, batch, items, chars, left = object(), 0, 0, 0, 0
        for frame in frames:
            out = []
            for part, name, n, enter, base in zip(*(frame.column(k).to_pylist() for k in (0, 1, 3, 4, 5)), strict=True):
                if (part, name) != own:
                    own, batch, items, chars, left = (part, name), base - 1, most_items, 0, enter
                if left:  # taken by a batch that began before
                    left -= 1
                else:
                    if chars + n > most_chars or items >= most_items:
                        batch, items, chars = batch + 1, 0, 0
                    items, chars = items + 1, chars + n
                out.append(batch)
            yield pa.RecordBatch.from_arrays([frame.column(1), frame.column(2), pa.array(out, pa.int64())], [source, key, "batch"])

    known = held.join(F.broadcast(entries), same, "left").select("__range", source, key, "__size", F.coalesce("__enter", F.lit(0)).alias("__enter"), F.coalesce("__base", F.lit(0)).alias("__base"))
    dealt = known.repartition("__range", source).sortWithinPartitions("__range", source, key)
    return dealt.mapInArrow(walk, f"`{source}` {kinds[source]}, `{key}` {kinds[key]}, batch bigint")


def _rows(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(*(c.to_pylist() for c in frame.columns), strict=True)


def unique_slugs(rows: DataFrame, by: str, position: str, base: str) -> DataFrame:
    """Adds ``slug``: the base, or base_2, base_3, ... where it is taken, in the order of ``position``.

    Slugs meet only where their bases are alike but for numbers at the end, so these are a group.
    One that has a single base is numbered; the others, which are rare, are folded.
    """
    own = rows.withColumn("__root", F.regexp_replace(base, "(?:_[0-9]+)+$", ""))
    groups = own.groupBy(by, "__root").agg(F.min(base).alias("__low"), F.max(base).alias("__high"))
    single = groups.filter("__low = __high").select(by, "__root")
    place = F.row_number().over(Window.partitionBy(by, base).orderBy(position))
    numbered = own.join(single, [by, "__root"]).withColumn("__n", place)
    plain = numbered.select(by, position, base, F.when(F.col("__n") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), F.col("__n").cast("string"))).alias("slug"))
    start = F.struct(F.array().cast("array<string>").alias("used"))

    def step(a: Column, x: Column) -> Column:
        tries = F.concat(F.array(x.base), F.transform(F.sequence(F.lit(2), F.size(a.used) + 2), lambda n: F.concat(x.base, F.lit("_"), n.cast("string"))))
        return F.struct(F.concat(a.used, F.slice(F.array_except(tries, a.used), 1, 1)).alias("used"))

    item = F.struct(F.col(position).alias("position"), F.col(base).alias("base"))
    mixed = own.join(groups.filter("__low <> __high").select(by, "__root"), [by, "__root"]).groupBy(by, "__root").agg(F.sort_array(F.collect_list(item)).alias("items"))
    folded = mixed.withColumn("slugs", F.aggregate("items", start, step, lambda a: a.used))
    each = F.explode(F.arrays_zip(F.col("items.position").alias("position"), F.col("items.base").alias("base"), F.col("slugs").alias("slug")))
    return plain.unionByName(folded.select(by, each.alias("x")).select(by, F.col("x.position").alias(position), F.col("x.base").alias(base), "x.slug"))


def in_text_order(rows: DataFrame, source: str, key: str) -> DataFrame:
    """Adds ``place`` of each source's sections by the string of their id, so that s10 comes before s2."""
    return numbering.placed(rows, "place", [source], [F.col(key).cast("string")])
