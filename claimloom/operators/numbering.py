"""Running numbers and budgets without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut

_INDEX = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a partition


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Adds ``name``, the place from 1 in ``order`` over the whole table.

    Rows are sorted by ranges and written; each range's own numbers are shifted by the sizes of
    those before it, a row per range.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = cut(ranged.withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX))), "numbered")
    sizes = held.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    joined = held.join(F.broadcast(shifts), "__range")  # a row per shuffle partition
    return joined.withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__range", "__at", "__before")


def placed(rows: DataFrame, name: str, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Adds ``name``, the place from 1 of each row in its group ``by`` in ``order``, which is total.

    Rows are dealt by ranges over group and order, and written, so that ranges stay what they are. A range numbers its
    own rows; of the groups that several ranges share, which are two a range at most, the sizes in earlier ranges are added. So a
    group that a third of all rows share is as many ranges as its size asks for.
    """
    own = {f"__o{n}": F.col(c) if isinstance(c, str) else c for n, c in enumerate(order)}
    held = cut(rows.withColumns(own).repartitionByRange(*by, *own).withColumn("__range", F.spark_partition_id()), "placed")
    counts = held.groupBy("__range", *by).agg(F.count("*").alias("__n"))
    parts = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    split = counts.groupBy(*by).agg(F.min("__range").alias("__low"), F.max("__range").alias("__high")).filter("__low < __high").drop("__low", "__high")
    shared = counts
    if by:
        split = split.select(*(F.col(c).alias(f"__s{n}") for n, c in enumerate(by)))
        shared = counts.join(F.broadcast(split), [F.col(c).eqNullSafe(F.col(f"__s{n}")) for n, c in enumerate(by)], "left_semi")
    shifts = shared.withColumn("__before", F.sum("__n").over(parts)).filter("__before IS NOT NULL")
    shifts = shifts.select(F.col("__range").alias("__r"), "__before", *(F.col(c).alias(f"__s{n}") for n, c in enumerate(by)))
    met = [F.col("__range") == F.col("__r"), *(F.col(c).eqNullSafe(F.col(f"__s{n}")) for n, c in enumerate(by))]
    place = F.row_number().over(Window.partitionBy("__range", *by).orderBy(*own)) + F.coalesce("__before", F.lit(0))
    return held.join(F.broadcast(shifts), met, "left").withColumn(name, place.cast("bigint")).select(*(c for c in rows.columns if c != name), name)


def within(rows: DataFrame, most: int, order: Sequence[str | Column], by: Sequence[str] = (), among: Column | None = None) -> DataFrame:
    """Adds ``within``: whether a row (of those that ``among`` holds for) is one of the first ``most`` of its group by ``order``, which is total.

    Only the first ``most`` of a group are ranked, which each task picks before the shuffle; every row is then
    compared with the last of them.
    """
    edge, own = F.struct(*order), F.lit(True) if among is None else among
    if most < 1:
        return rows.withColumn("within", F.lit(False))
    if by:
        best = rows.filter(own).withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= most)
        last = best.groupBy(*by).agg(F.max(F.when(F.col("__n") == most, edge)).alias("__last"))
        joined = rows.join(last, list(by), "left")
    else:
        best = rows.filter(own).orderBy(*order).limit(most)
        last = best.agg(F.when(F.count("*") == most, F.max(edge)).alias("__last"))
        joined = rows.crossJoin(F.broadcast(last))  # one row
    return joined.withColumn("within", own & F.coalesce(edge <= F.col("__last"), F.lit(True))).drop("__last")
