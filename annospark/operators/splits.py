"""Contiguous row ranges, synthesized ids and round-robin workers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annospark.lineage import cut
from annospark.names import free_name


def split_sizes(rows: int, wanted: int) -> tuple[int, int]:
    """(rows in a split, splits): ``wanted`` is the former if positive, minus the latter if negative."""
    if not wanted:
        raise ValueError("neither a size nor a number of splits")
    if wanted > 0:
        return wanted, math.ceil(rows / wanted)
    size = max(1, math.ceil(rows / -wanted))
    return size, -wanted


def split_ranges(spark: SparkSession, rows: int, size: int, limit: int | None = None) -> DataFrame:
    """``split, row_start, row_end`` (from 1; ends exclusive).  Splits that begin at ``limit`` or later are left out."""
    out = spark.range(math.ceil(rows / size)).select(
        (F.col("id") + 1).alias("split"), (F.col("id") * size).alias("row_start"), F.least((F.col("id") + 1) * size, F.lit(rows)).alias("row_end")
    )
    return out if limit is None else out.where(F.col("row_start") < limit)


def number_rows(df: DataFrame, order: list[str], out: str = "id", start: int = 1) -> DataFrame:
    """``df`` with ``out``: the row's place in the order, from ``start``.

    Rows are sorted by range partitions, each numbers its own, and the partitions' sizes, summed up, are added: no
    task holds more than its partition.
    """
    part, at, first, before = (free_name(n, df.columns) for n in ("part", "at", "first", "before"))
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "ranged")
    sizes = ranged.groupBy(part).agg(F.count("*").alias("rows"), F.min(at).alias(first))
    earlier = F.coalesce(F.sum("rows").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a partition, so the table is as small as the number of tasks and is sent to all.
    sizes = F.broadcast(sizes.select(part, first, earlier.alias(before)))
    return ranged.join(sizes, part).withColumn(out, F.col(before) + F.col(at) - F.col(first) + start).drop(part, at, first, before)


def rows_between(df: DataFrame, order: list[str], start: int, end: int) -> DataFrame:
    """The rows at places ``start`` to ``end`` (from 0, exclusive) of the order."""
    name = free_name("place", df.columns)
    return number_rows(df, order, name, 0).where(F.col(name).between(start, end - 1)).drop(name)


def worker_of(shard: Column, workers: int) -> Column:
    """The worker that owns a shard, round robin."""
    return F.pmod(shard, F.lit(workers)).cast("int")


def hex_suffixes(name: Column) -> Column:
    """A shard's hexadecimal name and all it becomes as leading zeros go, down to one digit."""
    zeros = F.least(F.length(F.regexp_extract(name, "^0*", 0)), F.length(name) - 1)
    return F.transform(F.sequence(F.lit(0), zeros), lambda i: F.substring(name, i + 1, F.length(name)))
