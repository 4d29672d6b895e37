"""Queries against written indices; each reads only the shards or cells that can hold an answer."""

from __future__ import annotations

from itertools import product
from math import floor, prod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.config import ShardingSpec
from annospark.functions.bits import cell_grid, morton_of, place
from annospark.functions.geometry import Box, in_bounds

#: Cells of a box that are named one by one in the filter; a larger box is given as ranges.
NAMED_CELLS = 512
#: Share of a cell by which a box is widened when its cells are told, so that rounding can't lose one.
EDGE = 1e-6


def write_index(index: DataFrame, path: str, *by: str, overwrite: str = "static") -> None:
    """Write an index partitioned by ``by``, each partition's rows in one file (or few, if it is large); ``dynamic`` overwrites only partitions that have rows now."""
    index.repartition(*by).sortWithinPartitions(*by).write.partitionBy(*by).option("partitionOverwriteMode", overwrite).parquet(path, mode="overwrite")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_csv(index: DataFrame, path: str, *by: str) -> None:
    """The same as CSV with headers, for looking at; nested columns are written as JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in index.dtypes]
    index.select(*flat).repartition(*by).write.partitionBy(*by).csv(path, header=True, mode="overwrite")


def shards_of(ids: list[int], sharding: ShardingSpec) -> list[int]:
    """The shards of a query's ids."""
    return sorted({place(i, sharding.shard_bits, sharding.minishard_bits, sharding.preshift_bits, sharding.hash)[0] for i in ids})


def lookup_id(index: DataFrame, ids: list[int], sharding: ShardingSpec) -> DataFrame:
    """The rows of an id index with these ids."""
    return index.where(F.col("shard").isin(shards_of(ids, sharding)) & F.col("id").isin(ids))


def lookup_relation(index: DataFrame, relation: str, ids: list[int], sharding: ShardingSpec) -> DataFrame:
    """The rows of a relation index with these related ids."""
    return index.where((F.col("relation") == relation) & F.col("shard").isin(shards_of(ids, sharding)) & F.col("rel_id").isin(ids))


def child_range(low: int, high: int, have: int, want: int) -> tuple[int, int]:
    """Cells of a grid of ``want`` to an axis that cells ``low`` to ``high`` of one of ``have`` are made of."""
    return low * want // have, (high + 1) * want // have - 1


def cells_in(box: Box, bounds: Box, level: int) -> list[tuple[int, int]]:
    """For each axis the first and last cell of ``level`` that ``box`` may meet.

    A point on the edge of two cells belongs to the lower one, but copies of other points' annotations may lie in
    either, so at an edge the range takes both.
    """
    out = []
    for low, high, first, last in zip(box.low, box.high, bounds.low, bounds.high, strict=True):
        width = (last - first) / (1 << level)
        at = lambda v, width=width, first=first: (v - first) / width if width else 0.0
        top = (1 << level) - 1
        out.append((max(0, min(top, floor(at(low) - EDGE))), max(0, min(top, floor(at(high) + EDGE)))))
    return out


def box_query(index: DataFrame, box: Box, bounds: Box, level: int, specs: list[ShardingSpec] | None = None, strict: bool = False) -> DataFrame:
    """Annotations that levels 0 to ``level`` of a spatial index hold and that are in ``box``: ``id, level, points``.

    With its deepest ``level`` an index of points has all answers; one of lines and polylines has them if it was made with ``crossing``, and
    else only those that have a point in a cell that the box meets.

    ``index`` is a written one, partitioned by level and shard (``write_index``): nothing else is read, and of it only levels, shards (if ``specs``
    gives the levels' sharding) and cells that can hold an answer; a box of over ``NAMED_CELLS`` cells of a level reads that
    level's shards and filters by ranges of cells.
    """
    near = F.lit(False)
    for k in range(level + 1):
        axes = cells_in(box, bounds, k)
        here = F.col("level") == k
        if prod(b - a + 1 for a, b in axes) <= NAMED_CELLS:
            cells = [morton_of(cell, cell_grid(k)) for cell in product(*(range(a, b + 1) for a, b in axes))]
            here &= F.col("morton").isin(cells)
            if specs:
                here &= F.col("shard").isin(shards_of(cells, specs[k]))
        else:
            here &= F.col("cx").between(*axes[0]) & F.col("cy").between(*axes[1]) & F.col("cz").between(*axes[2])
        near |= here
    held = index.where(near & in_bounds(F.col("points"), box, strict=strict))
    return held.groupBy("id").agg(F.min("level").alias("level"), F.first("points").alias("points"))
