"""Appending batches of annotations to written indices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from annospark.config import ShardingSpec
from annospark.functions.geometry import Box
from annospark.lineage import cut, scope
from annospark.operators import octree
from annospark.operators.indexes import id_index, relation_index, with_cell_shard
from annospark.plans.lookup import exists, remove, write_index
from annospark.plans.sharding import CELL_ROWS, MAX_LEVELS
from annospark.skew import if_few


@dataclass(frozen=True)
class Spatial:
    """Settings of a spatial index that grows; they and the bounds hold for all its batches."""

    bounds: Box
    specs: tuple[ShardingSpec, ...]
    cell_rows: int = CELL_ROWS
    max_levels: int = MAX_LEVELS
    seed: str = ""
    crossing: bool = False


def append_spatial(annotations: DataFrame, path: str, spatial: Spatial) -> None:
    """Put ``id, points`` into the spatial index at ``path`` (``write_index`` by level and shard), or begin one there.

    Rows displace others, which go down; the index is then what building all at once gives.  Partitions (level and shard) with changed cells are written anew, from what
    their other cells hold and what the changed ones hold now; no other partition is read or written.  They are written whole beside the index first and
    then put into it, so an append that ended halfway is brought to its end by the next one; a reader meanwhile may see some
    partitions new and others old.  Rows whose id is there already are left out, so a batch that runs twice changes nothing the second time.
    """
    spark, path = annotations.sparkSession, path.rstrip("/")
    pending = f"{path}.pending"
    if exists(spark, f"{pending}/_SUCCESS"):
        _put_in(spark, pending, path)
    with scope():
        there = spark.read.parquet(path) if exists(spark, path) else None
        rows = annotations.select("id", "points")
        if there is not None:
            rows = rows.join(there.select(F.col("id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_anti")
        rows = cut(rows, "batch")
        if there is not None and rows.isEmpty():
            return
        held, cells = octree.insert(there, rows, spatial.bounds, spatial.cell_rows, spatial.max_levels, spatial.seed, spatial.crossing)
        now = with_cell_shard(cut(octree.placed(held), "held"), list(spatial.specs))
        if there is not None:
            now, cells = cut(now, "now"), cut(cells.distinct(), "touched")
            parts = cut(now.select("level", "shard").distinct(), "parts")
            others = there.join(if_few(parts, parts.count()), ["level", "shard"], "left_semi").join(if_few(cells, cells.count()), ["level", *octree.CELL], "left_anti")
            now = now.unionByName(others.select(*now.columns))
        write_index(now, pending, "level", "shard")
    _put_in(spark, pending, path)


def _put_in(spark: SparkSession, pending: str, path: str) -> None:
    """Replace the partitions of the index that ``pending`` has; doing it twice is doing it once."""
    write_index(spark.read.parquet(pending), path, "level", "shard", overwrite="dynamic")
    remove(spark, pending)


def append_stream(
    annotations: DataFrame, out: str, checkpoint: str, by_id: ShardingSpec, relation: ShardingSpec, spatial: Spatial | None = None
) -> StreamingQuery:
    """Index a stream of ``id, points, properties, relations`` as it comes; a batch that runs twice replaces itself.

    With ``spatial`` the spatial index grows too, by ``append_spatial``.
    """

    def batch(rows: DataFrame, number: int) -> None:
        for name, table, by in (("by_id", id_index(rows, by_id), ["shard"]), ("relation", relation_index(rows, relation), ["relation", "shard"])):
            table.withColumn("batch", F.lit(number)).write.partitionBy("batch", *by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{out}/{name}")
        if spatial:
            append_spatial(rows, f"{out}/spatial", spatial)

    return annotations.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def grown(spark: SparkSession, batches: list[DataFrame], path: str, spatial: Spatial) -> DataFrame:
    """The index at ``path`` after ``batches`` have been put into it one by one."""
    for rows in batches:
        append_spatial(rows, path, spatial)
    return spark.read.parquet(path)
