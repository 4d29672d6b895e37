"""The id, relation and spatial indices as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.config import ShardingSpec
from annospark.functions.bits import cell_grid, morton, shard_hex, with_level_shard, with_shard
from annospark.functions.geometry import Box
from annospark.lineage import cut
from annospark.operators import octree
from annospark.plans.sharding import CELL_ROWS, MAX_LEVELS
from annospark.skew import if_few

#: Ids in one slice of a related object's list.
SLICE_IDS = 100_000


def id_index(annotations: DataFrame, sharding: ShardingSpec) -> DataFrame:
    """``annotations`` with ``shard, minishard, shard_hex`` of their id."""
    out = with_shard(annotations, "id", sharding.shard_bits, sharding.minishard_bits, sharding.preshift_bits, sharding.hash)
    return out.withColumn("shard_hex", shard_hex(F.col("shard"), sharding.shard_bits))


def relation_index(annotations: DataFrame, sharding: ShardingSpec, relations: str = "relations") -> DataFrame:
    """``relation, rel_id, shard, minishard, id`` from a map of relation keys to arrays of ids; each once."""
    long = annotations.select("id", F.explode(relations).alias("relation", "ids")).select("relation", F.explode("ids").alias("rel_id"), "id").distinct()
    return with_shard(long, "rel_id", sharding.shard_bits, sharding.minishard_bits, sharding.preshift_bits, sharding.hash)


def related(index: DataFrame) -> DataFrame:
    """``relation, rel_id, slice, ids``: the annotations of each related object, ascending within and across its slices.

    A slice has about ``SLICE_IDS`` ids; an object of few annotations has one.  Ids go to slices by ranges that
    the object's own least and greatest ids and its number of annotations give, so no task gathers a whole large list.
    """
    sizes = index.groupBy("relation", "rel_id").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    large = cut(sizes.where(F.col("n") > SLICE_IDS).withColumn("parts", F.ceil(F.col("n") / SLICE_IDS)), "large")
    width = (F.col("high").cast("double") - F.col("low").cast("double") + 1) / F.col("parts")
    part = F.coalesce(F.least(F.floor((F.col("id").cast("double") - F.col("low").cast("double")) / width), F.col("parts") - 1), F.lit(0)).cast("int")
    dealt = index.join(if_few(large, large.count()), ["relation", "rel_id"], "left").select("relation", "rel_id", "id", part.alias("slice"))
    return dealt.groupBy("relation", "rel_id", "slice").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def spatial_index(annotations: DataFrame, bounds: Box, specs: list[ShardingSpec], cell_rows: int = CELL_ROWS, max_levels: int = MAX_LEVELS, seed: str = "", crossing: bool = False) -> DataFrame:
    """``level, cx, cy, cz, morton, shard, minishard, id, place, points``; ``specs`` has the sharding of each level.

    Fewer specs than the octree has levels raise.  The points go along, so that a box is answered by its cells alone; for lines and
    polylines that takes an index that enters them in every cell that they cross (``crossing``).
    """
    index = cut(octree.build(annotations, bounds, cell_rows, max_levels, seed, points=True, crossing=crossing), "octree")
    return with_cell_shard(index, specs)


def with_cell_shard(held: DataFrame, specs: list[ShardingSpec]) -> DataFrame:
    """What an octree holds, a written table, with ``morton, shard, minishard`` of the cells."""
    deepest = held.agg(F.max("level")).first()[0] or 0
    if deepest >= len(specs):
        raise ValueError(f"{len(specs)} sharding specs for {deepest + 1} levels")
    # All axes of a level have as many bits, so the deepest level's code is that of each level.
    held = held.withColumn("morton", morton(F.col("cx"), F.col("cy"), F.col("cz"), cell_grid(deepest)))
    columns = ["level", *octree.CELL, "morton", "shard", "minishard", "id", "place", "points"]
    return with_level_shard(held, "morton", F.col("level"), specs[: deepest + 1]).select(*columns)
