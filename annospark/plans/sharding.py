"""How many shards and minishards an index needs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.config import ShardingSpec
from annospark.functions.bits import HASHES, with_shard
from annospark.lineage import cut

#: Entries in a minishard, bytes in a shard, rows in an octree cell, octree levels, shard workers, rows in a split.
MINISHARD_TARGET, SHARD_TARGET = 1000, 50_000_000
CELL_ROWS, MAX_LEVELS, WORKERS, SPLIT_ROWS = 10_000, 10, 32, 6_000_000
#: Bits of shard numbers beyond the formula's that a measured plan tries, and hot keys that it names.
MORE_BITS, HOT_KEYS = 8, 100


def _halvings(total: int, target: int) -> int:
    """How often ``total`` must be halved, rounding down, to be ``target`` at most."""
    n = 0
    while total >> n > target:
        n += 1
    return n


def plan_sharding(count: int, size: int, hash: str = HASHES[0], minishard_target: int = MINISHARD_TARGET, shard_target: int = SHARD_TARGET) -> ShardingSpec:
    """Bits for ``count`` entries of ``size`` bytes together.  A single entry has a single shard and minishard."""
    if count <= 1:
        return ShardingSpec(0, 0, 0, hash)
    parts, shards = _halvings(count, minishard_target), _halvings(size, shard_target)
    return ShardingSpec(shards, max(0, parts - shards), 0, hash)


def plan_level(level: int, rows: int, size: int, cell_rows: int = CELL_ROWS, hash: str = HASHES[0], **targets: int) -> ShardingSpec:
    """Bits for an octree level of data of ``rows`` and ``size``: it holds ``cell_rows`` for each of its cells at most."""
    held = min(8**level * cell_rows, rows)
    return plan_sharding(held, held * -(-size // max(1, rows)), hash, **targets)


def planned(spark: SparkSession, rows: int, size: int, levels: int = MAX_LEVELS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``level, held, bytes, shard_bits, minishard_bits`` of every level, as a table."""
    held = F.least(F.pow(F.lit(8), F.col("level")).cast("long") * cell_rows, F.lit(rows))
    halvings = lambda total, target: F.greatest(F.ceil(F.log2((F.col(total) + 1) / F.lit(target + 1))), F.lit(0)).cast("int")
    out = spark.range(levels).select(F.col("id").cast("int").alias("level")).withColumn("held", held)
    out = out.withColumn("bytes", F.col("held") * -(-size // max(1, rows))).withColumn("shard_bits", halvings("bytes", SHARD_TARGET))
    return out.withColumn("minishard_bits", F.greatest(halvings("held", MINISHARD_TARGET) - F.col("shard_bits"), F.lit(0)))


@dataclass(frozen=True)
class Measured:
    """``spec``; ``largest``, the bytes of its largest shard without hot keys; ``hot``, (key, bytes) of keys that alone exceed a shard's target, the largest first."""

    spec: ShardingSpec
    largest: int
    hot: tuple[tuple[int, int], ...]


def plan_measured(entries: DataFrame, key: str, size: Column, hash: str = HASHES[0], minishard_target: int = MINISHARD_TARGET, shard_target: int = SHARD_TARGET) -> Measured:
    """Bits for the entries as they are: the fewest shards, from the formula's number on, that are all within ``shard_target`` bytes.

    ``entries``: a row for each entry, of ``size`` bytes and the number ``key`` that its chunk has.  Bytes are added up by key, then by the leading bits of
    the keys' hashes at the largest width, which is folded for every smaller one, so the entries are read once.  A key that
    exceeds the target by itself can't be split; such keys are named and left out of the sums.  No entries give a single shard.
    """
    by_key = cut(entries.groupBy(F.col(key).alias("key")).agg(F.sum(size).cast("long").alias("bytes")).where("key is not null"), "by_key")
    count, total = by_key.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    formula = plan_sharding(count, total, hash, minishard_target, shard_target)
    if count <= 1:
        return Measured(formula, total, ())
    parts = formula.shard_bits + formula.minishard_bits
    widest = max(parts, formula.shard_bits + MORE_BITS)
    fits = F.col("bytes") <= shard_target
    leaves = with_shard(by_key.where(fits), "key", widest, 0, hash=hash).groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    # Of ``parts`` bits the upper ones are the shard's; more bits than that leave none for minishards.
    bits = F.col("bits").cast("int")
    low = F.col("shard").bitwiseAND(F.expr("shiftleft(1L, cast(greatest(bits, parts) as int)) - 1L"))
    own = leaves.withColumn("parts", F.lit(parts)).withColumn("bits", F.explode(F.sequence(F.lit(formula.shard_bits), F.lit(widest))))
    own = own.select("bits", F.call_function("shiftrightunsigned", low, F.greatest(F.lit(parts) - bits, F.lit(0))).alias("own"), "bytes")
    sums = own.groupBy("bits", "own").agg(F.sum("bytes").alias("bytes")).groupBy("bits").agg(F.max("bytes").alias("largest")).orderBy("bits")
    found = [(r["bits"], r["largest"]) for r in sums.collect()] or [(formula.shard_bits, 0)]  # a row for each width
    bits, largest = next((f for f in found if f[1] <= shard_target), found[-1])
    hot = by_key.where(~fits).orderBy(F.desc("bytes"), "key").limit(HOT_KEYS).collect()
    return Measured(ShardingSpec(bits, max(0, parts - bits), 0, hash), largest, tuple((r["key"], r["bytes"]) for r in hot))
