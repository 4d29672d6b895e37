import pytest
from pyspark.sql import functions as F

from annospark.config import DataConfig, PropertySpec, ShardingSpec, free_name, merged
from annospark.functions.bits import cell_grid, morton, place, unsigned, with_murmur, with_shard
from annospark.functions.values import duration, key_of
from annospark.operators import splits
from annospark.plans.lookup import child_range
from annospark.plans.sharding import plan_level, plan_sharding

MURMUR = {
    0: 5148371408780832321, 1: 16770674756601302682, 7: 15959679207757848918, 63: 205449246968267038,
    2108: 12362251378403072628, 864691135568681196: 866836499940242526,
}


def test_murmur_golden_values(spark):
    keys = spark.createDataFrame([(k,) for k in MURMUR], "id long")
    got = with_murmur(keys, "id").select("id", unsigned(F.col("hash")).alias("h")).collect()
    assert {r["id"]: int(r["h"]) for r in got} == MURMUR


def test_place_on_the_driver_is_that_of_the_column(spark):
    keys = [0, 1, 63, -1, 2**63 - 1, -(2**63), 864691135568681196]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    for kind in ("murmurhash3_x86_128", "identity"):
        for row in with_shard(df, "id", 7, 5, 2, kind).collect():
            assert (row["shard"], row["minishard"]) == place(row["id"], 7, 5, 2, kind)
    with pytest.raises(ValueError):
        with_shard(df, "id", 1, 1, hash="sha")


def test_morton_of_all_cells_of_two_levels_is_a_permutation(spark):
    axis = F.explode(F.sequence(F.lit(0), F.lit(3)))
    cells = spark.range(1).select(axis.alias("x")).select("x", axis.alias("y")).select("x", "y", axis.alias("z"))
    rows = cells.select("x", "y", "z", morton(F.col("x"), F.col("y"), F.col("z"), cell_grid(2)).alias("m")).collect()
    assert sorted(r["m"] for r in rows) == list(range(64))
    spread = lambda v: sum((v >> i & 1) << 3 * i for i in range(2))
    assert all(r["m"] == spread(r["x"]) | spread(r["y"]) << 1 | spread(r["z"]) << 2 for r in rows)


def test_planner_golden_values():
    sizes = [(2108, 313245), (24426, 3645906), (247392, 37056517), (2558733, 382826433), (25632771, 3833155147), (103980993, 15550001077), (337312429, 50345534259)]
    bits = [(s.shard_bits, s.minishard_bits) for s in (plan_sharding(*x) for x in sizes)]
    assert bits == [(0, 2), (0, 5), (0, 8), (3, 9), (7, 8), (9, 8), (10, 9)]
    levels = [plan_level(k, *sizes[-1]) for k in range(10)]
    assert [(s.shard_bits, s.minishard_bits) for s in levels[:6]] == [(0, 4), (0, 7), (1, 9), (4, 9), (7, 9), (10, 9)]
    assert plan_sharding(1, 10) == ShardingSpec(0, 0)


def test_split_sizes_and_ranges(spark):
    assert splits.split_sizes(10, 4) == (4, 3) and splits.split_sizes(10, -4) == (3, 4)
    got = [tuple(r) for r in splits.split_ranges(spark, 10, 4).orderBy("split").collect()]
    assert got == [(1, 0, 4), (2, 4, 8), (3, 8, 10)]
    assert splits.split_ranges(spark, 10, 4, limit=4).count() == 1
    with pytest.raises(ValueError):
        splits.split_sizes(10, 0)


def test_enums_and_names():
    spec = PropertySpec("a", "int8", "a", (-1, 3), ("x", "y")).with_null()
    assert (spec.enum_labels, spec.enum_values, spec.missing) == (("x", "y", "NULL"), (-1, 3, -2), -2)
    for bad in ({"id": "A"}, {"type": "vector"}, {"enum_values": (1,)}, {"type": "rgb", "enum_values": (1,), "enum_labels": ("x",)}):
        with pytest.raises(ValueError):
            PropertySpec(**{"id": "a", "type": "int8", "column": "a"} | bad)
    assert key_of("Pre-synaptic  Cell!") == "presynaptic_cell" and free_name("id", ["id", "id_1"]) == "id_2"
    assert merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert child_range(1, 2, 4, 8) == (2, 5) and duration(0.5) == "500ms" and duration(3725) == "1h 2m 5s"
    with pytest.raises(ValueError):
        ShardingSpec.from_json(ShardingSpec(1, 1).as_json() | {"data_encoding": "gzip"})


CONFIG = {
    "columns": ["id", "ax", "ay", "az", "bx", "by", "bz", "kind", "rel", "col"], "id_column": "id", "dimensions": {"x": [4, "nm"], "y": [4, "nm"], "z": [40, "nm"]},
    "spatial_pt_columns": {"a": {"x": "ax", "y": "ay", "z": "az"}, "b": {"x": "bx", "y": "by", "z": "bz"}},
    "line_annotation_config": {"start_pt_column_label": "a", "end_pt_column_label": "b"},
    "properties": {"Kind Of": {"id": "kind", "type": "int8", "enum_values": [5, 6], "enum_labels": ["p", "q"]}, "tint": {"id": "col", "type": "rgb"}, "way": {"id": None, "type": "vector"}},
    "relations": {"Cell A": {"id": "rel"}, "Kind": {"id": "kind"}},
}


def test_config_from_json():
    c = DataConfig.from_json(CONFIG, {"volume_bounds": [[0, 0, 0], [9, 9, 9]]})
    assert c.annotation_type == "LINE" and c.bounds == ((0, 0, 0), (9, 9, 9)) and c.resolution == (4, 4, 40)
    assert [p.id for p in c.properties] == ["kind_of", "tint", "way_x", "way_y", "way_z"] and c.properties[0].missing == -1
    with pytest.raises(ValueError):
        DataConfig.from_json(CONFIG, {"relations": {"cell a!": {"id": "rel"}}})


def test_measured_shards_are_within_their_target_and_hot_keys_are_named(spark):
    from pyspark.sql import functions as F

    from annospark.functions.bits import with_shard
    from annospark.plans.sharding import plan_measured, plan_sharding

    rows = spark.range(4000).select((F.col("id") % 997).alias("key"), F.when(F.col("id") % 50 == 0, 900).otherwise(10).alias("bytes"))
    rows = rows.unionByName(spark.range(600).select(F.lit(10_000_000).cast("long").alias("key"), F.lit(100).alias("bytes")))
    total = rows.agg(F.sum("bytes")).first()[0]
    plain, made = plan_sharding(998, total, minishard_target=10, shard_target=4000), plan_measured(rows, "key", F.col("bytes"), minishard_target=10, shard_target=4000)
    assert made.hot == ((10_000_000, 60_000),) and made.largest <= 4000 and made.spec.shard_bits >= plain.shard_bits
    sizes = lambda spec: with_shard(rows.where("key < 1000"), "key", spec.shard_bits, spec.minishard_bits).groupBy("shard").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0]
    assert sizes(made.spec) == made.largest and sizes(plain) > 4000
    assert plan_measured(rows.limit(0), "key", F.col("bytes")).spec == ShardingSpec(0, 0)
    even = spark.range(70_000).withColumn("bytes", F.lit(1000))
    assert plan_measured(even, "id", F.col("bytes")).spec == plan_sharding(70_000, 70_000_000)
