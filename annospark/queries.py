"""Queries over the given tables, one for each operator or two, and DuckDB SQL for each.

The tables hold no annotations, so these are derived: points from ``events``, lines
from each point to one nearby, polylines from ``embeddings``, relations from the
orders' parts, enums from ``part`` and ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.config import DataConfig, PropertySpec, Relationship, ShardingSpec
from annospark.functions import values as V
from annospark.functions.bits import cell_grid, morton, shard_hex, with_murmur, with_shard
from annospark.functions.geometry import Box, bounds_of, cell_volume, contains, convert, in_bounds, segment_meets
from annospark.lineage import cut, new_folder
from annospark.operators import checks, encode, octree, splits, zones
from annospark.operators.indexes import id_index, related, relation_index, spatial_index
from annospark.operators.sample import split_sample
from annospark.plans.build import info, plan
from annospark.plans.lookup import box_query, lookup_id, lookup_relation
from annospark.plans.sharding import plan_measured, plan_sharding, planned
from annospark.sources import shards
from annospark.sources.rows import index_rows
from annospark.sources.rows import rows_between as rows_of
from annospark.sources.tables import union, volume_bounds
from annospark.streaming.append import Spatial, grown

#: Rows in an octree cell, level of single-level queries, and bits of the shards.
CELL_ROWS, LEVEL = 200, 4
BY_ID, BY_RELATION, BY_CELL = ShardingSpec(5, 4), ShardingSpec(4, 3), ShardingSpec(4, 3)
#: Boxes of the predicates' queries, in the units of the points and of the polylines.
BOX, SMALL_BOX = Box((20.0, 50.0, 100_000.0), (90.0, 300.0, 1_500_000.0)), Box((-0.1, -0.1, -0.1), (0.1, 0.1, 0.1))
TYPES = (("STANDARD", 1), ("ECONOMY", 2), ("MEDIUM", 3), ("PROMO", 4), ("LARGE", 5))
EVENTS = (("view", 10), ("click", 11), ("signup", 12), ("purchase", 13))
SPLIT, ROW_BYTES = 7000, 149
#: Rows, about, that one task gathers by order, whatever the number of all rows.
TASK_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, points, event_type``: one point an event."""
    at = F.struct(
        F.col("user_id").cast("double").alias("x"), F.col("value").alias("y"),
        F.expr("cast(timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', cast(ts as timestamp_ntz)) as double)").alias("z"),
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.array(at).alias("points"), "event_type", "user_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, points, ...``: from each event's point to one nearby."""
    p = F.col("points")[0]
    end = F.struct((p["x"] + F.col("id") % 7).alias("x"), (p["y"] + F.col("id") % 5).alias("y"), (p["z"] + F.col("id") % 3600).alias("z"))
    return points(spark, sf_dir).withColumn("points", F.array(p, end))


def polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, points``: 21 points from the first 63 numbers of each embedding."""
    e = F.col("embedding")
    point = lambda i: F.struct(*(F.get(e, i * 3 + k).cast("double").alias(a) for k, a in enumerate("xyz")))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.transform(F.sequence(F.lit(0), F.lit(20)), point).alias("points"))


def flat(df: DataFrame, n: int = 1) -> list:
    return [F.col("points")[k][a].alias(f"{a}{k}") for k in range(n) for a in "xyz"]


def orders_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, relations``: an order and the parts in it."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_partkey")
    # Sets and what follows by order stay in these partitions, so a task's memory doesn't grow with the table.
    rows = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS)), "id")
    parts = rows.groupBy("id").agg(F.collect_set("l_partkey").alias("parts"))
    return parts.select("id", F.create_map(F.lit("part"), F.array_sort("parts")).alias("relations"))


CONFIG = DataConfig(
    (), "id", "LINE", (), (PropertySpec("kind", "uint8", "kind"), PropertySpec("user", "int32", "user")), (Relationship("User of Event", "user_id"),), {"x": [4, "nm"], "y": [4, "nm"], "z": [40, "nm"]}
)
USER_KEY = CONFIG.relations[0].key


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with properties ``kind, user`` and the relation to their user."""
    kind = V.enum_value(F.col("event_type"), *map(list, zip(*EVENTS, strict=True)), 0)
    user = F.col("user_id").cast("bigint")
    return lines(spark, sf_dir).select(
        "id", "points", F.struct(kind.cast("bigint").alias("kind"), user.alias("user")).alias("properties"), F.create_map(F.lit(USER_KEY), F.array(user)).alias("relations")
    )


# ---- hashing, shards, splits


def shard_histogram_identity(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return with_shard(keys, "o_orderkey", 5, 4, hash="identity").groupBy("shard", "minishard").agg(F.count("*").alias("entries"))


def shard_histogram_murmur(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return with_shard(keys, "o_orderkey", 5, 4).groupBy("shard", "minishard").agg(F.count("*").alias("entries"))


def murmur_hash(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return with_murmur(keys, "o_orderkey").select("o_orderkey", F.lpad(F.lower(F.hex("hash")), 16, "0").alias("hash"))


def shard_worker_assignment(spark, sf_dir):
    shards = with_shard(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 10, 2).select("shard").distinct()
    name = shard_hex(F.col("shard"), 10)
    return shards.select("shard", name.alias("name"), splits.worker_of(F.col("shard"), 32).alias("worker"), F.array_join(splits.hex_suffixes(name), ",").alias("names"))


def split_ranges(spark, sf_dir):
    size, _ = splits.split_sizes(n := table(spark, sf_dir, "lineitem").count(), SPLIT)
    return splits.split_ranges(spark, n, size)


def split_sizes(spark, sf_dir):
    """Rows that fall into each split by their place in the order of the keys."""
    rows = splits.number_rows(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "place", 0)
    split = (F.floor(F.col("place") / 1000) + 1).alias("split")
    return rows.groupBy(split).agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def synth_id(spark, sf_dir):
    return splits.number_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"])


def row_range(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()
    return splits.rows_between(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], n // 4, n // 2)


def csv_row_range(spark, sf_dir):
    """The second quarter of the orders as CSV files that are sorted by key, read by an index of the files' blocks."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folder = f"{new_folder(spark)}/orders"
    rows.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey").write.csv(folder, header=True)
    index = index_rows(spark, folder, rows.schema, 1 << 16)
    return rows_of(index, index.rows // 4, index.rows // 2)


def sharding_spec_levels(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").count()
    return planned(spark, n * 5000, n * 5000 * ROW_BYTES)


MEASURED = {"minishard_target": 20, "shard_target": 60_000}


def sharding_measured(spark, sf_dir):
    """Sharding of a relation to suppliers, every tenth of whose lines is said to be very long, by its measured sizes."""
    size = F.when(F.col("l_partkey") % 10 == 0, 20 * ROW_BYTES).otherwise(ROW_BYTES)
    made = plan_measured(table(spark, sf_dir, "lineitem"), "l_partkey", size, **MEASURED)
    told = [(made.spec.shard_bits, made.spec.minishard_bits, made.largest, len(made.hot))]
    return spark.createDataFrame(told, "shard_bits int, minishard_bits int, largest long, hot int")


def union_splits(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return union([rows.where(F.col("o_orderkey") % 3 == k) for k in range(3)])


def sample_rows(spark, sf_dir):
    """Whether each order is in a sample of 500."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    taken, others = split_sample(rows, "o_orderkey", 500)
    return taken.withColumn("taken", F.lit(True)).unionByName(others.withColumn("taken", F.lit(False)))


# ---- aggregates and checks


def bounds(spark, sf_dir):
    return lines(spark, sf_dir).agg(*bounds_of("points"))


def duplicate_ids(spark, sf_dir):
    return checks.duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def bounds_audit(spark, sf_dir):
    return checks.outside(lines(spark, sf_dir), BOX).select("id")


def outside_with_nulls(spark, sf_dir):
    """The same where every seventh line has no points, and every eleventh null ones."""
    rows = lines(spark, sf_dir)
    none = F.when(F.col("id") % 7 == 0, F.slice("points", 1, 0)).when(F.col("id") % 11 != 0, F.col("points"))
    return checks.outside(rows.withColumn("points", none), BOX).select("id")


def location_check(spark, sf_dir):
    return checks.misplaced(lines(spark, sf_dir), "LINE", BOX).select("id")


def density_check(spark, sf_dir):
    p = points(spark, sf_dir)
    box = volume_bounds(p)
    out = checks.density(octree.build(p, box, CELL_ROWS), cell_volume(box, 0, (4, 4, 40)), 0.5, 3)
    return out.select(F.col("level").cast("int"), "cx", "cy", "cz", "rows", "verdict")


# ---- enums, relations, values


def enum_encode(spark, sf_dir):
    spec = PropertySpec("type", "int32", "p_type", *zip(*((v, k) for k, v in TYPES), strict=True)).with_null()
    value = V.enum_value(F.col("p_type"), list(spec.enum_labels), list(spec.enum_values), spec.missing)
    return table(spark, sf_dir, "part").select("p_partkey", "p_type", value.alias("value"))


def missing_enum_labels(spark, sf_dir):
    return checks.undeclared(table(spark, sf_dir, "events"), "event_type", [k for k, _ in EVENTS])


def relation_coerce(spark, sf_dir):
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    field = F.when(F.col("o_orderkey") % 4 == 0, key).when(F.col("o_orderkey") % 4 == 1, F.concat_ws(",", key, cust)).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("["), key, F.lit(", "), cust, F.lit("]")))
    ids = V.relation_ids(field.otherwise(F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(ids).alias("n"), F.array_join(ids, ",").alias("ids"))


def relation_key(spark, sf_dir):
    label = F.concat_ws("  ", "p_name", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", V.relation_key(label).alias("key"))


def relation_explode_group(spark, sf_dir):
    index = relation_index(orders_of_parts(spark, sf_dir), BY_RELATION)
    return related(index).select("relation", "rel_id", "slice", F.size("ids").alias("n"), F.array_join("ids", ",").alias("ids"))


def relation_enum_fallback(spark, sf_dir):
    labels, numbers = map(list, zip(*EVENTS, strict=True))
    ids = V.relation_ids_or_enum(F.col("event_type"), labels, numbers)
    return table(spark, sf_dir, "events").select(F.explode_outer(ids).alias("rel_id")).groupBy("rel_id").agg(F.count("*").alias("rows"))


def hex_colour(spark, sf_dir):
    text = F.concat(F.lit("#"), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8))
    rgba = V.colour(text, 4)
    return table(spark, sf_dir, "part").select("p_partkey", *(rgba[i].cast("int").alias(n) for i, n in enumerate(("red", "green", "blue", "alpha"))))


def polyline_vector(spark, sf_dir):
    step = V.mean_step(F.col("points"))
    return polylines(spark, sf_dir).select("id", *(F.round(step[a], 9).alias(a) for a in "xyz"))


def point_list_parse(spark, sf_dir):
    again = V.parse_points(V.format_points(F.col("points")))
    return points(spark, sf_dir).withColumn("points", again).select("id", *flat(None))


# ---- geometry and cells


def point_in_box(spark, sf_dir):
    return points(spark, sf_dir).where(contains(F.col("points")[0], BOX)).select("id")


def segment_intersects_box(spark, sf_dir):
    return lines(spark, sf_dir).where(segment_meets(F.col("points")[0], F.col("points")[1], BOX)).select("id")


def polyline_in_bounds(spark, sf_dir):
    p = F.col("points")
    return polylines(spark, sf_dir).select("id", in_bounds(p, SMALL_BOX).alias("meets"), in_bounds(p, SMALL_BOX, strict=True).alias("inside"))


def convert_coordinates(spark, sf_dir):
    return points(spark, sf_dir).withColumn("points", convert(F.col("points"), (4, 4, 40), (1000, 1000, 1000))).select("id", *flat(None))


def octree_cell_by_level(spark, sf_dir):
    p = points(spark, sf_dir)
    cell = octree.cell_at(F.col("points")[0], volume_bounds(p), LEVEL)
    return p.select("id", cell.alias("c")).select("id", "c.*")


def morton_cells(spark, sf_dir):
    cells = octree_cell_by_level(spark, sf_dir)
    return cells.select("id", morton(F.col("cx"), F.col("cy"), F.col("cz"), cell_grid(LEVEL)).alias("morton"))


def cell_shard_hex(spark, sf_dir):
    cells = with_shard(morton_cells(spark, sf_dir).select("morton").distinct(), "morton", BY_CELL.shard_bits, BY_CELL.minishard_bits)
    return cells.select("morton", "shard", "minishard", shard_hex(F.col("shard"), BY_CELL.shard_bits).alias("name"))


def octree_points(spark, sf_dir):
    p = points(spark, sf_dir)
    return octree.build(p, volume_bounds(p), CELL_ROWS)


def octree_lines(spark, sf_dir):
    p = lines(spark, sf_dir)
    return octree.build(p, volume_bounds(p), CELL_ROWS)


def octree_grown(spark, sf_dir):
    """The same octree, grown by five batches of events."""
    p = points(spark, sf_dir).select("id", "points")
    settings = Spatial(volume_bounds(p), (BY_CELL,) * 8, CELL_ROWS, 8)
    index = grown(spark, [p.where(F.pmod("id", F.lit(5)) == k) for k in range(5)], f"{new_folder(spark)}/spatial", settings)
    return index.select(F.col("level").cast("int").alias("level"), "cx", "cy", "cz", "id", "place")


def octree_counts(spark, sf_dir):
    return octree.counts(octree_lines(spark, sf_dir))


# ---- indices and their queries


def lookup_id_query(spark, sf_dir):
    index = cut(id_index(points(spark, sf_dir), BY_ID), "by_id")
    return lookup_id(index, [7, 63, 99, 10**12], BY_ID).select("id", "shard", "minishard", "shard_hex")


def lookup_relation_query(spark, sf_dir):
    index = cut(relation_index(orders_of_parts(spark, sf_dir), BY_RELATION), "relation")
    return lookup_relation(index, "part", [5, 77, 150], BY_RELATION).select("rel_id", "id")


def written_index(rows, box, crossing=False):
    """A spatial index, written by level and shard."""
    index = spatial_index(rows, box, [BY_CELL] * 8, CELL_ROWS, 8, crossing=crossing)
    return cut(index.repartition("level", "shard"), "spatial", "level", "shard")


def box_query_query(spark, sf_dir):
    p = points(spark, sf_dir)
    box = volume_bounds(p)
    return box_query(written_index(p, box), BOX, box, 2, [BY_CELL] * 8).select("id", "level")


def box_query_lines(spark, sf_dir):
    """All lines that meet the box, from an index of the cells that they cross."""
    rows = lines(spark, sf_dir)
    box = volume_bounds(rows)
    return box_query(written_index(rows, box, True), BOX, box, 7, [BY_CELL] * 8).select("id")


def zone_box(spark, sf_dir):
    """The lines that meet the box, from clustered files of which only some are opened."""
    rows, folder = lines(spark, sf_dir).select("id", "points"), new_folder(spark)
    zones.write_zones(rows, folder, volume_bounds(rows), 500)
    return zones.read_box(spark, folder, BOX).select("id")


def cells_per_shard(spark, sf_dir):
    p = points(spark, sf_dir)
    index = spatial_index(p, volume_bounds(p), [BY_CELL] * 8, CELL_ROWS, 8)
    cells = index.select("level", "morton", "shard").distinct()
    return cells.groupBy("level", "shard").agg(F.count("*").alias("cells"))


def files(pieces: DataFrame) -> str:
    """A new folder with the files of ``pieces``, which all executors reach and which goes with the session."""
    folder = new_folder(pieces.sparkSession)
    encode.write_files(pieces, f"{folder}/shards")
    return f"{folder}/shards"


def id_shards_round_trip(spark, sf_dir):
    rows = annotations(spark, sf_dir)
    spec = plan_sharding(n := rows.count(), n * ROW_BYTES)
    back = shards.ids(spark, files(encode.id_shards(id_index(rows, spec), rows, CONFIG, spec)), CONFIG, spec)
    return back.select("id", *(c.cast("double").alias(n) for c, n in _decoded(2)), "properties.kind", "properties.user", F.col("relations")[USER_KEY][0].alias("rel_id"))


def relation_shards_round_trip(spark, sf_dir):
    rows = annotations(spark, sf_dir)
    spec = plan_sharding(rows.agg(F.approx_count_distinct("properties.user")).first()[0], rows.count() * ROW_BYTES)
    back = shards.groups(spark, files(encode.relation_shards(relation_index(rows, spec), rows, CONFIG, spec, USER_KEY)), CONFIG, spec)
    return back.select(F.col("chunk").alias("rel_id"), "place", "id", F.col("points")[0]["z"].cast("double").alias("z0"), "properties.kind")


def spatial_shards_round_trip(spark, sf_dir):
    rows = annotations(spark, sf_dir)
    n = rows.count()
    specs = list(plan(n, n * ROW_BYTES, CELL_ROWS, 8).levels)
    index = cut(spatial_index(rows, volume_bounds(rows), specs, CELL_ROWS, 8), "spatial")
    folder = files(encode.spatial_shards(index, rows, CONFIG, specs))
    levels = [r[0] for r in index.select("level").distinct().collect()]
    back = [shards.groups(spark, f"{folder}/spatial{k}", CONFIG, specs[k]).withColumn("level", F.lit(k)) for k in levels]
    return union(back).select("level", F.col("chunk").alias("morton"), "place", "id", "properties.user")


def shard_lookup(spark, sf_dir):
    """Some ids and the lines of some users, read from the shard files alone."""
    rows = annotations(spark, sf_dir)
    by_id, by_user = (plan_sharding(n, rows.count() * ROW_BYTES, minishard_target=50, shard_target=100_000) for n in (rows.count(), rows.agg(F.approx_count_distinct("properties.user")).first()[0]))
    one = shards.ids(spark, files(encode.id_shards(id_index(rows, by_id), rows, CONFIG, by_id)), CONFIG, by_id).where(F.col("id").isin(7, 63, 99, 10**12))
    many = shards.groups(spark, files(encode.relation_shards(relation_index(rows, by_user), rows, CONFIG, by_user, USER_KEY)), CONFIG, by_user).where(F.col("chunk").isin(3, 8))
    return one.select(F.lit("id").alias("index"), F.col("id").alias("key"), "id", "properties.kind").unionByName(many.select(F.lit("user").alias("index"), F.col("chunk").alias("key"), "id", "properties.kind"))


def info_json(spark, sf_dir):
    """Each level of the built index over the lines as the viewer's description has it."""
    rows = lines(spark, sf_dir)
    n, box = rows.count(), volume_bounds(rows)
    made = plan(n, n * ROW_BYTES, CELL_ROWS)
    levels = spatial_index(rows, box, list(made.levels), CELL_ROWS).agg(F.max("level")).first()[0] + 1
    told = [
        (s["key"], s["grid_shape"][0], *s["chunk_size"], s["limit"], s["sharding"]["shard_bits"], s["sharding"]["minishard_bits"])
        for s in info(CONFIG, box, made, levels)["spatial"]
    ]
    return spark.createDataFrame(told, "key string, cells int, x double, y double, z double, most int, shard_bits int, minishard_bits int")


def octree_conservation(spark, sf_dir):
    """Annotations, those in the octree, copies, and lost ones."""
    rows = lines(spark, sf_dir)
    return checks.conserved(octree.build(rows, volume_bounds(rows), CELL_ROWS), rows)


def unreadable_fields(spark, sf_dir):
    """Events whose label is no declared one where ids or labels are expected, and parts whose colour is malformed."""
    labels = [k for k, _ in EVENTS]
    events = table(spark, sf_dir, "events").where(V.bad_relation(F.col("event_type"), labels)).select(F.lit("relation").alias("field"), F.col("event_id").alias("id"))
    text = F.concat(F.lit("#"), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, (8 - F.col("p_partkey") % 3).cast("int")))
    parts = table(spark, sf_dir, "part").where(V.bad_colour(text, 4)).select(F.lit("colour").alias("field"), F.col("p_partkey").alias("id"))
    return events.unionByName(parts)


def _decoded(n: int):
    return [(F.col("points")[k][a], f"{a}{k}") for k in range(n) for a in "xyz"]


QUERIES = {
    f.__name__.removesuffix("_query"): f
    for f in (
        shard_histogram_identity, shard_histogram_murmur, murmur_hash, shard_worker_assignment, split_ranges, split_sizes, synth_id, row_range, csv_row_range,
        sharding_spec_levels, sharding_measured, union_splits, sample_rows, bounds, duplicate_ids, bounds_audit, outside_with_nulls, location_check, density_check, enum_encode, missing_enum_labels,
        relation_coerce, relation_key, relation_explode_group, relation_enum_fallback, hex_colour, polyline_vector, point_list_parse, point_in_box,
        segment_intersects_box, polyline_in_bounds, convert_coordinates, octree_cell_by_level, morton_cells, cell_shard_hex, octree_points,
        octree_lines, octree_grown, octree_counts, lookup_id_query, lookup_relation_query, box_query_lines, zone_box, cells_per_shard, id_shards_round_trip, relation_shards_round_trip,
        spatial_shards_round_trip, shard_lookup, info_json, octree_conservation, unreadable_fields,
    )
}
QUERIES["box_query"] = box_query_query

# ---- the same in DuckDB SQL

POINT_SQL = "SELECT event_id AS id, CAST(user_id AS DOUBLE) AS x, value AS y, CAST(floor(epoch(ts)) - 1704067200 AS DOUBLE) AS z, event_type, user_id FROM events"
LINE_SQL = f"SELECT id, x AS x0, y AS y0, z AS z0, x + id % 7 AS x1, y + id % 5 AS y1, z + id % 3600 AS z1, event_type, user_id FROM ({POINT_SQL})"
ENDS_SQL = f"SELECT id, x0 AS x, y0 AS y, z0 AS z FROM ({LINE_SQL}) UNION ALL SELECT id, x1, y1, z1 FROM ({LINE_SQL})"


def murmur_sql(source: str, key: str, keep: str = "") -> str:
    """``key``, ``keep`` and the unsigned ``h`` of a table; products of two 32-bit numbers fit 64 unsigned bits."""
    low = lambda x: f"(({x}) & 4294967295)"
    times = lambda x, c: low(f"({x}) * {c}::UBIGINT")
    rotate = lambda x, n: low(f"(({x}) << {n}) | (({x}) >> {32 - n})")
    also = f", {keep}" if keep else ""
    steps = [f"SELECT {key}{also}, {times(f'CAST({key} AS UBIGINT) & 4294967295', 0x239B961B)} AS a, {times(f'CAST({key} AS UBIGINT) >> 32', 0xAB0E9789)} AS b FROM ({source})"]
    step = lambda what: steps.append(f"SELECT {key}{also}, {what} FROM ({steps[-1]})")
    step(f"xor({times(rotate('a', 15), 0xAB0E9789)}, 8::UBIGINT) AS a, xor({times(rotate('b', 16), 0x38B34AE5)}, 8::UBIGINT) AS b")
    step(f"{low('a + b + 16')} AS a, b")
    step(f"a, {low('b + a')} AS b, {low('a + 8')} AS c")
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        step(", ".join(f"xor({n}, {n} >> {shift}) AS {n}" for n in "abc"))
        if factor:
            step(", ".join(f"{times(n, factor)} AS {n}" for n in "abc"))
    step(f"{low('a + b + 2 * c')} AS a, b")
    step(f"({low('b + a')} << 32) | a AS h")
    return steps[-1]


def placed_sql(source: str, key: str, spec: ShardingSpec, keep: str = "") -> str:
    also = f", {keep}" if keep else ""
    return (
        f"SELECT {key}{also}, CAST((h >> {spec.minishard_bits}) & {(1 << spec.shard_bits) - 1} AS BIGINT) AS shard,"
        f" CAST(h & {(1 << spec.minishard_bits) - 1} AS BIGINT) AS minishard FROM ({murmur_sql(source, key, keep)})"
    )


def name_sql(bits: int) -> str:
    return f"lpad(lower(hex(shard)), {max(1, -(-bits // 4))}, '0')"


def octree_sql(ends: str, levels: int = 8, k: int = CELL_ROWS) -> str:
    """``level, cx, cy, cz, id, place`` of an octree over points ``id, x, y, z``, level by level."""
    parts = [
        f"pts AS MATERIALIZED (SELECT id, x, y, z FROM ({ends}))",
        "r0 AS (SELECT DISTINCT id, md5(CAST(id AS VARCHAR)) AS key, 0 AS cx, 0 AS cy, 0 AS cz, x0, x1, y0, y1, z0, z1 FROM pts,"
        " (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM pts))",
    ]
    for n in range(levels):
        parts.append(f"h{n} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY cx, cy, cz ORDER BY key, id) AS place FROM r{n})")
        down = ", ".join(f"CAST(2 * c{a} + (p.{a} > ({a}0 + {a}1) / 2)::INT AS INT) AS c{a}" for a in "xyz")
        edges = ", ".join(f"CASE WHEN p.{a} > ({a}0 + {a}1) / 2 THEN ({a}0 + {a}1) / 2 ELSE {a}0 END AS {a}0, CASE WHEN p.{a} > ({a}0 + {a}1) / 2 THEN {a}1 ELSE ({a}0 + {a}1) / 2 END AS {a}1" for a in "xyz")
        inside = " AND ".join(f"p.{a} BETWEEN {a}0 AND {a}1" for a in "xyz")
        parts.append(f"r{n + 1} AS (SELECT DISTINCT s.id, key, {down}, {edges} FROM h{n} s JOIN pts p ON p.id = s.id WHERE place > {k} AND {inside})")
    held = " UNION ALL ".join(f"SELECT {n} AS level, cx, cy, cz, id, CAST(place AS INT) AS place FROM h{n} WHERE place <= {k}" for n in range(levels))
    return f"WITH {', '.join(parts)} {held}"


def inside_sql(box: Box, x: str = "x", y: str = "y", z: str = "z") -> str:
    return " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, lo, hi in zip((x, y, z), box.low, box.high, strict=True))


def meets_sql(box: Box, start: tuple[str, str, str], end: tuple[str, str, str]) -> str:
    enter, leave, beside = ["0.0"], ["1.0"], []
    for s, e, lo, hi in zip(start, end, box.low, box.high, strict=True):
        step = f"({e} - {s})"
        one, two = (f"(({edge}) - {s}) / (CASE WHEN abs({step}) >= 1e-9 THEN {step} END)" for edge in (lo, hi))
        enter.append(f"coalesce(least({one}, {two}), 0.0)")
        leave.append(f"coalesce(greatest({one}, {two}), 1.0)")
        beside.append(f"(abs({step}) >= 1e-9 OR {s} BETWEEN {lo} AND {hi})")
    return f"(({inside_sql(box, *start)}) OR ({inside_sql(box, *end)}) OR ({' AND '.join(beside)} AND greatest({', '.join(enter)}) <= least({', '.join(leave)})))"


def cell_sql(level: int) -> str:
    """The cell of each point by halving the bounds ``level`` times."""
    source = f"SELECT id, x, y, z, 0 AS cx, 0 AS cy, 0 AS cz, x0, x1, y0, y1, z0, z1 FROM ({POINT_SQL}), (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM ({POINT_SQL}))"
    for _ in range(level):
        cells = ", ".join(f"2 * c{a} + ({a} > ({a}0 + {a}1) / 2)::INT AS c{a}" for a in "xyz")
        edges = ", ".join(f"CASE WHEN {a} > ({a}0 + {a}1) / 2 THEN ({a}0 + {a}1) / 2 ELSE {a}0 END AS {a}0, CASE WHEN {a} > ({a}0 + {a}1) / 2 THEN {a}1 ELSE ({a}0 + {a}1) / 2 END AS {a}1" for a in "xyz")
        source = f"SELECT id, x, y, z, {cells}, {edges} FROM ({source})"
    return source


def morton_sql(level: int) -> str:
    bits = [f"((c{a}::BIGINT >> {i}) & 1) << {3 * i + k}" for i in range(level) for k, a in enumerate("xyz")]
    return " | ".join(f"({b})" for b in bits) or "0::BIGINT"


_CASES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENTS)
_LABELS = ", ".join(f"'{k}'" for k, _ in EVENTS)
_FLOATS = ", ".join(f"CAST(CAST({a}{k} AS FLOAT) AS DOUBLE) AS {a}{k}" for k in (0, 1) for a in "xyz")
_HALVINGS = "CASE WHEN {0} <= {1} THEN 0 ELSE CAST(ceil(log2(({0} + 1)::DOUBLE / ({1} + 1))) AS INT) END"
_PARTS = "SELECT DISTINCT l_orderkey AS id, l_partkey AS rel_id FROM lineitem"

ORACLE_SQL = {
    "shard_histogram_identity": "SELECT (o_orderkey >> 4) & 31 AS shard, o_orderkey & 15 AS minishard, count(*) AS entries FROM orders GROUP BY ALL",
    "shard_histogram_murmur": f"SELECT shard, minishard, count(*) AS entries FROM ({placed_sql('SELECT o_orderkey FROM orders', 'o_orderkey', BY_ID)}) GROUP BY ALL",
    "murmur_hash": f"SELECT o_orderkey, lpad(lower(hex(h)), 16, '0') AS hash FROM ({murmur_sql('SELECT o_orderkey FROM orders', 'o_orderkey')})",
    "shard_worker_assignment": f"""
        WITH s AS (SELECT DISTINCT shard, {name_sql(10)} AS name FROM ({placed_sql('SELECT o_orderkey FROM orders', 'o_orderkey', ShardingSpec(10, 2))}))
        SELECT shard, name, CAST(shard % 32 AS INT) AS worker,
               name || CASE WHEN name LIKE '0%' THEN ',' || substr(name, 2) ELSE '' END || CASE WHEN name LIKE '00%' THEN ',' || substr(name, 3) ELSE '' END AS names FROM s""",
    "split_ranges": f"""
        WITH n AS (SELECT count(*) AS n FROM lineitem)
        SELECT i + 1 AS split, i * {SPLIT} AS row_start, least((i + 1) * {SPLIT}, n) AS row_end FROM n, range((SELECT (n + {SPLIT} - 1) // {SPLIT} FROM n)) r(i)""",
    "split_sizes": """
        SELECT (place // 1000) + 1 AS split, count(*) AS rows, min(o_orderkey) AS first, max(o_orderkey) AS last
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders) GROUP BY ALL""",
    "synth_id": "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS id FROM part",
    "row_range": """
        SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
        WHERE place >= n // 4 AND place < n // 2""",
    "csv_row_range": """
        SELECT o_orderkey, o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
        WHERE place >= n // 4 AND place < n // 2""",
    "sharding_spec_levels": f"""
        WITH n AS (SELECT count(*) * 5000 AS n FROM lineitem),
             l AS (SELECT CAST(i AS INT) AS level, least(CAST(pow(8, i) AS BIGINT) * 10000, n) AS held FROM n, range(10) r(i)),
             b AS (SELECT *, held * {ROW_BYTES} AS bytes FROM l),
             s AS (SELECT *, {_HALVINGS.format('bytes', 50_000_000)} AS shard_bits, {_HALVINGS.format('held', 1000)} AS parts FROM b)
        SELECT level, held, bytes, shard_bits, greatest(parts - shard_bits, 0) AS minishard_bits FROM s""",
    "sharding_measured": f"""
        WITH p AS (SELECT l_partkey, CAST(sum(CASE WHEN l_partkey % 10 = 0 THEN 20 ELSE 1 END * {ROW_BYTES}) AS BIGINT) AS bytes FROM lineitem GROUP BY ALL),
             n AS (SELECT count(*) AS held, CAST(sum(bytes) AS BIGINT) AS bytes FROM p),
             f AS (SELECT {_HALVINGS.format('bytes', MEASURED['shard_target'])} AS shards, greatest({_HALVINGS.format('held', MEASURED['minishard_target'])}, {_HALVINGS.format('bytes', MEASURED['shard_target'])}) AS parts FROM n),
             h AS ({murmur_sql('SELECT l_partkey, bytes FROM p', 'l_partkey', 'bytes')}),
             c AS (SELECT CAST(shards + i AS INT) AS bits, CAST(parts AS INT) AS parts FROM f, range(30) r(i) WHERE shards + i <= greatest(parts, shards + 8)),
             o AS (SELECT bits, parts, (h % (1::UBIGINT << greatest(bits, parts))) // (1::UBIGINT << greatest(parts - bits, 0)) AS shard, sum(bytes) AS bytes FROM h, c WHERE bytes <= {MEASURED['shard_target']} GROUP BY ALL),
             m AS (SELECT bits, parts, CAST(max(bytes) AS BIGINT) AS largest FROM o GROUP BY ALL)
        SELECT bits AS shard_bits, greatest(parts - bits, 0) AS minishard_bits, largest, (SELECT CAST(least(count(*), 100) AS INT) FROM p WHERE bytes > {MEASURED['shard_target']}) AS hot
        FROM m WHERE bits = coalesce((SELECT min(bits) FROM m WHERE largest <= {MEASURED['shard_target']}), (SELECT max(bits) FROM m))""",
    "sample_rows": "SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 500 AS taken FROM orders",
    "union_splits": "SELECT o_orderkey, o_custkey FROM orders",
    "bounds": f"SELECT min(x) AS x_low, max(x) AS x_high, min(y) AS y_low, max(y) AS y_high, min(z) AS z_low, max(z) AS z_high FROM ({ENDS_SQL})",
    "duplicate_ids": """
        SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "bounds_audit": f"SELECT id FROM ({LINE_SQL}) WHERE NOT ({inside_sql(BOX, 'x0', 'y0', 'z0')}) AND NOT ({inside_sql(BOX, 'x1', 'y1', 'z1')})",
    "outside_with_nulls": f"SELECT id FROM ({LINE_SQL}) WHERE id % 7 = 0 OR id % 11 = 0 OR (NOT ({inside_sql(BOX, 'x0', 'y0', 'z0')}) AND NOT ({inside_sql(BOX, 'x1', 'y1', 'z1')}))",
    "location_check": f"SELECT id FROM ({LINE_SQL}) WHERE NOT (({inside_sql(BOX, 'x0', 'y0', 'z0')}) OR ({inside_sql(BOX, 'x1', 'y1', 'z1')}))",
    "density_check": f"""
        WITH o AS ({octree_sql(POINT_SQL)}), c AS (SELECT level, cx, cy, cz, count(*) AS rows FROM o GROUP BY ALL),
             v AS (SELECT (max(x) - min(x)) * 4 / 1000 * ((max(y) - min(y)) * 4 / 1000) * ((max(z) - min(z)) * 40 / 1000) * 0.5 AS most FROM ({POINT_SQL}))
        SELECT level, cx, cy, cz, rows, CASE WHEN rows > most / pow(8, level) THEN 'error' WHEN rows > 1.2 * floor(most / pow(8, level) / 3) THEN 'warning' ELSE 'ok' END AS verdict FROM c, v""",
    "enum_encode": f"SELECT p_partkey, p_type, CASE p_type {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in TYPES)} ELSE -1 END AS value FROM part",
    "missing_enum_labels": f"SELECT DISTINCT event_type AS label FROM events WHERE event_type NOT IN ({_LABELS})",
    "relation_coerce": """
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE 2 END AS n,
               CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 3 THEN NULL ELSE o_orderkey || ',' || o_custkey END AS ids FROM orders""",
    "relation_key": r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || '  ' || p_brand || '  ' || p_type), '[!-/:-@\[-`{-~]', '', 'g'), '\s+', '_', 'g') AS key FROM part",
    "relation_explode_group": f"SELECT 'part' AS relation, rel_id, 0 AS slice, CAST(count(*) AS INT) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM ({_PARTS}) GROUP BY rel_id",
    "relation_enum_fallback": f"SELECT CAST(CASE event_type {_CASES} END AS BIGINT) AS rel_id, count(*) AS rows FROM events GROUP BY ALL",
    "hex_colour": "SELECT p_partkey, " + ", ".join(f"CAST(('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), {2 * i + 1}, 2)) AS INT) AS {n}" for i, n in enumerate(("red", "green", "blue", "alpha"))) + " FROM part",
    "polyline_vector": "SELECT vec_id AS id, " + ", ".join(f"round((embedding[{61 + k}]::DOUBLE - embedding[{1 + k}]::DOUBLE) / 20, 9) AS {a}" for k, a in enumerate("xyz")) + " FROM embeddings",
    "point_list_parse": f"SELECT id, x AS x0, y AS y0, z AS z0 FROM ({POINT_SQL})",
    "point_in_box": f"SELECT id FROM ({POINT_SQL}) WHERE {inside_sql(BOX)}",
    "segment_intersects_box": f"SELECT id FROM ({LINE_SQL}) WHERE {meets_sql(BOX, ('x0', 'y0', 'z0'), ('x1', 'y1', 'z1'))}",
    "polyline_in_bounds": f"""
        WITH p AS (SELECT vec_id AS id, n, embedding[3 * n + 1]::DOUBLE AS x, embedding[3 * n + 2]::DOUBLE AS y, embedding[3 * n + 3]::DOUBLE AS z FROM embeddings, range(21) r(n)),
             s AS (SELECT a.id, a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1 FROM p a JOIN p b ON a.id = b.id AND b.n = a.n + 1)
        SELECT id, bool_or(meets) AS meets, (SELECT bool_and({inside_sql(SMALL_BOX)}) FROM p WHERE p.id = m.id) AS inside
        FROM (SELECT id, {meets_sql(SMALL_BOX, ('x0', 'y0', 'z0'), ('x1', 'y1', 'z1'))} AS meets FROM s) m GROUP BY id""",
    "convert_coordinates": f"SELECT id, round(x * 4 / 1000, 10) AS x0, round(y * 4 / 1000, 10) AS y0, round(z * 40 / 1000, 10) AS z0 FROM ({POINT_SQL})",
    "octree_cell_by_level": f"SELECT id, cx, cy, cz FROM ({cell_sql(LEVEL)})",
    "morton_cells": f"SELECT id, {morton_sql(LEVEL)} AS morton FROM ({cell_sql(LEVEL)})",
    "cell_shard_hex": f"""
        SELECT morton, shard, minishard, {name_sql(BY_CELL.shard_bits)} AS name
        FROM ({placed_sql(f'SELECT DISTINCT {morton_sql(LEVEL)} AS morton FROM ({cell_sql(LEVEL)})', 'morton', BY_CELL)})""",
    "octree_points": octree_sql(POINT_SQL),
    "octree_lines": octree_sql(ENDS_SQL),
    "octree_grown": octree_sql(POINT_SQL),
    "octree_counts": f"WITH o AS ({octree_sql(ENDS_SQL)}) SELECT level, count(*) AS cells, CAST(sum(n) AS BIGINT) AS held FROM (SELECT level, cx, cy, cz, count(*) AS n FROM o GROUP BY ALL) GROUP BY level",
    "lookup_id": f"SELECT id, shard, minishard, {name_sql(BY_ID.shard_bits)} AS shard_hex FROM ({placed_sql('SELECT event_id AS id FROM events WHERE event_id IN (7, 63, 99, 1000000000000)', 'id', BY_ID)})",
    "lookup_relation": f"SELECT rel_id, id FROM ({_PARTS}) WHERE rel_id IN (5, 77, 150)",
    "box_query": f"WITH o AS ({octree_sql(POINT_SQL)}) SELECT o.id, o.level FROM o JOIN ({POINT_SQL}) p ON p.id = o.id WHERE level <= 2 AND {inside_sql(BOX)}",
    "zone_box": f"SELECT id FROM ({LINE_SQL}) WHERE {meets_sql(BOX, ('x0', 'y0', 'z0'), ('x1', 'y1', 'z1'))}",
    "box_query_lines": f"SELECT id FROM ({LINE_SQL}) WHERE {meets_sql(BOX, ('x0', 'y0', 'z0'), ('x1', 'y1', 'z1'))}",
    "cells_per_shard": "WITH o AS ("
    + octree_sql(POINT_SQL)
    + "), c AS (SELECT DISTINCT level, "
    + "CASE level "
    + " ".join(f"WHEN {n} THEN {morton_sql(n)}" for n in range(8))
    + f" END AS morton FROM o) SELECT level, shard, count(*) AS cells FROM ({placed_sql('SELECT morton, level FROM c', 'morton', BY_CELL, 'level')}) GROUP BY ALL",
    "id_shards_round_trip": f"SELECT id, {_FLOATS}, CAST(CASE event_type {_CASES} ELSE 0 END AS BIGINT) AS kind, user_id AS user, user_id AS rel_id FROM ({LINE_SQL})",
    "relation_shards_round_trip": f"""
        SELECT user_id AS rel_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY id) AS INT) AS place, id, CAST(CAST(z0 AS FLOAT) AS DOUBLE) AS z0,
               CAST(CASE event_type {_CASES} ELSE 0 END AS BIGINT) AS kind FROM ({LINE_SQL})""",
    "spatial_shards_round_trip": f"WITH o AS ({octree_sql(ENDS_SQL)}) SELECT level, CASE level {' '.join(f'WHEN {n} THEN {morton_sql(n)}' for n in range(8))} END AS morton, place, o.id, user_id AS user FROM o JOIN events ON event_id = o.id",
    "shard_lookup": f"""
        WITH k AS (SELECT id, user_id, CAST(CASE event_type {_CASES} ELSE 0 END AS BIGINT) AS kind FROM ({LINE_SQL}))
        SELECT 'id' AS index, id AS key, id, kind FROM k WHERE id IN (7, 63, 99, 1000000000000) UNION ALL SELECT 'user', user_id, id, kind FROM k WHERE user_id IN (3, 8)""",
    "info_json": f"""
        WITH o AS ({octree_sql(ENDS_SQL)}), n AS (SELECT count(*) AS n FROM events),
             e AS (SELECT max(x) - min(x) AS x, max(y) - min(y) AS y, max(z) - min(z) AS z FROM ({ENDS_SQL})),
             l AS (SELECT DISTINCT level, CAST(pow(2, level) AS INT) AS cells, least(CAST(pow(8, level) AS BIGINT) * {CELL_ROWS}, n) AS held FROM o, n),
             s AS (SELECT *, {_HALVINGS.format(f'(held * {ROW_BYTES})', 50_000_000)} AS shard_bits, {_HALVINGS.format('held', 1000)} AS parts FROM l)
        SELECT 'spatial' || level AS key, cells, x / cells AS x, y / cells AS y, z / cells AS z, {CELL_ROWS} AS most, shard_bits, greatest(parts - shard_bits, 0) AS minishard_bits FROM s, e""",
    "octree_conservation": f"""
        WITH o AS ({octree_sql(ENDS_SQL)}), c AS (SELECT id, count(*) AS entries FROM o GROUP BY id)
        SELECT (SELECT count(*) FROM events) AS rows, count(*) AS held, CAST(sum(entries - 1) AS BIGINT) AS copies, (SELECT count(*) FROM events) - count(*) AS lost FROM c""",
    "unreadable_fields": f"""
        SELECT 'relation' AS field, event_id AS id FROM events WHERE event_type NOT IN ({_LABELS})
        UNION ALL SELECT 'colour', p_partkey FROM part WHERE p_partkey % 3 <> 0""",
}
