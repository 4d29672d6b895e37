"""Boxes over lines and polylines, awkward geometry, and what a box query reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.config import DataConfig, ShardingSpec
from annospark.functions.geometry import Box, in_bounds
from annospark.lineage import cut
from annospark.operators import checks, octree, zones
from annospark.operators.indexes import spatial_index
from annospark.plans import build, lookup
from annospark.sources.tables import volume_bounds
from annospark.streaming import append

SCHEMA = "id long, points array<struct<x:double,y:double,z:double>>"
SPECS = [ShardingSpec(2, 1)] * 8


def table(spark, rows):
    return spark.createDataFrame([(i, None if p is None else [tuple(map(float, q)) for q in p]) for i, p in rows], SCHEMA)


def random_lines(seed, n, points, step):
    """Paths on a grid of quarters, so that many run along faces of cells, and some at odd places."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        at, path = rng.integers(0, 33, 3) / 4, []
        for _ in range(points):
            path.append(at.tolist())
            move = rng.integers(-step, step + 1, 3) / 4 * (rng.random(3) < 0.7) + (rng.normal(0, 0.3, 3) if i % 3 == 0 else 0)
            at = np.clip(at + move, 0, 8)
        rows.append((i, path))
    return rows + [(n, [[0, 0, 0], [8, 8, 8]]), (n + 1, [[0, 8, 0]] * points), (n + 2, [[0, 4, 4], [8, 4, 4]])]


@pytest.mark.parametrize(("points", "step", "cell_rows"), [(2, 20, 5), (6, 6, 4)])
def test_a_crossing_index_answers_boxes_like_a_scan(spark, points, step, cell_rows):
    rows = table(spark, random_lines(points + step, 60, points, step)).cache()
    bounds = volume_bounds(rows)
    index = cut(spatial_index(rows, bounds, SPECS, cell_rows, 8, crossing=True), "spatial", "level", "shard")
    held = {r["id"] for r in index.select("id").distinct().collect()}
    assert held == {r["id"] for r in rows.collect()} and index.groupBy("id", "level", "morton").count().where("count > 1").count() == 0
    rng = np.random.default_rng(1)
    boxes = [Box((4.0, 4.0, 4.0), (4.0, 4.0, 4.0)), Box((3.9, 3.9, 3.9), (4.1, 4.1, 4.1)), Box((0.0,) * 3, (8.0,) * 3), Box((2.0, 2.0, 2.0), (3.0, 3.0, 3.0))]
    boxes += [Box(tuple(low), tuple(low + rng.choice([0, 0.25, 1, 2.7], 3))) for low in rng.integers(0, 29, (3, 3)) / 4]
    for box in boxes:
        want = sorted(r["id"] for r in rows.where(in_bounds(F.col("points"), box)).collect())
        assert sorted(r["id"] for r in lookup.box_query(index, box, bounds, 7, SPECS).collect()) == want, box


def test_a_diagonal_is_lost_without_crossing_and_found_with_it(spark):
    rows = table(spark, [(0, [[0, 0, 0], [8, 8, 8]]), *((i, [[i / 10, 0, 0], [i / 10, 0.1, 0]]) for i in range(1, 20))])
    bounds, box = volume_bounds(rows), Box((3.9, 3.9, 3.9), (3.95, 3.95, 3.95))
    found = lambda crossing: {r["id"] for r in lookup.box_query(cut(spatial_index(rows, bounds, SPECS, 1, 8, crossing=crossing), "s", "level", "shard"), box, bounds, 7, SPECS).collect()}
    assert found(True) == {0}


def test_points_go_to_one_cell_of_either_kind_of_index(spark):
    rng = np.random.default_rng(2)
    rows = table(spark, [(i, [rng.random(3).tolist()]) for i in range(150)])
    bounds = volume_bounds(rows)
    plain, crossing = (octree.build(rows, bounds, 10, 8, crossing=c).collect() for c in (False, True))
    assert sorted(map(tuple, plain)) == sorted(map(tuple, crossing)) and len(plain) == 150


def test_null_and_empty_geometry_and_null_ids_raise(spark):
    good = [(i, [[i, i, i], [i + 1, i, i]]) for i in range(20)]
    bounds = Box((0.0,) * 3, (30.0,) * 3)
    for bad, what in (((50, None), "annotation 50"), ((51, []), "annotation 51"), ((None, [[1, 1, 1]]), "no id"), ((52, [[99, 99, 99]]), "annotation 52")):
        for crossing in (False, True):
            with pytest.raises(RuntimeError, match=what):
                octree.build(table(spark, [*good, bad]), bounds, 5, crossing=crossing)
    rows = table(spark, [*good, (50, None), (51, []), (52, [[99, 99, 99]])])
    assert {r["id"] for r in checks.outside(rows, bounds).collect()} == {50, 51, 52}
    assert {r["id"] for r in checks.misplaced(rows, "LINE", bounds).collect()} == {50, 51, 52}
    assert {r["id"] for r in rows.where(in_bounds(F.col("points"), bounds, strict=True)).collect()} == set(range(20))


def test_empty_tables_make_empty_indices(spark):
    none = spark.createDataFrame([], "id long, x double, y double, z double, kind string")
    config = DataConfig((), "id", "POINT", (("x", "y", "z"),), (), (), {})
    assert volume_bounds(table(spark, [])) == Box((0.0,) * 3, (0.0,) * 3)
    made = build.index(none, config)
    assert made.spatial.count() == made.by_id.count() == made.relation.count() == 0 and made.levels == 1
    assert lookup.box_query(made.spatial, Box((0.0,) * 3, (1.0,) * 3), made.bounds, 0, list(made.plan.levels)).count() == 0
    assert build.info(config, made.bounds, made.plan, made.levels)["spatial"][0]["chunk_size"] == [0.0] * 3


def test_a_box_query_reads_the_partitions_of_its_cells_only(spark):
    rng = np.random.default_rng(3)
    rows = table(spark, [(i, [rng.random(3).tolist()]) for i in range(400)])
    bounds = volume_bounds(rows)
    index = cut(spatial_index(rows, bounds, SPECS, 20, 8), "spatial", "level", "shard")
    plan = lookup.box_query(index, Box((0.1,) * 3, (0.2,) * 3), bounds, 3, SPECS)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "level#" in filters and "shard#" in filters and len(plan) < 20_000


@pytest.mark.parametrize("crossing", [False, True])
def test_batches_grow_the_index_that_one_build_makes(spark, tmp_path, crossing):
    rows = table(spark, random_lines(9, 90, 2, 6)).cache()
    bounds, settings = volume_bounds(rows), dict(cell_rows=15, max_levels=8)
    spatial = append.Spatial(bounds, tuple(SPECS), crossing=crossing, **settings)
    want = sorted(map(tuple, spatial_index(rows, bounds, SPECS, crossing=crossing, **settings).drop("points").collect()))
    path, batches = str(tmp_path / "spatial"), [rows.where(F.pmod("id", F.lit(3)) == k) for k in (2, 0, 1)]
    columns = ["level", "cx", "cy", "cz", "morton", "shard", "minishard", "id", "place"]
    index = append.grown(spark, [*batches, rows.limit(0), batches[1]], path, spatial)  # the last one comes twice
    assert sorted(map(tuple, index.select(columns).collect())) == want
    assert {r["id"]: r["points"] for r in index.collect()} == {r["id"]: r["points"] for r in rows.collect()}


def test_a_batch_leaves_partitions_without_changed_cells_alone(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = table(spark, [(i, [rng.random(3).tolist()]) for i in range(300)] + [(1000, [[0, 0, 0]]), (1001, [[1, 1, 1]])])
    spatial, path = append.Spatial(volume_bounds(rows), tuple([ShardingSpec(3, 0)] * 8), 20, 8), tmp_path / "spatial"
    append.append_spatial(rows, str(path), spatial)
    files = lambda: {str(f.relative_to(path)) for f in path.rglob("*.parquet")}
    before = files()
    append.append_spatial(table(spark, [(5000, [[0.9, 0.9, 0.9]])]), str(path), spatial)
    after = files()
    assert len(before & after) > len(before) / 2 and before != after
    assert spark.read.parquet(str(path)).count() == 303


def test_an_append_that_ends_halfway_is_brought_to_its_end(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(6)
    rows = table(spark, [(i, [rng.random(3).tolist()]) for i in range(60)])
    spatial, path = append.Spatial(volume_bounds(rows), tuple(SPECS), 10, 8), str(tmp_path / "spatial")
    append.append_spatial(rows.where("id < 40"), path, spatial)

    def some(spark, pending, path):
        lookup.write_index(spark.read.parquet(pending).where("level = 0"), path, "level", "shard", overwrite="dynamic")
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError, match="lost"):
        patched.setattr(append, "_put_in", some)
        append.append_spatial(rows.where("id >= 40"), path, spatial)
    append.append_spatial(rows.where("id >= 40"), path, spatial)
    want = spatial_index(rows, spatial.bounds, SPECS, 10, 8)
    same = lambda df: sorted(map(tuple, df.select("level", "morton", "id", "place").collect()))
    assert same(spark.read.parquet(path)) == same(want) and not (tmp_path / "spatial.pending").exists()


def test_a_box_opens_only_the_files_that_it_meets(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = table(spark, [(i, [(a := rng.random(3) * 100).tolist(), (a + rng.random(3)).tolist()]) for i in range(2000)] + [(5000, None), (5001, [])])
    path = str(tmp_path / "zoned")
    zones.write_zones(rows.withColumns({"code": F.lit(1), "cell": F.lit("c"), "file": F.lit("f")}), path, volume_bounds(rows), 100)
    assert spark.read.parquet(f"{path}/rows").count() == 2002 and spark.read.parquet(f"{path}/zones").count() > 15
    for box in (Box((10.0,) * 3, (25.0,) * 3), Box((50.0,) * 3, (50.1,) * 3), Box((-9.0,) * 3, (-1.0,) * 3)):
        found = zones.read_box(spark, path, box)
        assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in rows.where(in_bounds(F.col("points"), box)).collect())
        assert found.columns == ["id", "points", "code", "cell", "file"] and len(found.inputFiles()) < 8
    none = str(tmp_path / "none")
    zones.write_zones(rows.limit(0), none, Box((0.0,) * 3, (1.0,) * 3))
    assert zones.read_box(spark, none, Box((0.0,) * 3, (1.0,) * 3)).count() == 0


def test_tables_are_sent_to_all_tasks_by_rows_and_bytes(spark, monkeypatch):
    from annospark import skew

    rows = cut(spark.range(1000).select("id", F.expr("sequence(1, 50)").alias("list")), "rows")
    sent = lambda df, n=1000: "ResolvedHint" in skew.if_few(df, n)._jdf.queryExecution().analyzed().toString()
    assert sent(rows) and not sent(rows, skew.SENT_ROWS + 1)
    monkeypatch.setattr(skew, "SENT_BYTES", 100)
    assert not sent(rows) and sent(spark.range(5), 5)


def test_rows_on_their_way_down_are_narrow_and_go_where_halvings_send_them(spark):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.integers(0, 17, (int(rng.integers(1, 4)), 3)) / 2).tolist()) for i in range(60)] + [(60, [[4, 4, 4], [4.5, 4, 4]])]
    bounds, depth = Box((0.0,) * 3, (8.0,) * 3), 3
    told = octree.paths(table(spark, rows).withColumn("cell", F.lit(0).cast("long")), bounds, 0, depth)
    assert [c for c, _ in told.dtypes] == ["id", "rank", "cell", "split"]

    def visited(points, low, high, level, cell):
        if level == 0:
            yield depth, cell
            return
        yield depth - level, cell
        middle = [(a + b) / 2 for a, b in zip(low, high, strict=True)]
        inside = [p for p in points if all(a <= v <= b for a, v, b in zip(low, p, high, strict=True))]
        for kid in sorted({tuple(int(v > m) for v, m in zip(p, middle, strict=True)) for p in inside}):
            side = [(m, b) if k else (a, m) for k, a, m, b in zip(kid, low, middle, high, strict=True)]
            yield from visited(points, *zip(*side, strict=True), level - 1, tuple(2 * c + k for c, k in zip(cell, kid, strict=True)))

    want = sorted((i, level, *cell) for i, points in rows for level, cell in visited(points, bounds.low, bounds.high, depth, (0, 0, 0)))
    got = []
    for level in range(depth + 1):
        at = told.where(F.col("split") <= level).withColumn("at", octree.above(F.col("cell"), depth - level)).select("id", *octree.unpacked("at"))
        got += [(r[0], level, *r[1:]) for r in at.collect()]
    assert sorted(got) == want


def test_the_code_that_clusters_files_is_the_morton_code_without_loops(spark):
    from annospark.functions.bits import cell_grid, morton

    rng = np.random.default_rng(12)
    rows = table(spark, [(i, [(rng.integers(0, 4096, 3) + 0.5).tolist()]) for i in range(200)] + [(300, [[4096, 0, 4096]])])
    code = zones.code_of(F.col("points")[0], Box((0.0,) * 3, (4096.0,) * 3))
    cell = [F.least(F.floor(F.col("points")[0][a]), F.lit(4095)) for a in "xyz"]
    assert rows.where(code != morton(*cell, cell_grid(12))).count() == 0
    assert "aggregate(" not in rows.select(code)._jdf.queryExecution().optimizedPlan().toString()
