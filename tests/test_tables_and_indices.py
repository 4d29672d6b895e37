import gzip
import json
import os
import random
import re
import struct
import tarfile
import zipfile
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_bits_and_plans import CONFIG

from annospark import lineage
from annospark.config import DataConfig, PropertySpec, Relationship, ShardingSpec
from annospark.functions import values as V
from annospark.functions.geometry import Box, convert, in_bounds
from annospark.operators import checks, encode, indexes, octree
from annospark.operators.indexes import id_index, relation_index
from annospark.operators.sample import split_sample
from annospark.plans import build
from annospark.plans.lookup import box_query, lookup_id, write_csv
from annospark.sources import archives, tables
from annospark.sources import rows as row_ranges
from annospark.sources.shards import chunks_of, decode_groups, decode_ids, read_shards
from annospark.streaming.append import Spatial, append_stream

POINTS = "id long, points array<struct<x:double,y:double,z:double>>"


def some_lines(spark, n=300, seed=1):
    r = random.Random(seed)
    rows = [(i, [tuple(r.uniform(0, 10) for _ in range(3)) for _ in range(2)]) for i in range(n)]
    return spark.createDataFrame(rows, POINTS), dict(rows)


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_csv_with_and_without_header(spark, tmp_path):
    c = DataConfig.from_json(CONFIG)
    body = '1,0,0,0,1,1,2,p,"5,6",#0a0b0c\n2,1,1,1,2,2,4,q,p,#ffffff\n'
    for head in ("", ",".join(CONFIG["columns"]) + "\n"):
        path = write(tmp_path / f"{len(head)}.csv", head + body)
        got = tables.annotations(tables.read_table(spark, path, c), c).orderBy("id").collect()
        assert [r["id"] for r in got] == [1, 2] and got[0]["properties"]["kind_of"] == 5 and got[0]["properties"]["tint"] == [10, 11, 12]
        assert got[0]["relations"] == {"cell_a": [5, 6], "kind": [5]} and got[1]["relations"]["cell_a"] is None
        assert [got[0]["properties"][f"way_{a}"] for a in "xyz"] == [1, 1, 2]


def test_bad_field_raises(spark, tmp_path):
    path = write(tmp_path / "bad.csv", "1,x,0,0,1,1,2,p,5,#0a0b0c\n")
    c = DataConfig.from_json(CONFIG)
    with pytest.raises(Exception, match="(?i)malformed|record"):
        tables.read_table(spark, path, c).collect()


def test_swc_files_become_polylines(spark, tmp_path):
    write(tmp_path / "17.swc", "# id,type,x,y,z,r,pid\n1 0 1.5 2 3 1 -1\n2 0 4 5 6 1 1\n")
    write(tmp_path / "4.swc", "# id,type,x,y,z,r,pid\n1 0 9 9 9 1 -1\n")
    got = {r["ID"]: r["Points"] for r in tables.read_swc(spark, str(tmp_path)).collect()}
    assert got == {17: "1.5,2,3;4,5,6", 4: "9,9,9"}


def test_unpack_and_discover(spark, tmp_path):
    source = tmp_path / "in" / "deep"
    source.mkdir(parents=True)
    with zipfile.ZipFile(source / "a.zip", "w") as z:
        z.writestr("synapses__2-rows.csv", "1\n2\n")
    with gzip.open(source / "b.csv.gz", "wt") as f:
        f.write("9\n")
    (tmp_path / "in" / "disabled.zip").write_bytes(b"")
    kind, found = tables.discover(archives.unpack(spark, str(tmp_path / "in"), str(tmp_path / "out")))
    assert kind == "csv" and len(found) == 1 and tables.rows_named(found[0]) == 2


def test_archives_are_unpacked_by_tasks(spark, tmp_path, monkeypatch):
    source, big = tmp_path / "in", "".join(f"{i},x\n" for i in range(50_000))
    source.mkdir()
    for k in range(3):
        with zipfile.ZipFile(source / f"{k}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"d{k}/a.csv", f"{k}\n")
            z.writestr(f"b{k}.csv", big)
    (source / "disabled-x.zip").write_bytes(b"no zip")
    members = archives.member_table(spark, archives.chosen(str(source)))
    assert sorted((r["member"], r["size"]) for r in members.collect()) == sorted((m, n) for k in range(3) for m, n in ((f"d{k}/a.csv", 2), (f"b{k}.csv", len(big))))
    for out in (f"{tmp_path}/out", f"file://{tmp_path}/out2"):
        files = archives.unpack(spark, f"file://{source}" if out.startswith("file") else str(source), out)
        assert files == sorted(f"{out}/{m}" for k in range(3) for m in (f"b{k}.csv", f"d{k}/a.csv"))
        assert open(files[0].removeprefix("file://")).read() == big
    assert not [f for f in os.listdir(".") if f.startswith("file:")] and sorted(os.listdir(tmp_path)) == ["in", "out", "out2"]
    # Of a tar each member is read by its offset alone.
    with tarfile.open(tmp_path / "x.tar", "w") as t:
        for k in range(3):
            t.add(f"{tmp_path}/out/b{k}.csv", f"t/{k}.csv")
    rows = list(archives.members_of(str(tmp_path / "x.tar")))
    assert [n for n, _, _ in rows] == ["t/0.csv", "t/1.csv", "t/2.csv"]
    read = []
    real = archives._Opened.readinto
    monkeypatch.setattr(archives._Opened, "readinto", lambda self, b: read.append(n := real(self, b)) or n)
    assert list(archives.extracted(str(tmp_path / "x.tar"), *rows[1], f"{tmp_path}/out")) == [f"{tmp_path}/out/t/1.csv"]
    assert open(f"{tmp_path}/out/t/1.csv").read() == big and sum(read) < len(big) + (1 << 17)
    for bad in ("../x", "/etc/x", "a/../../x"):
        with pytest.raises(ValueError, match="leads out"):
            archives.safe(bad)


def test_many_csv_files_with_and_without_headers(spark, tmp_path):
    c = DataConfig.from_json(CONFIG)
    row, head = '{},0,0,0,1,1,2,p,"5,6",#0a0b0c\n', ",".join(CONFIG["columns"]) + "\n"
    (tmp_path / "in").mkdir()
    for k in range(300):
        write(tmp_path / "in" / f"{k}.csv", head * (k % 3 == 0) + row.format(k) if k % 7 else head * (k % 2))
    df = tables.read_input(spark, str(tmp_path / "in"), c)
    assert sorted(r[0] for r in df.collect()) == [k for k in range(300) if k % 7]
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_row_ranges_of_csv_files_read_their_blocks(spark, tmp_path, monkeypatch):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])
    (tmp_path / "in").mkdir()
    texts = [f"{i},t{'x' * (i % 37)}é" for i in range(900)] + ["900," + "long" * 500, "901,end"]
    for k, (a, b, head, end) in enumerate(((0, 300, True, "\n"), (300, 301, False, ""), (301, 301, True, "\n"), (301, 902, False, "\r\n\n"))):
        lines = ["n,text"] * head + texts[a:b]
        (tmp_path / "in" / f"{k}.csv").write_bytes(("\n".join(lines) + end).replace("\n", "\r\n" if k == 3 else "\n").encode() if lines else b"")
    want = [(int(t.split(",")[0]), t.split(",")[1]) for t in texts]
    for block in (1 << 20, 100, 7):
        index = row_ranges.index_rows(spark, str(tmp_path / "in"), schema, block)
        assert index.rows == 902
        for a, b in ((0, 902), (299, 302), (300, 301), (895, 902), (5, 5)):
            assert sorted(map(tuple, row_ranges.rows_between(index, a, b).collect())) == want[a:b], (block, a, b)
    some = index.blocks.where((F.col("first") < 310) & (F.col("first") + F.col("lines") > 305) & (F.col("lines") > 0))
    assert some.count() <= 6
    (tmp_path / "in" / "0.csv").write_text("x,1\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        row_ranges.rows_between(row_ranges.index_rows(spark, str(tmp_path / "in"), schema), 0, 1).collect()


def test_parquet_files_that_store_different_types(spark, tmp_path):
    c = DataConfig.from_json(CONFIG)
    row = spark.createDataFrame([(1, *[0.0] * 6, "p", "5", "#0a0b0c")], c.schema)
    for k, kind in enumerate(("int", "bigint", "int")):
        one = row.withColumn(c.schema.names[0], F.lit(k).cast(kind)).toPandas()
        (tmp_path / "in").mkdir(exist_ok=True)
        one[c.schema.names[0]] = one[c.schema.names[0]].astype("int32" if kind == "int" else "int64")
        one.to_parquet(tmp_path / "in" / f"{k}.parquet")
    assert sorted(r[0] for r in tables.read_input(spark, str(tmp_path / "in"), c).collect()) == [0, 1, 2]


def test_synthesized_ids_count_from_one(spark):
    df, name = tables.with_id(spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "id string, v int"), ["id"])
    assert name == "id_1" and [r[name] for r in df.orderBy("id").collect()] == [1, 2, 3]


def test_values(spark):
    df = spark.createDataFrame([("5",), ("1,2",), ("[1, 2]",), ("(3,)",), ("p",), ("1.5",), (None,), ("[]",)], "t string")
    got = [r[0] for r in df.select(V.relation_ids(F.col("t"))).collect()]
    assert got == [[5], [1, 2], [1, 2], [3], None, None, None, []]
    assert [r[0] for r in df.select(V.relation_ids_or_enum(F.col("t"), ["p"], [8])).collect()][4] == [8]
    one = spark.range(1)
    assert one.select(V.colour(F.lit("#ff0010")), V.colour(F.lit("ff0010")), V.colour(F.lit("#ff00107f"), 4)).first()[:] == ([255, 0, 16], None, [255, 0, 16, 127])
    steps = one.select(V.mean_step(V.parse_points(F.lit("0,0,0;1,1,1;4,2,3"))), V.mean_step(V.parse_points(F.lit("1,2,3")))).first()
    assert tuple(steps[0]) == (2, 1, 1.5) and tuple(steps[1]) == (0, 0, 0)
    assert one.select(V.enum_value(F.lit("a"), ["a", "a"], [1, 2]), V.enum_value(F.lit("z"), ["a"], [1], -1)).first()[:] == (1, -1)
    assert tuple(one.select(V.parse_cell(V.cell_name(F.lit(1), F.lit(2), F.lit(3)))).first()[0]) == (1, 2, 3)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id long, label string")
    assert checks.duplicate_ids(df, "id").first()[:] == (3, 2, 1)
    with pytest.raises(ValueError):
        checks.require_unique(df, "id")
    with pytest.raises(ValueError, match="b"):
        checks.require_labels(df, "label", ["a"])
    checks.require_labels(df, "label", ["a", "b"])
    with pytest.raises(ValueError):
        checks.require_rows(df, 4)


def test_segments_against_a_sampled_model(spark):
    df, rows = some_lines(spark, 400, 3)
    box = Box.of((3, 3, 3), (5, 6, 7))
    got = {r["id"] for r in df.where(in_bounds(F.col("points"), box)).collect()}
    for i, (a, b) in rows.items():
        steps = [[p + (q - p) * t / 400 for p, q in zip(a, b, strict=True)] for t in range(401)]
        if any(all(lo + 1e-3 <= v <= hi - 1e-3 for v, lo, hi in zip(s, box.low, box.high, strict=True)) for s in steps):
            assert i in got
        if not any(all(lo - 0.05 <= v <= hi + 0.05 for v, lo, hi in zip(s, box.low, box.high, strict=True)) for s in steps):
            assert i not in got
    flat = spark.createDataFrame([(1, [(4.0, 4.0, 0.0), (4.0, 4.0, 9.0)]), (2, [(2.0, 4.0, 0.0), (2.0, 4.0, 9.0)]), (3, [(4.0, 4.0, 4.0)])], POINTS)
    assert [r["id"] for r in flat.where(in_bounds(F.col("points"), box)).orderBy("id").collect()] == [1, 3]
    moved = flat.select(convert(F.col("points"), (4, 4, 40), (1, 1, 1)).alias("p")).first()["p"][1]
    assert (moved["x"], moved["z"]) == (16, 360)


def model_octree(rows, bounds, k):
    """The same tree, held in dictionaries."""
    import hashlib

    order = lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)
    level, cells, held = 0, {(0, 0, 0): (set(rows), bounds)}, {}
    while cells:
        below = {}
        for cell, (ids, (lo, hi)) in cells.items():
            ranked = sorted(ids, key=order)
            held |= {(level, *cell, i): n + 1 for n, i in enumerate(ranked[:k])}
            mid = [(a + b) / 2 for a, b in zip(lo, hi, strict=True)]
            for i in ranked[k:]:
                for p in rows[i]:
                    if all(a <= v <= b for v, a, b in zip(p, lo, hi, strict=True)):
                        up = tuple(int(v > m) for v, m in zip(p, mid, strict=True))
                        edge = ([m if u else a for u, m, a in zip(up, mid, lo, strict=True)], [b if u else m for u, m, b in zip(up, mid, hi, strict=True)])
                        below.setdefault(tuple(2 * c + u for c, u in zip(cell, up, strict=True)), (set(), edge))[0].add(i)
        level, cells = level + 1, below
    return held


def test_octree_is_the_model_and_holds_points_on_faces(spark):
    df, rows = some_lines(spark, 120, 5)
    rows |= {1000: [(5.0, 5.0, 5.0), (5.0, 9.0, 5.0)], 1001: [(0.0, 0.0, 0.0), (10.0, 10.0, 10.0)]}
    df = spark.createDataFrame(list(rows.items()), POINTS)
    box = Box.of((0, 0, 0), (10, 10, 10))
    got = {(r["level"], r["cx"], r["cy"], r["cz"], r["id"]): r["place"] for r in octree.build(df, box, 12).collect()}
    assert got == model_octree(rows, ((0.0,) * 3, (10.0,) * 3), 12)


def test_octree_limits(spark):
    same = spark.createDataFrame([(i, [(1.0, 1.0, 1.0)]) for i in range(9)], POINTS)
    with pytest.raises(RuntimeError):
        octree.build(same, Box.of((0, 0, 0), (2, 2, 2)), 2, 3)
    with pytest.raises(RuntimeError):
        octree.build(same, Box.of((5, 5, 5), (6, 6, 6)), 2, 3)
    assert octree.build(same.limit(0), Box.of((0, 0, 0), (2, 2, 2)), 2).count() == 0


def packed(rows, kind, specs, keys=()):
    """Bodies of rows of (points, properties, related ids)."""
    types = {"rgb": pa.list_(pa.int16()), "rgba": pa.list_(pa.int16()), "float32": pa.float32()}
    point = pa.list_(pa.struct([(a, pa.float64()) for a in "xyz"]))
    columns = {"points": pa.array([[dict(zip("xyz", p, strict=True)) for p in points] for points, *_ in rows], point)}
    columns |= {f"p_{s.id}": pa.array([r[1].get(s.id) for r in rows], types.get(s.type, pa.int64())) for s in specs}
    columns |= {f"r_{k}": pa.array([r[2].get(k) for r in rows], pa.list_(pa.int64())) for k in keys}
    data, at = encode.pack_bodies(pa.RecordBatch.from_pydict(columns), kind, specs, list(keys))
    return [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_bodies_byte_for_byte():
    specs = encode.property_order([PropertySpec("c", "rgb", "c"), PropertySpec("b", "uint16", "b"), PropertySpec("f", "float32", "f"), PropertySpec("s", "int8", "s")])
    assert [p.id for p in specs] == ["f", "b", "c", "s"]
    given = {"c": [1, 2, 3], "b": 513, "f": 0.5, "s": -1}
    rows = [([(1, 2, 3)], given, {"k": [7, 8], "l": None}), ([(4, 5, 6)], {"f": float("nan")}, {"k": [], "l": [-1]})]
    assert packed(rows, "POINT", specs, ["k", "l"]) == [
        struct.pack("<3ffH3Bbxx", 1, 2, 3, 0.5, 513, 1, 2, 3, -1) + struct.pack("<IQQI", 2, 7, 8, 0),
        struct.pack("<3ffH3Bbxx", 4, 5, 6, 0, 0, 0, 0, 0, 0) + struct.pack("<IIq", 0, 1, -1),
    ]
    assert packed([([(1, 2, 3)] * 2, {}, {}), ([], {}, {})], "POLYLINE", []) == [struct.pack("<I6f", 2, *(1, 2, 3) * 2), struct.pack("<I", 0)]
    assert packed([], "LINE", specs) == []
    with pytest.raises(ValueError):
        packed(rows, "LINE", specs)
    with pytest.raises(ValueError):
        packed([([(1, 2, 3)], {"s": 200}, {})], "POINT", specs)


def test_headers_byte_for_byte():
    head = encode.header(np.array([1, 1]), np.array([3, 2**63 + 5 - 2**64]), np.array([1, 2]), 2)
    assert head[:32] == struct.pack("<4Q", 0, 0, 0, 48) and struct.unpack("<6Q", head[32:]) == (3, 2**63 + 2, 48, 0, 1, 2)
    assert chunks_of(head + b"xyy", 1) == [(1, 3, b"x"), (1, 2**63 + 5, b"yy")]
    with pytest.raises(ValueError):
        encode.header(np.array([0, 0]), np.array([1, 1]), np.array([1, 1]), 1)


def some_chunks(rng, shards):
    """``shard, minishard, id, size`` of chunks in order, and the minishards of each shard; some minishards have none."""
    minishards, rows = [1 << int(rng.integers(0, 5)) for _ in range(shards)], []
    for shard, n in enumerate(minishards):
        for m in sorted(rng.choice(n, int(rng.integers(1, n + 1)), replace=False).tolist()):
            ids = np.unique(rng.integers(0, 1 << 64, 4, dtype=np.uint64))
            rows += [(7 * shard, m, int(i), int(rng.integers(0, 99))) for i in ids]
    return [np.array(c, t) for c, t in zip(zip(*rows, strict=True), (np.int64, np.int64, np.uint64, np.int64), strict=True)], np.array(minishards)


def test_headers_of_many_shards_are_those_of_each():
    rng = np.random.default_rng(1)
    for _ in range(50):
        (shard, minishard, ids, sizes), minishards = some_chunks(rng, int(rng.integers(1, 8)))
        data, ends = encode.headers(shard, minishard, ids.view(np.int64), sizes, minishards)
        for k, n in enumerate(minishards.tolist()):
            own, at, indices, position = shard == 7 * k, 0, [], 24 * int((shard == 7 * k).sum())
            heads = []
            for m in range(n):
                i, size = ids[own & (minishard == m)], sizes[own & (minishard == m)]
                gaps = [position] * (len(i) > 0) + [0] * (len(i) - 1)
                index = struct.pack(f"<{3 * len(i)}Q", *np.diff(i, prepend=np.uint64(0)).tolist(), *gaps, *size.tolist())
                heads.append(struct.pack("<2Q", at, at + len(index)))
                indices.append(index)
                at, position = at + len(index), position + int(size.sum())
            assert data[ends[k] : ends[k + 1]].astype("<u8").tobytes() == b"".join(heads + indices)


def test_shards_that_go_on_in_the_next_batch_stay_whole():
    shard = np.sort(np.random.default_rng(2).integers(0, 9, 60))
    for size in (1, 2, 7, 60):
        batches = [pa.RecordBatch.from_pydict({"shard": pa.array(shard[k : k + size])}) for k in range(0, 60, size)]
        found = [t["shard"].to_pylist() for t in encode.whole_shards(iter([*batches, batches[0].slice(0, 0)]))]
        assert sum(found, []) == shard.tolist() and all(a[-1] < b[0] for a, b in zip(found, found[1:], strict=False))


def test_headers_are_made_by_several_tasks(spark):
    """Headers of many shards are much work over few bytes."""
    df, _ = some_lines(spark, 600, 8)
    rows = df.select("id", "points", F.lit(None).cast("struct<none:int>").alias("properties"), F.create_map(F.lit("r"), F.array(F.col("id") % 200)).alias("relations"))
    config, spec = DataConfig((), "id", "LINE", (), (), (Relationship("r", "r"),)), ShardingSpec(6, 1)
    for pieces in (encode.id_shards(id_index(rows, spec), rows, config, spec), encode.relation_shards(relation_index(rows, spec), rows, config, spec, "r")):
        heads = pieces.where("minishard = -1").select("shard", F.spark_partition_id().alias("task")).collect()
        assert len(heads) == len({h["shard"] for h in heads}) > 50 and len({h["task"] for h in heads}) > 1


def test_the_drivers_garbage_goes_when_a_table_is_written(spark, monkeypatch):
    beans, app = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans, spark.sparkContext.applicationId
    whole = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    for taken, more in ((0, True), (1 << 60, False)):  # the heap has grown since it was last collected, or hasn't
        monkeypatch.setattr(lineage, "FULL", 0.0)
        monkeypatch.setattr(lineage, "_taken", {app: taken})
        before = whole()
        lineage.cut(spark.range(3), "some")
        assert (whole() > before) == more == (0 < lineage._taken[app] < 1 << 60)


@pytest.mark.parametrize(("used", "more"), [(600, True), (520, False)])
def test_a_heap_that_stays_large_is_collected_again(monkeypatch, used, more):
    """A collection leaves 380 of 750 MB in use, and a heap of 620 MB; what comes into use after that is garbage again."""
    state, done = {"used": 600}, []
    heap = SimpleNamespace(totalMemory=lambda: 620, maxMemory=lambda: 750, freeMemory=lambda: 620 - state["used"])
    runtime = SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: heap))
    jvm = SimpleNamespace(java=SimpleNamespace(lang=runtime), System=SimpleNamespace(gc=lambda: (done.append(1), state.update(used=380))))
    monkeypatch.setattr(lineage, "_taken", {})
    session = SimpleNamespace(_jvm=jvm, sparkContext=SimpleNamespace(applicationId="app"))
    lineage.let_go(session)
    state["used"] = used
    lineage.let_go(session)
    assert len(done) == 1 + more


def test_shards_of_a_hot_relation_are_spread_and_whole(spark):
    """Two thirds of all annotations belong to one object; ids are negative too, and order is unsigned."""
    df, points = some_lines(spark, 900, 8)
    rows = df.select((F.col("id") - 300).alias("id"), "points", F.lit(None).cast("struct<none:int>").alias("properties"), F.create_map(F.lit("r"), F.array(F.when(F.col("id") % 3 > 0, -5).otherwise(F.col("id")))).alias("relations")).cache()
    config, spec = DataConfig((), "id", "LINE", (), (), (Relationship("r", "r"),)), ShardingSpec(1, 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with tables that aren't small
    pieces = encode.relation_shards(relation_index(rows, spec), rows, config, spec, "r")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pieces.where("kind = 1").groupBy("part").count().count() > 2
    got = sorted((x["chunk"], x["place"], x["id"]) for x in decode_groups(encode.whole(pieces), config, 2).collect())
    want = {}
    for i in range(900):
        want.setdefault(-5 if i % 3 else i, []).append(i - 300)
    assert got == sorted((c, n + 1, i) for c, ids in want.items() for n, i in enumerate(sorted(ids)))
    assert encode.whole(encode.id_shards(id_index(rows, spec), rows, config, spec)).count() == 2
    with pytest.raises(Exception, match="repeated chunk id"):
        encode.whole(encode.id_shards(id_index(rows.unionByName(rows), spec), rows, config, spec)).count()


def test_related_ids_in_slices(spark, monkeypatch):
    monkeypatch.setattr(indexes, "SLICE_IDS", 10)
    rows = spark.range(100).select("id", F.create_map(F.lit("r"), F.array(F.when(F.col("id") < 70, 1).otherwise(F.col("id")))).alias("relations"))
    got = indexes.related(relation_index(rows, ShardingSpec(0, 0))).orderBy("rel_id", "slice").collect()
    hot = [r["ids"] for r in got if r["rel_id"] == 1]
    assert len(hot) == 7 and sum(hot, []) == list(range(70)) and len(got) == 7 + 30


def test_a_level_without_sharding_raises(spark):
    df, _ = some_lines(spark, 60)
    box = Box.of((0, 0, 0), (10, 10, 10))
    with pytest.raises(ValueError, match="sharding"):
        indexes.spatial_index(df, box, [ShardingSpec(0, 0)] * 2, 5)
    assert indexes.spatial_index(df, box, [ShardingSpec(0, 0)] * 9, 5).select("id").distinct().count() == 60


def test_samples_are_of_rows(spark):
    df = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c"), (8, "d"), (8, "d")], "id long, v string")
    for n in range(7):
        taken, others = split_sample(df, "id", n)
        assert taken.count() == min(n, 5) and sorted(map(repr, taken.unionByName(others).collect())) == sorted(map(repr, df.collect()))


def test_fields_that_cannot_be_read_raise(spark):
    c = DataConfig.from_json(CONFIG)
    good = {"cell_a": "5, 6", "kind": "p", "tint": "#0a0b0c"}
    columns = {r.key: r.column for r in c.relations} | {p.id: p.column for p in c.properties if p.type == "rgb"}
    for name, bad in ((None, None), ("cell_a", "1.5"), ("cell_a", "abc"), ("tint", "0a0b0c"), ("tint", "#0a0b0")):
        values = {col: good[k] for k, col in columns.items()} | ({columns[name]: bad} if name else {})
        df = spark.createDataFrame([tuple(values.values()), (None,) * len(values)], ", ".join(f"`{k}` string" for k in values))
        if name:
            with pytest.raises(ValueError, match="can't be read"):
                checks.require_values(df, c)
        else:
            checks.require_values(df, c)


def test_sharding_that_is_given(spark):
    given = build.Given(by_id=ShardingSpec(3, 1), targets={"minishard_target": 10})
    made = build.plan(5000, 50_000, related=(100, 9000), given=given)
    assert made.by_id == ShardingSpec(3, 1) and made.relation.minishard_bits == 4 and made.levels[0].minishard_bits > build.plan(5000, 50_000).levels[0].minishard_bits
    with pytest.raises(ValueError, match="preshift"):
        build.plan(5, 5, given=build.Given(by_id=ShardingSpec(3, 1, 1)))
    c = DataConfig.from_json(CONFIG)
    assert c.relation("cell_a").key == "cell_a"


def test_a_measured_relation_index(spark):
    """One cell has a third of all lines; no shard but its own is larger than wanted."""
    df = spark.range(3000).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), F.when(F.col("id") < 1000, 5).otherwise(F.col("id")).cast("string").alias("cell"))
    config = DataConfig((), "id", "POINT", (("x", "y", "z"),), (), (Relationship("Cell", "cell"),))
    targets = {"shard_target": 20_000, "minishard_target": 50}
    made = build.index(df, config, 64 * 3000, 3000, given=build.Given(targets=targets, measured=True))
    assert made.plan.relation.shard_bits >= build.index(df, config, 64 * 3000, 3000, given=build.Given(targets=targets)).plan.relation.shard_bits
    assert made.relation.where("rel_id <> 5").groupBy("shard").count().agg(F.max("count")).first()[0] * 64 <= 20_000


def test_folders_of_files_as_input(spark, tmp_path):
    c = DataConfig.from_json(CONFIG)
    row = '{},0,0,0,1,1,2,p,"5,6",#0a0b0c\n'
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a__2-rows.csv", row.format(1) + row.format(2))
    write(tmp_path / "in" / "b__1-rows.csv", ",".join(CONFIG["columns"]) + "\n" + row.format(3))
    for path in (f"{tmp_path}/in", f"file://{tmp_path}/in"):
        assert sorted(r[0] for r in tables.read_input(spark, path, c).collect()) == [1, 2, 3]
    write(tmp_path / "in" / "b__1-rows.csv", row.format(3) + row.format(4))
    with pytest.raises(ValueError, match="4 rows"):
        tables.read_input(spark, f"{tmp_path}/in", c)
    for kind in ("tar.gz", "tar", "gz"):
        packed_in = tmp_path / kind
        packed_in.mkdir()
        if kind == "gz":
            with gzip.open(packed_in / "x.csv.gz", "wt") as f:
                f.write(row.format(9))
        else:
            with tarfile.open(packed_in / f"x.{kind}", "w:gz" if kind == "tar.gz" else "w") as f:
                f.add(write(tmp_path / "x.csv", row.format(9)), "x.csv")
        assert [r[0] for r in tables.read_input(spark, str(packed_in), c, f"{tmp_path}/out-{kind}").collect()] == [9]
    swc = tmp_path / "swc"
    swc.mkdir()
    write(swc / "17.swc", "# id,type,x,y,z,r,pid\n1 0 1.5 2 3 1 -1\n")
    assert tables.read_input(spark, str(swc), c).collect()[0][:] == (17, "1.5,2,3")


def test_run_writes_tables_shards_and_info(spark, tmp_path):
    r = random.Random(2)
    lines = "".join(f"{i},{','.join(str(r.randint(0, 90)) for _ in range(6))},{r.choice('pq')},{r.randint(1, 9)},#0a0b0c\n" for i in range(200))
    path, out = write(tmp_path / "in.csv", lines), str(tmp_path / "out")
    config = DataConfig.from_json(CONFIG)
    made = build.run(spark, path, config, out, cell_rows=20)
    told = json.load(open(f"{out}/info"))
    assert told["annotation_type"] == "LINE" and len(told["spatial"]) == made.levels and {x["key"] for x in told["relationships"]} == {"cell_a", "kind"}
    ids = decode_ids(read_shards(spark, f"{out}/by_id"), config, made.plan.by_id.minishard_bits)
    want = {x["id"]: x for x in made.annotations.collect()}
    got = {x["id"]: x for x in ids.collect()}
    assert got.keys() == want.keys()
    for i, x in got.items():
        assert [tuple(p) for p in x["points"]] == [tuple(p) for p in want[i]["points"]] and x["properties"]["kind_of"] == want[i]["properties"]["kind_of"]
        assert x["relations"]["cell_a"] == want[i]["relations"]["cell_a"]
    held = decode_groups(read_shards(spark, f"{out}/spatial1"), config, made.plan.levels[1].minishard_bits)
    assert held.count() == made.spatial.where("level = 1").count() and os.path.isdir(f"{out}/cell_a")
    assert json.load(open(f"{out}/config.json"))["annotation_type"] == "LINE"
    write_csv(made.by_id, f"{out}/csv", "shard")
    assert spark.read.csv(f"{out}/csv", header=True).count() == 200
    stored = spark.read.parquet(f"{out}/tables/by_id")
    assert [x["id"] for x in lookup_id(stored, [7, 999], made.plan.by_id).collect()] == [7]
    box = Box.of((10, 10, 10), (60, 60, 60))
    deep = box_query(spark.read.parquet(f"{out}/tables/spatial"), box, made.bounds, made.levels - 1, made.plan.levels)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    scan = box_query(spark.read.parquet(f"{out}/tables/spatial"), box, made.bounds, made.levels - 1, made.plan.levels)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "shard" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1] and scan.count("FileScan") == 1
    ends = {i for i, x in want.items() if any(all(10 <= p[a] <= 60 for a in "xyz") for p in x["points"])}
    assert ends <= {x["id"] for x in deep.collect()}


def test_unsharded_files(spark, tmp_path):
    config = DataConfig((), "id", "LINE", (), (), (Relationship("A b", "r"),))
    df, _ = some_lines(spark, 5)
    rows = df.select("id", "points", F.lit(None).cast("struct<none:int>").alias("properties"), F.create_map(F.lit("a_b"), F.array(F.col("id") % 2)).alias("relations"))
    assert encode.write_files(encode.unsharded(rows, config), str(tmp_path / "ids")) == 5
    files = encode.unsharded_relation(relation_index(rows, ShardingSpec(0, 0)), rows, config, "a_b")
    assert encode.write_files(files, str(tmp_path / "rel")) == 2 and sorted(os.listdir(tmp_path / "rel")) == ["0", "1"]


def test_appending_a_stream(spark, tmp_path):
    df, _ = some_lines(spark, 40)
    rows = df.select("id", "points", F.create_map(F.lit("r"), F.array(F.col("id") % 3)).alias("relations"))
    spec = ShardingSpec(2, 1)
    source, out, spatial = str(tmp_path / "in"), str(tmp_path / "out"), Spatial(tables.volume_bounds(rows), (spec,) * 6, 8, 6)
    for part in (rows.where("id < 20"), rows.where("id >= 20")):
        part.write.mode("append").parquet(source)
        append_stream(spark.readStream.schema(rows.schema).parquet(source), out, str(tmp_path / "state"), spec, spec, spatial).awaitTermination()
    assert spark.read.parquet(f"{out}/by_id").select("id").distinct().count() == 40
    assert spark.read.parquet(f"{out}/relation").groupBy("rel_id").count().count() == 3
    assert id_index(rows, spec).count() == 40
    same = lambda df: sorted(map(tuple, df.select("level", "morton", "id", "place").collect()))
    assert same(spark.read.parquet(f"{out}/spatial")) == same(indexes.spatial_index(rows, spatial.bounds, [spec] * 6, 8, 6))
