"""Shard files as a data source: whole reads, lookups by ranged reads, chunks larger than a window."""

import json
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annospark.config import DataConfig, PropertySpec, Relationship, ShardingSpec
from annospark.operators import encode
from annospark.operators.indexes import id_index, relation_index
from annospark.sources import shards

PROPERTIES = (PropertySpec("f", "float32", "f"), PropertySpec("c", "rgb", "c"), PropertySpec("n", "int16", "n"))
RELATIONS = (Relationship("a", "a"), Relationship("b", "b"))


def annotations(spark, n, kind):
    points = {"POINT": 1, "LINE": 2}.get(kind)
    size = F.lit(points) if points else (F.col("id") % 5).cast("int")
    x = lambda i: (F.col("id") % 1000 + i).cast("double")
    at = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.struct(x(i).alias("x"), (x(i) * 2).alias("y"), (-x(i)).alias("z")))
    return spark.range(n).select(
        (F.col("id") - n // 2).alias("id"), F.slice(at, 1, size).alias("points"),
        F.struct((F.col("id") / 4).cast("float").alias("f"), F.array(*(F.lit(k).cast("int") for k in (1, 2, 255))).alias("c"), (-F.col("id") % 100).alias("n")).alias("properties"),
        F.create_map(F.lit("a"), F.array(F.when(F.col("id") % 3 > 0, F.lit(-7)).otherwise(F.col("id"))), F.lit("b"), F.slice(F.array("id", -F.col("id")), 1, (F.col("id") % 3).cast("int"))).alias("relations"),
    )


def plain(rows, columns):
    return sorted(json.dumps([r.asDict(recursive=True)[c] for c in columns], sort_keys=True) for r in rows)


@pytest.mark.parametrize("kind", ["POINT", "LINE", "POLYLINE"])
def test_shards_come_back_as_they_were(spark, tmp_path, kind, monkeypatch):
    config, spec = DataConfig((), "id", kind, (), PROPERTIES, RELATIONS), ShardingSpec(2, 2)
    rows = annotations(spark, 700, kind).cache()
    encode.write_files(encode.id_shards(id_index(rows, spec), rows, config, spec), str(tmp_path / "ids"))
    encode.write_files(encode.relation_shards(relation_index(rows, spec), rows, config, spec, "a"), str(tmp_path / "a"))
    back = shards.ids(spark, str(tmp_path / "ids"), config, spec)
    columns = ["id", "points", "properties", "relations"]
    same = rows.select("id", F.col("points").cast(shards.POINTS).alias("points"), F.expr("struct(properties.f, cast(properties.n as bigint) as n, cast(properties.c as array<smallint>) as c)").alias("properties"), "relations")
    want = plain(same.collect(), columns)
    assert plain(back.collect(), columns) == want and back.where("id < 0").count() == 350
    some = [-350, -1, 0, 349]
    found = back.where(F.col("id").isin([*some, 10**15]))
    assert sorted(r["id"] for r in found.collect()) == some and back.where("id = 5").first()["properties"]["c"] == [1, 2, 255]
    assert back.where("id = 5 and id = 6").count() == 0
    by = shards.groups(spark, str(tmp_path / "a"), config, spec)
    expected = {}
    for r in rows.select("id", F.col("relations")["a"][0].alias("a")).orderBy("id").collect():
        expected.setdefault(r["a"], []).append(r["id"])
    got = {}
    for r in by.orderBy("chunk", "place").collect():
        assert r["place"] == len(got.setdefault(r["chunk"], [])) + 1
        got[r["chunk"]].append(r["id"])
    assert got == expected
    assert by.where("chunk = -7").count() == len(expected[-7])
    # The same by windows smaller than a chunk, in this process.
    monkeypatch.setattr(shards, "WINDOW", 300)
    monkeypatch.setattr(shards, "STEP", 7)
    reader = shards.ShardReader(str(tmp_path / "a"), shards.Layout.of(config, False), spec, True)
    whole = pa.Table.from_batches([b for p in reader.partitions() for b in reader.read(p)])
    assert sorted(zip(whole["chunk"].to_pylist(), whole["id"].to_pylist(), strict=True)) == sorted((c, i) for c, own in expected.items() for i in own)
    bodies = {i: p for i, p in zip(whole["id"].to_pylist(), whole["points"].to_pylist(), strict=True)}
    assert bodies == {r["id"]: [x.asDict() for x in r["points"]] for r in same.collect()}


def test_a_lookup_reads_a_small_share_of_the_bytes(spark, tmp_path):
    config, spec = DataConfig((), "id", "LINE", (), PROPERTIES, RELATIONS), ShardingSpec(2, 6)
    rows = annotations(spark, 20_000, "LINE")
    encode.write_files(encode.id_shards(id_index(rows, spec), rows, config, spec), str(tmp_path))
    size = sum(f.stat().st_size for f in tmp_path.glob("*.shard"))
    reader = shards.ShardReader(str(tmp_path), shards.Layout.of(config, True), spec, False)
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("id",), 77)]))
    parts = reader.partitions()
    assert len(parts) == 1 and [b.column("id").to_pylist() for b in reader.read(parts[0])] == [[77]] and reader.bytes_read < 0.01 * size
    plan = shards.ids(spark, str(tmp_path), config, spec).where("id = 77")
    assert plan.rdd.getNumPartitions() == 1 and plan.count() == 1


def test_decoding_is_fast_and_checks_offsets(spark):
    layout = shards.Layout("LINE", tuple(encode.property_order(PROPERTIES)), ("a", "b"))
    n, size = 100_000, layout.fixed + 24
    body = np.zeros((n, size), np.uint8)
    body[:, layout.fixed] = body[:, layout.fixed + 12] = 1
    begin = np.arange(n) * size
    start = time.perf_counter()
    columns = shards.decoded(body.reshape(-1), begin, layout)
    assert time.perf_counter() - start < 3 and len(columns[2]) == n and columns[2][5].as_py() == [("a", [0]), ("b", [0])]
    for bad in (np.array([5, 3], "<u8"), np.array([0, 99], "<u8")):
        with pytest.raises(ValueError, match="bad minishard"):
            shards.chunks_of(bad.tobytes() + bytes(40), 0)
    with pytest.raises(ValueError, match="bad minishard"):
        shards.chunks_of(np.array([0, 24, 1, 0, 1000], "<u8").tobytes(), 0)


def test_a_folder_without_shards_has_no_rows(spark, tmp_path):
    config = DataConfig((), "id", "POINT", (), (), ())
    (tmp_path / "note.txt").write_text("x")
    for load in (shards.ids, shards.groups):
        assert load(spark, str(tmp_path), config, ShardingSpec(1, 1)).count() == 0


def test_a_failed_write_leaves_the_old_files_and_stale_ones_go(spark, tmp_path):
    config, folder = DataConfig((), "id", "LINE", (), PROPERTIES, RELATIONS), tmp_path / "ids"
    rows = annotations(spark, 300, "LINE")
    wide, narrow = ShardingSpec(4, 1), ShardingSpec(1, 1)
    assert encode.write_files(encode.id_shards(id_index(rows, wide), rows, config, wide), str(folder)) == 16
    (folder / "info").write_text("kept")
    before = {f.name: f.read_bytes() for f in folder.iterdir()}
    twice = rows.unionByName(rows)
    with pytest.raises(Exception, match="repeated chunk id"):
        encode.write_files(encode.id_shards(id_index(twice, narrow), twice, config, narrow), str(folder))
    assert {f.name: f.read_bytes() for f in folder.iterdir()} == before and [f.name for f in tmp_path.iterdir()] == ["ids"]
    assert encode.write_files(encode.id_shards(id_index(rows, narrow), rows, config, narrow), str(folder)) == 2
    assert sorted(f.name for f in folder.iterdir()) == ["0.shard", "1.shard", "info"] and [f.name for f in tmp_path.iterdir()] == ["ids"]
    assert shards.ids(spark, str(folder), config, narrow).count() == 300
