"""Binary shards of the indices.

Annotations are sorted by shard, minishard and chunk in range partitions, so a chunk of
very many annotations (a related object with a third of all rows) is spread over tasks
like any others.  Each task packs its Arrow batches with numpy into slices: bytes of
annotations that follow each other in one shard.  Sizes of the slices give each shard's
header.  Headers and slices are the pieces of the files; a task writes a file by streaming its
pieces in order, so it never holds a whole one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.config import PROPERTY_TYPES, DataConfig, PropertySpec, ShardingSpec
from annospark.functions.bits import shard_hex, unsigned
from annospark.lineage import cut, written_bytes
from annospark.sources.files import Output, can_move, names_in, put_in_place, remove_files, remove_folder

#: numpy types of the properties that are single numbers.
NUMBERS = {"uint32": "<u4", "int32": "<i4", "float32": "<f4", "uint16": "<u2", "int16": "<i2", "uint8": "u1", "int8": "i1"}
DEFAULT_COLOUR = {"rgb": (0, 0, 0), "rgba": (0, 0, 0, 255)}
#: Slices: runs of annotations of one minishard (of one chunk, where chunks are groups) as a task has sorted them.
SLICES = "shard long, minishard long, chunk long, part int, seq long, n long, bodies binary, ids binary, sizes binary"
#: Pieces of files; those of one shard follow each other by all columns between ``name`` and ``content``.
PIECES = "shard long, minishard long, at long, kind int, part int, seq long, content binary"
#: Bits of a shard's number below the level, where levels are encoded together.
LEVEL_BITS = 40
ORDER = ["shard", "minishard", "at", "kind", "part", "seq"]
#: Minishards, about, whose headers are made together.
TOGETHER = 1 << 19
#: Bytes of slices, about, whose headers one task makes.
PART_BYTES = 64 << 20


def property_order(specs) -> list[PropertySpec]:
    """Properties as the format stores them: those of 4 bytes, of 2, then of 1 with the colours."""
    size = lambda p: 1 if p.type in DEFAULT_COLOUR else PROPERTY_TYPES[p.type]
    return sorted(specs, key=lambda p: -size(p))


def _numbers(spec: PropertySpec, column: pa.Array) -> np.ndarray:
    """A property's values, missing ones 0, or black.  A value out of the type's range raises."""
    if spec.type in DEFAULT_COLOUR:
        default = DEFAULT_COLOUR[spec.type]
        out, has = np.tile(np.array(default, np.uint8), (len(column), 1)), column.is_valid().to_numpy(zero_copy_only=False)
        given = column.drop_null()
        if len(given):
            out[has] = given.flatten().to_numpy(zero_copy_only=False).reshape(len(given), -1)[:, : len(default)]
        return out
    kind = np.dtype(NUMBERS[spec.type])
    values = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
    if values.dtype.kind == "f":
        values = np.where(np.isnan(values), 0, values)
    if kind.kind != "f":
        bad = (values < np.iinfo(kind).min) | (values > np.iinfo(kind).max)
        if bad.any():
            raise ValueError(f"{spec.id}: {values[bad][0]} doesn't fit {spec.type}")
    return values.astype(kind)


def _bytes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1)


def pack_bodies(batch: pa.RecordBatch, kind: str, specs: list[PropertySpec], keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bodies of a batch one after the other, and where each begins and the last one ends.

    A body is the geometry, the properties padded to 4 bytes, and a list of related ids for each of ``keys``.
    """
    n, points = batch.num_rows, batch.column("points")
    counts = pc.fill_null(pc.list_value_length(points), 0).to_numpy().astype(np.int64)
    want = {"POINT": 1, "LINE": 2}.get(kind)
    if want and (counts != want).any():
        raise ValueError(f"{kind} with {counts[counts != want][0]} points")
    flat = points.flatten()
    xyz = np.stack([flat.field(a).to_numpy(zero_copy_only=False) for a in "xyz"], axis=1).astype("<f4")
    parts = [] if want else [(np.full(n, 4), _bytes(counts.astype("<u4")))]
    parts.append((12 * counts, _bytes(xyz)))
    columns = [_bytes(_numbers(s, batch.column(f"p_{s.id}"))).reshape(n, PROPERTY_TYPES[s.type]) for s in specs]
    size = sum(c.shape[1] for c in columns)
    if size:
        packed = np.concatenate([*columns, np.zeros((n, -size % 4), np.uint8)], axis=1)
        parts.append((np.full(n, packed.shape[1]), packed.reshape(-1)))
    for key in keys:
        lists = batch.column(f"r_{key}")
        length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        parts += [(np.full(n, 4), _bytes(length.astype("<u4"))), (8 * length, _bytes(lists.flatten().to_numpy(zero_copy_only=False).astype("<i8")))]
    sizes = sum(s for s, _ in parts)
    ends = np.cumsum(sizes)
    at, out = ends - sizes, np.empty(int(ends[-1]) if n else 0, np.uint8)
    for size, data in parts:
        out[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(len(data))] = data
        at = at + size
    return out, np.concatenate([[0], ends])


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values of ``data``; more than offsets of 32 bits can tell apart raise."""
    if offsets[-1] >= 1 << 31:
        raise OverflowError(f"{offsets[-1]} bytes in an Arrow batch: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def encodable(annotations: DataFrame, config: DataConfig, relations: bool = False) -> DataFrame:
    """``id, points``, properties as ``p_<id>`` and, for the id index, relations as ``r_<key>``."""
    columns = [F.col(f"properties.{p.id}").alias(f"p_{p.id}") for p in config.properties]
    columns += [F.element_at("relations", r.key).alias(f"r_{r.key}") for r in config.relations] if relations else []
    return annotations.select("id", "points", *columns)


def _unsigned(chunk: Column) -> Column:
    """A number whose signed order is the unsigned order of ``chunk``."""
    return chunk.bitwiseXOR(F.lit(-(1 << 63)))


def _slices(rows: DataFrame, chunk: str, order: list[str], config: DataConfig, keys: list[str], grouped: bool) -> DataFrame:
    """The slices of ``rows`` (``shard, minishard``, ``chunk``, ``order`` and what ``encodable`` gives), written."""
    specs, kind = property_order(config.properties), config.annotation_type
    by = [F.col("shard"), F.col("minishard"), _unsigned(F.col(chunk)), *map(F.col, order)]
    rows = rows.withColumn("_chunk", F.col(chunk)).repartitionByRange(*by).sortWithinPartitions(*by)

    def each(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, minishard, chunks, ids = (batch.column(c).to_numpy() for c in ("shard", "minishard", "_chunk", "id"))
            data, offsets = pack_bodies(batch, kind, specs, keys)
            same = (shard[1:] == shard[:-1]) & (minishard[1:] == minishard[:-1]) & ((chunks[1:] == chunks[:-1]) | (not grouped))
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            ends = np.append(first, len(ids))
            n = np.diff(ends)
            own = [pa.array(x[first]) for x in (shard, minishard, chunks)]
            own += [pa.array(np.full(len(first), part, np.int32)), pa.array(seq + np.arange(len(first))), pa.array(n), _binary(data, offsets[ends])]
            lists = [_binary(_bytes(x.astype("<i8")), 8 * ends) for x in (ids, np.diff(offsets))]
            yield pa.RecordBatch.from_arrays([*own, *lists], ["shard", "minishard", "chunk", "part", "seq", "n", "bodies", "ids", "sizes"])
            seq += len(first)

    return cut(rows.mapInArrow(each, SLICES), "slices")


def headers(shard: np.ndarray, minishard: np.ndarray, ids: np.ndarray, sizes: np.ndarray, minishards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The headers of whole shards one after the other, as 8-byte numbers, and where each begins and the last one ends.

    A header is the offsets of its minishard indices, then the indices, of chunks that come in the order of their bytes; ``minishards`` has
    the number of each shard's.  An id that repeats in a minishard raises.
    """
    ids, sizes, n = ids.astype(np.uint64), sizes.astype(np.int64), len(ids)
    new_shard = np.concatenate([[True], shard[1:] != shard[:-1]])
    new = new_shard | np.concatenate([[True], minishard[1:] != minishard[:-1]])
    bad = np.flatnonzero(~new[1:] & (ids[1:] <= ids[:-1]))
    if len(bad):
        raise ValueError(f"repeated chunk id in minishard {minishard[bad[0]]}")
    first, own = np.flatnonzero(new_shard), np.cumsum(new_shard) - 1
    chunks, words = np.diff(np.append(first, n)), 2 * minishards
    ends = np.concatenate([[0], np.cumsum(words + 3 * chunks)])
    out = np.zeros(int(ends[-1]), np.uint64)

    # Each minishard's index is three rows: steps between ids, gaps, sizes.
    begin, run = np.flatnonzero(new), np.cumsum(new) - 1
    many = np.diff(np.append(begin, n))
    at = (ends[:-1] + words)[own] + 3 * (begin[run] - first[own]) + np.arange(n) - begin[run]
    out[at] = np.where(new, ids, ids - np.concatenate([ids[:1], ids[:-1]]))
    before = np.cumsum(sizes) - sizes
    # Data follow the indices: three 8-byte numbers a chunk.
    out[at[begin] + many] = 24 * chunks[own[begin]] + before[begin] - before[first[own[begin]]]
    out[at + 2 * many[run]] = sizes

    # An empty minishard begins and ends where the one before it ends.
    slots = np.zeros(int(minishards.sum()), np.int64)
    base = np.cumsum(minishards) - minishards
    slots[base[own[begin]] + minishard[begin]] = 24 * many
    stops = np.cumsum(slots)
    lead = np.repeat(stops[base] - slots[base], minishards)
    to = np.repeat(ends[:-1] - 2 * base, minishards) + 2 * np.arange(len(slots))
    out[to], out[to + 1] = stops - slots - lead, stops - lead
    return out, ends


def header(minishard: np.ndarray, ids: np.ndarray, sizes: np.ndarray, minishards: int) -> bytes:
    """The header of one shard."""
    return headers(np.zeros(len(ids), np.int64), minishard, ids, sizes, np.array([minishards]))[0].astype("<u8").tobytes()


def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches that come by shard, joined so that no shard is in two of them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard").to_numpy()
        if rest and rest[-1].column("shard")[-1].as_py() != shard[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        last = int(np.searchsorted(shard, shard[-1]))  # where the shard begins that may go on
        if last:
            yield pa.Table.from_batches([*rest, batch.slice(0, last)])
            rest = []
        rest.append(batch.slice(last))
    if rest:
        yield pa.Table.from_batches(rest)


def _pieces(slices: DataFrame, grouped: bool, name: Column, minishards: Callable[[int], int] | None) -> DataFrame:
    """``name`` and ``PIECES``; ``minishards`` tells those of a shard, and without it files have no header."""
    at = _unsigned(F.col("chunk"))
    lead = ["shard", "minishard", at.alias("at")]
    data = slices.select(*lead, F.lit(1).alias("kind"), "part", "seq", F.col("bodies").alias("content"))
    if grouped:
        data = data.unionByName(slices.select(*lead, F.lit(2).alias("kind"), "part", "seq", F.col("ids").alias("content")))
        chunks = slices.groupBy("shard", "minishard", "chunk").agg(F.sum("n").alias("n"), F.sum(F.octet_length("bodies")).alias("bytes"))
        swapped = F.array_join(F.transform(F.sequence(F.lit(7), F.lit(0)), lambda i: F.substring(F.lpad(F.hex("n"), 16, "0"), 2 * i + 1, F.lit(2))), "")
        count = F.unhex(swapped)  # little-endian
        data = data.unionByName(chunks.select(*lead, F.lit(0).alias("kind"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("seq"), count.alias("content")))
        known = chunks.select("shard", "minishard", at.alias("at"), F.col("chunk").alias("id"), (F.col("bytes") + 8 + 8 * F.col("n")).alias("size"))
    if minishards is None:
        return data.withColumn("name", name)

    def head(batches):
        for rows in whole_shards(batches):
            shard, minishard = (rows[c].to_numpy() for c in ("shard", "minishard"))
            if grouped:
                ids, sizes = rows["id"].to_numpy(), rows["size"].to_numpy()
            else:
                n = rows["n"].to_numpy()
                shard, minishard = np.repeat(shard, n), np.repeat(minishard, n)
                ids, sizes = (np.frombuffer(b"".join(rows[c].to_pylist()), "<i8") for c in ("ids", "sizes"))
            first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            many = np.array([minishards(i) for i in shard[first].tolist()], np.int64)
            runs = np.flatnonzero(np.diff(np.cumsum(many) // TOGETHER)) + 1
            for a, b in zip([0, *runs.tolist()], [*runs.tolist(), len(first)], strict=True):
                here = slice(first[a], first[b] if b < len(first) else len(shard))
                data, ends = headers(shard[here], minishard[here], ids[here], sizes[here], many[a:b])
                zero = [pa.array(np.full(b - a, v, t)) for v, t in ((-1, np.int64), (0, np.int64), (0, np.int32), (0, np.int32), (0, np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(shard[first[a:b]]), *zero, _binary(_bytes(data.astype("<u8")), 8 * ends)], [*ORDER, "content"])

    # A shard's header has 24 bytes a chunk; the planner bounds the chunks of a shard.  Rows are few bytes and many shards' headers much work, so
    # partitions have a number: Spark, which goes by bytes, would make one of them.
    listed, order = (known, ["shard", "minishard", "at"]) if grouped else (slices.select("shard", "minishard", "part", "seq", "n", "ids", "sizes"), ["shard", "minishard", "part", "seq"])
    partitions = max(slices.sparkSession.sparkContext.defaultParallelism, written_bytes(slices) // PART_BYTES)
    heads = listed.repartition(partitions, "shard").sortWithinPartitions(*order).mapInArrow(head, PIECES)
    return heads.unionByName(data).withColumn("name", name)


def _name(sharding: ShardingSpec, shard: Column) -> Column:
    return F.concat(shard_hex(shard, sharding.shard_bits), F.lit(".shard"))


def id_shards(index: DataFrame, annotations: DataFrame, config: DataConfig, sharding: ShardingSpec) -> DataFrame:
    """Pieces of the shards of an id index (``id, shard, minishard``): a chunk for each annotation, with its relations."""
    rows = index.select("id", "shard", "minishard").join(encodable(annotations, config, True), "id")
    slices = _slices(rows, "id", [], config, [r.key for r in config.relations], False)
    return _pieces(slices, False, _name(sharding, F.col("shard")), lambda _: 1 << sharding.minishard_bits)


def relation_shards(index: DataFrame, annotations: DataFrame, config: DataConfig, sharding: ShardingSpec, relation: str) -> DataFrame:
    """Pieces of the shards of one relation of a relation index: a chunk for each related id, annotations by id."""
    rows = index.where(F.col("relation") == relation).select("rel_id", "shard", "minishard", "id").join(encodable(annotations, config), "id")
    return _pieces(_slices(rows, "rel_id", ["id"], config, [], True), True, _name(sharding, F.col("shard")), lambda _: 1 << sharding.minishard_bits)


def spatial_shards(index: DataFrame, annotations: DataFrame, config: DataConfig, specs: list[ShardingSpec]) -> DataFrame:
    """Pieces of the shards of all levels of a spatial index, in one pass: a chunk for each cell, annotations in their random order.

    Files are named ``spatial<level>/<shard>``; ``shard`` has the level above ``LEVEL_BITS`` bits of the shard's own number.
    """
    shard = F.shiftleft(F.col("level").cast("long"), LEVEL_BITS).bitwiseOR(F.col("shard"))
    rows = index.select("morton", shard.alias("shard"), "minishard", "id", "place").join(encodable(annotations, config), "id")
    name, level = None, F.shiftright("shard", LEVEL_BITS)
    for k, spec in enumerate(specs):
        own = F.concat(F.lit(f"spatial{k}/"), _name(spec, F.col("shard").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))))
        name = F.when(level == k, own) if name is None else name.when(level == k, own)
    return _pieces(_slices(rows, "morton", ["place"], config, [], True), True, name, lambda s: 1 << specs[s >> LEVEL_BITS].minishard_bits)


def unsharded(annotations: DataFrame, config: DataConfig) -> DataFrame:
    """Pieces of one file for each annotation, named by its id."""
    specs, keys, kind = property_order(config.properties), [r.key for r in config.relations], config.annotation_type

    def each(batches):
        for batch in batches:
            n, ids = batch.num_rows, batch.column("id").to_numpy()
            zero = [pa.array(np.zeros(n, t)) for t in (np.int64, np.int64, np.int32, np.int32, np.int64)]
            names = pa.array([str(i % (1 << 64)) for i in ids.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids), *zero, _binary(*pack_bodies(batch, kind, specs, keys)), names], [*ORDER, "content", "name"])

    return encodable(annotations, config, True).mapInArrow(each, f"{PIECES}, name string")


def unsharded_relation(index: DataFrame, annotations: DataFrame, config: DataConfig, relation: str) -> DataFrame:
    """Pieces of one file for each related id of a relation."""
    rows = index.where(F.col("relation") == relation).select("rel_id", F.col("rel_id").alias("shard"), F.lit(0).cast("long").alias("minishard"), "id")
    return _pieces(_slices(rows.join(encodable(annotations, config), "id"), "rel_id", ["id"], config, [], True), True, unsigned(F.col("shard")).cast("string"), None)


def whole(pieces: DataFrame) -> DataFrame:
    """``shard, name, content`` of files that are small enough for a row."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ORDER)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1].array, "name": rows["name"].iloc[:1].array, "content": [b"".join(rows["content"])]})

    return pieces.groupBy("shard").applyInPandas(one, "shard long, name string, content binary")


def write_files(pieces: DataFrame, directory: str, stale: str = r"[0-9a-f]+\.shard") -> int:
    """Write the files of ``pieces`` to a directory that all executors reach, a path or a URI; returns their number.

    A task streams the pieces of its files in order, into a folder beside the directory.  When all are written, tasks move them to their
    places, and files there whose names match ``stale`` and that weren't written go; if the writing fails, the directory is as it was.
    On an object store, which can't move, a file takes its place as soon as it is whole, and only stale ones wait for the end.
    """
    directory = directory.rstrip("/")
    parent, _, base = directory.rpartition("/")
    staged = f"{parent}/.{base}.{uuid.uuid4().hex}" if can_move(directory) else directory

    def put(batches):
        name, out, names = None, None, []
        try:
            for batch in batches:
                for own, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                    if own != name:
                        if out:
                            out.close()
                        name, out = own, Output(f"{staged}/{own}")
                        names.append(own)
                    out.write(content.as_buffer())
            if out:
                out.close()
                out = None
        finally:
            if out:
                out.abort()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    def move(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                put_in_place(f"{staged}/{name}", f"{directory}/{name}")
            yield batch

    ordered = pieces.repartition("shard").sortWithinPartitions(*ORDER).select("name", "content")
    try:
        names = cut(ordered.mapInArrow(put, "name string"), "names")
        if staged != directory:
            names = cut(names.mapInArrow(move, "name string"), "moved")
    finally:
        if staged != directory:
            remove_folder(staged)
    folders = [r[0] for r in names.select(F.regexp_extract("name", "^(.*?)[^/]*$", 1)).distinct().collect()]  # one, or one a level
    there = [f"{folder}{name}" for folder in folders for name in names_in(f"{directory}/{folder}") if re.fullmatch(stale, name)]
    if there:
        old = names.sparkSession.createDataFrame([(n,) for n in there], "name string").join(names, "name", "left_anti")
        remove_files([f"{directory}/{r['name']}" for r in old.collect()])
    return names.count()
