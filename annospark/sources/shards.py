"""Reading binary shards back as tables.

A shard file has an index of minishards, an index of chunks for each, and the chunks.  ``ids`` and ``groups`` give the annotations
of a folder of shards as a Spark data source: a partition is a range of one file's minishards and reads
the bytes that it needs by their offsets, a window at a time, so neither a file nor a chunk is ever held whole.  Filters on the chunk's
number are pushed down: they name the shard, the minishard and the chunk, and nothing else is read.

Bytes are taken apart by numpy: offsets of all annotations of a window first, then each field of all of them at once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from annospark.config import PROPERTY_TYPES, DataConfig, PropertySpec, ShardingSpec
from annospark.functions.bits import place
from annospark.operators.encode import DEFAULT_COLOUR, NUMBERS, property_order
from annospark.sources.files import filesystem

POINTS = "array<struct<x:float,y:float,z:float>>"
#: Bytes that are read and taken apart together; bytes of a partition, about; annotations of a large chunk in a batch.
WINDOW, PART_BYTES, STEP = 8 << 20, 64 << 20, 1 << 16

Read = Callable[[int, int], bytes]  # of where and how many


@dataclass(frozen=True)
class Layout:
    """What a body holds: geometry, properties in the format's order, keys of lists of related ids."""

    kind: str
    specs: tuple[PropertySpec, ...]
    keys: tuple[str, ...]

    @classmethod
    def of(cls, config: DataConfig, relations: bool) -> Layout:
        return cls(config.annotation_type, tuple(property_order(config.properties)), tuple(r.key for r in config.relations) if relations else ())

    @property
    def property_bytes(self) -> int:
        size = sum(PROPERTY_TYPES[s.type] for s in self.specs)
        return size + -size % 4

    @property
    def fixed(self) -> int | None:
        """Bytes of a body without lists, if all have as many."""
        points = {"POINT": 1, "LINE": 2}.get(self.kind)
        return points and 12 * points + self.property_bytes

    def fields(self) -> str:
        kind = lambda p: "array<smallint>" if p.type in DEFAULT_COLOUR else "float" if p.type == "float32" else "bigint"
        return ",".join(f"{p.id}:{kind(p)}" for p in self.specs) or "none:int"


def _spread(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all bytes of the ranges of ``sizes`` from ``at``, one range after the other."""
    return np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _fields(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    """The number of type ``kind`` at each place."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(np.dtype(kind).itemsize)]).view(kind).reshape(-1)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def decoded(data: np.ndarray, at: np.ndarray, layout: Layout) -> list[pa.Array]:
    """``points, properties`` and, if there are keys, ``relations`` of the bodies that begin at ``at``."""
    n, counts = len(at), np.full(len(at), {"POINT": 1, "LINE": 2}.get(layout.kind, 0), np.int64)
    if layout.kind == "POLYLINE":
        counts, at = _fields(data, at, "<u4").astype(np.int64), at + 4
    xyz = data[_spread(at, 12 * counts)].view("<f4").reshape(-1, 3)
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xyz[:, i])) for i in range(3)], ["x", "y", "z"])
    at, properties = at + 12 * counts, []
    start = at
    for s in layout.specs:
        if s.type in DEFAULT_COLOUR:
            width = PROPERTY_TYPES[s.type]
            colours = data[at[:, None] + np.arange(width)].astype(np.int16)
            properties.append(_lists(pa.array(colours.reshape(-1)), np.full(n, width)))
        else:
            values = _fields(data, at, NUMBERS[s.type])
            properties.append(pa.array(values if s.type == "float32" else values.astype(np.int64)))
        at = at + PROPERTY_TYPES[s.type]
    own = pa.StructArray.from_arrays(properties, [s.id for s in layout.specs]) if properties else pa.nulls(n, pa.struct([("none", pa.int32())]))
    out, at, flat, sizes = [_lists(points, counts), own], start + layout.property_bytes, [], []
    if not layout.keys:
        return out
    for _ in layout.keys:
        many = _fields(data, at, "<u4").astype(np.int64)
        flat.append(data[_spread(at + 4, 8 * many)].view("<i8"))
        sizes.append(many)
        at = at + 4 + 8 * many
    # Lists of one key after the other become those of one annotation after the other.
    k = len(layout.keys)
    by_key = _lists(pa.array(np.concatenate(flat)), np.concatenate(sizes))
    items = by_key.take(pa.array((np.arange(k)[None, :] * n + np.arange(n)[:, None]).reshape(-1)))
    ends = pa.array(np.arange(0, k * (n + 1), k, dtype=np.int32)[: n + 1])
    return [*out, pa.MapArray.from_arrays(ends, pa.array(list(layout.keys) * n, pa.string()), items)]


class Shard:
    """Chunks of one shard file, whose bytes ``read`` gives."""

    def __init__(self, read: Read, size: int, minishard_bits: int):
        self.read, self.size, self.base = read, size, 16 << minishard_bits

    def chunks(self, first: int, last: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Minishard, number, beginning and size of the chunks of minishards ``first`` to ``last`` (exclusive), or of those ``wanted``."""
        heads = np.frombuffer(self.read(16 * first, 16 * (last - first)), "<u8").reshape(-1, 2).astype(np.int64)
        out = []
        if len(heads) and ((heads[:, 0] > heads[:, 1]) | (self.base + heads[:, 1] > self.size)).any():
            raise ValueError("bad minishard index")
        for m, (start, end) in enumerate(heads.tolist(), first):
            if start == end:
                continue
            steps, gaps, sizes = np.frombuffer(self.read(self.base + start, end - start), "<u8").reshape(3, -1)
            number, size = np.cumsum(steps, dtype=np.uint64), sizes.astype(np.int64)
            begin = self.base + np.cumsum(gaps.astype(np.int64) + size) - size
            if (begin + size > self.size).any():
                raise ValueError("bad minishard index")
            keep = slice(None) if wanted is None else np.isin(number, wanted)
            out.append((np.full(len(number), m)[keep], number[keep], begin[keep], size[keep]))
        empty = np.empty(0, np.int64)
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (empty, empty.astype(np.uint64), empty, empty)

    def windows(self, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Runs of chunks that lie together, of about ``WINDOW`` bytes, with their bytes."""
        if not len(begin):
            return
        end, total = begin + size, np.cumsum(size)
        cuts = np.flatnonzero((begin[1:] != end[:-1]) | (total[1:] // WINDOW != total[:-1] // WINDOW)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(begin)], strict=True):
            yield slice(a, b), np.frombuffer(self.read(int(begin[a]), int(end[b - 1] - begin[a])), np.uint8)

    def single(self, layout: Layout, first: int, last: int, wanted: np.ndarray | None = None) -> Iterator[list[pa.Array]]:
        """``id, points, properties, relations`` of chunks that are an annotation each."""
        _, number, begin, size = self.chunks(first, last, wanted)
        for run, data in self.windows(begin, size):
            yield [pa.array(number[run].view(np.int64)), *decoded(data, begin[run] - begin[run][0], layout)]

    def grouped(self, layout: Layout, first: int, last: int, wanted: np.ndarray | None = None) -> Iterator[list[pa.Array]]:
        """``chunk, place, id, points, properties`` of chunks that are lists of annotations."""
        _, number, begin, size = self.chunks(first, last, wanted)
        large = size > WINDOW
        for run, data in self.windows(begin[~large], size[~large]):
            at, own = begin[~large][run] - begin[~large][run][0], number[~large][run]
            counts = _fields(data, at, "<u8").astype(np.int64)
            within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            if layout.fixed:
                bodies = np.repeat(at + 8, counts) + within * layout.fixed
            else:
                bodies = np.concatenate([_bodies(data, int(a) + 8, int(n), layout)[0] for a, n in zip(at, counts, strict=True)] or [within])
            ids = _fields(data, np.repeat(at + size[~large][run] - 8 * counts, counts) + 8 * within, "<i8")
            yield [pa.array(np.repeat(own, counts).view(np.int64)), pa.array((within + 1).astype(np.int32)), pa.array(ids), *decoded(data, bodies, layout)]
        for own, start, length in zip(number[large], begin[large].tolist(), size[large].tolist(), strict=True):
            yield from self.streamed(layout, own, start, length)

    def streamed(self, layout: Layout, number: np.uint64, start: int, size: int) -> Iterator[list[pa.Array]]:
        """A chunk of any size, some annotations at a time: their bodies, and their ids from the chunk's end."""
        count = int(np.frombuffer(self.read(start, 8), "<u8")[0])
        ids_at, done, at, window = start + size - 8 * count, 0, start + 8, WINDOW
        while done < count:
            if layout.fixed:
                n = min(STEP, count - done)
                bodies, used = np.arange(n) * layout.fixed, n * layout.fixed
                data = np.frombuffer(self.read(at, used), np.uint8)
            else:
                data = np.frombuffer(self.read(at, min(window, ids_at - at)), np.uint8)
                bodies, used = _bodies(data, 0, min(STEP, count - done), layout)
                if not len(bodies):
                    if len(data) == ids_at - at:
                        raise ValueError("a chunk ends within an annotation")
                    window *= 2  # an annotation that is longer
                    continue
            n = len(bodies)
            ids = np.frombuffer(self.read(ids_at + 8 * done, 8 * n), "<i8")
            yield [pa.array(np.full(n, number, np.uint64).view(np.int64)), pa.array(np.arange(done + 1, done + n + 1, dtype=np.int32)), pa.array(ids), *decoded(data, bodies, layout)]
            done, at = done + n, at + used


def _bodies(data: np.ndarray, at: int, n: int, layout: Layout) -> tuple[np.ndarray, int]:
    """Where up to ``n`` whole polylines begin from ``at`` on, and where the last one ends."""
    out, rest, points = [], layout.property_bytes, data.data
    while len(out) < n and at + 4 <= len(data):
        end = at + 4 + 12 * int.from_bytes(points[at : at + 4], "little") + rest
        if end > len(data):
            break
        out.append(at)
        at = end
    return np.array(out, np.int64), at


@dataclass
class Part(InputPartition):
    """Minishards ``first`` to ``last`` (exclusive) of a file, or of these the chunks ``wanted``."""

    name: str
    first: int
    last: int
    wanted: tuple[int, ...] | None = None


class ShardReader(DataSourceReader):
    def __init__(self, path: str, layout: Layout, sharding: ShardingSpec, grouped: bool):
        self.path, self.layout, self.sharding, self.grouped = path.rstrip("/"), layout, sharding, grouped
        self.wanted: list[int] | None = None
        self.bytes_read = 0

    def pushFilters(self, filters):
        """Takes the chunks that ``=`` and ``in`` name; Spark filters once more."""
        column = "chunk" if self.grouped else "id"
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == (column,):
                named = {int(v) for v in (f.value if isinstance(f, In) else [f.value]) if v is not None}
                self.wanted = sorted(named if self.wanted is None else named & set(self.wanted))
            yield f

    def partitions(self):
        spec = self.sharding
        digits = max(1, -(-spec.shard_bits // 4))
        system, root = filesystem(self.path)
        if self.wanted is not None:
            by: dict[tuple[int, int], list[int]] = {}
            for i in self.wanted:
                by.setdefault(place(i, spec.shard_bits, spec.minishard_bits, spec.preshift_bits, spec.hash), []).append(i)
            return [Part(f"{shard:0{digits}x}.shard", m, m + 1, tuple(ids)) for (shard, m), ids in sorted(by.items())] or [Part("", 0, 0)]
        parts = []
        for f in system.get_file_info(fs.FileSelector(root)):
            if f.base_name.endswith(".shard"):
                n = min(1 << spec.minishard_bits, max(1, -(-f.size // PART_BYTES)))
                ends = [(k << spec.minishard_bits) // n for k in range(n + 1)]
                parts += [Part(f.base_name, a, b) for a, b in zip(ends, ends[1:], strict=False)]
        return sorted(parts, key=lambda p: (p.name, p.first)) or [Part("", 0, 0)]

    def read(self, part: Part):
        system, root = filesystem(self.path)
        found = system.get_file_info(f"{root}/{part.name}") if part.name else None
        if found is None or found.type != fs.FileType.File:
            return  # a shard without chunks has no file
        with system.open_input_file(found.path) as file:

            def read(at: int, n: int) -> bytes:
                self.bytes_read += n
                return file.read_at(n, at)

            shard = Shard(read, found.size, self.sharding.minishard_bits)
            wanted = None if part.wanted is None else np.array([i % (1 << 64) for i in part.wanted], np.uint64)
            names = [c.split()[0] for c in schema_of(self.layout, self.grouped).split(", ")]
            for columns in (shard.grouped if self.grouped else shard.single)(self.layout, part.first, part.last, wanted):
                if self.grouped:
                    columns = [pa.array([part.name] * len(columns[0]), pa.string()), *columns]
                elif not self.layout.keys:
                    columns = [*columns, pa.nulls(len(columns[0]), pa.map_(pa.string(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, names)


def schema_of(layout: Layout, grouped: bool) -> str:
    if grouped:
        return f"name string, chunk long, place int, id long, points {POINTS}, properties struct<{layout.fields()}>"
    return f"id long, points {POINTS}, properties struct<{layout.fields()}>, relations map<string,array<bigint>>"


class ShardSource(DataSource):
    """Format ``annotation_shards``."""

    @classmethod
    def name(cls):
        return "annotation_shards"

    def _layout(self) -> Layout:
        given = json.loads(self.options["layout"])
        return Layout(given["kind"], tuple(PropertySpec(i, t, i) for i, t in given["properties"]), tuple(given["keys"]))

    def schema(self):
        return schema_of(self._layout(), self.options["grouped"] == "true")

    def reader(self, schema):
        return ShardReader(self.options["path"], self._layout(), ShardingSpec.from_json(json.loads(self.options["sharding"])), self.options["grouped"] == "true")


def _load(spark: SparkSession, path: str, config: DataConfig, sharding: ShardingSpec, grouped: bool) -> DataFrame:
    layout = Layout.of(config, not grouped)
    spark.dataSource.register(ShardSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    told = {"kind": layout.kind, "properties": [(s.id, s.type) for s in layout.specs], "keys": layout.keys}
    options = {"path": path, "layout": json.dumps(told), "sharding": json.dumps(sharding.as_json()), "grouped": str(grouped).lower()}
    return spark.read.format(ShardSource.name()).options(**options).load()


def ids(spark: SparkSession, path: str, config: DataConfig, sharding: ShardingSpec) -> DataFrame:
    """``id, points, properties, relations`` of the shards of an id index in a folder; filters ``id = ...`` and ``id in (...)`` read those chunks only."""
    return _load(spark, path, config, sharding, False)


def groups(spark: SparkSession, path: str, config: DataConfig, sharding: ShardingSpec) -> DataFrame:
    """``name, chunk, place, id, points, properties`` of the shards of a relation, or of a spatial level, in a folder.

    ``chunk`` is the related id, or the cell's Morton code; filters ``chunk = ...`` and ``chunk in (...)`` read those chunks only.
    """
    return _load(spark, path, config, sharding, True)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``name, content`` of every shard file below ``path``, for files that are small enough for a row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shard").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def in_memory(content: bytes, minishard_bits: int) -> Shard:
    return Shard(lambda at, n: content[at : at + n], len(content), minishard_bits)


def chunks_of(content: bytes, minishard_bits: int) -> list[tuple[int, int, bytes]]:
    """(minishard, id, data) of every chunk of a shard, by the offsets that its indices give."""
    found = in_memory(content, minishard_bits).chunks(0, 1 << minishard_bits)
    return [(m, i, content[at : at + n]) for m, i, at, n in zip(*(c.tolist() for c in found), strict=True)]


def decode_ids(shards: DataFrame, config: DataConfig, minishard_bits: int) -> DataFrame:
    """``id, points, properties, relations`` of the annotations in shards (``content``) of an id index."""
    layout = Layout.of(config, True)

    def each(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for columns in in_memory(content, minishard_bits).single(layout, 0, 1 << minishard_bits):
                    if not layout.keys:
                        columns = [*columns, pa.nulls(len(columns[0]), pa.map_(pa.string(), pa.list_(pa.int64())))]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "points", "properties", "relations"])

    return shards.select("content").mapInArrow(each, schema_of(layout, False))


def decode_groups(shards: DataFrame, config: DataConfig, minishard_bits: int) -> DataFrame:
    """``name, chunk, place, id, points, properties`` of the annotations in shards (``name, content``) of a relation or spatial index."""
    layout = Layout.of(config, False)

    def each(batches):
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                for columns in in_memory(content, minishard_bits).grouped(layout, 0, 1 << minishard_bits):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(columns[0]), pa.string()), *columns], ["name", "chunk", "place", "id", "points", "properties"])

    return shards.select("name", "content").mapInArrow(each, schema_of(layout, True))
