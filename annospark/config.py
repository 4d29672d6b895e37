"""What a dataset's columns mean: ids, points, properties, relations, sharding."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import types as T

from annospark.functions.bits import HASHES
from annospark.functions.values import key_of
from annospark.names import free_name as free_name

#: Property types of the format with their bytes, in the order that the encoder writes sizes.
PROPERTY_TYPES = {"uint32": 4, "int32": 4, "float32": 4, "uint16": 2, "int16": 2, "uint8": 1, "int8": 1, "rgb": 3, "rgba": 4}
COLOURS = ("rgb", "rgba")
NAME = re.compile(r"[a-z][a-zA-Z0-9_]*")
ANNOTATION_TYPES = ("POINT", "LINE", "POLYLINE")


@dataclass(frozen=True)
class ShardingSpec:
    shard_bits: int
    minishard_bits: int
    preshift_bits: int = 0
    hash: str = HASHES[0]

    def __post_init__(self):
        if self.hash not in HASHES:
            raise ValueError(f"unknown hash {self.hash!r}")

    def as_json(self) -> dict:
        kind = {"@type": "neuroglancer_uint64_sharded_v1", "hash": self.hash, "preshift_bits": self.preshift_bits, "minishard_bits": self.minishard_bits}
        return kind | {"shard_bits": self.shard_bits, "minishard_index_encoding": "raw", "data_encoding": "raw"}

    @classmethod
    def from_json(cls, d: dict) -> ShardingSpec:
        if (d.get("minishard_index_encoding", "raw"), d.get("data_encoding", "raw")) != ("raw", "raw"):
            raise ValueError("only raw encodings are supported: offsets of a compressed index would be wrong")
        return cls(d["shard_bits"], d["minishard_bits"], d.get("preshift_bits", 0), d["hash"])


@dataclass(frozen=True)
class PropertySpec:
    id: str
    type: str
    column: str
    enum_values: tuple[int, ...] | None = None
    enum_labels: tuple[str, ...] | None = None

    def __post_init__(self):
        if not NAME.fullmatch(self.id):
            raise ValueError(f"bad property name {self.id!r}")
        if self.type not in PROPERTY_TYPES:
            raise ValueError(f"bad property type {self.type!r}")
        if (self.enum_values is None) != (self.enum_labels is None):
            raise ValueError(f"{self.id}: enum_values and enum_labels go together")
        if self.enum_values is not None:
            if self.type in COLOURS:
                raise ValueError(f"{self.id}: a colour can't be an enum")
            if len(self.enum_values) != len(self.enum_labels):
                raise ValueError(f"{self.id}: as many enum_values as enum_labels are needed")

    @property
    def missing(self) -> int | None:
        """The value of the label NULL."""
        return dict(zip(self.enum_labels[::-1], self.enum_values[::-1], strict=True)).get("NULL") if self.enum_labels else None

    def with_null(self) -> PropertySpec:
        """With a label NULL, of the first unused value of -1, -2, ..."""
        if self.enum_labels is None or "NULL" in self.enum_labels:
            return self
        value = -1
        while value in self.enum_values:
            value -= 1
        return PropertySpec(self.id, self.type, self.column, (*self.enum_values, value), (*self.enum_labels, "NULL"))

    def as_json(self) -> dict:
        out = {"id": self.id, "type": self.type, "description": self.id}
        return out | ({"enum_values": list(self.enum_values), "enum_labels": list(self.enum_labels)} if self.enum_labels else {})


@dataclass(frozen=True)
class Relationship:
    label: str
    column: str

    @property
    def key(self) -> str:
        return key_of(self.label)

    def as_json(self, sharding: ShardingSpec | None) -> dict:
        return {"id": self.label, "key": self.key} | ({"sharding": sharding.as_json()} if sharding else {})


@dataclass(frozen=True)
class DataConfig:
    """``points``: (x, y, z) columns of each point in order, or the name of one column of ``x,y,z;x,y,z``."""

    columns: tuple[tuple[str, str], ...]
    id_column: str | None
    annotation_type: str
    points: tuple[tuple[str, str, str], ...] | str
    properties: tuple[PropertySpec, ...] = ()
    relations: tuple[Relationship, ...] = ()
    dimensions: dict = field(default_factory=lambda: {a: [1, ""] for a in "xyz"}, hash=False)
    bounds: tuple[tuple[float, ...], tuple[float, ...]] | None = None
    max_per_cubic_micron: float | None = None

    def __post_init__(self):
        if self.annotation_type not in ANNOTATION_TYPES:
            raise ValueError(f"bad annotation type {self.annotation_type!r}")
        keys = [r.key for r in self.relations]
        if len(set(keys)) < len(keys):
            raise ValueError(f"relation keys collide: {keys}")

    def relation(self, key: str) -> Relationship:
        """The relation of a key, as directories and index rows name it; a KeyError for any other."""
        return {r.key: r for r in self.relations}[key]

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in self.columns))

    @property
    def resolution(self) -> tuple[float, ...]:
        return tuple(float(self.dimensions[a][0]) for a in "xyz")

    @classmethod
    def from_json(cls, text: str | dict, override: dict | None = None) -> DataConfig:
        """From a JSON data configuration; ``override`` is merged into it at any depth."""
        d = merged(json.loads(text) if isinstance(text, str) else text, override or {})
        properties: list[PropertySpec] = []
        for name, p in (d.get("properties") or {}).items():
            name = name.lower().replace(" ", "_")
            if p["type"] == "vector":
                properties += [PropertySpec(f"{name}_{a}", "float32", f"{name}_{a}") for a in "xyz"]
            else:
                enum = [tuple(p[k]) if p.get(k) else None for k in ("enum_values", "enum_labels")]
                properties.append(PropertySpec(name, p["type"], p["id"], *enum).with_null())
        kind, labels = annotation_of(d)
        at = d["spatial_pt_columns"]
        points = "Points" if at == "single_field_list" else tuple(tuple(at[k][a] for a in "xyz") for k in labels or at)
        columns = d["columns"]
        types = d.get("column_types", {})
        typed = {c for p in (points if not isinstance(points, str) else ()) for c in p}
        columns = tuple((c, types.get(c, "double" if c in typed else "bigint" if c == d.get("id_column") else "string")) for c in columns)
        relations = tuple(Relationship(label, r["id"]) for label, r in (d.get("relations") or {}).items())
        dimensions = {a: list(d["dimensions"][a]) for a in "xyz"}
        bounds = tuple(map(tuple, d["volume_bounds"])) if d.get("volume_bounds") else None
        return cls(columns, d.get("id_column"), kind, points, tuple(properties), relations, dimensions, bounds, (d.get("spatial_limit") or {}).get("max_annotations_per_cubic_micron"))


def annotation_of(d: dict) -> tuple[str, list[str]]:
    """The annotation type of a configuration and the labels of its points in order (empty: all)."""
    if line := d.get("line_annotation_config"):
        return "LINE", [line["start_pt_column_label"], line["end_pt_column_label"]]
    if d.get("polyline_annotation_config"):
        return "POLYLINE", []
    point = d.get("point_annotation_config") or {}
    label = point.get("pt_column_label") or point.get("position_pt_column_label")
    return "POINT", [label] if label else []


def merged(base: dict, over: dict) -> dict:
    """``base`` with ``over`` laid over it, key by key at any depth."""
    both = {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}
    return {**base, **both}


def run_label(debug: bool = False) -> str:
    """A name for a run from the time in UTC; always the same when debugging."""
    at = datetime(2000, 1, 1, tzinfo=timezone.utc) if debug else datetime.now(timezone.utc)
    return at.strftime("%Y-%m-%d_%H-%M-%S_%Z")
