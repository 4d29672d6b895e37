"""Enums, relations, colours, point lists and names."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import AXES

POINTS = "array<struct<x:double,y:double,z:double>>"


def enum_value(label: Column, labels: list[str], values: list[int], missing: int | None = None) -> Column:
    """The value of a label, the first one's if it repeats; ``missing`` for an undeclared one."""
    first: dict[str, int] = {}
    for k, v in zip(labels, values, strict=True):
        first.setdefault(k, v)
    table = F.create_map(*(F.lit(x) for pair in first.items() for x in pair)) if first else F.create_map().cast("map<string,int>")
    return F.coalesce(F.element_at(table, label.cast("string")), F.lit(missing).cast("int"))


def relation_ids(text: Column) -> Column:
    """Ids of a relation field: ``5``, ``1,2`` or ``[1,2]``; null if it holds anything else, such as a label."""
    inner = F.regexp_replace(F.trim(text.cast("string")), r"^[\[(]\s*(.*?)\s*,?\s*[\])]$", "$1")
    whole = F.when(inner == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(inner, r"\s*,\s*"), lambda x: x.try_cast("bigint")))
    return F.when(F.forall(whole, lambda x: x.isNotNull()), whole)


def relation_ids_or_enum(text: Column, labels: list[str], values: list[int]) -> Column:
    """``relation_ids``, or the value of the enum that shares the column if the field is one of its labels; else null."""
    by_label = enum_value(text, labels, values)
    return F.coalesce(relation_ids(text), F.when(by_label.isNotNull(), F.array(by_label.cast("bigint"))))


def bad_relation(text: Column, labels: list[str] = ()) -> Column:
    """Whether a relation field is neither null or blank, nor ids, nor one of the labels."""
    bare = F.trim(text.cast("string"))
    return F.coalesce((bare != "") & relation_ids(text).isNull() & ~bare.isin(*labels), F.lit(False))


def bad_colour(text: Column, channels: int = 3) -> Column:
    """Whether a colour field is not null and not ``#`` with two hexadecimal digits a channel."""
    return F.coalesce(~text.rlike(rf"^#[0-9a-fA-F]{{{2 * channels}}}$"), F.lit(False))


def relation_key(label: Column) -> Column:
    """A relation's directory name: lower case, without ASCII punctuation, white space as underscores."""
    bare = F.regexp_replace(F.lower(label), r"\p{Punct}", "")
    return F.regexp_replace(bare, r"\s+", "_")


def key_of(label: str) -> str:
    """``relation_key`` for one label."""
    return re.sub(r"\s+", "_", label.lower().translate(str.maketrans("", "", string.punctuation)))


def colour(text: Column, channels: int = 3) -> Column:
    """``#rrggbb`` or ``#rrggbbaa`` as an array of ``channels`` numbers; null for anything else."""
    digits = F.regexp_extract(text, rf"^#([0-9a-fA-F]{{{2 * channels}}})$", 1)
    parts = [F.conv(F.substring(digits, 2 * i + 1, 2), 16, 10).cast("smallint") for i in range(channels)]
    return F.when(digits != "", F.array(*parts))


def parse_points(text: Column) -> Column:
    """``x,y,z;x,y,z`` as an array of points; a field that isn't three numbers raises."""
    point = lambda t: F.struct(*(F.element_at(F.split(t, ","), i + 1).cast("double").alias(a) for i, a in enumerate(AXES)))
    return F.transform(F.split(F.trim(text), ";"), point)


def format_points(points: Column) -> Column:
    return F.array_join(F.transform(points, lambda p: F.concat_ws(",", *(p[a].cast("string") for a in AXES))), ";")


def mean_step(points: Column) -> Column:
    """The mean step from point to point, (last - first) / (n - 1); zero for fewer than two points."""
    n = F.size(points)
    last, first = F.element_at(points, F.when(n > 0, -1)), F.element_at(points, F.when(n > 0, 1))
    return F.struct(*(F.when(n > 1, (last[a] - first[a]) / F.nullif(n - 1, F.lit(0))).otherwise(0.0).alias(a) for a in AXES))


def cell_name(x: Column, y: Column, z: Column) -> Column:
    return F.concat_ws("_", x, y, z)


def parse_cell(name: Column) -> Column:
    parts = F.split(name, "_")
    return F.struct(*(F.element_at(parts, i + 1).cast("int").alias(f"c{a}") for i, a in enumerate(AXES)))


def duration(seconds: float) -> str:
    """Seconds for people: milliseconds under one, hours and minutes from a minute up."""
    if seconds < 1:
        return f"{seconds * 1000:.0f}ms"
    if seconds < 60:
        return f"{seconds:.1f}s"
    minutes, rest = divmod(round(seconds), 60)
    return f"{minutes // 60}h {minutes % 60}m {rest}s" if minutes >= 60 else f"{minutes}m {rest}s"
