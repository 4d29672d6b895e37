"""Assertions about tables, as queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.config import COLOURS, DataConfig
from annospark.functions.geometry import Box, any_inside, in_bounds
from annospark.functions.values import bad_colour, bad_relation
from annospark.operators.octree import CELL

#: A cell of more rows than the limit by this factor is worth a warning.
SPARE = 1.2
#: Undeclared labels that an error names.
NAMED = 100


def duplicate_ids(df: DataFrame, *ids: str) -> DataFrame:
    """``rows, distinct, duplicates`` of the ids, aggregated in two steps so that no task holds all of them."""
    each = df.groupBy(*ids).agg(F.count("*").alias("n"))
    out = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct"))
    return out.withColumn("duplicates", F.col("rows") - F.col("distinct"))


def require_unique(df: DataFrame, *ids: str) -> DataFrame:
    """``df``, or a ValueError that names one repeated id."""
    twice = df.groupBy(*ids).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"repeated id {[twice[0][i] for i in ids]}")
    return df


def undeclared(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """``label``: each value of a column that isn't among ``labels``, once."""
    value = F.col(f"`{column}`").cast("string")
    return df.where(value.isNotNull() & ~value.isin(labels)).select(value.alias("label")).distinct()


def require_labels(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """``df``, or a ValueError that names labels that occur but aren't declared, ``NAMED`` at most."""
    found = sorted(r[0] for r in undeclared(df, column, labels).limit(NAMED).collect())
    if found:
        raise ValueError(f"{column} has undeclared labels: {found}")
    return df


def require_values(df: DataFrame, config: DataConfig) -> DataFrame:
    """``df``, or a ValueError that names a relation field without ids or declared label, or a malformed colour."""
    enums = {p.column: list(p.enum_labels) for p in config.properties if p.enum_labels}
    wrong = {r.column: bad_relation(F.col(r.column), enums.get(r.column, [])) for r in config.relations}
    wrong |= {p.column: bad_colour(F.col(p.column), len(p.type)) for p in config.properties if p.type in COLOURS}
    if wrong:
        some = [F.min(F.when(bad, F.col(c).cast("string"))).alias(c) for c, bad in wrong.items()]
        found = {c: v for c, v in df.agg(*some).first().asDict().items() if v is not None}
        if found:
            raise ValueError(f"fields that can't be read: {found}")
    return df


def conserved(index: DataFrame, annotations: DataFrame) -> DataFrame:
    """``rows, held, copies, lost``: annotations, distinct ones in a spatial index, further entries of them, and those that it hasn't."""
    each = index.groupBy("id").agg(F.count("*").alias("entries"))
    both = annotations.select(F.col("id").alias("_id")).join(each, F.col("_id") == F.col("id"), "left")
    counts = both.agg(F.count("*").alias("rows"), F.count("id").alias("held"), F.coalesce(F.sum(F.col("entries") - 1), F.lit(0)).alias("copies"))
    return counts.withColumn("lost", F.col("rows") - F.col("held"))


def density(index: DataFrame, volume: float, per_volume: float, splits: int = 1) -> DataFrame:
    """``level, cx, cy, cz, rows, verdict``: ``error`` above the limit of a cell of ``volume``, ``warning`` near it, else ``ok``.

    Cells are eight times as small with each level.  A split's share of the limit is rounded down.
    """
    limit = F.lit(volume * per_volume) / F.pow(F.lit(8.0), F.col("level"))
    cells = index.groupBy("level", *CELL).agg(F.count("*").alias("rows"))
    verdict = F.when(F.col("rows") > limit, "error").when(F.col("rows") > SPARE * F.floor(limit / splits), "warning").otherwise("ok")
    return cells.withColumn("verdict", verdict)


def outside(annotations: DataFrame, box: Box, resolution=(1, 1, 1)) -> DataFrame:
    """The annotations none of whose points is in ``box``, those without points included."""
    return annotations.where(~any_inside(F.col("points"), box, resolution))


def misplaced(annotations: DataFrame, kind: str, box: Box, resolution=(1, 1, 1)) -> DataFrame:
    """Annotations that ``box`` shouldn't hold: a point outside it, or a line with both ends outside it."""
    held = in_bounds(F.col("points"), box, resolution, strict=True) if kind == "POINT" else any_inside(F.col("points"), box, resolution)
    return annotations.where(~held) if kind != "POLYLINE" else annotations.limit(0)


def row_limit(volume: float, per_volume: float, splits: int) -> int:
    return math.floor(volume * per_volume / splits)


def require_rows(df: DataFrame, expected: int) -> DataFrame:
    """``df``, or a ValueError if it hasn't as many rows as expected."""
    if (n := df.count()) != expected:
        raise ValueError(f"{n} rows where {expected} were expected")
    return df
