"""Boxes, segments and annotations as predicates over ``array<struct<x,y,z>>`` columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
#: Decimals that coordinates and bounds are rounded to, and the size below which a step counts as parallel.
PLACES, PARALLEL = 10, 1e-9


@dataclass(frozen=True)
class Box:
    """Bounds in physical units, both ends inclusive."""

    low: tuple[float, float, float]
    high: tuple[float, float, float]

    @classmethod
    def of(cls, low, high, resolution=(1, 1, 1)) -> Box:
        scaled = [tuple(round(float(v) * r, PLACES) for v, r in zip(side, resolution, strict=True)) for side in (low, high)]
        return cls(*scaled)

    @property
    def shape(self) -> tuple[float, ...]:
        return tuple(h - w for w, h in zip(self.low, self.high, strict=True))


def _side(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def contains(point: Column, box: Box, resolution=(1, 1, 1)) -> Column:
    """Whether a point, scaled by ``resolution``, is in ``box``, whose sides may be columns."""
    inside = [(point[a] * F.lit(float(r))).between(_side(box.low[i]), _side(box.high[i])) for i, (a, r) in enumerate(zip(AXES, resolution, strict=True))]
    return reduce(and_, inside)


def segment_meets(start: Column, end: Column, box: Box, resolution=(1, 1, 1)) -> Column:
    """Whether the segment meets ``box``: its share inside each axis's slab is an interval, and the three overlap."""
    enter, leave, beside = [F.lit(0.0)], [F.lit(1.0)], []
    for i, (a, r) in enumerate(zip(AXES, resolution, strict=True)):
        s, low, high = start[a] * F.lit(float(r)), _side(box.low[i]), _side(box.high[i])
        step = end[a] * F.lit(float(r)) - s
        flat = F.abs(step) < PARALLEL
        one, two = ((edge - s) / F.when(~flat, step) for edge in (low, high))
        enter.append(F.coalesce(F.least(one, two), F.lit(0.0)))
        leave.append(F.coalesce(F.greatest(one, two), F.lit(1.0)))
        beside.append(~flat | s.between(low, high))
    crosses = reduce(and_, beside) & (F.greatest(*enter) <= F.least(*leave))
    return contains(start, box, resolution) | contains(end, box, resolution) | crosses


def segments(points: Column) -> Column:
    """Consecutive points as ``array<struct<a,b>>``."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(points) - 1, F.lit(1))), lambda i: F.struct(F.get(points, i - 1).alias("a"), F.coalesce(F.get(points, i), F.get(points, i - 1)).alias("b"))
    )


def in_bounds(points: Column, box: Box, resolution=(1, 1, 1), strict: bool = False) -> Column:
    """Whether an annotation is in ``box``: all its points if ``strict``, else its point or any segment of it.  One without points isn't."""
    if strict:
        return F.coalesce(F.forall(points, lambda p: contains(p, box, resolution)) & (F.size(points) > 0), F.lit(False))
    return F.coalesce(F.exists(segments(points), lambda s: segment_meets(s["a"], s["b"], box, resolution)), F.lit(False))


def any_inside(points: Column, box: Box, resolution=(1, 1, 1)) -> Column:
    """Whether any point is in ``box``; not so for null points, or none."""
    return F.coalesce(F.exists(points, lambda p: contains(p, box, resolution)), F.lit(False))


def convert(points: Column, have, want) -> Column:
    """Points in units of ``have`` as points in units of ``want``, rounded."""
    rounded = lambda p: F.struct(*(F.round(p[a] * F.lit(float(h)) / F.lit(float(w)), PLACES).alias(a) for a, h, w in zip(AXES, have, want, strict=True)))
    return F.transform(points, rounded)


def bounds_of(points: str) -> list[Column]:
    """Aggregates for the least and largest coordinate over all points of a column, as ``x_low, x_high, ...``."""
    out = []
    for a in AXES:
        values = F.expr(f"transform(`{points}`, p -> p.{a})")
        out += [F.min(F.array_min(values)).alias(f"{a}_low"), F.max(F.array_max(values)).alias(f"{a}_high")]
    return out


def cell_volume(box: Box, level: int, nanometres=(1, 1, 1)) -> float:
    """Cubic micrometres of a cell of ``level``."""
    out = 1.0
    for width, size in zip(box.shape, nanometres, strict=True):
        out *= width / (1 << level) * size / 1000
    return out


def voxel_extent(box: Box, level: int) -> list[float]:
    return [width / (1 << level) for width in box.shape]
