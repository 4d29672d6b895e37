"""Building all indices of a table at once."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.config import DataConfig, ShardingSpec
from annospark.functions.geometry import Box, cell_volume, voxel_extent
from annospark.lineage import cut
from annospark.operators import encode
from annospark.operators.checks import conserved, density, outside, require_labels, require_unique, require_values
from annospark.operators.indexes import id_index, relation_index, spatial_index
from annospark.plans.lookup import write_index
from annospark.plans.sharding import CELL_ROWS, MAX_LEVELS, plan_level, plan_measured, plan_sharding
from annospark.sources.files import write_text
from annospark.sources.tables import annotations as annotations_of
from annospark.sources.tables import read_input, volume_bounds


@dataclass(frozen=True)
class Plan:
    by_id: ShardingSpec
    relation: ShardingSpec
    levels: tuple[ShardingSpec, ...]
    cell_rows: int


@dataclass(frozen=True)
class Given:
    """Sharding that isn't to be planned, and what planning aims at (``hash, minishard_target, shard_target``).

    ``measured``: the relation index is planned from the sizes of its lists instead of their mean.
    """

    by_id: ShardingSpec | None = None
    relation: ShardingSpec | None = None
    levels: tuple[ShardingSpec, ...] | None = None
    targets: dict = field(default_factory=dict, hash=False)
    measured: bool = False


def plan(rows: int, size: int, cell_rows: int = CELL_ROWS, max_levels: int = MAX_LEVELS, related: tuple[int, int] | None = None, given: Given | None = None) -> Plan:
    """Sharding of every index of data of ``rows`` and ``size`` bytes.

    ``related``: the number of related ids and of all their entries; without it, one entry a row and id.  What ``given``
    names is taken as it is, and the rest planned.
    """
    given = given or Given()
    ids, entries = related or (rows, rows)
    by_id = given.by_id or plan_sharding(rows, size, **given.targets)
    relation = given.relation or plan_sharding(ids, 8 * ids + entries * -(-size // max(1, rows)), **given.targets)
    levels = given.levels or tuple(plan_level(k, rows, size, cell_rows, **given.targets) for k in range(max_levels))
    for spec in (by_id, relation, *levels):
        if spec.preshift_bits:
            raise ValueError("a preshift isn't supported in a build: neighbouring ids would share shards")
    return Plan(by_id, relation, tuple(levels), cell_rows)


def info(config: DataConfig, bounds: Box, plan: Plan, levels: int) -> dict:
    """What a viewer needs to know, as it is written to ``info``."""
    spatial = [
        {"key": f"spatial{k}", "grid_shape": [1 << k] * 3, "chunk_size": voxel_extent(bounds, k), "limit": plan.cell_rows, "sharding": plan.levels[k].as_json()}
        for k in range(levels)
    ]
    validate_levels(spatial)
    return {
        "@type": "neuroglancer_annotations_v1",
        "annotation_type": config.annotation_type,
        "by_id": {"key": "by_id", "sharding": plan.by_id.as_json()},
        "dimensions": config.dimensions,
        "lower_bound": list(bounds.low),
        "upper_bound": list(bounds.high),
        "properties": [p.as_json() for p in config.properties],
        "relationships": [r.as_json(plan.relation) for r in config.relations],
        "spatial": spatial,
    }


def validate_levels(spatial: list[dict]) -> None:
    """Cells never grow from level to level, and all levels span the same volume."""
    for a, b in zip(spatial, spatial[1:], strict=False):
        for i in range(3):
            if b["chunk_size"][i] > a["chunk_size"][i]:
                raise ValueError(f"{b['key']}: cells grow")
            spans = [s["chunk_size"][i] * s["grid_shape"][i] for s in (a, b)]
            if abs(spans[0] - spans[1]) > 1e-6 * max(1.0, abs(spans[0])):
                raise ValueError(f"{b['key']}: spans {spans[1]}, not {spans[0]}")


@dataclass
class Indices:
    annotations: DataFrame
    by_id: DataFrame
    relation: DataFrame
    spatial: DataFrame
    bounds: Box
    plan: Plan
    levels: int


def index(rows: DataFrame, config: DataConfig, size: int | None = None, cell_rows: int = CELL_ROWS, max_levels: int = MAX_LEVELS, strict: bool = True, given: Given | None = None, crossing: bool = False) -> Indices:
    """All indices of a configured table; ``crossing`` enters lines and polylines in every octree cell that they cross.

    ``strict``: repeated ids, undeclared enum labels, relation fields without ids or label, malformed colours, annotations
    outside the bounds, entries lost on the way down the octree, and cells denser than the configuration allows raise.
    """
    if strict:
        require_values(rows, config)
        for p in config.properties:
            if p.enum_labels:
                require_labels(rows, p.column, list(p.enum_labels))
    table = cut(annotations_of(rows, config), "annotations")
    if strict:
        require_unique(table, "id")
    bounds = Box.of(*config.bounds) if config.bounds else volume_bounds(table)
    if strict and (lost := outside(table, bounds).limit(1).collect()):
        raise ValueError(f"annotation {lost[0]['id']} has no point inside the bounds")
    count = table.count()
    entries = F.aggregate(F.map_values("relations"), F.lit(0).cast("long"), lambda n, ids: n + F.coalesce(F.size(ids), F.lit(0)))
    n_related = table.agg(F.coalesce(F.sum(entries), F.lit(0))).first()[0]
    n_ids = table.select(F.explode("relations").alias("relation", "ids")).select(F.explode("ids").alias("id")).agg(F.approx_count_distinct("id")).first()[0]
    if given and given.measured and not given.relation:
        lists = table.select(F.explode("relations").alias("relation", "ids")).select("relation", F.explode("ids").alias("id"))
        each = -(-(size if size is not None else 64 * count) // max(1, count))
        given = replace(given, relation=plan_measured(lists, "id", F.lit(each), **given.targets).spec)
    made = plan(count, size if size is not None else 64 * count, cell_rows, max_levels, (n_ids, n_related), given)
    spatial = cut(spatial_index(table, bounds, list(made.levels), cell_rows, max_levels, crossing=crossing), "spatial")
    levels = (spatial.agg(F.max("level")).first()[0] or 0) + 1
    if strict:
        if conserved(spatial, table).first()["lost"]:
            raise ValueError("annotations are missing from the spatial index")
        if config.max_per_cubic_micron and (bad := density(spatial, cell_volume(bounds, 0, config.resolution), config.max_per_cubic_micron).where("verdict = 'error'").limit(1).collect()):
            raise ValueError(f"too dense: {bad[0].asDict()}")
    return Indices(table, id_index(table, made.by_id), relation_index(table, made.relation), spatial, bounds, made, levels)


def run(spark: SparkSession, path: str, config: DataConfig, out: str, size: int | None = None, cell_rows: int = CELL_ROWS, max_levels: int = MAX_LEVELS, shards: bool = True, given: Given | None = None, crossing: bool = False) -> Indices:
    """Index the table, the file or the folder of files at ``path`` into the folder ``out``: tables, and binary shards with ``info`` for viewers.

    Both may be paths that all executors reach or URIs of a store; a folder with archives must be a path.
    """
    made = index(read_input(spark, path, config, f"{out}/unpacked"), config, size, cell_rows, max_levels, given=given, crossing=crossing)
    write_index(made.by_id.select("id", "points", "properties", "relations", "shard", "minishard"), f"{out}/tables/by_id", "shard")
    write_index(made.relation, f"{out}/tables/relation", "relation", "shard")
    write_index(made.spatial, f"{out}/tables/spatial", "level", "shard")
    if shards:
        encode.write_files(encode.id_shards(made.by_id, made.annotations, config, made.plan.by_id), f"{out}/by_id")
        for r in config.relations:
            encode.write_files(encode.relation_shards(made.relation, made.annotations, config, made.plan.relation, r.key), f"{out}/{r.key}")
        encode.write_files(encode.spatial_shards(made.spatial, made.annotations, config, list(made.plan.levels)), out)
        for name, what in (("info", info(config, made.bounds, made.plan, made.levels)), ("config.json", asdict(config))):
            write_text(f"{out}/{name}", json.dumps(what, indent=2))
    return made
