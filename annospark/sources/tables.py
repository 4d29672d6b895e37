"""Annotation tables from CSV, Parquet and SWC, single files and folders, packed or not."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.config import DataConfig, free_name
from annospark.functions.geometry import Box, bounds_of
from annospark.functions.values import POINTS, colour, enum_value, key_of, mean_step, parse_points, relation_ids_or_enum
from annospark.operators.checks import require_rows
from annospark.operators.splits import number_rows
from annospark.sources.archives import ENDINGS, unpack
from annospark.sources.files import filesystem, listed

#: Columns of an SWC file, and those of the table of polylines that files become.
SWC = ("id", "type", "x", "y", "z", "r", "pid")
POLYLINES = (("ID", "bigint"), ("Points", "string"))
#: Files that a task looks into, about.
FILES_TOGETHER = 64


def has_header(first: str, columns: list[str]) -> bool:
    """Whether a file's first line names its first column, or its second."""
    fields = [f.strip().strip('"') for f in first.split(",")]
    return any(f == c for f, c in zip(fields[:2], columns[:2], strict=False))


def first_lines(files: list[str]) -> list[str]:
    """The first line of each file."""
    out = []
    for f in files:
        system, at = filesystem(f)
        with system.open_input_stream(at) as stream:
            line = b""
            while b"\n" not in line and (more := stream.read(1 << 16)):
                line += more
        out.append(line.partition(b"\n")[0].decode("utf-8-sig").rstrip("\r"))
    return out


def by_what(spark: SparkSession, files: list[str], tell: Callable[[list[str]], list[str]]) -> dict[str, list[str]]:
    """``files`` by what ``tell`` says of them; tasks look into the files."""

    def each(batches):
        for batch in batches:
            own = batch.column("file")
            yield pa.RecordBatch.from_arrays([own, pa.array(tell(own.to_pylist()), pa.string())], ["file", "what"])

    rows = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // FILES_TOGETHER))
    out: dict[str, list[str]] = {}
    for r in rows.mapInArrow(each, "file string, what string").orderBy("what", "file").collect():  # a row for each file that the caller names
        out.setdefault(r["what"], []).append(r["file"])
    return out


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV files, each with or without a header by its own first line; a field that doesn't fit its type raises.

    Tasks look at the first lines; then there is one scan of all files with headers and one of all without.
    """
    files = listed(path) if isinstance(path, str) else path
    columns = schema.names
    headed = by_what(spark, files, lambda own: [str(has_header(line, columns)) for line in first_lines(own)]) if files else {}
    read = spark.read.schema(schema)
    return union([read.csv(own, header=head == "True", enforceSchema=True, mode="FAILFAST") for head, own in headed.items()] or [spark.createDataFrame([], schema)])


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet files; with ``schema`` those of a folder may store its columns in different types, and each kind of file is one scan."""
    if schema is None or isinstance(path, str):
        parts = [spark.read.parquet(*([path] if isinstance(path, str) else path))]
    else:
        parts = [spark.read.parquet(*own) for own in by_what(spark, path, stored_types).values()]
    return union([df.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in schema)) if schema else df for df in parts])


def stored_types(files: list[str]) -> list[str]:
    """The columns of Parquet files with their types, as text."""
    out = []
    for f in files:
        system, at = filesystem(f)
        out.append(str(pq.read_schema(at, filesystem=system).remove_metadata()))
    return out


def read_swc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``ID, Points`` of SWC files: a file is a polyline, its id the file's name, its points in the order of the lines.

    Lines hold space-separated numbers, point number first; the first line, after ``#``, names the columns.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.trim("value").alias("line")).where("line <> '' and line not like '#%'")
    at = {c: F.element_at(F.split("line", r"\s+"), i + 1) for i, c in enumerate(SWC)}
    point = F.struct(at["id"].cast("long").alias("at"), F.concat_ws(",", at["x"], at["y"], at["z"]).alias("p"))
    joined = lines.groupBy("file").agg(F.array_sort(F.collect_list(point)).alias("points"))
    return joined.select(F.regexp_extract("file", r"^(.*)\.[^.]*$", 1).cast("bigint").alias("ID"), F.array_join(F.col("points.p"), ";").alias("Points"))


def discover(paths: list[str]) -> tuple[str, list[str]]:
    """(kind, paths): the CSV files if there are any, else Parquet, else SWC; those that lie highest only."""
    for kind in ("csv", "parquet", "swc"):
        found = [p for p in paths if p.lower().endswith(f".{kind}")]
        if found:
            depth = min(p.count("/") for p in found)
            return kind, sorted(p for p in found if p.count("/") == depth)
    raise FileNotFoundError("no CSV, Parquet or SWC file")


def rows_named(path: str) -> int | None:
    """The row count that a file's name claims, as in ``synapses__2108-rows.csv``."""
    found = re.search(r"(\d+)-rows", os.path.basename(path.rstrip("/")))
    return int(found[1]) if found else None


def read_table(spark: SparkSession, path: str, config: DataConfig) -> DataFrame:
    """A table by its path's ending, with ``config.columns``."""
    if path.endswith(".swc"):
        return read_swc(spark, path)
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path, config.schema)
    return read_csv(spark, path, config.schema)


def read_input(spark: SparkSession, path: str, config: DataConfig, unpacked: str | None = None) -> DataFrame:
    """A table, a file, or a folder of files: archives are unpacked to ``unpacked``, then CSV files are read if there are any, else Parquet, else SWC.

    Where all names claim a number of rows, the rows are counted and must be as many.
    """
    if path.rstrip("/").endswith((".parquet", ".csv", ".swc")):
        files = [path]
    else:
        files = listed(path)
        if any(f.endswith(ENDINGS) for f in files):
            files = unpack(spark, path, unpacked)
    kind, files = discover(files)
    if kind == "swc":
        df = read_swc(spark, files)
    elif kind == "parquet":
        df = read_parquet(spark, files, config.schema)
    else:
        df = read_csv(spark, [f for path in files for f in listed(path)], config.schema)
    claimed = [rows_named(f) for f in files]
    return df if None in claimed else require_rows(df, sum(claimed))


def with_id(df: DataFrame, order: list[str] | None = None, wanted: str = "id") -> tuple[DataFrame, str]:
    """``df`` with synthesized ids from 1 in the order of ``order`` (all columns), and the new column's name."""
    name = free_name(wanted, df.columns)
    return number_rows(df, order or df.columns, name), name


def annotations(df: DataFrame, config: DataConfig) -> DataFrame:
    """A configured table as ``id, points, properties, relations``."""
    if config.id_column is None:
        df, name = with_id(df)
    else:
        name = config.id_column
    if isinstance(config.points, str):
        points = parse_points(F.col(config.points))
    else:
        points = F.array(*(F.struct(*(F.col(c).cast("double").alias(a) for a, c in zip("xyz", p, strict=True))) for p in config.points)).cast(POINTS)
    own = free_name("points", df.columns)
    df = df.withColumn(own, points)
    step = mean_step(F.col(own))
    values = []
    for p in config.properties:
        if p.column not in df.columns and re.fullmatch(r".*_[xyz]", p.column):  # a part of the mean step
            value = step[p.column[-1]].cast("float")
        elif p.enum_labels:
            value = enum_value(F.col(p.column), list(p.enum_labels), list(p.enum_values), p.missing)
        elif p.type in ("rgb", "rgba"):
            value = colour(F.col(p.column), len(p.type))
        else:
            value = F.col(p.column).cast("float" if p.type == "float32" else "bigint")
        values.append(value.alias(p.id))
    enums = {p.column: p for p in config.properties if p.enum_labels}
    related = []
    for r in config.relations:
        enum = enums.get(r.column)
        related += [F.lit(key_of(r.label)), relation_ids_or_enum(F.col(r.column), list(enum.enum_labels) if enum else [], list(enum.enum_values) if enum else [])]
    none = F.create_map().cast("map<string,array<bigint>>")
    return df.select(
        F.col(name).cast("bigint").alias("id"),
        F.col(own).alias("points"),
        (F.struct(*values) if values else F.lit(None).cast("struct<none:int>")).alias("properties"),
        (F.create_map(*related) if related else none).alias("relations"),
    )


def volume_bounds(df: DataFrame) -> Box:
    """The least box around all points, its sides rounded where that doesn't cut points off; without any points, the box at the origin."""
    found = df.agg(*bounds_of("points")).first()
    if found["x_low"] is None:
        return Box((0.0,) * 3, (0.0,) * 3)
    low, high = ([found[f"{a}_{end}"] for a in "xyz"] for end in ("low", "high"))
    box = Box.of(low, high)
    return Box(tuple(map(min, box.low, low)), tuple(map(max, box.high, high)))


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(DataFrame.unionByName, parts)
