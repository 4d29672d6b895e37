"""Annotations in clustered files with the box of each file, so that a box opens the files that it meets only.

Rows are dealt to files by ranges of the Morton code of their first point, so a file's annotations lie together.  The table of
zones (``file``, its number of rows and its least and largest coordinates) is small and written beside them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.functions.geometry import AXES, Box, bounds_of, in_bounds
from annospark.names import free_name

#: Halvings of the bounds that the code tells apart, and rows in a file, about.
LEVEL, FILE_ROWS = 12, 1_000_000


def code_of(point: Column, bounds: Box) -> Column:
    """The Morton code of a point in a grid of ``2 ** LEVEL`` cells an axis; it only clusters, so cells are told by a product, not by halvings."""
    code = F.lit(0).cast("long")
    for i, (a, low, width) in enumerate(zip(AXES, bounds.low, bounds.shape, strict=True)):
        share = (point[a] - F.lit(float(low))) * F.lit((1 << LEVEL) / width if width else 0.0)
        cell = F.least(F.greatest(share, F.lit(0.0)), F.lit(float((1 << LEVEL) - 1))).cast("long")
        spread = cell
        for shift, mask in ((16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask))
        code = code.bitwiseOR(F.shiftleft(spread, i))
    return code


def write_zones(annotations: DataFrame, path: str, bounds: Box, file_rows: int = FILE_ROWS) -> None:
    """Write ``annotations`` (with ``points``) to ``path/rows``, clustered, and the table of zones to ``path/zones``.

    Rows without points are kept, in files like any others, and are in no box.  No rows give no zones.
    """
    code = free_name("code", annotations.columns)
    rows = annotations.withColumn(code, code_of(F.get("points", F.lit(0)), bounds))
    files = max(1, -(-annotations.count() // file_rows))
    # Rows of one place may be very many, so the place alone doesn't deal them.
    by = [F.col(code), F.xxhash64(*(F.col(f"`{c}`") for c in annotations.columns if not dict(annotations.dtypes)[c].startswith("map")))]
    rows.repartitionByRange(files, *by).sortWithinPartitions(*by).drop(code).write.parquet(f"{path}/rows", mode="overwrite")
    written = rows.sparkSession.read.parquet(f"{path}/rows")
    zones = written.select("points", F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("rows"), *bounds_of("points"))
    zones.coalesce(1).write.parquet(f"{path}/zones", mode="overwrite")


def zones_in(spark: SparkSession, path: str, box: Box) -> DataFrame:
    """The zones that may hold something in ``box``."""
    meets = reduce(and_, ((F.col(f"{a}_low") <= box.high[i]) & (F.col(f"{a}_high") >= box.low[i]) for i, a in enumerate(AXES)))
    return spark.read.parquet(f"{path}/zones").where(meets)


def read_box(spark: SparkSession, path: str, box: Box, strict: bool = False) -> DataFrame:
    """The annotations of ``path`` in ``box`` (if ``strict``, with all their points); only files whose zone meets it are opened."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = [f"{path}/rows/{r['file']}" for r in zones_in(spark, path, box).select("file").orderBy("file").collect()]  # names only
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.where(in_bounds(F.col("points"), box, strict=strict))
