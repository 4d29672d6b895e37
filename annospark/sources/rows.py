"""Row ranges of CSV files by an index of their blocks.

A row is a line.  Tasks count the lines that begin in each block of each file; sums over the blocks before tell which row
a block begins with.  A range of rows then reads the blocks that hold it, and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.lineage import cut
from annospark.sources.files import filesystem, listed
from annospark.sources.tables import first_lines, has_header

#: Bytes of a block, and of what is read at a time beyond it for its last line.
BLOCK, MORE = 16 << 20, 1 << 16


@dataclass(frozen=True)
class RowIndex:
    """``blocks``: ``file, at, size, lines, first``: a block's place, the rows that begin in it, and the first of them (from 0)."""

    blocks: DataFrame
    schema: T.StructType
    rows: int


def _starts(data: bytes, at: int, header: bool) -> np.ndarray:
    """Where lines begin in a block at ``at`` of a file, given the block and the byte before it; not the header's, nor empty lines'."""
    whole = np.frombuffer(data, np.uint8)
    lead = 1 if at else 0
    begins = np.flatnonzero(whole[:-1] == 10) + 1 if len(whole) > 1 else np.empty(0, np.int64)
    if not at and len(whole):
        begins = np.concatenate([[0], begins])[int(header) :]
    return begins[(whole[begins] != 10) & (whole[begins] != 13)] - lead


def index_rows(spark: SparkSession, path: str, schema: T.StructType, block: int = BLOCK) -> RowIndex:
    """The index of a CSV file, or of all files of a folder in the order of their names; headers and empty lines aren't rows."""
    places = []
    for f in listed(path):
        system, at = filesystem(f)
        size = system.get_file_info(at).size
        places.append((f, size))
    columns = schema.names

    def cuts(batches):
        for batch in batches:
            for file, size in zip(batch.column("file").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
                at = np.arange(0, size, block)
                yield pa.RecordBatch.from_pydict({"file": [file] * len(at), "at": at, "size": np.minimum(block, size - at)})

    def count(batches):
        for batch in batches:
            lines = []
            for file, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size")), strict=True):
                lines.append(len(_block(file, at, size, columns)[1]))
            yield batch.append_column("lines", pa.array(lines, pa.int64()))

    files = spark.createDataFrame(places, "file string, bytes long").where("bytes > 0").repartition(max(1, len(places) // 64))
    blocks = cut(files.mapInArrow(cuts, "file string, at long, size long"), "cuts").repartition("file", "at")
    blocks = cut(blocks.mapInArrow(count, "file string, at long, size long, lines long"), "counted")
    # Lines are summed up by file first, so no window has more rows than one file has blocks, or than there are files.
    by_file = blocks.groupBy("file").agg(F.sum("lines").alias("all"))
    by_file = by_file.withColumn("before", F.sum("all").over(Window.orderBy("file")) - F.col("all")).select("file", "before")
    inside = F.sum("lines").over(Window.partitionBy("file").orderBy("at")) - F.col("lines")
    blocks = cut(blocks.join(by_file, "file").withColumn("first", F.col("before") + inside).drop("before"), "blocks")
    return RowIndex(blocks, schema, blocks.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0])


def _block(file: str, at: int, size: int, columns: list[str]) -> tuple[bytes, np.ndarray]:
    """The bytes of a block and where lines begin in it."""
    system, path = filesystem(file)
    with system.open_input_file(path) as f:
        lead = 1 if at else 0
        data = f.read_at(size + lead, at - lead)
    starts = _starts(data, at, not at and has_header(first_lines([file])[0], columns))
    return data[lead:], starts


def rows_between(index: RowIndex, start: int, end: int) -> DataFrame:
    """Rows ``start`` to ``end`` (exclusive, from 0) of an index's files, with the columns of its schema; a malformed field raises."""
    columns = index.schema.names
    some = index.blocks.where((F.col("first") < end) & (F.col("first") + F.col("lines") > start) & (F.col("lines") > 0))

    def lines(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, starts = _block(row["file"], row["at"], row["size"], columns)
                wanted = starts[max(0, start - row["first"]) : max(0, end - row["first"])]
                if len(wanted):
                    ends = np.append(starts, len(data))
                    last = int(ends[np.searchsorted(starts, wanted[-1]) + 1])
                    text = data[int(wanted[0]) : last]
                    if last == len(data) and not text.endswith(b"\n"):
                        text += _rest(row["file"], row["at"] + len(data))
                    own = [line for line in text.decode().split("\n") if line.strip("\r")]
                    yield pa.RecordBatch.from_pydict({"value": pa.array([line.rstrip("\r") for line in own], pa.string())})

    values = some.select("file", "at", "size", "first").repartition("file", "at").mapInArrow(lines, "value string")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema)
    return values.select(F.from_csv("value", fields, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def _rest(file: str, at: int) -> bytes:
    """What is left of a line that goes on at ``at``."""
    system, path = filesystem(file)
    out = b""
    with system.open_input_file(path) as f:
        while more := f.read_at(MORE, at + len(out)):
            out += more
            if b"\n" in more:
                break
    return out.partition(b"\n")[0]
