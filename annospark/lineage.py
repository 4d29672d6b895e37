"""Cutting lineage with tables in the folder that all executors share.

Iterative operators read one intermediate result several times.  A written table
survives lost executors, keeps only the wanted columns and stops the plan from
growing with each round.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import local

from pyspark.sql import DataFrame, SparkSession

#: Share of the driver's largest heap that it may have taken when a table is written; beyond it, garbage is collected and the heap given back.
FULL = 0.5
#: Times what the last collection left that must be in use for another one.
GROWN = 1.5

_own: dict[str, str] = {}
_taken: dict[str, int] = {}
_open = local()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may leave that unset, and gets a folder of its own; on a cluster a folder of the driver's
    machine would not be seen by the executors, so that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="annospark-")
    return _own[app]


@contextmanager
def scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are cut inside are dropped at the end, but for those given to the function that this yields.

    What leaves the block must read kept tables only.  Plans of the block hold its shuffles and broadcasts; they are let go too,
    as Spark removes those only when the driver's memory is collected.
    """
    outer, mine, kept = getattr(_open, "tables", None), [], []
    _open.tables = mine

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._cut_path)
        return df

    try:
        yield keep
    finally:
        _open.tables = outer
        for df in mine:
            if df._cut_path not in kept:
                drop(df)
            elif outer is not None:
                outer.append(df)
        if mine:
            collect(mine[0].sparkSession)


def _in_use(spark: SparkSession) -> int:
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    return heap.totalMemory() - heap.freeMemory()


def collect(spark: SparkSession) -> None:
    """Have the driver's garbage collected, and note what is left in use."""
    gc.collect()
    spark._jvm.System.gc()
    _taken[spark.sparkContext.applicationId] = _in_use(spark)


def let_go(spark: SparkSession) -> None:
    """Have the driver's garbage collected if its heap has grown beyond ``FULL``, and what is in use by half since that was last done.

    A plan is garbage once its table is written.  Left alone, the heap grows to its limit before plans go, and the shuffles and
    broadcasts that they hold stay as long.  What is in use decides, not what the heap has taken: a heap that stayed large once
    would otherwise never be collected again.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > FULL * heap.maxMemory() and _in_use(spark) > GROWN * _taken.get(spark.sparkContext.applicationId, 0):
        collect(spark)


def new_folder(spark: SparkSession) -> str:
    """A new folder below the shared one; it goes when the session ends."""
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(at)
    system.deleteOnExit(at)
    return path


def cut(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder, partitioned by ``by``, and return the written table.

    The files go when the session ends, or before that through ``scope`` or ``drop``.
    """
    spark = df.sparkSession
    path = f"{new_folder(spark)}/{name}"
    df.write.partitionBy(*by).parquet(path)
    let_go(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    if getattr(_open, "tables", None) is not None:
        _open.tables.append(out)
    return out


def written_bytes(df: DataFrame) -> int | None:
    """The bytes of a table that ``cut`` wrote; None for any other."""
    if not hasattr(df, "_cut_path"):
        return None
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def drop(df: DataFrame) -> None:
    """Remove a table that ``cut`` wrote and nothing reads any more."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path).getParent()
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
