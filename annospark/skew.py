"""Joining aggregates back to their rows when one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import written_bytes

#: Groups that may be split: the largest ones.  This bounds what is broadcast (two longs for each).
MOST_SPLIT = 1024
#: Rows of a split group that go to one task together.
TOGETHER = 256


#: Rows of a table that is sent to all tasks, at most, and its bytes as it is written.
SENT_ROWS, SENT_BYTES = 200_000, 16 << 20


def few(df: DataFrame, rows: int) -> bool:
    """Whether a table may be sent to all tasks: its ``rows`` are few and, if it is a written table, which may have lists or texts, its bytes too."""
    return rows <= SENT_ROWS and (written_bytes(df) or 0) <= SENT_BYTES


def if_few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if it may be sent to all tasks."""
    return F.broadcast(df) if few(df, rows) else df


def join_back(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner", most: int = MOST_SPLIT, together: int = TOGETHER) -> DataFrame:
    """``rows`` joined with ``groups`` (one row a key, ``size`` rows of it each) on ``keys``.

    Groups of over ``together`` rows are salted: their rows are dealt over ``size / together`` salts and the group's
    own row is repeated for each.  The ``most`` largest groups only are salted, so the broadcast table of salts has a
    fixed bound; any other group is smaller than a ``most``-th of all rows.  A row's salt depends on its columns alone, so a
    task that runs again deals its rows as before; rows that are equal in all columns stay together, so give them a number.
    """
    hot = groups.where(F.col(size) > together).orderBy(F.desc(size)).limit(most)
    hot = hot.select(F.xxhash64(*keys).alias("_hot"), F.ceil(F.col(size) / together).cast("long").alias("_salts"))
    # A row that meets no key keeps the plan the same whether any group is hot or not.
    hot = hot.unionByName(groups.sparkSession.range(1).select(F.lit(None).cast("long").alias("_hot"), F.lit(1).cast("long").alias("_salts")))
    hot = hot.coalesce(1)  # ``most`` rows of two longs, which need no shuffle of their own
    hot = F.broadcast(hot.groupBy("_hot").agg(F.max("_salts").alias("_salts")))
    deal = F.pmod(F.xxhash64(*rows.columns), "_salts")
    left = rows.join(hot, F.xxhash64(*keys) == F.col("_hot"), "left").withColumn("_salt", F.coalesce(deal, F.lit(0))).drop("_hot", "_salts")
    right = groups.join(hot, F.xxhash64(*keys) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)))
    return left.join(right.drop("_hot", "_salts", size), [*keys, "_salt"], how).drop("_salt")
