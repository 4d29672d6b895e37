"""Filtering whole rows by decisions about few of them.

A dedup stage decides on narrow rows and must then drop rows of the wide table.  Most rows
stay, so only the keys of those that go are sent to the wide rows: in a broadcast while they are few.  Beyond that
a Bloom filter cascade over the keys of all rows tells them apart exactly, so that no text is shuffled; only where its filters exceed their
bound are the rows joined.  Rows of one key are alike in all that a decision looks at, and one of them is as good as another.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.config import free_name
from annospark.lineage import cut
from annospark.skew import few, if_few

from .url_filter import MAX_FILTER_BYTES, Cascade


def named(key: dict[str, Column], types: dict[str, str]) -> Column:
    """A key's columns as one text that tells all keys apart."""
    parts = [F.hex(c) if types[k] == "binary" else c.cast("string") for k, c in key.items()]
    return F.concat_ws(",", *(F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts))


def among(docs: DataFrame, key: dict[str, Column], keys: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Column | None:
    """Whether the ``key`` of a row of ``docs`` is in ``keys`` (columns named as in ``key``), exactly and without a join; None if that takes more than ``max_bytes``.

    Only keys move: those of all rows, once each.
    """
    types = dict(docs.select(*(c.alias(k) for k, c in key.items())).dtypes)
    own = named(key, types)
    listed = keys.select(named({k: F.col(k) for k in key}, types).alias("key"), F.lit(True).alias("listed"), F.lit(False).alias("occurs"))
    every = docs.select(own.alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("occurs")).unionByName(listed)
    every = cut(every.groupBy("key").agg(F.max("listed").alias("listed"), F.max("occurs").alias("occurs")).where("occurs").drop("occurs"), "keys")
    cascade = Cascade.build(every, max_bytes)
    return cascade and cascade.contains(own)


def without(docs: DataFrame, key: dict[str, Column], gone: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows of ``docs`` whose ``key`` isn't in ``gone``, and one row of each key there that ``stays``.

    ``gone``: distinct keys (columns named as in ``key``; nulls are equal) and ``stays``; a written table.
    """
    n, again = gone.agg(F.count("*"), F.coalesce(F.sum(F.col("stays").cast("int")), F.lit(0))).first()
    if not n:
        return docs
    own = {k: free_name(f"key_{k}", docs.columns) for k in key}
    rows = docs.withColumns({own[k]: c for k, c in key.items()})

    def met(keys: DataFrame, how: str) -> DataFrame:
        here = None if few(keys, n) else among(docs, key, keys, max_bytes)
        if here is not None:
            return rows.where(here if how == "left_semi" else ~here)
        return rows.join(if_few(keys, n), reduce(and_, (rows[own[k]].eqNullSafe(keys[k]) for k in key)), how)

    out = met(gone, "left_anti").select(*docs.columns)
    if again:
        # First values are aggregated with map-side combining, so a key of very many rows is one row a task.
        one = met(gone.where("stays"), "left_semi").groupBy(*own.values()).agg(F.first(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("_row"))
        out = out.unionByName(one.select("_row.*"))
    return out
