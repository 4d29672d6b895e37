"""Reproducible samples without replacement, and what they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import cut
from annospark.names import free_name
from annospark.operators.octree import hold_order
from annospark.operators.splits import number_rows


def sample(df: DataFrame, id: str, n: int, seed: str = "") -> DataFrame:
    """``n`` rows, or all if there are fewer: those of least key, ties by id.  Repeated ids count as rows."""
    key = free_name("key", df.columns)
    return df.withColumn(key, hold_order(F.col(id), seed)).orderBy(key, id).limit(n).drop(key)


def split_sample(df: DataFrame, id: str, n: int, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """``n`` rows of ``df`` (all if there are fewer) and the others, row by row: repeated and null ids are rows like any others.

    Rows are numbered in the order of their keys, ties by id, by range partitions, so no task holds the sample.
    """
    key, place = free_name("_key", df.columns), free_name("_place", df.columns)
    ranked = cut(number_rows(df.withColumn(key, hold_order(F.col(id), seed)), [key, id], place, 0).drop(key), "ranked")
    return ranked.where(F.col(place) < n).drop(place), ranked.where(F.col(place) >= n).drop(place)
