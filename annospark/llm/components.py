"""Connected components of a table of links, on Spark.

Large-star and small-star steps in turn shorten all paths until every component is
a star around its least node; the number of rounds is logarithmic.  Minima are
aggregated with map-side combining and joined back by salts, so a node with very many links
never gathers them in one task.  Each round is cut to a written table, and no round
follows once all links are those of stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import cut, drop
from annospark.skew import join_back


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over ``u, v`` with ``u < v``; returns links of the same form."""
    both = links.select(F.col("u").alias("a"), F.col("v").alias("b"))
    if large:  # every node takes its larger neighbours to its least one
        both = both.unionByName(links.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("size")).withColumn("m", F.least("m", "a"))
        moved = join_back(both.where("b > a"), least, ["a"], "size").select(F.col("m").alias("u"), F.col("b").alias("v"))
    else:  # every node takes itself and its smaller neighbours to its least one
        both = links.select(F.col("v").alias("a"), F.col("u").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("size"))
        moved = join_back(both, least, ["a"], "size").select(F.col("m").alias("u"), F.col("b").alias("v")).unionByName(least.select(F.col("m").alias("u"), F.col("a").alias("v")))
    return moved.where("u <> v").distinct()


def _is_stars(links: DataFrame) -> bool:
    """Whether links ``u, v`` (distinct, ``u < v``) are stars around their least nodes: no node has two smaller neighbours, or smaller and larger ones."""
    ends = links.select(F.col("v").alias("a"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).unionByName(links.select(F.col("u").alias("a"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))
    ends = ends.groupBy("a").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return not ends.where("smaller + larger > 1 and smaller > 0").agg(F.count("*")).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``u, v`` (longs): the least node it is connected with.

    Links may repeat, point either way or join a node to itself; no links give no rows.
    """
    tidy = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    now, before = cut(tidy, "links"), None
    own = now.where("u = v").select(F.col("u").alias("node"))
    alone = own.distinct()
    links = now.where("u <> v")
    while not _is_stars(links):
        large = cut(_star(links, True), "large_stars")
        links = cut(_star(large, False), "stars")
        drop(large)
        if before is not None:
            drop(before)
        before = links
    found = links.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(links.select(F.col("u").alias("node"), F.col("u").alias("component")))
    return found.unionByName(alone.select("node", F.col("node").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
