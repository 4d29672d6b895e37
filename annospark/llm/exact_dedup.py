"""Exact duplicates by deterministic block naming.

A text, lower-cased in A-Z only, is cut into blocks of ``BLOCK`` bytes.  All
distinct blocks are sorted and numbered from 0 in that order: equal blocks share a name, different
blocks never do, and names don't depend on how rows are dealt to tasks.  Then adjacent names are paired and the distinct pairs sorted
and numbered in turn, until each document has a single name.  No hash decides
equality anywhere, so identities are free of collisions.

Everything is DataFrame operations.  Each naming is an aggregation with map-side
combining (a block that a third of all rows share arrives as one row per task), a
sort of the distinct keys by ranges, and a salted join back.  Text moves once, in the first
naming; after it a block is fetched by a pair of hashes that are checked to be
unique among all distinct blocks, and that blocks are sorted by.  The levels above move integers, half as many
each time, and their number is the logarithm of the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.lineage import cut, scope
from annospark.skew import join_back

from .keep import without

#: Bytes in a block.
BLOCK = 4096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is; null becomes empty.

    For pure ASCII this is ``lower``, which is several times as fast as ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct ``keys`` of ``rows``, and ``size``, the rows that have them."""
    return rows.groupBy(*keys).agg(F.count("*").alias("size"))


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """``distinct`` with ``name``, the place from 0 in the order of ``keys``, whatever the partitions."""
    placed = cut(distinct.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)  # the number of a row's partition; below it is its place there
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))  # a row for each partition
    name = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), part == F.col("part")).withColumn("name", name).drop("at", "part", "start")


def _hashes(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed + i), F.col("block")).alias(f"h{i}") for i in (0, 1)]


def _block_names(blocks: DataFrame) -> tuple[DataFrame, int]:
    """``h0, h1, name, size`` of each distinct block, and the seed of the two hashes.

    The hashes stand for the block when it is sorted and when its name is fetched, so that text moves once only.  They decide
    nothing: should two different blocks share both, another seed is taken.
    """
    seed = 0
    while True:
        distinct = cut(_counted(blocks.select("block"), ["block"]).select(*_hashes(seed), "size"), "distinct")
        if distinct.groupBy("h0", "h1").count().where("count > 1").isEmpty():
            return _numbered(distinct, ["h0", "h1"]), seed
        seed += 2


def identities(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, sha, level, name``.

    Two rows have the same ``(level, name)`` exactly if their normalised texts are equal.
    ``row`` is unique, and the column named ``row`` if that is given; ``sha`` is the SHA-256 of the normalised text in UTF-8.
    """
    key = F.monotonically_increasing_id() if row is None else F.col(f"`{row}`")
    flat = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), ascii_lower(F.col(f"`{text}`")).cast("binary").alias("bytes"), key.alias("row"))
    cuts = F.expr(
        f"transform(sequence(0, greatest(0, cast((octet_length(bytes) - 1) div {block} as int))),"
        f" i -> substring(bytes, cast(i * {block} + 1 as int), {block}))"
    )
    blocks = flat.select("row", "doc_id", F.sha2("bytes", 256).alias("sha"), cuts.alias("blocks"))
    blocks = blocks.select("row", "doc_id", "sha", F.size("blocks").alias("width"), F.posexplode("blocks").alias("pos", "block"))
    # What belongs to the row travels with its first block only.
    first = F.col("pos") == 0
    blocks = blocks.select("row", "pos", "width", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.unhex("sha")).alias("sha"), "block")
    names, seed = _block_names(blocks)
    keyed = blocks.select("row", "pos", "width", "doc_id", "sha", *_hashes(seed))
    table = cut(join_back(keyed, names, ["h0", "h1"], "size").drop("h0", "h1"), "blocks")
    heads = table.where("pos = 0").select("row", "doc_id", F.lower(F.hex("sha")).alias("sha"), "width", "name")
    done = heads.where("width = 1").select("row", F.lit(0).alias("level"), "name")
    level, width = 0, table.agg(F.max("width")).first()[0] or 0
    here = table.where("width > 1").select("row", "pos", "width", "name")
    parts = [done]
    while width > 1:
        level, width = level + 1, (width + 1) // 2
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = here.groupBy("row", F.expr("cast(pos div 2 as int)").alias("at"), F.expr("cast((width + 1) div 2 as int)").alias("wide"))
        pairs = pairs.agg(side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right"))
        pairs = pairs.select("row", F.col("at").alias("pos"), F.col("wide").alias("width"), "left", "right")
        pairs = cut(pairs, f"pairs{level}")
        names = _numbered(_counted(pairs, ["left", "right"]), ["left", "right"])
        here = cut(join_back(pairs, names, ["left", "right"], "size").select("row", "pos", "width", "name"), f"level{level}")
        parts.append(here.where("width = 1").select("row", F.lit(level).alias("level"), "name"))
        here = here.where("width > 1")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return heads.select("row", "doc_id", "sha").join(found, "row")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK, row: str | None = None) -> DataFrame:
    """The group of equal texts that each row belongs to.

    Returns one row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``, and ``row`` if a column
    of unique longs is named by it.
    Of equal texts the row with the largest ``doc_id`` stays (``kept``); its id is ``keep_id``.
    A null text is an empty text.  A null ``doc_id`` sorts below all others.  Repeated rows,
    also of one ``doc_id``, are separate members and exactly one row of a group stays.  A text of any
    length is one more level at most for each doubling.  No rows give no rows; other columns are not read.
    """
    with scope() as keep:
        rows = keep(cut(identities(docs, text, doc_id, block, row), "identities"))
    groups = rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
    groups = cut(groups.withColumn("size", F.col("group_size")), "groups")
    out = join_back(rows, groups, ["level", "name"], "size")
    return out.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *([] if row is None else ["row"]),
    )


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, one of the largest ``doc_id``.

    All columns of ``docs`` stay as they are.  A null text is an empty text; rows that share a ``doc_id``, or have none, are
    members of their groups like any others, and of rows with equal ids and texts exactly one can stay.
    """
    with scope() as keep:
        keys = exact_dedup(docs, text, doc_id).groupBy("doc_id", F.unhex("text_sha256").alias("sha")).agg(F.count("*").alias("rows"), F.max("kept").alias("stays"))
        gone = keep(cut(keys.where("rows > 1 or not stays").drop("rows"), "gone"))
    sha = F.unhex(F.sha2(ascii_lower(F.col(f"`{text}`")).cast("binary"), 256))
    return without(docs, {"doc_id": F.col(f"`{doc_id}`"), "sha": sha}, gone)
