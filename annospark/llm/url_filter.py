"""URL verdicts from host rules and a Bloom filter cascade.

A cascade answers "is this key listed?" exactly for every key of a known
universe.  Level 0 encodes the listed keys; level 1 encodes the unlisted keys of
the universe that level 0 lets through by mistake; level 2 the listed keys that
level 1 lets through; and so on until a level has no false positives.  The
universe is every host suffix that occurs in the corpus, so no lookup can err.

Building is DataFrame aggregation (``bitmap_construct_agg``); each level's bitmap
is a binary literal in the expression that judges the rows, so judging is one
narrow pass without join or shuffle.  Filters grow with the list, not with the
corpus: level 0's error rate is chosen so that about as many unlisted keys slip
through as there are listed ones.  ``MAX_FILTER_BYTES`` bounds what goes out with
each task; a longer list is joined instead, with the same results.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.config import free_name
from annospark.lineage import cut

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

#: Above so many bytes of filters the list is joined, not sent to each task.
MAX_FILTER_BYTES = 32 << 20
#: Bits in one bitmap of ``bitmap_construct_agg``.
BITMAP_BITS = 8 * 4096
#: (host, path, verdict) rules of the query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: First labels of sites that the query's list names.
LISTED_LABELS = ("casino-win", "free-bets", "ads-track", "cheap-pills", "adult-x", "spam-farm")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as (``host`` + ``path``, verdict); nulls if none fits."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def suffixes(host: Column) -> Column:
    """The host and each parent domain of it, as an array; empty for an empty host."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """1-based positions of ``key`` in the filter of ``level``."""
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) + 1 for i in range(hashes)]


def _in_filter(key: Column, level: int, bits: int, hashes: int, bitmap: bytes) -> Column:
    whole = F.lit(bytearray(bitmap))
    out = F.lit(True)
    for pos in _positions(key, level, bits, hashes):
        byte = F.conv(F.hex(F.substring(whole, F.floor((pos - 1) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        out = out & (F.getbit(byte, ((pos - 1) % 8).cast("int")) == 1)
    return out


class Cascade:
    """Exact membership for the keys of a universe; build it with ``Cascade.build``."""

    def __init__(self, levels: list[tuple[int, int, bytes]]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        """Whether ``key``, which must be in the universe, is listed."""
        out = F.lit(False)
        for n in reversed(range(len(self.levels))):
            out = _in_filter(key, n, *self.levels[n]) & ~out
        return out

    @staticmethod
    def build(keys: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade | None:
        """``keys``: distinct, not null, as ``key, listed``.  None if the filters would exceed ``max_bytes``."""
        counts = keys.agg(F.count("*").alias("all"), F.coalesce(F.sum(F.col("listed").cast("long")), F.lit(0)).alias("listed")).first()
        n, others = counts["listed"], counts["all"] - counts["listed"]
        rate = min(0.5, max(2.0**-20, n / max(1, others) / math.sqrt(2)))
        levels, spent = [], 0
        left = keys  # keys that all levels so far let through
        while n:
            hashes = max(1, round(-math.log2(rate)))
            bits = BITMAP_BITS * math.ceil(n * hashes / math.log(2) / BITMAP_BITS) if n * hashes > 4096 else max(64, math.ceil(n * hashes / math.log(2) / 8) * 8)
            spent += bits // 8
            if spent > max_bytes:
                return None
            level, encodes = len(levels), F.col("listed") == (len(levels) % 2 == 0)
            at = left.where(encodes).select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("pos"))
            maps = at.groupBy(F.bitmap_bucket_number("pos").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("map"))
            parts = {r["part"]: bytes(r["map"]) for r in maps.collect()}  # one row for each BITMAP_BITS bits, bounded by max_bytes
            bitmap = b"".join(parts.get(p, bytes(BITMAP_BITS // 8)) for p in range(1, math.ceil(bits / BITMAP_BITS) + 1))[: bits // 8]
            levels.append((bits, hashes, bitmap))
            left = left.where(_in_filter(F.col("key"), level, *levels[-1]) | encodes)
            # The next level encodes what slipped through here.
            n = left.where(~encodes).count()
            rate = 0.5
        return Cascade(levels)


def url_filter(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url", max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Judge every row of ``pages``: its columns, and ``host, path, rule, verdict``.

    ``listed``: hosts and domains to block, in its first column; an entry holds for all subdomains.  The longest
    fitting rule decides; without one the verdict is ``block`` if the host is listed, else ``allow``.  A null url, or
    one without ``://``, has an empty host and path, fits no rule and is allowed.  Repeated urls and entries change
    nothing, no rows give no rows, and columns of ``pages`` named like a new one are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.coalesce(F.col(f"`{url}`"), F.lit(""))), "path": path_of(F.coalesce(F.col(f"`{url}`"), F.lit("")))})
    name, ruled = rule_of(F.col("host"), F.col("path"), rules)
    entry = F.translate(F.col(f"`{listed.columns[0]}`"), UPPER, LOWER)
    universe = pages.select("host").distinct().select(F.explode(suffixes(F.col("host"))).alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("occurs"))
    entries = listed.select(entry.alias("key"), F.lit(True).alias("listed"), F.lit(False).alias("occurs")).where("key is not null")
    keys = universe.unionByName(entries).groupBy("key").agg(F.max("listed").alias("listed"), F.max("occurs").alias("occurs"))
    keys = cut(keys.where("occurs").select("key", "listed"), "keys")
    cascade = Cascade.build(keys, max_bytes)
    if cascade:
        bad = F.exists(suffixes(F.col("host")), cascade.contains)
        return pages.withColumns({"rule": name, "verdict": F.coalesce(ruled, F.when(bad, "block").otherwise("allow"))})
    flag, own = free_name("bad", pages.columns), free_name("bad_host", pages.columns)
    hosts = pages.select("host").distinct().select(F.col("host").alias(own), F.explode(suffixes(F.col("host"))).alias("key"))
    bad = hosts.join(keys.where("listed"), "key", "left_semi").select(own, F.lit(True).alias(flag)).distinct()
    out = pages.join(bad, pages["host"] == bad[own], "left").withColumns({"rule": name, "verdict": F.coalesce(ruled, F.when(F.col(flag), "block").otherwise("allow"))})
    return out.drop(flag, own)
