"""Near-duplicates by SimHash fingerprints and pivot distance tables.

A fingerprint bit is the majority of that bit over the hashes of a text's word
shingles.  Fingerprints within ``bits`` differing bits are linked, and the
components of links are the classes of near-duplicates.

Links are found among distinct fingerprints, so copies cost nothing.  Rows meet
under keys: agreements in some blocks of bits.  With one lane of 64 bits the keys
are exact by the pigeonhole principle: two linked fingerprints agree in at least
``n - bits`` of ``n`` blocks, with ``n`` chosen so that a key has few rows at any
corpus size.  With more lanes, for distances that rule out no block, each lane
gives as many keys as fit; ``recall`` tells the share of links that they find.

``near_dedup`` needs every link of a Jaccard similarity.  The links of several
lanes are its first step only: they connect most copies cheaply, each one verified.
Then texts of classes that are still apart meet under the shingles of their heads:
of all shingles in one order, common ones last, two sets that are alike share one
among the first ``n - ceil(similarity * n) + 1``.  This holds at any corpus size and
for any order, so no link is lost; every such pair is verified before it joins classes.
Where a shingle of heads has more than ``CROWD`` texts no pairs are written: the texts are
members of a crowd, their sets go to its groups, and these give links of a spanning forest.

The Hamming distances of each fingerprint to ``PIVOTS`` fixed reference fingerprints are
tabulated once, before rows meet, and go with it as two longs.  By the triangle inequality
linked fingerprints differ by ``bits`` at most in every coordinate: pairs whose largest
difference is more are discarded, and the rest verified by their exact distance.

A key with more than ``HOT`` fingerprints is split into chunks that meet pairwise
in groups of their own, so no task holds an unbounded group and no pair is lost.
A group gives the links of a spanning forest only, never all pairs.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annospark.lineage import cut, scope
from annospark.skew import few, if_few, join_back

from .components import components
from .keep import among, without

SEED = 42
PIVOTS = 16
#: A key's fingerprints in one group at most; more are split into chunks of half as many.
HOT = 2048
#: Distinct shingles, about, of the sets that one group of pairs is verified with.
GROUP_SHINGLES = 1 << 21
#: Fingerprints that a key should have at most on average; the least bits of a key with several lanes.
PER_KEY, LEAST_KEY = 64, 12
#: Bits of a SimHash key in ``near_dedup``, at any corpus size.
NEAR_KEY = 32
#: Groups of up to so many rows are compared shift by shift, larger ones by a search from row to row.
SMALL = 128
#: Texts of one shingle whose pairs are written one by one at most, and texts that a part of a larger crowd should have, in up to ``CROWD_PARTS`` parts.
CROWD, CROWD_PART, CROWD_PARTS = 32, 256, 16
#: Bits of the buckets that all shingles are counted in for their order, and bits of the buckets that are added up together.
CROWD_BITS, PART_BITS = 21, 13
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; of all words together if there are fewer than ``words``."""
    tokens = (text or "").encode().lower().split()
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else [], np.uint64)
    line, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, words: int = 4, lanes: int = 1) -> list[int]:
    """The SimHash of one text, an unsigned integer a lane: the hashes themselves, then mixes of them; zeros without words."""
    return lanes_of(shingle_hashes(text, words), lanes)


def lanes_of(hashes: np.ndarray, lanes: int) -> list[int]:
    out = [majority(hashes) if len(hashes) else 0]
    for lane in range(1, lanes):
        x = (hashes ^ hashes >> np.uint64(31)) * np.uint64((2 * lane * int(_MIX) + 1) % (1 << 64))
        out.append(majority(x ^ x >> np.uint64(29)) if len(hashes) else 0)
    return out


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    count = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = 4, lanes: int = 1) -> Column:
    """SimHash of each text as a struct of longs ``f0, f1, ...`` of the same bits; zeros for a null or empty text."""
    names = [f"f{i}" for i in range(lanes)]

    @F.arrow_udf(f"struct<{','.join(f'{n}:bigint' for n in names)}>")
    def of(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, words, lanes) for t in texts.to_pylist()], np.uint64).reshape(-1, lanes).view(np.int64)
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, i])) for i in range(lanes)], names)

    return of(F.coalesce(text, F.lit("")))


def pivots(lanes: int) -> np.ndarray:
    """The reference fingerprints: multiples of an odd constant, mixed."""
    with np.errstate(over="ignore"):
        x = np.arange(1, PIVOTS * lanes + 1, dtype=np.uint64) * _MIX
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0xBF58476D1CE4E5B9)).reshape(PIVOTS, lanes)


def pivot_columns(lanes: int) -> dict[str, Column]:
    """``p0, p1``: the Hamming distances of ``f0, ...`` to the pivots, a byte each (255 for more), eight in a long."""
    out = {}
    for name, part in (("p0", pivots(lanes)[:8]), ("p1", pivots(lanes)[8:])):
        value = F.lit(0).cast("long")
        for k, pivot in enumerate(part.view(np.int64).tolist()):
            apart = sum((F.bit_count(F.col(f"f{i}").bitwiseXOR(F.lit(x))).cast("long") for i, x in enumerate(pivot)), F.lit(0).cast("long"))
            value = value.bitwiseOR(F.shiftleft(F.least(apart, F.lit(255).cast("long")), 8 * k))
        out[name] = value
    return out


def distance_table(p0: np.ndarray, p1: np.ndarray) -> np.ndarray:
    """The distances to each pivot from ``pivot_columns``."""
    return np.stack([p0, p1], axis=1).astype("<i8").view(np.uint8).astype(np.int16)


def key_plan(distinct: int, bits: int, lanes: int = 1, width: int | None = None) -> list[tuple[tuple[int, int, int], ...]]:
    """Blocks (lane, shift, width) of each key: ``width`` bits, or enough that ``distinct`` fingerprints have few to a key."""
    if lanes > 1:
        width = width or max(LEAST_KEY, min(32, (max(1, distinct) // PER_KEY).bit_length()))
        return [((lane, shift, width),) for lane in range(lanes) for shift in range(0, 64 - width + 1, width)]
    for n in range(bits + 1, 65):
        widths = [64 // n + (i < 64 % n) for i in range(n)]
        shifts = [sum(widths[:i]) for i in range(n)]
        agree = n - bits
        if distinct >> min(sum(sorted(widths)[:agree]), 63) <= PER_KEY or n >= bits + 4:
            return [tuple((0, shifts[i], widths[i]) for i in chosen) for chosen in combinations(range(n), agree)]
    raise ValueError("no plan")


def recall(distinct: int, lanes: int, differing: float) -> float:
    """The share of links found by the keys of several lanes when that share of bits differs."""
    plan = key_plan(distinct, 0, lanes)
    return 1 - (1 - (1 - differing) ** plan[0][0][2]) ** len(plan)


def _keys(plan) -> Column:
    """One key for each agreement of ``plan``: its number, and the agreeing bits."""
    out = []
    for number, blocks in enumerate(plan):
        key = F.lit(0).cast("long")
        for lane, shift, width in blocks:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(F.col(f"f{lane}"), shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)))
        out.append(F.struct(F.lit(number).alias("plan"), key.alias("bits")))
    return F.array(*out)


class _Forest:
    """Union-find over one group's nodes."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        self.up[max(a, b)] = min(a, b)
        return a != b


def near(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs (i, j) are within ``bits``: pivot coordinates discard, exact distances verify."""
    at = np.flatnonzero(np.abs(table[i] - table[j]).max(axis=1) <= bits)
    apart = np.zeros(len(at), np.int16)
    for lane in range(fp.shape[1]):
        apart += np.bitwise_count(fp[i[at], lane] ^ fp[j[at], lane])
        close = apart <= bits
        at, apart = at[close], apart[close]
    return at


def _spread(fp: np.ndarray, table: np.ndarray, start: int, end: int, bits: int):
    """Links of a spanning forest of one group: from row to row, each reached row leaves the search."""
    left_out = np.arange(start, end)
    while len(left_out):
        queue, left_out = [int(left_out[0])], left_out[1:]
        while queue and len(left_out):
            x = queue.pop()
            hit = near(fp, table, np.full(len(left_out), x), left_out, bits)
            found = left_out[hit].tolist()
            yield from ((x, y) for y in found)
            queue += found
            left_out = np.delete(left_out, hit)


def _nearest(fp: np.ndarray, start: int, end: int, bits: int):
    """Links of a minimum spanning forest of one group, by Hamming distance."""
    out, x = np.arange(start + 1, end), start  # rows that aren't in the forest yet, the last one that went in
    least, to = np.full(len(out), bits + 1, np.int16), np.full(len(out), start)
    while len(out):
        apart = np.bitwise_count(fp[out] ^ fp[x]).sum(axis=1, dtype=np.int16)
        nearer = apart < least
        least[nearer], to[nearer] = apart[nearer], x
        k = int(least.argmin())
        x = int(out[k])
        if least[k] <= bits:
            yield int(to[k]), x
        for a in (out, least, to):
            a[k] = a[-1]
        out, least, to = out[:-1], least[:-1], to[:-1]


def group_links(group: np.ndarray, fp: np.ndarray, table: np.ndarray, bits: int, nearest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of each group; rows come sorted by ``group``.

    ``nearest``: of a minimum spanning forest, whose links are those that a stricter test most likely passes; what it
    cuts off must then be found otherwise.
    """
    n = len(fp)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, n))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    for shift in range(1, min(SMALL, int(sizes.max(initial=0)))):
        i = np.flatnonzero((size_of[:-shift] <= SMALL) & (group[shift:] == group[:-shift]))
        if not len(i):
            break
        hit = i[near(fp, table, i, i + shift, bits)]
        left.append(hit)
        right.append(hit + shift)
    links = []
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        apart = np.bitwise_count(fp[i] ^ fp[j]).sum(axis=1) if nearest else np.zeros(len(i), np.int64)
        order, forest = np.lexsort((apart, group[i])), _Forest()
        links += [(a, b) for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True) if forest.join(a, b)]
    for start, size in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        links += _nearest(fp, start, start + size, bits) if nearest else _spread(fp, table, start, start + size, bits)
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def whole_groups(batches, keys: list[str]):
    """Tables of whole groups, with the number of each row's group, from batches sorted by ``keys``; a group may go on in the next batch."""
    left: list[pa.RecordBatch] = []

    def changes(part: pa.Table) -> np.ndarray:
        key = np.stack([part[c].to_numpy().astype(np.int64) for c in keys])
        return (key[:, 1:] != key[:, :-1]).any(axis=0)

    def numbered(part: pa.Table) -> tuple[pa.Table, np.ndarray]:
        return part, np.concatenate([[0], np.cumsum(changes(part))])

    for batch in batches:
        part = pa.Table.from_batches([*left, batch])
        if not part.num_rows:
            continue
        ends = np.flatnonzero(changes(part))
        done = int(ends[-1]) + 1 if len(ends) else 0
        if done:
            yield numbered(part.slice(0, done))
        left = part.slice(done).combine_chunks().to_batches()
    if left:
        yield numbered(pa.Table.from_batches(left))


def meeting(rows: DataFrame, keys: list[str], hot: int, expected: int) -> tuple[DataFrame, list[str]]:
    """``rows`` (``node``, ``keys`` and more; about ``expected``) that share their keys with others, sorted by group; and what names a group.

    A key of over ``hot`` rows is split into chunks, and each pair of chunks is a group.  Keys are counted by buckets first,
    where few rows come together, and by themselves only in buckets that have so many.
    """
    more = [c for c in rows.columns if c not in keys]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(max(1024, 8 * expected // hot)))
    crowded = cut(rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("size")).where(F.col("size") > hot).select("bucket"), "crowded")
    chunks, n = F.lit(1), crowded.count()
    if n:
        sizes = rows.join(if_few(crowded, n), bucket == F.col("bucket"), "left_semi").groupBy(*keys).agg(F.count("*").alias("size"))
        sizes = cut(sizes.where(F.col("size") > hot), "hot")
        if n := sizes.count():
            rows = rows.join(if_few(sizes, n), keys, "left")
            chunks = F.coalesce(F.ceil(F.col("size") * 2 / hot), F.lit(1)).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = [*keys, "low", "high"]
    rows = rows.select(*keys, F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), *more).repartition(*group)
    alone = F.count("*").over(Window.partitionBy(*group))  # a group is bounded, so is this window's partition
    return rows.withColumn("together", alone).where("together > 1").drop("together").sortWithinPartitions(*group), group


def links(table: DataFrame, bits: int = 4, lanes: int = 1, hot: int = HOT, nearest: bool = False, width: int | None = None) -> DataFrame:
    """Links ``u, v`` that connect all nodes of ``table`` (``node``, and distinct lanes ``f0, ...``) within ``bits``."""
    names = [f"f{i}" for i in range(lanes)]
    n = table.count()
    plan = key_plan(n, bits, lanes, width)
    # The pivot table is worked out once for each fingerprint; the keys are unfolded after that.
    known = cut(table.select("node", *names, *(c.alias(p) for p, c in pivot_columns(lanes).items())), "pivots")
    rows = known.select("*", F.explode(_keys(plan)).alias("k")).select("node", *names, "p0", "p1", "k.plan", "k.bits")
    rows, keys = meeting(rows, ["plan", "bits"], hot, n * len(plan))

    def compare(batches):
        for part, group in whole_groups(batches, keys):
            fp = np.stack([part[n].to_numpy() for n in names], axis=1).view(np.uint64)
            i, j = group_links(group, fp, distance_table(part["p0"].to_numpy(), part["p1"].to_numpy()), bits, nearest)
            node = part["node"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], ["u", "v"])

    return rows.mapInArrow(compare, "u long, v long").distinct()


def crowds(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """How crowded each bucket of shingle hashes is: eight times the binary logarithm of the shingles that all rows have in it.

    All shingles of all rows are counted, in a table of fixed size; a shingle that is common in the corpus makes its bucket stand out.  Tasks
    send their counts in parts, and a part is added up as it streams by.
    """
    width, parts = 1 << PART_BITS, 1 << (CROWD_BITS - PART_BITS)

    def count(batches):
        found = np.zeros(1 << CROWD_BITS, np.uint32)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                at, n = np.unique(shingle_hashes(t, words) >> np.uint64(64 - CROWD_BITS), return_counts=True)
                found[at.astype(np.int64)] += n.astype(np.uint32)
        if found.any():
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.arange(parts)), "counts": pa.array([x.astype("<u4").tobytes() for x in found.reshape(parts, width)], pa.binary())})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        levels = [np.round(8 * np.log2(x + 1)).astype(np.uint16).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(total), pa.int64()), "levels": pa.array(levels, pa.binary())})

    counts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit(""))).mapInArrow(count, "part long, counts binary")
    out = np.zeros((parts, width), np.uint16)
    for r in counts.repartition(parts, "part").mapInArrow(add, "part long, levels binary").collect():  # the table's parts, 4 MB in all
        out[r["part"]] = np.frombuffer(bytes(r["levels"]), np.uint16)
    return out.reshape(-1)


def head(own: np.ndarray, crowd: np.ndarray, similarity: float) -> np.ndarray:
    """The first of the distinct shingles ``own``, of which a set of that Jaccard similarity must hold one.

    The order, the same for all sets, is by the ``crowd`` of the shingle's bucket, then by value, so that what many texts share comes last.
    """
    order = np.lexsort((own, crowd[(own >> np.uint64(64 - CROWD_BITS)).astype(np.int64)]))
    return own[order[: len(own) - math.ceil(similarity * len(own) - 1e-9) + 1]] if len(own) else own


def sketches(text: Column, words: int, lanes: int, similarity: float, crowd: np.ndarray, spark: SparkSession) -> Column:
    """``f0, ...``, the fingerprint of each text, ``d0, d1``, a digest of its set of distinct shingles, ``n``, their number, and ``head``, the first
    of them in the order by ``crowd``."""
    names = [*(f"f{i}" for i in range(lanes)), "d0", "d1", "n"]
    sent = spark.sparkContext.broadcast(crowd)  # 4 MB

    @F.arrow_udf(f"struct<{','.join(f'{n}:bigint' for n in names)},head:array<bigint>>")
    def of(texts: pa.Array) -> pa.Array:
        found, first = np.zeros((len(texts), lanes + 3), np.uint64), []
        for i, t in enumerate(texts.to_pylist()):
            hashes = shingle_hashes(t, words)
            own = np.unique(hashes)
            found[i, :lanes] = lanes_of(hashes, lanes)
            found[i, lanes : lanes + 2] = np.frombuffer(xxhash.xxh3_128_digest(own.astype("<u8").tobytes(), SEED), "<u8")
            found[i, lanes + 2] = len(own)
            first.append(head(own, sent.value, similarity).view(np.int64))
        found = found.view(np.int64)
        ends = pa.array(np.cumsum([0, *map(len, first)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *first])))
        return pa.StructArray.from_arrays([*(pa.array(np.ascontiguousarray(found[:, i])) for i in range(lanes + 3)), lists], [*names, "head"])

    return of(F.coalesce(text, F.lit("")))


def may_be_alike(group: np.ndarray, at: np.ndarray, n: np.ndarray, member: np.ndarray, similarity: float):
    """Pairs of rows of one group and different ``member`` whose sizes and places in their heads leave room for that similarity.

    The places are those of the shingle that names the group.  It may not be a pair's first one in common, for which the
    bound holds; then the pair comes in the group of that one too.
    """
    i = np.arange(len(group))
    for shift in range(1, len(group)):
        i = i[i + shift < len(group)]
        i = i[group[i] == group[i + shift]]
        if not len(i):
            return
        j = i + shift
        need = np.ceil(similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9)
        good = (member[i] != member[j]) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
        good &= np.minimum(n[i] - at[i], n[j] - at[j]) >= need
        if good.any():
            yield i[good], j[good]


def candidates(table: DataFrame, similarity: float, hot: int = HOT, crowd: int = CROWD) -> DataFrame:
    """``u, v, crowd`` for all pairs of nodes of different ``member`` that may have that Jaccard similarity, from ``node, member, n, head``.

    Of a group of up to ``crowd`` nodes these are the pairs ``u, v``; of a larger one, of any size, a row a node: ``v`` is in the crowd of ``u``,
    its least node, and ``crowd`` is true.  So rows grow with the nodes of a group.
    """
    expected = table.agg(F.coalesce(F.sum(F.size("head")), F.lit(0))).first()[0]
    rows = table.select("node", "member", "n", F.posexplode("head").alias("at", "shingle"))
    rows, keys = meeting(rows, ["shingle"], hot, expected)

    def compare(batches):
        for part, group in whole_groups(batches, keys):
            at, n, member, node = (part[c].to_numpy().astype(np.int64) for c in ("at", "n", "member", "node"))
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size, least = np.bincount(group), np.minimum.reduceat(node, first)
            many = (size > crowd)[group]
            mixed = (np.minimum.reduceat(member, first) != np.maximum.reduceat(member, first))[group]

            def out(found, crowded):
                pairs = np.unique(np.concatenate(found), axis=0)
                return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)), pa.array(np.full(len(pairs), crowded))], ["u", "v", "crowd"])

            if (x := many & mixed).any():
                yield out([np.stack([least[group[x]], node[x]], axis=1)], True)
            found, made = [], 0
            group, at, n, member, node = (a[~many] for a in (group, at, n, member, node))
            for i, j in may_be_alike(group, at, n, member, similarity):
                found.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1))
                made += len(i)
                if made > 1 << 18:
                    yield out(found, False)
                    found, made = [], 0
            if found:
                yield out(found, False)

    return rows.mapInArrow(compare, "u long, v long, crowd boolean").distinct()


def shingle_sets(text: Column, words: int) -> Column:
    """The distinct shingle hashes of each text."""

    @F.arrow_udf("array<bigint>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    return of(F.coalesce(text, F.lit("")))


def grouped_pairs(found: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``found`` with ``gid``, the group that verifies a pair, and ``node, gids`` of all nodes in pairs.

    Nodes whose least partner is the same lie together, so a node is sent to few groups however many pairs it has; where the sets of
    such nodes exceed ``GROUP_SHINGLES`` they are dealt into parts, and each pair of parts that has pairs is a group.
    """
    ends = found.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(found.select(F.col("v").alias("node"), F.col("u").alias("other")))
    lead = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("lead")).join(nodes.select("node", "n"), "node")
    lead = cut(lead, "lead")
    size = cut(lead.groupBy("lead").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).alias("parts")).where("parts > 1"), "size")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), "parts"))
    place = cut(lead.join(if_few(size, size.count()), "lead", "left").select("node", F.struct("lead", part.cast("long").alias("part")).alias("place")), "place")
    n, out = place.count(), found
    for end in ("u", "v"):
        out = out.join(if_few(place.select(F.col("node").alias(end), F.col("place").alias(f"at_{end}")), n), end)
    out = cut(out.select(*found.columns, F.xxhash64(F.least("at_u", "at_v"), F.greatest("at_u", "at_v")).alias("gid")), "grouped")
    sent = out.select("gid", F.col("u").alias("node")).unionByName(out.select("gid", F.col("v").alias("node"))).groupBy("node").agg(F.collect_set("gid").alias("gids"))
    return out, cut(sent, "sent")


def in_groups(pairs: DataFrame, sets: DataFrame, decide, kind: str):
    """What ``decide`` gives for the pairs of each group (``gid, u, v, mu, mv``), which has the ``set`` of each of its nodes (``gid, u``)."""
    none = F.lit(None).cast("long")
    sets = sets.select("gid", "u", none.alias("v"), none.alias("mu"), none.alias("mv"), "n", "set")
    both = sets.unionByName(pairs.select("gid", "u", "v", "mu", "mv", none.alias("n"), F.lit(None).cast("array<bigint>").alias("set")))

    def verify(batches):
        for part, group in whole_groups(batches, ["gid"]):
            u, v, mu, mv, n = (part[c].to_pylist() for c in ("u", "v", "mu", "mv", "n"))
            rows, out, forest, now, have = part["set"].combine_chunks(), [], _Forest(), None, {}
            for i in range(part.num_rows):  # of each group, sets come first
                if group[i] != now:
                    now, have, forest = group[i], {}, _Forest()
                if v[i] is None:
                    have[u[i]] = rows[i].values.to_numpy(), n[i]
                elif decide(forest, mu[i], mv[i], *have[u[i]], *have[v[i]]):
                    out.append((u[i], v[i], mu[i], mv[i]))
            found = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in range(4)], ["u", "v", "mu", "mv"])

    return both.repartition("gid").sortWithinPartitions("gid", F.col("v").isNotNull(), "u", "v").mapInArrow(verify, kind)


PAIRS = "u long, v long, mu long, mv long"


def may_share(found: DataFrame, nodes: DataFrame, heads: DataFrame, similarity: float) -> DataFrame:
    """The pairs of ``found`` (``u, v, mu, mv``) that share enough of their heads to have that similarity, of ``node, n, head``.

    Of two sets that share ``c`` shingles of their heads, take the one whose head ends first in the order.  What it shares of its
    head with the other set is in the other's head too, so they share ``c`` and what is behind its head at most, ``ceil(similarity * n) - 1``.
    """
    pairs, sent = grouped_pairs(found, nodes)
    sets = heads.join(if_few(sent, sent.count()), "node").select(F.explode("gids").alias("gid"), F.col("node").alias("u"), "n", F.array_sort("head").alias("set"))

    def decide(forest, mu, mv, a, n, b, m):
        if min(n, m) < similarity * max(n, m) - 1e-9:
            return False
        need = math.ceil(similarity / (1 + similarity) * (n + m) - 1e-9) - (math.ceil(similarity * max(n, m) - 1e-9) - 1)
        return need <= 1 or len(np.intersect1d(a, b, assume_unique=True)) >= need

    return in_groups(pairs, sets, decide, PAIRS)


def with_sets(sent: DataFrame, nodes: DataFrame, docs: DataFrame, key: dict[str, Column], text: str, words: int) -> DataFrame:
    """``sent`` (a row a ``node``) with ``n`` and ``set``, the shingles of the row of ``docs`` that stands for the node."""
    ends = cut(nodes.select("node", "n", *(F.col(k).alias(f"_{k}") for k in key)).join(sent, "node"), "ends")
    rows = docs.select(F.col(f"`{text}`").alias("text"), *(c.alias(k) for k, c in key.items()))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key))
    n = ends.count()
    if few(ends, n):
        return rows.join(F.broadcast(ends), same).select(*sent.columns, "n", shingle_sets(F.col("text"), words).alias("set"))
    # Sets of the rows that are needed are made where their texts are, and they move instead of texts.
    here = among(docs, key, nodes.join(sent, "node", "left_semi"))
    needed = docs if here is None else docs.where(here)
    needed = needed.select(shingle_sets(F.col(f"`{text}`"), words).alias("set"), *(c.alias(k) for k, c in key.items()))
    return needed.join(ends, same).select(*sent.columns, "n", "set")


def alike(found: DataFrame, nodes: DataFrame, docs: DataFrame, key: dict[str, Column], text: str, words: int, similarity: float) -> DataFrame:
    """Links ``u, v`` that connect what the pairs of ``found`` connect whose texts share ``similarity`` of their distinct shingles (Jaccard), exactly.

    ``nodes`` has the shingles ``n`` and the ``key`` of the row of ``docs`` that stands for each ``node``; ``found`` may have ``mu, mv``, classes
    that are connected already.  A set of shingles moves once for each group that needs it, and pairs whose classes a group has connected
    are not looked at again.
    """
    if "mu" not in found.columns:
        found = found.withColumns({"mu": F.col("u"), "mv": F.col("v")})
    pairs, sent = grouped_pairs(found, nodes)
    sets = with_sets(sent, nodes, docs, key, text, words)
    sets = sets.select(F.explode("gids").alias("gid"), F.col("node").alias("u"), "n", "set")

    def decide(forest, mu, mv, a, n, b, m):
        if forest.root(mu) == forest.root(mv) or min(n, m) < similarity * max(n, m) - 1e-9:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both >= similarity * (n + m - both) - 1e-9 and forest.join(mu, mv)

    return in_groups(pairs, sets, decide, PAIRS).select("u", "v")


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set, each the parity of the shingles that fall on it; sets differ in as many shingles at least as their rows in bits."""
    n, most = len(sets), max(map(len, sets))
    width = max(1024, 1 << min((8 * most).bit_length(), 20, 27 - n.bit_length()))  # eight bits a shingle, of 16 MB in all
    out = np.zeros((n, width // 64), np.uint64)
    for row, own in zip(out, sets, strict=True):
        at = (own.view(np.uint64) * _MIX >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)
        row[:] = np.packbits(np.bincount(at, minlength=width) & 1, bitorder="little").view("<u8")
    return out


def crowd_forest(sets: list[np.ndarray], member: np.ndarray, side: np.ndarray, similarity: float):
    """Links ``i, j`` of a spanning forest of ``member`` over the pairs of ``sets`` that have that Jaccard similarity, of different ``side`` or of side 0.

    Of two sets of ``n`` and ``m`` whose bitmaps differ in ``d`` bits, at most ``(n + m - d) / 2`` shingles are shared; what is left is verified.
    """
    n, rows = np.fromiter(map(len, sets), np.int64, len(sets)), bitmaps(sets)
    label = np.unique(member, return_inverse=True)[1]
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        j = j[(label[j] != label[i]) & ((side[j] != side[i]) | (side[j] == 0)) & (np.minimum(n[j], n[i]) >= similarity * np.maximum(n[j], n[i]) - 1e-9)]
        apart = np.bitwise_count(rows[j] ^ rows[i]).sum(axis=1, dtype=np.int64)
        good = (n[j] + n[i] - apart) / 2 >= similarity / (1 + similarity) * (n[j] + n[i]) - 1e-9
        for x in j[good][np.argsort(apart[good], kind="stable")].tolist():
            if label[x] != label[i]:
                both = len(np.intersect1d(sets[i], sets[x], assume_unique=True))
                if both >= similarity * (n[i] + n[x] - both) - 1e-9:
                    yield i, x
                    label[label == label[x]] = label[i]


def crowd_links(gathered: DataFrame, table: DataFrame, docs: DataFrame, key: dict[str, Column], text: str, words: int, similarity: float, hot: int = HOT) -> DataFrame:
    """Links ``u, v`` that connect what the pairs of nodes of one crowd connect whose texts share ``similarity`` of their distinct shingles, exactly.

    ``gathered``: ``lead, node``; ``table``: ``node, n, member`` and ``key``.  A crowd is dealt into parts, and each pair of parts is a group of
    at most ``hot`` nodes and ``GROUP_SHINGLES`` shingles, about; a node's set goes once to each part that its crowd has.
    """
    rows = gathered.join(table.select("node", "n", "member"), "node")
    size = rows.groupBy("lead").agg(F.count("*").alias("size"), F.sum("n").alias("all"), (F.min("member") < F.max("member")).alias("mixed")).where("mixed")
    parts = F.greatest(F.least(F.ceil(F.col("size") / CROWD_PART), F.lit(CROWD_PARTS)), F.ceil(F.col("size") * 2 / hot), F.ceil(F.col("all") * 2 / GROUP_SHINGLES))
    size = cut(size.select("lead", parts.cast("int").alias("parts")), "crowd_parts")
    if not (crowded := size.count()):
        return docs.sparkSession.createDataFrame([], "u long, v long")
    part = F.pmod(F.xxhash64("node"), "parts").cast("int")
    side = lambda x: F.when(x == F.col("part"), 0).when(x < F.col("part"), 1).otherwise(2)
    group = lambda x: F.struct("lead", F.least("part", x).alias("low"), F.greatest("part", x).alias("high"), side(x).alias("side"))
    placed = rows.join(if_few(size, crowded), "lead").withColumn("part", part)
    placed = placed.select("node", "member", F.transform(F.sequence(F.lit(0), F.col("parts") - 1), group).alias("groups"))
    sent = cut(placed.groupBy("node").agg(F.first("member").alias("member"), F.flatten(F.collect_list("groups")).alias("groups")), "crowd_sent")
    sets = with_sets(sent, table, docs, key, text, words).select(F.explode("groups").alias("g"), "node", "member", "set").select("g.*", "node", "member", "set")
    keys = ["lead", "low", "high"]

    def verify(batches):
        for part, group in whole_groups(batches, keys):
            node, member, side = (part[c].to_numpy().astype(np.int64) for c in ("node", "member", "side"))
            own, out = part["set"].combine_chunks(), []
            ends = np.flatnonzero(np.concatenate([group[1:] != group[:-1], [True]])) + 1
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                sets = [own[k].values.to_numpy() for k in range(a, b)]
                out += [(node[a + i], node[a + j]) for i, j in crowd_forest(sets, member[a:b], side[a:b], similarity)]
            found = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in (0, 1)], ["u", "v"])

    return sets.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(verify, "u long, v long").distinct()


def simhash_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, bits: int = 4, lanes: int = 1, hot: int = HOT) -> DataFrame:
    """``doc_id, f0, ..., component_id`` for each row of ``docs``: its fingerprint and the least ``doc_id`` of its class.

    Words are what stands between ASCII whitespace after lower-casing A-Z; a text of fewer than ``words`` words is one
    shingle, a null, empty or blank text has fingerprint zero and is linked like any other.  A null ``doc_id`` stays
    and names a class only if no other id can.  Repeated rows give repeated rows of one class; no rows give no rows;
    other columns are not read.  A very long text is fingerprinted by the task that reads it, from all its shingles; only its fingerprint moves.
    """
    names = [f"f{i}" for i in range(lanes)]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprints(F.col(f"`{text}`"), words, lanes).alias("fp"))
    rows = cut(rows.select("doc_id", "fp.*").withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    distinct = rows.groupBy(*names).agg(F.min("doc_id").alias("least"), F.count("*").alias("size"))
    distinct = cut(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    found = links(distinct.select("node", *names), bits, lanes, hot)
    member = components(found).withColumnRenamed("node", "_node")
    named = distinct.join(member, distinct["node"] == member["_node"], "left").select(*names, "least", "size", F.coalesce("component", "node").alias("class"))
    named = cut(named, "classes")
    ids = cut(named.groupBy("class").agg(F.min("least").alias("component_id"), F.count("*").alias("fps")), "ids")
    named = join_back(named.select(*names, "size", "class"), ids, ["class"], "fps")
    return join_back(rows, cut(named.drop("class"), "named"), names, "size").select("doc_id", *names, "component_id")


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, similarity: float = 0.8, lanes: int = 4, hot: int = HOT) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates, one of the least ``doc_id``; all columns stay.

    Two texts are linked exactly if the Jaccard similarity of their distinct shingles of ``words`` words is ``similarity``
    or more; texts without words are alike, null ones too.  Rows that repeat an id and a text are rows like any others: one row of a
    class stays, one with a null ``doc_id`` only if no row of the class has another.  No rows give no rows.
    """
    names = [f"f{i}" for i in range(lanes)]
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Equal ids and texts, by 128 bits of hash, are one row for all decisions.
    key = {"id": F.col(f"`{doc_id}`"), "k0": F.xxhash64(column), "k1": F.xxhash64(F.lit(1), column)}
    with scope() as keep:
        sketch = sketches(column, words, lanes, similarity, crowds(docs, text, words), docs.sparkSession)
        rows = cut(docs.select(*(c.alias(k) for k, c in key.items()), sketch.alias("x")).select(*key, "x.*"), "rows")
        # A node is one set of shingles; the row that would stay stands for it.
        best = F.struct(F.col("id").isNull().alias("none"), *key)
        nodes = rows.select(*names, "d0", "d1", "n", best.alias("best")).groupBy("d0", "d1").agg(F.min("best").alias("best"), *(F.first(c).alias(c) for c in (*names, "n")))
        nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "best", *(F.col(f"best.{k}").alias(k) for k in key), "d0", "d1", *names, "n"), "nodes")

        with scope() as keep_links:
            one = cut(nodes.groupBy(*names).agg(F.min("node").alias("node")), "prints")
            near_prints = cut(links(one, int((1 - similarity) * 64 * lanes), lanes, hot, True, NEAR_KEY), "near_prints")
            sure = keep_links(cut(alike(near_prints, nodes, docs, key, text, words, similarity), "sure"))
        with scope() as keep_links:
            member = keep_links(cut(components(sure).withColumnRenamed("node", "_node"), "members"))
            table = nodes.join(member, F.col("node") == F.col("_node"), "left").select("node", "n", F.coalesce("component", "node").alias("member"), "d0", "d1", F.col("best").alias("_best"), *key)
            first = rows.select(best.alias("best"), F.col("d0").alias("_d0"), F.col("d1").alias("_d1"), "head")
            # Only a node's own row gives its head, and equal rows give it once more, which changes nothing.
            first = first.join(table, (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1")) & F.col("best").eqNullSafe(F.col("_best")))
            heads = cut(first.select("node", "member", "n", "head"), "heads")
            met = cut(candidates(heads, similarity, hot), "candidates")
            gathered, found = met.where("crowd").select(F.col("u").alias("lead"), F.col("v").alias("node")), met.where("not crowd").select("u", "v")
            for end in ("u", "v"):
                found = found.join(table.select(F.col("node").alias(end), F.col("member").alias(f"m{end}")), end)
            found = cut(may_share(found, nodes, heads.select("node", "n", "head"), similarity), "may_share")
            more = keep_links(cut(alike(found, nodes, docs, key, text, words, similarity), "more"))
            crowded = keep_links(cut(crowd_links(gathered, table, docs, key, text, words, similarity, hot), "crowded_links"))
        # The first links are stars by now, which need fewer rounds than the links themselves.
        stars = member.select(F.col("component").alias("u"), F.col("_node").alias("v"))
        member = components(stars.unionByName(more).unionByName(crowded)).withColumnRenamed("node", "_node")
        stay = nodes.join(member, F.col("node") == F.col("_node"), "left").groupBy(F.coalesce("component", "node")).agg(F.min("best").alias("best"))
        stay = stay.select(*(F.col(f"best.{k}").alias(f"_{k}") for k in key), F.lit(True).alias("stays"))
        each = rows.groupBy(*key).agg(F.count("*").alias("rows"))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key))
        each = each.join(stay, same, "left").select(*key, "rows", F.coalesce("stays", F.lit(False)).alias("stays"))
        gone = keep(cut(each.where("rows > 1 or not stays").drop("rows"), "gone"))
    return without(docs, key, gone)
