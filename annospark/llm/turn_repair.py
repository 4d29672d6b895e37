"""Repair of conversation structure by Wagner-Fischer alignment to the grammar's strings.

A conversation's role initials shall be ``(s?(ua)+)?``.  For each length there is one such string, and a run of turns is
aligned to the string of each length that can still be cheapest: lengths are tried from the number of turns that need not go
outwards, and the best cost so far (the incumbent) bounds both which lengths are tried and the band of the table that is
filled (Ukkonen).  Alignments that cost as little as the incumbent are traced back and their audits compared.

Runs of up to ``RUN`` turns are aligned, many of one length together, to the strings between any two places in the
grammar (before anything, after s, after u, after a).  Runs then follow each other: of two places the least sum over the
place between is taken, ties by the audits.  That is exact, as an audit's cost follows from its letters, so of two audits
of equal cost over the same turns neither begins with the other.  A conversation of very many turns is therefore spread
over tasks in segments; whole conversations only meet in one row as their audit, which is a column of the result.

No task holds a conversation's texts.  Turns are ordered by range partitions; repeats are told by a digest; texts are
joined to the turns that stay, and hashed in the order of the turns as they stream by.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from annospark.lineage import cut
from annospark.skew import join_back

#: Turns in a run that is aligned at once, in a segment (a power of two), and lines in a piece of repaired text.
RUN, SEGMENT_BITS, PIECE_LINES = 64, 10, 16
#: Costs of the edits, and of a truncated turn that stays.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Whitespace, and ends of whole turns.
SPACE, STOPS = " \t\n\v\f\r", ".!?"
#: Characters of role and text that order the turns of equal number, before a digest does.
HEAD = 64
#: A turn as a letter: its role's initial (any other one is o), in three alphabets: whole, truncated, blank or repeated.
INITIALS = "suao"
LETTERS = {"": "suao", "truncated": "SUAO", "gone": "1234"}

NEVER = 1 << 29
#: Places in the grammar: before anything, after s, after u, after a.
PLACES = 4
#: Classes of strings: what they begin with and which lengths they have.
CLASSES = ("none", "u odd", "u even", "a odd", "a even", "s", "s even", "s odd")
#: Of each place, the places that a class of strings leads to.
LEADS = (
    {"none": 0, "u odd": 2, "u even": 3, "s": 1, "s even": 2, "s odd": 3},
    {"none": 1, "u odd": 2, "u even": 3},
    {"none": 2, "a odd": 3, "a even": 2},
    {"none": 3, "u odd": 2, "u even": 3},
)


def class_of(first: str, length: int) -> int:
    """The class of the string of ``length`` that begins with ``first``."""
    if length == 0:
        return 0
    if first == "s" and length == 1:
        return CLASSES.index("s")
    return CLASSES.index(f"{first} {'odd' if length % 2 else 'even'}")


def target(first: str, length: int) -> str:
    """The alternating string of ``length``; after a first s comes u."""
    pair = {"u": "ua", "a": "au", "s": "ua"}[first]
    return ("s" if first == "s" else "") * (length > 0) + (pair * length)[: max(0, length - (first == "s"))]


def table(role: np.ndarray, extra: np.ndarray, gone: np.ndarray, string: str, limit: int) -> np.ndarray:
    """Least costs ``turn, place, run`` from each turn and place of ``string`` on, where a path of cost ``limit`` can pass."""
    (m, n), size = role.shape, len(string)
    out = np.full((n + 1, size + 1, m), NEVER, np.int32)
    symbols = np.array([INITIALS.index(c) for c in string], np.int8)
    ramp = (INSERT * np.arange(size + 1, dtype=np.int32))[:, None]
    # The band: each step off the straight way takes a deletion and an insertion more.
    skew = size - n
    spare = (limit - INSERT * max(0, skew) - DELETE * max(0, -skew)) // (DELETE + INSERT)
    for i in range(n, -1, -1):
        low, high = max(0, i + min(0, skew) - spare), min(size, i + max(0, skew) + spare)
        if low > high:
            continue
        here = np.full((high - low + 1, m), NEVER, np.int32)
        if i < n:
            here = out[i + 1, low : high + 1] + DELETE
            inner = min(high, size - 1)
            if inner >= low:
                want = symbols[low : inner + 1, None]
                same = role[None, :, i] == want
                step = np.where(same, 0, np.where(want == 0, NEVER, REROLE)) + extra[None, :, i]
                step = np.where(gone[None, :, i], NEVER, step)
                here[: inner - low + 1] = np.minimum(here[: inner - low + 1], out[i + 1, low + 1 : inner + 2] + step)
        elif high == size:
            here[-1] = 0
        # Insertions: the least over the places to the right, each five more a step; s can't be inserted.
        tail = here + ramp[low : high + 1]
        tail = np.minimum.accumulate(tail[::-1], axis=0)[::-1] - ramp[low : high + 1]
        if low == 0 and string[:1] == "s":
            tail[0] = here[0]
        out[i, low : high + 1] = np.minimum(tail, NEVER)
    return out


def traced(costs: np.ndarray, role: np.ndarray, string: str) -> list[bytes]:
    """The ASCII-least audit of each run's least cost."""
    n, size, m = costs.shape[0] - 1, len(string), costs.shape[2]
    symbols = np.array([*(INITIALS.index(c) for c in string), -1], np.int8)
    i, j, rows = np.zeros(m, np.int64), np.zeros(m, np.int64), np.arange(m)
    audit = np.zeros((m, n + size), np.uint8)
    for at in range(n + size):
        go = rows[(i < n) | (j < size)]
        if not len(go):
            break
        a, b = i[go], j[go]
        now = costs[a, b, go]
        deletes = (a < n) & (costs[np.minimum(a + 1, n), b, go] + DELETE == now)
        inserts = ~deletes & (b < size) & (symbols[b] != 0) & (costs[a, np.minimum(b + 1, size), go] + INSERT == now)
        keeps = role[go, np.minimum(a, n - 1)] == symbols[b]
        audit[go, at] = np.where(deletes, ord("D"), np.where(inserts, ord("I"), np.where(keeps, ord("K"), ord("R"))))
        i[go] += ~inserts
        j[go] += ~deletes
    return [bytes(x).rstrip(b"\0") for x in audit]


def aligned(runs: list[str]) -> list[list[tuple[int, bytes] | None]]:
    """Of each run (turns as ``LETTERS``) the least cost and audit for each of ``CLASSES``."""
    out: list = [None] * len(runs)
    sizes: dict[int, dict[str, list[int]]] = {}
    for k, run in enumerate(runs):
        sizes.setdefault(len(run), {}).setdefault(run, []).append(k)
    every = "".join(LETTERS.values())
    places = np.zeros(128, np.int8)
    places[[ord(c) for c in every]] = np.arange(len(every))
    for n, same in sizes.items():
        letters = places[np.frombuffer("".join(same).encode(), np.uint8).reshape(len(same), n)]
        for found, where in zip(_aligned(letters % len(INITIALS), letters // len(INITIALS)), same.values(), strict=True):
            for k in where:
                out[k] = found
    return out


def _aligned(role: np.ndarray, fault: np.ndarray) -> list[list[tuple[int, bytes] | None]]:
    m, n = role.shape
    extra, gone = np.where(fault == 1, TRUNCATED, 0).astype(np.int32), fault == 2
    must = gone.sum(axis=1)
    stay = n - must
    system = ((role == 0) & ~gone).any(axis=1)
    cost = np.full((len(CLASSES), m), NEVER, np.int64)
    audits: list[list[bytes]] = [[b""] * m for _ in CLASSES]
    for first in "uas":
        usable = system if first == "s" else np.ones(m, bool)
        middle, step, idle = int(np.median(stay)), 0, 0
        # Lengths of one parity in a step; those of a class end when none can be as cheap as the incumbent.
        while idle < 2 or step <= middle:
            idle += 1
            for length in sorted(x for x in {middle + step, middle - step} if x >= (first != "u")):
                c = class_of(first, length)
                least = DELETE * np.maximum(must, n - length) + INSERT * np.maximum(0, length - stay)
                at = np.flatnonzero(usable & (least <= cost[c]))
                if not len(at):
                    continue
                idle = 0
                string = target(first, length)
                limit = int(np.minimum(cost[c, at], DELETE * n + (INSERT + TRUNCATED) * (length + 1)).max())
                costs = table(role[at], extra[at], gone[at], string, limit)
                won = costs[0, 0] <= cost[c, at]
                won &= costs[0, 0] < NEVER
                at, costs = at[won], costs[:, :, won]
                for k, new, audit in zip(at.tolist(), costs[0, 0].tolist(), traced(costs, role[at], string) if len(at) else [], strict=True):
                    if new < cost[c, k] or audit < audits[c][k]:
                        cost[c, k], audits[c][k] = new, audit
            step += 1
    return [[(int(cost[c, k]), audits[c][k]) if cost[c, k] < NEVER else None for c in range(len(CLASSES))] for k in range(m)]


Paths = list[list[tuple[int, bytes] | None]]


def paths_of(classes: list[tuple[int, bytes] | None]) -> Paths:
    """The least cost and audit from each place of the grammar to each."""
    out: Paths = [[None] * PLACES for _ in range(PLACES)]
    for start, leads in enumerate(LEADS):
        for name, end in leads.items():
            out[start][end] = _less(out[start][end], classes[CLASSES.index(name)])
    return out


def _less(a, b):
    return b if a is None else a if b is None else min(a, b)


def follow(first: list[tuple[int, bytes] | None], then: Paths) -> list[tuple[int, bytes] | None]:
    """What ``first`` gives for each place, followed by ``then``."""
    out: list = [None] * PLACES
    for middle, a in enumerate(first):
        for end, b in enumerate(then[middle]):
            if a and b:
                out[end] = _less(out[end], (a[0] + b[0], a[1] + b[1]))
    return out


def segments_aligned(texts: list[str]) -> list[str]:
    """The paths of each segment's turns, written as text."""
    runs = [t[i : i + RUN] for t in texts for i in range(0, len(t), RUN)]
    paths, at, out = [paths_of(c) for c in aligned(runs)], 0, []
    for t in texts:
        n = -(-len(t) // RUN)
        own = paths[at]
        for then in paths[at + 1 : at + n]:
            own = [follow(first, then) for first in own]
        at += n
        out.append("|".join(f"{p[0]}:{p[1].decode()}" if p else "" for first in own for p in first))
    return out


def parse(text: str) -> Paths:
    cells = [(int(c.partition(":")[0]), c.partition(":")[2].encode()) if c else None for c in text.split("|")]
    return [cells[k * PLACES : (k + 1) * PLACES] for k in range(PLACES)]


def cheapest(paths: list[str]) -> tuple[int, bytes]:
    """Cost and audit of a whole conversation, of its segments' paths."""
    now = [(0, b""), None, None, None]
    for text in paths:
        now = follow(now, parse(text))
    return _less(now[0], now[3])


def slices(audit: bytes, turns: list[int]) -> list[tuple[int, str]]:
    """Of each segment of ``turns`` how many turns of the result come before it, and its part of the audit."""
    letters = np.frombuffer(audit, np.uint8)
    of_turns = np.flatnonzero(letters != ord("I"))
    cuts = [0, *(of_turns[np.cumsum(turns)[:-1] - 1] + 1).tolist(), len(audit)]
    before = np.concatenate([[0], np.cumsum(letters != ord("D"))])
    return [(int(before[a]), audit[a:b].decode()) for a, b in zip(cuts, cuts[1:], strict=False)]


def role_at(place: int, length: int) -> str | None:
    """The role that an edited turn has at a place of the repaired conversation; the first of an odd number is system's, which no edit makes."""
    place -= length % 2
    return ("user", "assistant")[place % 2] if place >= 0 else None


def damaged(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, text, copies``: conversations damaged by the checksum of id and turn; nulls become one space."""
    given = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(given(conv_id), F.lit(":"), given(turn))) % 20
    out = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), given(role).alias("role"), given(text).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def digest() -> Column:
    """A digest of conversation, role and text that tells them all apart."""
    known = F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("conv_id").cast("string")))
    return F.unhex(F.sha2(F.concat(F.length(known).cast("string"), F.lit(":"), known, F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def ordered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, at, initial, blank, truncated, digest``, written: a row a turn, numbered in order by ``at``."""
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    slim = rows.select(
        "conv_id", "turn", F.substring("role", 1, HEAD).alias("_role"), F.substring("text", 1, HEAD).alias("_text"), digest().alias("digest"),
        F.when(initial.isin(*INITIALS[:3]), initial).otherwise(INITIALS[3]).alias("initial"), (end == "").alias("blank"),
        (~end.isin("", *STOPS)).alias("truncated"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"),
    )
    by = ["conv_id", "turn", "_role", "_text", "digest"]
    return cut(slim.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()).drop("_role", "_text", "_copy"), "turns")


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The damaged conversations of ``turns`` and their cheapest repairs, a row for each conversation of ``turns``.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.  A null role or text is one space, as are null ids and turns where
    the damage is chosen; rows of a null ``conv_id`` are one conversation, null turns come first.  Turns of equal number are ordered by
    role and text (beyond their first 64 characters by a digest), so repeated rows follow each other and only the first stays.
    A conversation that has no rows after the damage has zeros, an empty audit and the digest of the empty string; no rows give no rows.
    Long texts are only digested and joined, ``PIECE_LINES`` in a row at most; other columns are not read.
    """
    before = damaged(turns, conv_id, turn, role, text)
    rows = ordered(before)
    repeated = cut(rows.groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("rows")).where("rows > 1"), "repeated")
    rows = join_back(rows, repeated, ["digest"], "rows", "left").withColumn("duplicate", ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    rows = rows.withColumn("truncated", F.col("truncated") & ~F.col("duplicate"))
    letter = F.when(F.col("blank") | F.col("duplicate"), F.translate("initial", INITIALS, LETTERS["gone"])).when(F.col("truncated"), F.translate("initial", INITIALS, LETTERS["truncated"])).otherwise(F.col("initial"))
    counts = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    each = F.array_sort(F.collect_list(F.struct("at", letter.alias("letter"), "initial", F.col("turn").cast("long").alias("turn"), "digest")))  # 2**SEGMENT_BITS rows at most
    segments = cut(rows.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(each.alias("turns"), *counts), "segments")

    @F.arrow_udf("string")
    def paths(letters: pa.Array) -> pa.Array:
        return pa.array(segments_aligned(letters.to_pylist()), pa.string())

    initials = F.array_join("turns.initial", "")
    # The initials that follow each other are wrong unless they are one of the three legal pairs.
    pairs = F.transform(F.sequence(F.lit(1), F.size("turns") - 1), lambda i: F.substring(initials, i, F.lit(2)))
    wrong = F.when(F.size("turns") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    numbers = F.filter("turns.turn", lambda t: t.isNotNull())
    parts = segments.select(
        "conv_id", "blank", "duplicate", "truncated",
        F.struct(
            "segment", F.size("turns").alias("n"), paths(F.array_join("turns.letter", "")).alias("paths"), wrong.alias("illegal"), F.substring(initials, 1, 1).alias("first"), F.substring(initials, -1, 1).alias("last"),
            F.size(F.array_distinct(numbers)).alias("distinct"), F.array_min(numbers).alias("least"), F.array_max(numbers).alias("most"),
        ).alias("part"),
    )
    kind = "struct<gaps:long,illegal:long,cost:long,audit:string,segments:array<struct<segment:long,before:long,audit:string>>>"

    @F.arrow_udf(kind)
    def whole(conversations: pa.Array) -> pa.Array:
        out = []
        for own in conversations.to_pylist():
            cost, audit = cheapest([p["paths"] for p in own])
            illegal = sum(p["illegal"] for p in own) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
            known = [p for p in own if p["least"] is not None]
            distinct = sum(p["distinct"] for p in known) - sum(a["most"] == b["least"] for a, b in zip(known, known[1:], strict=False))
            gaps = known[-1]["most"] - known[0]["least"] + 1 - distinct if known else 0
            where = [{"segment": p["segment"], "before": b, "audit": a} for p, (b, a) in zip(own, slices(audit, [p["n"] for p in own]), strict=True)]
            out.append({"gaps": gaps, "illegal": illegal, "cost": cost, "audit": audit.decode(), "segments": where})
        place = pa.list_(pa.struct([("segment", pa.int64()), ("before", pa.int64()), ("audit", pa.string())]))
        return pa.array(out, pa.struct([("gaps", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("segments", place)]))

    # A conversation's parts take a few bytes a turn, as its audit does.
    gathered = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    found = cut(gathered.select("conv_id", "blank", "duplicate", "truncated", whole("parts").alias("x")).select("conv_id", "blank", "duplicate", "truncated", "x.*"), "conversations")
    hashes = _hashes(before, segments, found)

    everyone = turns.select(F.col(f"`{conv_id}`").alias("conv_id")).distinct()
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = _with(_with(everyone, found.drop("segments")), hashes)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the columns of ``right`` by ``conv_id``, null ids being equal."""
    return left.join(right.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")


def _hashes(before: DataFrame, segments: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired conversations that aren't empty."""
    size = F.expr("cast(length(replace(audit, 'D', '')) as long)")
    places = found.select(F.col("conv_id").alias("_id"), size.alias("length"), F.explode("segments").alias("s")).select("_id", "length", F.col("s.segment").alias("_segment"), "s.before", "s.audit")
    both = segments.join(places, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("segment") == F.col("_segment"))).select("conv_id", "length", "before", "audit", F.col("turns.digest").alias("digests"))

    @F.arrow_udf("array<struct<place:long,digest:binary,role:string>>")
    def edits(audits: pa.Array, digests: pa.Array, before: pa.Array, length: pa.Array) -> pa.Array:
        out = []
        for audit, own, place, n in zip(audits.to_pylist(), digests.to_pylist(), before.to_pylist(), length.to_pylist(), strict=True):
            turns, lines = iter(own), []
            for letter in audit:
                at = None if letter == "I" else next(turns)
                if letter != "D":
                    lines.append({"place": place, "digest": at, "role": None if letter == "K" else role_at(place, n)})
                    place += 1
            out.append(lines)
        return pa.array(out, pa.list_(pa.struct([("place", pa.int64()), ("digest", pa.binary()), ("role", pa.string())])))

    lines = both.select("conv_id", "length", F.explode(edits("audit", "digests", "before", "length")).alias("e")).select("conv_id", "length", "e.*")
    # What stays of a conversation has no repeats, so a digest names one turn; copies of its text are one.
    texts = before.select(digest().alias("_digest"), F.col("role").alias("_role"), "text").groupBy("_digest").agg(F.first("_role").alias("_role"), F.first("text").alias("text"))
    lines = lines.join(texts, F.col("digest") == F.col("_digest"), "left")
    line = F.concat(F.coalesce("role", "_role"), F.lit(":"), F.coalesce("text", F.lit("")))
    piece = F.shiftright("place", PIECE_LINES.bit_length() - 1)
    # A piece has PIECE_LINES lines at most.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda x: x["line"]), "\n")
    pieces = lines.groupBy("conv_id", piece.alias("piece"), "length").agg(joined.alias("content"))
    pieces = cut(pieces.select("conv_id", "piece", "length", F.when(F.col("length") <= PIECE_LINES, F.sha2("content", 256)).alias("sha256"), F.when(F.col("length") > PIECE_LINES, F.col("content")).alias("content")), "pieces")
    whole = pieces.where("sha256 is not null").select("conv_id", "sha256")

    def hashed(batches):
        # SHA-256 goes through a text in order, so one task streams a conversation's pieces.
        none = object()
        now, state, out = none, hashlib.sha256(), []
        for batch in batches:
            for own, content in zip(batch.column("conv_id").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if own != now:
                    if now is not none:
                        out.append((now, state.hexdigest()))
                    now, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(content.encode())
            yield batch_of(out)
            out = []
        if now is not none:
            yield batch_of([(now, state.hexdigest())])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], to_arrow_type(kind)), pa.array([r[1] for r in rows], pa.string())], ["conv_id", "sha256"])

    kind = pieces.schema["conv_id"].dataType
    long = pieces.where("sha256 is null").select("conv_id", "piece", "content").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(long.mapInArrow(hashed, f"conv_id {kind.simpleString()}, sha256 string"))

