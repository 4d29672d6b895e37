"""Hashing, shard placement and Morton codes as column expressions.

64-bit ids travel as BIGINT bit patterns: shifts are unsigned, and only
``unsigned`` renders a pattern as a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.names import free_name

#: Fixed values of MurmurHash3_x86_128 that an 8-byte key meets.
C1, C2, C3 = 0x239B961B, 0xAB0E9789, 0x38B34AE5
MIX1, MIX2 = 0x85EBCA6B, 0xC2B2AE35
KEY_BYTES = 8

LOW = 0xFFFFFFFF
HASHES = ("murmurhash3_x86_128", "identity")


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LOW))


def _times(x: Column, c: int) -> Column:
    """``x * c`` modulo 2**32 for ``x`` under 2**32; halves of ``c`` keep the products in range."""
    return _low(x * F.lit(c & 0xFFFF) + F.shiftleft((x * F.lit(c >> 16)).bitwiseAND(F.lit(0xFFFF)), 16))


def _rotate(x: Column, n: int) -> Column:
    return _low(F.shiftleft(x, n)).bitwiseOR(F.shiftrightunsigned(x, 32 - n))


def with_murmur(df: DataFrame, key: str, out: str = "hash", preshift: int = 0) -> DataFrame:
    """``df`` with ``out``: the low 64 bits of MurmurHash3_x86_128, seed 0, of the 8 little-endian bytes of ``key``.

    The steps are columns of their own, so that none is spelled out twice in a later one.
    """
    v, a, b, c = (free_name(f"step_{n}", df.columns) for n in "vabc")
    step = df.withColumn(v, F.shiftrightunsigned(F.col(key).cast("long"), preshift))
    step = step.withColumns({a: _times(_low(F.col(v)), C1), b: _times(F.shiftrightunsigned(v, 32), C2)})
    step = step.withColumns({a: _times(_rotate(F.col(a), 15), C2).bitwiseXOR(F.lit(KEY_BYTES)), b: _times(_rotate(F.col(b), 16), C3).bitwiseXOR(F.lit(KEY_BYTES))})
    # The third and fourth words never differ.
    step = step.withColumn(a, _low(F.col(a) + F.col(b) + 2 * KEY_BYTES))
    step = step.withColumns({b: _low(F.col(b) + F.col(a)), c: _low(F.col(a) + KEY_BYTES)})
    for shift, factor in ((16, MIX1), (13, MIX2), (16, None)):
        mixed = {n: F.col(n).bitwiseXOR(F.shiftrightunsigned(F.col(n), shift)) for n in (a, b, c)}
        step = step.withColumns(mixed)
        if factor:
            step = step.withColumns({n: _times(F.col(n), factor) for n in (a, b, c)})
    step = step.withColumn(a, _low(F.col(a) + F.col(b) + 2 * F.col(c)))
    whole = F.shiftleft(_low(F.col(b) + F.col(a)), 32).bitwiseOR(F.col(a))
    return step.withColumn(out, whole).drop(v, a, b, c)


def _with_hash(df: DataFrame, key: str, preshift: int, hash: str) -> tuple[DataFrame, str]:
    if hash not in HASHES:
        raise ValueError(f"unknown hash {hash!r}")
    name = free_name("hash", df.columns)
    if hash == "identity":
        return df.withColumn(name, F.shiftrightunsigned(F.col(key).cast("long"), preshift)), name
    return with_murmur(df, key, name, preshift), name


def with_shard(df: DataFrame, key: str, shard_bits: int, minishard_bits: int, preshift: int = 0, hash: str = HASHES[0]) -> DataFrame:
    """``df`` with ``shard`` and ``minishard`` of each ``key``."""
    df, name = _with_hash(df, key, preshift, hash)
    part = lambda down, bits: F.shiftrightunsigned(F.col(name), down).bitwiseAND(F.lit((1 << bits) - 1)).cast("long")
    return df.withColumns({"shard": part(minishard_bits, shard_bits), "minishard": part(0, minishard_bits)}).drop(name)


def with_level_shard(df: DataFrame, key: str, level: Column, specs: list) -> DataFrame:
    """``df`` with ``shard`` and ``minishard`` of each ``key`` by the spec of its ``level``; one hash serves all levels of equal hash and preshift."""
    kinds = {(s.preshift_bits, s.hash) for s in specs}
    if len(kinds) > 1:
        raise ValueError("levels with different hashes")
    df, name = _with_hash(df, key, *(kinds.pop() if kinds else (0, HASHES[0])))
    bits = lambda of: F.get(F.array(*(F.lit(of(s)) for s in specs)), level)
    m, n = free_name("minishard_bits", df.columns), free_name("shard_bits", df.columns)
    df = df.withColumns({m: bits(lambda s: s.minishard_bits), n: bits(lambda s: s.shard_bits)})
    df = df.withColumns({"shard": F.expr(f"shiftrightunsigned(`{name}`, `{m}`) & (shiftleft(1L, `{n}`) - 1L)"), "minishard": F.expr(f"`{name}` & (shiftleft(1L, `{m}`) - 1L)")})
    return df.drop(name, m, n)


def place(key: int, shard_bits: int, minishard_bits: int, preshift: int = 0, hash: str = HASHES[0]) -> tuple[int, int]:
    """(shard, minishard) of one key on the driver, for the few keys that a lookup names."""
    times, rotate = (lambda x, c: x * c & LOW), (lambda x, n: (x << n | x >> 32 - n) & LOW)
    h = (key & (1 << 64) - 1) >> preshift
    if hash != "identity":
        a, b = times(rotate(times(h & LOW, C1), 15), C2) ^ KEY_BYTES, times(rotate(times(h >> 32, C2), 16), C3) ^ KEY_BYTES
        a = a + b + 2 * KEY_BYTES & LOW
        words = [a, a + b & LOW, a + KEY_BYTES & LOW]
        for shift, factor in ((16, MIX1), (13, MIX2), (16, 1)):
            words = [times(w ^ w >> shift, factor) for w in words]
        a = words[0] + words[1] + 2 * words[2] & LOW
        h = (words[1] + a & LOW) << 32 | a
    return h >> minishard_bits & (1 << shard_bits) - 1, h & (1 << minishard_bits) - 1


def shard_hex(shard: Column, shard_bits: int) -> Column:
    """The shard's number in lower-case hexadecimal, as wide as the largest number needs."""
    return F.lpad(F.lower(F.hex(shard)), max(1, -(-shard_bits // 4)), "0")


def morton(x: Column, y: Column, z: Column, grid: tuple[int, int, int]) -> Column:
    """The compressed Morton code of a cell: bits of the axes in turn, those that the grid's size needs."""
    code, at = F.lit(0).cast("long"), 0
    for bit in range(max(grid).bit_length()):
        for axis, size in zip((x, y, z), grid, strict=True):
            if 1 << bit < size:
                code = code.bitwiseOR(F.shiftleft(F.shiftright(axis.cast("long"), bit).bitwiseAND(F.lit(1)), at))
                at += 1
    return code


def morton_of(cell: tuple[int, int, int], grid: tuple[int, int, int]) -> int:
    """``morton`` of one cell on the driver, for the few cells that a lookup names."""
    code = at = 0
    for bit in range(max(grid).bit_length()):
        for axis, size in zip(cell, grid, strict=True):
            if 1 << bit < size:
                code |= (axis >> bit & 1) << at
                at += 1
    return code


def cell_grid(level: int) -> tuple[int, int, int]:
    return (1 << level,) * 3


def unsigned(x: Column) -> Column:
    """A 64-bit pattern as a number from 0 to 2**64 - 1."""
    wide = x.cast("decimal(20,0)")
    return F.when(x < 0, wide + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")
