"""Codes of vectors against plain Python over all entries."""

import hashlib
import math

import numpy as np
import pytest

from annospark.llm import queries, vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) of (vec_id, vector, label) by whole searches in Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts if kept else 0
    cut = [[v[s * w : (s + 1) * w] for s in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, np.array(kept[k][1], "<i4").tobytes()))[:entries]
    books = [[cut[k][s] for k in order] for s in range(parts)]
    nearest = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for s in range(parts):
            owners = [nearest(c[s], books[s])[1] for c in cut]
            for e in range(len(books[s])):
                own = [c[s] for c, o in zip(cut, owners, strict=True) if o == e]
                if own:
                    books[s][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[s], books[s]) for s in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, y), e in zip(kept, error, strict=True):
        total[y] = total.get(y, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, total[y], digest) for (i, _, y), f, e in zip(kept, found, error, strict=True)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_op13_on_the_small_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(queries.op13_vector_codes(spark, sf)) == brute(rows)


SCHEMA = "vec_id long, embedding array<float>, label int, rows long, code string, n int, vector string"


def test_nulls_ties_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    vector = lambda scale=1.0: [float(np.float32(x)) for x in rng.normal(0, scale, 16)]
    rows = [(k, vector(), k % 3 if k % 4 else None) for k in range(60)]
    rows += [(None, vector(), 1), (7, vector(), 2), (7, [0.0] * 16, 2), (7, [0.0] * 16, 2), (90, None, 1), (91, [*vector()[:15], None], 1)]
    rows += [(92, [*vector()[:15], float("nan")], 1), (93, [float("-inf"), *vector()[:15]], 1), (94, vector(5000.0), 0), (95, [-1e-9] * 16, None)]
    df = spark.createDataFrame([(*r, 5, "c", 2, "v") for r in rows], SCHEMA)
    assert got(vector_codes.compress(df.repartition(5))) == brute(rows)
    assert got(vector_codes.compress(df.where("vec_id < 5").repartition(2))) == brute([r for r in rows if r[0] is not None and r[0] < 5])
    assert got(vector_codes.compress(df.limit(0))) == []
    assert got(vector_codes.compress(df.where("vec_id = 90"))) == []


def test_vectors_without_components(spark):
    df = spark.createDataFrame([(k, [], 1, 5, "c", 2, "v") for k in range(3)], SCHEMA)
    assert got(vector_codes.compress(df)) == brute([(k, [], 1) for k in range(3)])


def test_ragged_and_huge_vectors_raise(spark):
    for vectors, what in (([[0.0] * 16, [0.0] * 8], "different lengths"), ([[0.0] * 9], "equal parts"), ([[1e6] * 8], "too large")):
        df = spark.createDataFrame([(k, v, 1, 5, "c", 2, "v") for k, v in enumerate(vectors)], SCHEMA)
        with pytest.raises(Exception, match=what):
            vector_codes.compress(df).collect()


def test_bounds_prune_and_never_change_the_nearest():
    rng = np.random.default_rng(4)
    vectors, books = rng.integers(-3000, 3000, (500, 8, 8)), rng.integers(-3000, 3000, (8, 16, 8))
    vectors[:200] = rng.integers(-2, 3, (200, 8, 8))
    books[:, 8:] = books[:, :8]  # ties throughout
    books[:, 3] = 0
    pivots = vector_codes.pivots_of(books)
    code, best, exact = vector_codes.assign(vectors, vector_codes.to_pivots(vectors, pivots), pivots, books)
    every = ((vectors[:, :, None] - books[None]) ** 2).sum(axis=3)
    assert (code == every.argmin(axis=2)).all() and (best == every.min(axis=2)).all() and exact < 0.8 * every.size
