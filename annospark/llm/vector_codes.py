"""Codes of vectors by parts: integer k-means of each part, searched by LAESA.

Components become integers, vectors are cut into equal parts, and each part position
has a codebook of its own.  All arithmetic that decides anything is exact in integers.

The distances of every part to a few fixed pivots are computed once and stored beside it.
In a round, the distances of those pivots to the codebook's entries are a small table;
by the triangle inequality their differences bound a part's distance to an entry from
below.  Entries are tried in the order of their bounds, and an entry is evaluated exactly only where its
bound doesn't exceed the best distance so far.

A round is one narrow pass: a task adds up the parts of each entry and gives one row for each
part position and entry, so what is shuffled, and what comes to the driver, has a fixed size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import cut
from annospark.skew import join_back

#: Parts of a vector, entries of a codebook, rounds, pivots of each part position, what components are multiplied by.
PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 8, 16, 6, 4, 4096
#: Components have smaller absolute values than this once they are integers, so that squared distances fit 64 bits.
LARGEST = 1 << 27
#: What rounding of the square roots may add to a bound.
ROUNDING = 1e-3


def pivots_of(books: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` entries of each codebook (``part, entry, component``) that lie far apart: each is the farthest from those before."""
    out = []
    for entries in books:
        chosen = [0] if len(entries) else []
        while chosen and len(chosen) < min(n, len(entries)):
            near = np.min([((entries - entries[c]) ** 2).sum(axis=1) for c in chosen], axis=0)
            chosen.append(int(near.argmax()))
        out.append(entries[chosen])
    return np.stack(out)


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances ``row, part, pivot`` of ``vectors`` (``row, part, component``)."""
    return np.stack([np.sqrt(((vectors - pivots[None, :, p]) ** 2).sum(axis=2)) for p in range(pivots.shape[1])], axis=2)


def assign(vectors: np.ndarray, distances: np.ndarray, pivots: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each ``row, part`` the nearest entry, ties to the lower index, its squared distance, and how many exact distances that took."""
    n, parts = vectors.shape[:2]
    code, best, exact = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64), 0
    for s in range(parts):
        own, entries = vectors[:, s], books[s]
        across = np.sqrt(((entries[:, None] - pivots[s][None]) ** 2).sum(axis=2))
        bound = np.abs(distances[:, s, None, :] - across[None]).max(axis=2)
        order = np.argsort(bound, axis=1, kind="stable")
        rows, least, index = np.arange(n), np.full(n, np.iinfo(np.int64).max), np.full(n, len(entries))
        for r in range(len(entries)):
            k = order[rows, r]
            # Bounds ascend, so a row that is done stays done.  An equal distance may still have a lower index.
            going = bound[rows, k] <= np.sqrt(least[rows].astype(np.float64)) + ROUNDING
            rows, k = rows[going], k[going]
            if not len(rows):
                break
            d = ((own[rows] - entries[k]) ** 2).sum(axis=1)
            exact += len(rows)
            better = (d < least[rows]) | ((d == least[rows]) & (k < index[rows]))
            least[rows[better]], index[rows[better]] = d[better], k[better]
        code[:, s], best[:, s] = index, least
    return code, best, exact


def next_books(books: np.ndarray, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """Codebooks whose used entries are the floors of their parts' means."""
    out = books.copy()
    for (part, entry), (n, total) in sums.items():
        out[part, entry] = [t // n for t in total]
    return out


def _integers(batch: pa.RecordBatch, parts: int, width: int) -> np.ndarray:
    """``row, part, component`` of a batch of stored vectors of ``parts`` times ``width`` components."""
    flat = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").astype(np.int64)
    return flat.reshape(batch.num_rows, parts, width)


def stored(rows: DataFrame, vector: str, parts: int = PARTS) -> DataFrame:
    """``rows`` with usable vectors only, these as the bytes of 32-bit integers: floors of ``SCALE`` times the components."""
    x = F.col(f"`{vector}`")
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    @F.arrow_udf("binary")
    def integers(vectors: pa.Array) -> pa.Array:
        values = np.floor(pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False) * SCALE)
        if len(values) and np.abs(values).max() >= LARGEST:
            raise OverflowError(f"a component of {np.abs(values).max() / SCALE:g} is too large: squared distances wouldn't fit 64 bits")
        length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        if (length % parts).any():
            raise ValueError(f"a vector of {length[length % parts > 0][0]} components can't be cut into {parts} equal parts")
        ends, data = np.cumsum(length), values.astype("<i4")
        return pa.array([data[b - n : b].tobytes() for b, n in zip(ends.tolist(), length.tolist(), strict=True)], pa.binary())

    return rows.where(usable).withColumn(vector, integers(x))


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each row of ``vectors`` with a usable vector.

    Rows whose vector is null or holds null or non-finite components are dropped.  ``code``: the index of each part's entry, two
    hexadecimal digits each; ``error``: squared distances to them, summed; ``label_error``: ``error`` over all rows of an
    equal label, null labels together; ``codebooks_sha256``: of all final components in order, joined by commas.

    The codebooks start as the parts of the rows of least id; null ids come last, rows of equal id by their vectors.  Repeated rows
    count as often as they occur.  No usable rows give no rows.  Vectors of different lengths, or of one
    that ``parts`` doesn't divide, raise, as do components of 2**15 or more.  Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    usable = stored(rows, "vector", parts)
    least = usable.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries)
    first = [np.frombuffer(bytes(r["vector"]), "<i4").astype(np.int64) for r in least.collect()]  # ENTRIES rows at most
    size = len(first[0]) if first else 0
    if any(len(v) != size for v in first):
        raise ValueError("vectors have different lengths")
    books = np.array(first, np.int64).reshape(len(first), parts, size // parts).transpose(1, 0, 2)
    pivots, width = pivots_of(books), size // parts

    def measured(batches):
        for batch in batches:
            lengths = pc.binary_length(batch.column("vector"))
            if pc.any(pc.not_equal(lengths, 4 * size)).as_py():
                raise ValueError("vectors have different lengths")
            found = to_pivots(_integers(batch, parts, width), pivots).astype("<f8")
            yield batch.append_column("to_pivots", pa.array([x.tobytes() for x in found], pa.binary()))

    kept = cut(usable.mapInArrow(measured, f"vec_id {dict(rows.dtypes)['vec_id']}, label {dict(rows.dtypes)['label']}, vector binary, to_pivots binary"), "vectors")

    def coded(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = _integers(batch, parts, width)
        distances = np.frombuffer(b"".join(batch.column("to_pivots").to_pylist()), "<f8").reshape(len(own), parts, pivots.shape[1])
        return own, *assign(own, distances, pivots, books)[:2]

    def summed(books: np.ndarray):
        def each(batches):
            n, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for batch in batches:
                own, code, _ = coded(batch, books)
                for s in range(parts):
                    n[s] += np.bincount(code[:, s], minlength=n.shape[1])
                    np.add.at(total[s], code[:, s], own[:, s])
            part, entry = np.nonzero(n)
            arrays = [pa.array(part), pa.array(entry), pa.array(n[part, entry]), *(pa.array(total[part, entry, c]) for c in range(total.shape[2]))]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", *(f"c{c}" for c in range(total.shape[2]))])

        names = [f"c{c}" for c in range(books.shape[2])]
        found = kept.select("vector", "to_pivots").mapInArrow(each, ", ".join(f"{c} long" for c in ("part", "entry", "n", *names)))
        totals = found.groupBy("part", "entry").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *names)))
        return {(r["part"], r["entry"]): (int(r["n"]), [int(r[c]) for c in names]) for r in totals.collect()}  # a row for each part and entry

    for _ in range(rounds if len(first) else 0):
        books = next_books(books, summed(books))

    def final(batches):
        for batch in batches:
            _, code, error = coded(batch, books)
            text = pa.array([bytes(c).hex() for c in code.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), text, pa.array(error.sum(axis=1))], ["vec_id", "label", "code", "error"])

    types = dict(kept.dtypes)
    done = cut(kept.mapInArrow(final, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"), "codes")
    # Null labels are equal to each other here, so they join by a flag.
    key = {"no_label": F.col("label").isNull(), "own_label": F.coalesce("label", F.lit("0").cast(types["label"]))}
    done = done.withColumns(key)
    groups = done.groupBy(*key).agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return join_back(done, groups, list(key), "rows").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
