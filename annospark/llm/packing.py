"""Packing into optimal length buckets.

The global histogram of lengths (every length by itself; ``n`` different ones add up
to ``n * (n + 1) / 2`` tokens at least, so 30 GB of text have 200,000 at most) goes to
the driver, where dynamic programming chooses the ``buckets`` boundaries that minimise
the padding of all rows together.  Rows are then numbered within their bucket, and
runs of as many rows as the token budget allows are the batches.

Numbering is spread: a bucket, which may hold most rows, is dealt into slices of
about ``SLICE`` rows; a slice numbers its own rows, and prefix sums of the slices'
sizes make the numbers global.  Only a bucket's last batch is not full.
"""

from __future__ import annotations

import math
from collections import deque
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.lineage import cut

#: Rows numbered together.
SLICE = 20_000
#: Buckets, and padded tokens in a batch.
BUCKETS, BUDGET = 12, 32_768


def words(text: Column) -> Column:
    """The number of whitespace-separated words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def boundaries(top: list[int], count: list[int], total: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``top, count, total``: the largest length, the rows and the sum of lengths of each bin, ascending.  A bound is
    the largest length of some bin; the padding of a bucket is its bound times its rows less its lengths.  For a last
    bin j that is a minimum over lines in its bound, which a convex hull gives in linear time; all in integers.
    """
    n = len(top)
    if not n:
        return []
    rows, lengths = list(accumulate(count)), list(accumulate(total))
    best = [t * r - s for t, r, s in zip(top, rows, lengths, strict=True)]  # bins up to j in one bucket
    cuts = []
    for _ in range(1, min(buckets, n)):
        more, cut = best.copy(), [-1] * n
        hull: deque[tuple[int, int, int]] = deque()  # slope, height and bin of the lines that may still be least
        for j in range(1, n):
            slope, height = -rows[j - 1], best[j - 1] + lengths[j - 1]
            while len(hull) > 1 and (height - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - slope):
                hull.pop()
            hull.append((slope, height, j - 1))
            while len(hull) > 1 and hull[1][0] * top[j] + hull[1][1] <= hull[0][0] * top[j] + hull[0][1]:
                hull.popleft()
            padding = hull[0][0] * top[j] + hull[0][1] + top[j] * rows[j] - lengths[j]
            if padding < more[j]:
                more[j], cut[j] = padding, hull[0][2]
        best = more
        cuts.append(cut)
    out, j = [top[-1]], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = cut[j]
            out.append(top[j])
    return sorted(out)


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET, slice_rows: int = SLICE) -> DataFrame:
    """``doc_id, n_tokens, bucket, padded, batch, slot`` for each row of ``docs``.

    ``n_tokens`` is ``length``, or the words of the text.  ``bucket`` counts from 0 by length, ``padded`` is the length
    that rows of the bucket are padded to, ``batch`` counts from 0 in the bucket and ``slot`` in the batch.  A batch
    has ``budget`` padded tokens at most, or one row if that is longer.  A null or empty text has length 0; null,
    equal and repeated ids are rows like any others; no rows give no rows; other columns are not read.  Of very long texts only the
    lengths move.  The driver gets the histogram, about 100 bytes for each different length: a million lengths, which is what token counts of
    a hundred terabytes may have, are some 100 MB there and as many steps for each bucket.
    """
    length = words(F.col(f"`{text}`")) if length is None else F.greatest(F.coalesce(length, F.lit(0)).cast("long"), F.lit(0).cast("long"))
    rows = cut(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), length.alias("n_tokens")), "lengths")
    found = rows.groupBy("n_tokens").agg(F.count("*").alias("count")).orderBy("n_tokens").toArrow()
    top, count = (found[c].to_pylist() for c in ("n_tokens", "count"))
    bounds = boundaries(top, count, [t * c for t, c in zip(top, count, strict=True)], buckets)
    slices = max(1, math.ceil(sum(count) / slice_rows))
    bucket = padded = F.lit(None)
    for number, bound in reversed(list(enumerate(bounds))):
        fits = F.col("n_tokens") <= bound
        bucket, padded = F.when(fits, number).otherwise(bucket), F.when(fits, F.lit(bound)).otherwise(padded)
    rows = rows.withColumns({"bucket": bucket.cast("int"), "padded": padded.cast("long"), "slice": F.pmod(F.xxhash64("doc_id", "n_tokens", F.monotonically_increasing_id()), F.lit(slices))})
    sizes = rows.groupBy("bucket", "slice").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("bucket", "slice", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("n_tokens", "doc_id"))
    numbered = rows.withColumn("rank", rank).join(sizes, ["bucket", "slice"])
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("padded", F.lit(1)))).cast("long")
    at = F.col("before") + F.col("rank") - 1
    return numbered.select("doc_id", "n_tokens", "bucket", "padded", F.floor(at / fit).alias("batch"), F.pmod(at, fit).alias("slot"))
