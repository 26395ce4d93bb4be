"""Length buckets with the least padding, and token-budget batches inside them.

A batch pads all its texts to the length of its bucket. The histogram of all lengths is one row
per different length; a dynamic program over it finds the boundaries with the least padding of
all choices of at most ``n_buckets``. Every bucket is then cut into batches of as many texts as
fit the token budget.

Texts are dealt to batches in an order given by a hash of id and text, which also deals the rows
of a bucket to tasks: a bucket that holds most of the table is numbered by many tasks.

Defined results: null and empty texts have length 1, their end. A text longer than the budget is
a batch of its own, whole. Repeated rows are packed one by one. An empty table gives no rows.
Columns of the input that have the name of an added one are replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.session import BROADCAST_ROWS, stored

BUCKETS = 16
TOKEN_BUDGET = 1 << 16
#: Rows of a bucket that one task numbers, about.
CHUNK_ROWS = 50_000


def word_count(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text and one end, as a length."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), "^[\\x20\\x09-\\x0D]+", "")
    pieces = F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    ends_white = trimmed.rlike("[\\x20\\x09-\\x0D]\\z") | (trimmed == "")
    return (pieces - ends_white.cast("int") + 1).cast("long")


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding in all.

    ``lengths`` ascend. With C and S the counts and the tokens up to a length, putting lengths
    after i up to j into one bucket pads ``L[j] * (C[j] - C[i]) - (S[j] - S[i])``. For a fixed
    number of buckets the best i minimises lines in L[j] whose slopes fall with i, so a lower
    hull of lines, passed from left to right, gives all j in linear time.
    """
    n = len(lengths)
    if not n:
        return []
    c, s = [0], [0]
    for length, count in zip(lengths, counts):
        c.append(c[-1] + count)
        s.append(s[-1] + count * length)
    cost = [0] + [lengths[j - 1] * c[j] - s[j] for j in range(1, n + 1)]
    back: list[list[int]] = []
    for _ in range(1, min(n_buckets, n)):
        new, chosen = list(cost), [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []       # (i, value at 0, slope)
        at = 0
        for j in range(1, n + 1):
            i = j - 1
            line = (i, (cost[i] if i else 0) + s[i], -c[i])
            while len(hull) - at >= 2 and _useless(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            x = lengths[j - 1]
            while at + 1 < len(hull) and _value(hull[at + 1], x) <= _value(hull[at], x):
                at += 1
            value = x * c[j] - s[j] + _value(hull[at], x)
            if value < new[j] or chosen[j] == 0 and value == new[j]:
                new[j], chosen[j] = value, hull[at][0]
        cost = new
        back.append(chosen)
    bounds, j = [], n
    for chosen in reversed(back):
        bounds.append(lengths[j - 1])
        j = chosen[j]
        if not j:
            break
    if j:
        bounds.append(lengths[j - 1])
    return bounds[::-1]


def _value(line: tuple[int, int, int], x: int) -> int:
    return line[1] + line[2] * x


def _useless(a, b, c) -> bool:
    """Line b is nowhere below both of its neighbours; slopes fall from a to c."""
    return (c[1] - a[1]) * (a[2] - b[2]) <= (b[1] - a[1]) * (a[2] - c[2])


def padding(lengths: Sequence[int], counts: Sequence[int], bounds: Sequence[int]) -> int:
    """Padding tokens if every length goes to the first bound that holds it."""
    return sum(c * (bounds[bisect.bisect_left(bounds, x)] - x) for x, c in zip(lengths, counts))


def pack(docs: DataFrame, length: Column | None = None, id_column: str = "doc_id",
         text: str = "text", n_buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """``docs`` without the text, with n_tokens, bucket, bucket_length, batch and place.

    ``batch`` counts the batches of a bucket from 0, ``place`` the texts of a batch. The
    histogram reaches the driver: it has a row per different length, fewer than
    ``sqrt(2 * all tokens)``.
    """
    added = {"n_tokens", "bucket", "bucket_length", "batch", "place", "_order"}
    keep = [c for c in docs.columns if c.lower() not in added | {text.lower()}]
    sized = stored(docs.select(
        *[col(c) for c in keep], (word_count(text) if length is None else length)
        .cast("long").alias("n_tokens"),
        F.xxhash64(col(id_column), col(text)).alias("_order")), "lengths")
    histogram = sorted((r["n_tokens"], r["n"]) for r in
                       sized.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    bounds = best_boundaries([x for x, _ in histogram], [n for _, n in histogram], n_buckets)
    if not bounds:
        bounds = [1]
    upper = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(upper, lambda b: b < F.col("n_tokens")))
    rows = sum(n for _, n in histogram)
    chunks = max(1, -(-rows // CHUNK_ROWS))
    # Chunks are ranges of the order, so numbers run on from chunk to chunk.
    chunk = F.expr(f"cast(floor((cast(_order as double) + 9223372036854775808D) "
                   f"/ 18446744073709551616D * {chunks}) as int)")
    dealt = sized.withColumn("bucket", bucket).withColumn("_chunk", chunk)
    sizes = dealt.groupBy("bucket", "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("bucket").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_chunk",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if chunks * len(bounds) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("bucket", "_chunk").orderBy("_order", col(id_column))
    numbered = (dealt.withColumn("_at", F.row_number().over(inside) - 1)
                .join(offsets, ["bucket", "_chunk"])
                .withColumn("_at", F.col("_at") + F.col("_before")))
    bucket_length = upper[F.col("bucket")]
    per_batch = F.greatest(F.lit(1).cast("long"), F.expr(f"{budget} div bucket_length"))
    return (numbered.withColumn("bucket_length", bucket_length)
            .withColumn("_k", per_batch)
            .select(*[col(c) for c in keep], "n_tokens", "bucket", "bucket_length",
                    F.expr("_at div _k").alias("batch"),
                    F.expr("_at % _k").alias("place")))
