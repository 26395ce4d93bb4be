"""The most frequent values of columns, exact, without shuffling every distinct value.

Columns of few values are simply counted; partial counts keep that shuffle small. For others:

1. Every task keeps a Misra-Gries summary of each column, ``COUNTERS`` values at most, and the
   smallest values. What the tasks have kept are the candidates, heavy values among them.
2. One scan counts the candidates exactly, and all other rows by ``BUCKETS`` of their hash. No
   value has more rows than its bucket.
3. A bucket with fewer rows than the last candidate that would be listed holds nothing that could
   take its place. The values of the remaining buckets are counted in full: none of them where
   some values stand out or where a column's values hardly repeat in a bucket, all of them where
   the bound does not tell values apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.session import BROADCAST_ROWS, stored

#: Columns with about this many values at most are counted directly.
FEW_VALUES = 100_000
#: Values that a task keeps for each column, and candidates that are counted.
COUNTERS = 1000
BUCKETS = 1 << 16


def _merge(held: dict, values: pa.Array, counts: np.ndarray, counters: int) -> dict:
    """Misra-Gries: add counts, then take as much from each value as leaves ``counters``."""
    if len(counts) > counters:
        off = np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
        kept = np.flatnonzero(counts > off)
        values, counts = values.take(pa.array(kept)), counts[kept] - off
    for value, n in zip(values.to_pylist(), counts.tolist()):
        held[value] = held.get(value, 0) + n
    if len(held) > 2 * counters:
        off = sorted(held.values(), reverse=True)[counters]
        held = {v: n - off for v, n in held.items() if n > off}
    return held


def _summaries(width: int, smallest: int, counters: int):
    """Arrow function: columns c0, c1, ... to (i, v, n): heavy values, and the smallest with 0."""
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy: list[dict] = [{} for _ in range(width)]
        low: list[pa.Array | None] = [None] * width
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(width)]
            for i in range(width):
                counted = batch.column(i).drop_null().value_counts()
                values = counted.field("values")
                heavy[i] = _merge(heavy[i], values, counted.field("counts").to_numpy(), counters)
                if low[i] is not None:
                    values = pc.unique(pa.concat_arrays([values, low[i]]))
                order = pc.array_sort_indices(values)
                low[i] = values.take(order.slice(0, smallest))
        for i, kind in enumerate(kinds):
            for values, counts in ((pa.array(list(heavy[i]), kind), list(heavy[i].values())),
                                   (low[i], [0] * len(low[i]))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(values), pa.int32()), values,
                     pa.array(counts, pa.int64())], names=["i", "v", "n"])

    return summaries


def _cells(df: DataFrame, names: Sequence[str], cast: str | None) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(i).alias("i"), (col(c).cast(cast) if cast else col(c))
                               .alias("v")) for i, c in enumerate(names)])
    return (df.select(F.explode(cells).alias("x")).select("x.i", "x.v")
            .filter(F.col("v").isNotNull()))


def _first(counts: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("i").orderBy(F.desc("n"), "v")
    # The rank filter is also applied before the shuffle, per input partition.
    return (counts.withColumn("__rn", F.row_number().over(order))
            .filter(F.col("__rn") <= top))


def _candidates(df: DataFrame, names: Sequence[str], top: int, cast: str | None) -> DataFrame:
    """(i, v): what the tasks' summaries have kept, ``COUNTERS`` heavy ones a column."""
    columns = df.select(*[(col(c).cast(cast) if cast else col(c)).alias(f"c{i}")
                          for i, c in enumerate(names)])
    kind = columns.schema["c0"].dataType.simpleString()
    kept = stored(columns.mapInArrow(_summaries(len(names), top, COUNTERS),
                                     f"i int, v {kind}, n long"), "summaries")
    heavy = _first(kept.filter("n > 0").groupBy("i", "v").agg(F.sum("n").alias("n")), COUNTERS)
    order = W.partitionBy("i").orderBy("v")
    low = (kept.filter("n = 0").select("i", "v").distinct()
           .withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= top))
    return heavy.select("i", "v").unionByName(low.select("i", "v")).distinct()


def open_buckets(counts: DataFrame, top: int) -> DataFrame:
    """(i, bucket) that may hold one of the ``top`` values, from the counts of step 2.

    ``counts`` has (i, v, bucket, n): candidates with their value, other rows with their bucket.
    The smallest values of a column are candidates, so a value of a single row never takes the
    place of a candidate of a single row.
    """
    known = counts.filter("bucket is null")
    last = (_first(known, top).groupBy("i").agg(F.max("__rn").alias("listed"), F.min("n").alias("n"))
            .select(F.col("i").alias("__i"),
                    F.when(F.col("listed") == top, F.col("n")).otherwise(0).alias("least")))
    # A row for each column on the right side.
    return (counts.filter("bucket is not null")
            .join(F.broadcast(last), F.expr("i = __i"), "left")
            .withColumn("least", F.coalesce("least", F.lit(0)))
            .filter("n > least or (least > 1 and n = least)").select("i", "bucket"))


def _from_summaries(df: DataFrame, names: Sequence[str], top: int, cast: str | None
                    ) -> DataFrame:
    """(i, v, n) of the ``top`` values, by the three steps."""
    wanted = stored(_candidates(df, names, top, cast), "candidates")
    # At most COUNTERS + top rows a column.
    mark = wanted.select("i", "v", F.lit(True).alias("known"))
    if len(names) * (COUNTERS + top) <= BROADCAST_ROWS:
        mark = F.broadcast(mark)
    bucket = F.pmod(F.xxhash64("v"), F.lit(BUCKETS))
    marked = (_cells(df, names, cast).join(mark, ["i", "v"], "left")
              .select("i", F.when(F.col("known"), F.col("v")).alias("w"),
                      F.when(F.col("known").isNull(), bucket).alias("bucket"), "v"))
    counts = stored(marked.groupBy("i", F.col("w").alias("v"), "bucket")
                    .agg(F.count(F.lit(1)).alias("n")), "counts")
    known = counts.filter("bucket is null").select("i", "v", "n")
    rest = stored(open_buckets(counts, top), "open")
    n_open = rest.count()
    if not n_open:
        return _first(known, top)
    rest = rest.select("i", F.col("bucket").alias("b"))
    again = (marked.filter("w is null").select("i", "v", F.col("bucket").alias("b"))
             .join(F.broadcast(rest) if n_open <= BROADCAST_ROWS else rest, ["i", "b"],
                   "left_semi")
             .groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
    return _first(known.unionByName(again), top)


def top_values(df: DataFrame, columns: Sequence[str], top: int, cast: str | None = None,
               few_values: int | None = None) -> DataFrame:
    """(i, v, n, place): the ``top`` most frequent values of columns of one type, smaller ones
    first on ties; ``i`` is the column's place in ``columns``. Nulls are not counted.

    Columns of about ``few_values`` values at most (``FEW_VALUES``) are counted directly."""
    names = list(columns)
    few_values = FEW_VALUES if few_values is None else few_values
    about = df.agg(*[F.approx_count_distinct(col(c)).alias(f"d{i}")
                     for i, c in enumerate(names)]).first()
    parts = []
    for many in (False, True):
        mine = [i for i in range(len(names)) if (about[i] > few_values) == many]
        if not mine:
            continue
        chosen = [names[i] for i in mine]
        found = (_from_summaries(df, chosen, top, cast) if many else
                 _first(_cells(df, chosen, cast).groupBy("i", "v")
                        .agg(F.count(F.lit(1)).alias("n")), top))
        place = F.array(*[F.lit(i) for i in mine])
        parts.append(found.select(F.element_at(place, F.col("i") + 1).alias("i"), "v", "n",
                                  F.col("__rn").alias("place")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
