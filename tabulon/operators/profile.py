"""Profiling and exploratory aggregations. Every report is one or two scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.expr import col, correlation, sample_kurtosis, sample_skewness
from tabulon.operators.common import (
    join_small, melt, numeric_columns, rows_from_aggregate)
from tabulon.operators.frequent import top_values
from tabulon.operators.quantiles import column_quantiles, group_quantiles
from tabulon.session import BROADCAST_ROWS

#: Columns whose pairs are correlated by one scan.
PAIR_COLUMNS = 700
#: Up to so many columns their pairs are one aggregate.
FEW_COLUMNS = 12
#: Tasks that merge the sums of all others before the last one.
_MERGERS = 16


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, null_count, null_pct), all columns in one scan."""
    names = list(columns or df.columns)
    types = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    return rows_from_aggregate(wide, [
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"n{i}").alias("null_count"),
                 F.try_divide(F.col(f"n{i}") * 100.0, F.col("__rows")).alias("null_pct"))
        for i, c in enumerate(names)])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(total_rows, duplicate_rows): rows beyond the first of each group of equals.

    Rows are first counted by a hash, so that the shuffle carries a few bytes per row.
    Only rows sharing a hash are then grouped by their columns, which also tells rows
    apart whose hashes merely collide.
    """
    columns = [col(c) for c in df.columns]
    hashed = df.groupBy(F.xxhash64(*columns).alias("__h")).agg(F.count(F.lit(1)).alias("__n"))
    total, repeated = hashed.agg(
        F.coalesce(F.sum("__n"), F.lit(0)),
        F.coalesce(F.sum((F.col("__n") > 1).cast("bigint")), F.lit(0))).first()
    if not repeated:
        return df.sparkSession.createDataFrame(
            [(total, 0)], "total_rows bigint, duplicate_rows bigint")
    again = hashed.filter("__n > 1").select("__h")
    candidates = df.withColumn("__h", F.xxhash64(*columns)).join(
        F.broadcast(again) if repeated <= BROADCAST_ROWS else again, "__h", "left_semi")
    groups = candidates.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.lit(total).cast("bigint").alias("total_rows"),
                      F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def table_info(df: DataFrame) -> DataFrame:
    """The null profile with the table's row, column and duplicate counts on each row."""
    found = duplicate_rows(df).first()
    return (null_profile(df)
            .withColumn("total_rows", F.lit(found["total_rows"]).cast("bigint"))
            .withColumn("total_columns", F.lit(len(df.columns)).cast("bigint"))
            .withColumn("duplicate_rows", F.lit(found["duplicate_rows"]).cast("bigint")))


def quality_report(df: DataFrame, top: int = 10) -> DataFrame:
    """Columns with nulls, most nulls first."""
    return (null_profile(df).filter("null_count > 0")
            .orderBy(F.desc("null_count"), "column").limit(top))


def dtype_counts(df: DataFrame) -> DataFrame:
    """(dtype, columns) from the schema."""
    seen: dict[str, int] = {}
    for _, t in df.dtypes:
        seen[t] = seen.get(t, 0) + 1
    return df.sparkSession.createDataFrame(sorted(seen.items()), "dtype string, columns bigint")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    approximate: bool = False) -> DataFrame:
    """(column, distinct_count), nulls not counted.

    Exact counts group (column, value) pairs, so no task sees a whole column.
    """
    names = list(columns or df.columns)
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(col(c)).alias(f"n{i}")
                        for i, c in enumerate(names)])
        return rows_from_aggregate(wide, [
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("distinct_count"))
            for i, c in enumerate(names)])
    values = melt(df, names, cast="string").groupBy("column", "value").agg(F.lit(1))
    return values.groupBy("column").agg(F.count("value").alias("distinct_count"))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max, corrected skewness and kurtosis."""
    names = list(columns or numeric_columns(df))
    quartiles = column_quantiles(df, names, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(names):
        x = col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"a{i}"),
                 F.max(x).alias(f"b{i}"), sample_skewness(x).alias(f"w{i}"),
                 sample_kurtosis(x).alias(f"k{i}")]
    return rows_from_aggregate(df.agg(*aggs), [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                 F.col(f"a{i}").alias("min"),
                 *[F.lit(v).cast("double").alias(q)
                   for q, v in zip(("q25", "median", "q75"), quartiles[c])],
                 F.col(f"b{i}").alias("max"), F.col(f"w{i}").alias("skewness"),
                 F.col(f"k{i}").alias("kurtosis"))
        for i, c in enumerate(names)])


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max of one column."""
    return numeric_summary(df, [column]).drop("skewness", "kurtosis")


def value_counts(df: DataFrame, columns: str | Sequence[str], top: int | None = None,
                 few_values: int | None = None) -> DataFrame:
    """(column, value, count), nulls excluded; the ``top`` most frequent of each column."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if top is None:
        return (melt(df, names, cast="string").filter(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    return _named(top_values(df, names, top, "string", few_values), names).drop("place")


def _named(tops: DataFrame, names: Sequence[str]) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1)
    return tops.select(name.alias("column"), F.col("v").alias("value"),
                       F.col("n").alias("count"), "place")


def categorical_summary(df: DataFrame, columns: str | Sequence[str], top_n: int = 10
                        ) -> DataFrame:
    """(column, total_unique, most_frequent, most_frequent_count, top_categories)."""
    names = [columns] if isinstance(columns, str) else list(columns)
    unique = distinct_counts(df, names).select(
        "column", F.col("distinct_count").alias("total_unique"))
    best = (_named(top_values(df, names, top_n, "string"), names)
            .groupBy("column").agg(F.array_sort(F.collect_list(
                F.struct("place", "value", "count"))).alias("top")))
    top = F.transform("top", lambda t: F.struct(t["value"].alias("value"),
                                                t["count"].alias("count")))
    return unique.join(best, "column").select(
        "column", "total_unique", F.col("top")[0]["value"].alias("most_frequent"),
        F.col("top")[0]["count"].alias("most_frequent_count"), top.alias("top_categories"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct (column, value) pairs without nulls."""
    return (melt(df, columns, cast="string").filter(F.col("value").isNotNull())
            .distinct().orderBy("column", "value"))


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None
                        ) -> DataFrame:
    """(column, correlation) with the target, strongest first; undefined ones dropped."""
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    wide = df.agg(*[correlation(col(c).cast("double"), col(target).cast("double")).alias(f"r{i}")
                    for i, c in enumerate(names)])
    out = rows_from_aggregate(wide, [
        F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("correlation"))
        for i, c in enumerate(names)])
    r = F.col("correlation")
    return out.filter(r.isNotNull() & ~F.isnan(r)).orderBy(F.desc(F.abs(r)), "column")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation) for every ordered pair, diagonal included.

    Each pair uses the rows that have both values (NaN counts as missing). All pairs come from
    one scan, in which tasks multiply the values, squares and masks of their rows; more than
    ``PAIR_COLUMNS`` columns take a scan for each pair of blocks of that many.
    """
    names = list(columns or numeric_columns(df))
    if len(names) <= FEW_COLUMNS:
        return _few_correlations(df, names)
    blocks = [names[at:at + PAIR_COLUMNS] for at in range(0, len(names), PAIR_COLUMNS)]
    out = None
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            found = _pair_correlations(df, a, b)
            if b is not a:
                found = found.unionByName(found.select(
                    F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"),
                    "correlation"))
            out = found if out is None else out.unionByName(found)
    return out


def _few_correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same for so few columns that one aggregate holds their pairs."""
    x = {c: F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    wide = df.agg(*[correlation(x[a], x[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return rows_from_aggregate(wide, [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.col(f"r{i}").alias("correlation"))
        for i, pair in enumerate(pairs) for a, b in sorted({pair, pair[::-1]})])


def _centred_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per pair of a column of ``x`` and one of ``y``, over the rows that have both: count, means,
    squared deviations and their product. NaN is a missing value."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    # Shifting by a value of the column keeps the sums free of cancellation.
    sx, sy = (np.nan_to_num(np.nanmedian(np.where(m.any(0), z, 0.0), axis=0))
              for z, m in ((x, mx), (y, my)))
    x, y = np.where(mx, x - sx, 0.0), np.where(my, y - sy, 0.0)
    mx, my = mx.astype(float), my.astype(float)
    n, ax, ay = mx.T @ my, x.T @ my, mx.T @ y
    qx, qy, p = (x * x).T @ my, mx.T @ (y * y), x.T @ y
    some = np.maximum(n, 1)
    cx, cy = qx - ax * ax / some, qy - ay * ay / some
    # What rounding leaves of a constant is none.
    least = 4.5e-16 * (n + 16)
    cx, cy = np.where(cx <= least * qx, 0.0, cx), np.where(cy <= least * qy, 0.0, cy)
    return np.stack([n, ax / some + sx[:, None], ay / some + sy, cx, cy, p - ax * ay / some])


def _merge_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    dx, dy = np.where(weight > 0, dx, 0.0), np.where(weight > 0, dy, 0.0)
    first = a[0] == 0
    return np.stack([n, np.where(first, b[1], a[1] + dx * share),
                     np.where(first, b[2], a[2] + dy * share),
                     a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight,
                     a[5] + b[5] + dx * dy * weight])


def _pair_correlations(df: DataFrame, a: Sequence[str], b: Sequence[str]) -> DataFrame:
    """(column_a, column_b, correlation) of every column of ``a`` with every one of ``b``."""
    names = list(a) if a is b else [*a, *b]
    shape = (6, len(a), len(b))

    def state(part: int, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary())],
            names=["part", "sums"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float)
                                 for c in batch.columns])
            sums = _centred_products(z[:, :len(a)], z[:, -len(b):])
            held = sums if held is None else _merge_products(held, sums)
        if held is not None:
            yield state(TaskContext.get().partitionId(), held)

    def merged(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        held = None
        for batch in batches:
            for v in batch.column("sums").drop_null():
                sums = np.frombuffer(v.as_buffer(), float).reshape(shape)
                held = sums if held is None else _merge_products(held, sums)
        return held

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = merged(batches)
        if held is not None:
            yield state(TaskContext.get().partitionId(), held)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = merged(batches)
        sums = np.zeros(shape) if held is None else held
        # Means of a constant differ between tasks in their last bits.
        cx, cy = (np.where(c <= sums[0] * (1e-14 * m) ** 2, 0.0, c)
                  for c, m in ((sums[3], sums[1]), (sums[4], sums[2])))
        spread = np.sqrt(cx) * np.sqrt(cy)
        r = np.divide(sums[5], spread, out=np.full(shape[1:], np.nan), where=spread > 0)
        for x, row in zip(a, r):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(b)), pa.array(list(b)),
                 pa.array(row, pa.float64(), from_pandas=True)],
                names=["column_a", "column_b", "correlation"])

    sums = "part int, sums binary"
    # The last task has a row to run on where the table has none.
    start = df.sparkSession.range(1).selectExpr("-1 as part", "cast(null as binary) as sums")
    return (df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
            .mapInArrow(multiply, sums)
            .repartition(_MERGERS, "part").sortWithinPartitions("part").mapInArrow(merge, sums)
            .unionByName(start).repartition(1).sortWithinPartitions("part")
            .mapInArrow(finish, "column_a string, column_b string, correlation double"))


def dataset_card(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns and the target's mean, std, min and max in one row."""
    t = col(target).cast("double")
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
                  F.avg(t).alias("target_mean"), F.stddev_samp(t).alias("target_std"),
                  F.min(t).alias("target_min"), F.max(t).alias("target_max"))


def histogram(df: DataFrame, value: str, bins: int = 40, by: Sequence[str] = ()) -> DataFrame:
    """(by..., bin, bin_start, bin_end, count): equal bins from min to max.

    The last bin is closed, empty bins are kept, and a constant column gets a
    range of one around its value.
    """
    v = col(value).cast("double")
    keys = [col(b) for b in by]
    slim = df.filter(v.isNotNull()).select(*keys, v.alias("__v"))
    span = slim.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    flat = F.col("__lo") == F.col("__hi")
    span = (span.filter(F.col("__lo").isNotNull())
            .withColumn("__start", F.when(flat, F.col("__lo") - 0.5).otherwise(F.col("__lo")))
            .withColumn("__end", F.when(flat, F.col("__hi") + 0.5).otherwise(F.col("__hi")))
            .withColumn("__w", (F.col("__end") - F.col("__start")) / bins)
            .drop("__lo", "__hi"))
    if by:
        placed = join_small(slim, span, list(by))
    else:                                            # one row of fitted limits
        limits = span.first()
        if limits is None:
            raise ValueError(f"{value} has no values")
        placed = slim.select("__v", *[F.lit(limits[c]).alias(c)
                                      for c in ("__start", "__end", "__w")])
        span = df.sparkSession.createDataFrame([tuple(limits)], span.schema)
    slot = F.least(F.floor((F.col("__v") - F.col("__start")) / F.col("__w")),
                   F.lit(bins - 1)).cast("int")
    counts = placed.withColumn("bin", slot).groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("count"))
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    # At most ``bins`` rows per group on both sides.
    joined = join_small(grid, counts, list(by) + ["bin"])
    return joined.select(
        *keys, "bin", (F.col("__start") + F.col("bin") * F.col("__w")).alias("bin_start"),
        (F.col("__start") + (F.col("bin") + 1) * F.col("__w")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_stats(df: DataFrame, by: Sequence[str], value: str, whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, extremes, whiskers and outlier count."""
    v = col(value).cast("double")
    quartiles = group_quantiles(df, by, value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    reach = whisker * (F.col("q75") - F.col("q25"))
    fences = (quartiles.withColumn("__low", F.col("q25") - reach)
              .withColumn("__high", F.col("q75") + reach))
    slim = df.filter(v.isNotNull()).select(*[col(b) for b in by], v.alias("__v"))
    inside = F.col("__v").between(F.col("__low"), F.col("__high"))
    return (join_small(slim, fences, list(by))
            .groupBy(*[col(b) for b in by])
            .agg(F.count(F.lit(1)).alias("count"), F.min("__v").alias("min"),
                 F.first("q25").alias("q25"), F.first("median").alias("median"),
                 F.first("q75").alias("q75"), F.max("__v").alias("max"),
                 F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
                 F.count_if(~inside).alias("outliers")))
