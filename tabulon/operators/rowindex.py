"""Global row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expr import as_column, col
from tabulon.operators.common import join_small
from tabulon.session import stored


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index",
                   ) -> DataFrame:
    """Add 0, 1, 2, ... in the order of ``order``.

    Rows are range-partitioned and sorted within partitions; the partition sizes
    give the offsets. The sorted rows are written to the shared folder in between,
    because the numbers must not change if a task is run again. A random last key
    spreads rows that tie on ``order`` over several partitions.
    """
    keys = [as_column(o) for o in order]
    spread = df.withColumn("__tie", F.rand(17))
    placed = (spread.repartitionByRange(*keys, F.col("__tie"))
              .sortWithinPartitions(*keys, F.col("__tie"))
              .withColumn("__part", F.spark_partition_id())
              .withColumn("__at", F.monotonically_increasing_id()
                          .bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("__tie"))
    placed = stored(placed, "row-index")
    sizes = sorted((r["__part"], r["n"]) for r in
                   placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    # One row per partition, as many as spark.sql.shuffle.partitions.
    table = df.sparkSession.createDataFrame(offsets, "__part int, __offset bigint")
    return (join_small(placed, table, ["__part"])
            .withColumn(name, F.col("__offset") + F.col("__at"))
            .drop("__part", "__at", "__offset"))


def with_group_rank(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                    rank: str, size: str) -> DataFrame:
    """Add the 0-based rank within each group and the group's size.

    A group may be spread over many partitions, so a hot group costs no more.
    """
    indexed = with_row_index(df, [col(b) for b in by] + list(order), "__i")
    groups = indexed.groupBy(*[col(b) for b in by]).agg(
        F.min("__i").alias("__start"), F.count(F.lit(1)).alias(size))
    return (join_small(indexed, groups, by)
            .withColumn(rank, F.col("__i") - F.col("__start"))
            .drop("__i", "__start"))
