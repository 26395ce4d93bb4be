"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.session import BROADCAST_ROWS, stored


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; never counts far beyond that."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def as_local(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` computed once as a local table, or None if it has more than ``limit`` rows."""
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
               limit: int = BROADCAST_ROWS, fits: bool | None = None) -> DataFrame:
    """Join on null-safe keys; broadcasts ``small`` only after checking its size.

    Above ``limit`` rows the join shuffles, and adaptive execution splits hot keys.
    ``fits`` tells the outcome where the caller has checked already.
    """
    if fits is None:
        local = as_local(small, limit)
        fits = local is not None
        small = local if fits else small
    right = small.select(*[
        col(c).alias(f"__r_{c}") if c in on else col(c) for c in small.columns])
    if fits:
        right = F.broadcast(right)
    condition = F.lit(True)
    for c in on:
        condition = condition & col(c).eqNullSafe(col(f"__r_{c}"))
    joined = big.join(right, condition, how)
    return joined.drop(*[f"__r_{c}" for c in on])


def settled(df: DataFrame, fits: bool, name: str = "stage") -> DataFrame:
    """``df`` computed once: as a local table if it ``fits``, else in the shared folder."""
    if fits:
        return df.sparkSession.createDataFrame(df.toArrow(), df.schema)
    return stored(df, name)


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if is_numeric(f.dataType) and f.name not in exclude]


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
         cast: str | None = None) -> DataFrame:
    """(by..., column, value): one row per listed column, in a single scan."""
    def value(c: str) -> Column:
        return col(c).cast(cast) if cast else col(c)

    cells = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value"))
                      for c in columns])
    return (df.select(*[col(c) for c in by], F.explode(cells).alias("__cell"))
            .select(*[col(c) for c in by], "__cell.column", "__cell.value"))


def rows_from_aggregate(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct."""
    return one_row.select(F.explode(F.array(*structs)).alias("__s")).select("__s.*")
