"""Checks on tables and rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.operators.common import is_numeric, rows_from_aggregate


@dataclass(frozen=True)
class TableCheck:
    ok: bool
    problems: tuple[str, ...]


def check_table(df: DataFrame, required: Sequence[str] = (), min_rows: int = 0) -> TableCheck:
    """Not empty, enough rows, required columns present. Reads no more rows than needed."""
    problems = []
    need = max(min_rows, 1)
    seen = df.limit(need).count()
    if seen == 0:
        problems.append("table is empty")
    elif seen < min_rows:
        problems.append(f"table has {seen} rows, needs {min_rows}")
    missing = [c for c in required if c not in df.columns]
    if missing:
        problems.append("missing columns: " + ", ".join(missing))
    return TableCheck(not problems, tuple(problems))


def model_input_nulls(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(column, null_count) of feature and label columns that contain nulls."""
    names = list(features) + [label]
    wide = df.agg(*[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    return rows_from_aggregate(wide, [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(names)]).filter("null_count > 0")


def target_range(df: DataFrame, target: str, low: float | None = None,
                 high: float | None = None) -> DataFrame:
    """(numeric, below, above, ok): values outside [low, high]."""
    numeric = is_numeric(df.schema[target].dataType)
    t = col(target).try_cast("double")
    below = F.count_if(t < low) if low is not None else F.lit(0).cast("bigint")
    above = F.count_if(t > high) if high is not None else F.lit(0).cast("bigint")
    out = df.agg(F.lit(numeric).alias("numeric"), below.alias("below"), above.alias("above"))
    return out.withColumn("ok", F.col("numeric") & (F.col("below") + F.col("above") == 0))


@dataclass(frozen=True)
class Messages:
    """The error texts, {0} {1} {2} are column names or limits."""

    missing: str = "Feature faltante: {0}"
    empty: str = "Feature vacío: {0}"
    not_numeric: str = "Feature {0} debe ser numérico"
    out_of_range: str = "{0} debe estar entre {1} y {2}"
    order: str = "{0} no puede ser mayor que {1}"


@dataclass(frozen=True)
class RowRules:
    """What a scoring request must satisfy."""

    text: Sequence[str] = ()
    numeric: Sequence[str] = ()
    ranges: Sequence[tuple[str, float, float]] = ()
    ordered: Sequence[tuple[str, str]] = ()
    messages: Messages = field(default_factory=Messages)


def row_errors(df: DataFrame, rules: RowRules, errors: str = "errors",
               valid: str = "is_valid") -> DataFrame:
    """Add the array of messages of each row and whether it is empty.

    Range and order rules are skipped where a value is missing or no number.
    """
    m = rules.messages
    checks: list[Column] = []

    def number(c: str) -> Column:
        return col(c).try_cast("double")

    for c in rules.text:
        if c not in df.columns:
            checks.append(F.lit(m.missing.format(c)))
        else:
            blank = col(c).isNull() | (col(c).cast("string") == "")
            checks.append(F.when(blank, m.empty.format(c)))
    for c in rules.numeric:
        if c not in df.columns:
            checks.append(F.lit(m.missing.format(c)))
        else:
            checks.append(F.when(col(c).isNull(), m.empty.format(c))
                          .when(number(c).isNull(), m.not_numeric.format(c)))
    for c, low, high in rules.ranges:
        if c in df.columns:
            checks.append(F.when((number(c) < low) | (number(c) > high),
                                 m.out_of_range.format(c, low, high)))
    for a, b in rules.ordered:
        if a in df.columns and b in df.columns:
            checks.append(F.when(number(a) > number(b), m.order.format(a, b)))
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn(errors, found).withColumn(valid, F.size(errors) == 0)
