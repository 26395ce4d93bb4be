"""Column roles, missing values, outliers, type conversion and duplicates."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.operators.common import is_numeric, numeric_columns, rows_from_aggregate
from tabulon.operators.frequent import top_values
from tabulon.operators.quantiles import column_quantiles
from tabulon.session import BROADCAST_ROWS, stored

#: Fixed value: what a missing category is called.
UNKNOWN = "DESCONOCIDO"


@dataclass(frozen=True)
class FeatureRoles:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    excluded: tuple[str, ...] = ()

    def keep(self, columns: Sequence[str]) -> FeatureRoles:
        """The roles of the columns that are still there."""
        return FeatureRoles(tuple(c for c in self.numeric if c in columns),
                            tuple(c for c in self.categorical if c in columns),
                            self.target, tuple(c for c in self.excluded if c in columns))


def identify_roles(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> FeatureRoles:
    """Numeric columns by type, everything else categorical; names match exactly."""
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    absent = [c for c in exclude if c not in df.columns]
    if absent:
        warnings.warn("excluded columns not in the table: " + ", ".join(absent), stacklevel=2)
    rest = [f for f in df.schema.fields if f.name != target and f.name not in exclude]
    return FeatureRoles(tuple(f.name for f in rest if is_numeric(f.dataType)),
                        tuple(f.name for f in rest if not is_numeric(f.dataType)),
                        target, tuple(c for c in exclude if c in df.columns))


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Share of nulls (0 to 1) per column, one scan."""
    names = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(col(c).isNull()).alias(f"c{i}") for i, c in enumerate(names)]
                 ).first()
    return {c: (row[f"c{i}"] / row["n"] if row["n"] else 0.0) for i, c in enumerate(names)}


def sparse_columns(shares: Mapping[str, float], threshold: float, keep: Sequence[str] = ()
                   ) -> list[str]:
    """Columns with strictly more nulls than ``threshold``."""
    return [c for c, s in shares.items() if s > threshold and c not in keep]


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(col(target).isNotNull())


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()
                        ) -> DataFrame:
    return df.drop(*sparse_columns(null_shares(df), threshold, keep))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows without a null in any column."""
    return df.na.drop("any")


def keep_filled_columns(df: DataFrame, min_share: float = 0.3) -> DataFrame:
    """Columns with at least ``min_share`` non-null values."""
    shares = null_shares(df)
    return df.select(*[col(c) for c in df.columns if 1.0 - shares[c] >= min_share])


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent value per column, the smallest on ties; None without values.

    See ``frequent``: neither a frequent value nor a column of distinct ones gathers in a task.
    """
    out: dict[str, Any] = {c: None for c in columns}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in by_type.values():
        for row in top_values(df, names, 1).collect():       # one row per column
            out[names[row["i"]]] = row["v"]
    return out


@dataclass(frozen=True)
class Imputer:
    """Fill values fitted on one table and applied to others."""

    values: Mapping[str, Any]

    def apply(self, df: DataFrame) -> DataFrame:
        def filled(c: str) -> Column:
            if self.values.get(c) is None:
                return col(c)
            kind = df.schema[c].dataType
            # A fractional fill value turns a whole-number column into double.
            if isinstance(kind, T.IntegralType) and float(self.values[c]) % 1:
                kind = T.DoubleType()
            return F.coalesce(col(c).cast(kind), F.lit(self.values[c]).cast(kind)).alias(c)

        return df.select(*[filled(c) for c in df.columns])


def fit_imputer(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                numeric_strategy: str = "median", categorical_strategy: str = "mode",
                constant: str = UNKNOWN) -> Imputer:
    """Mean, median or mode for numbers; mode or a constant for categories."""
    values: dict[str, Any] = {}
    numeric, categorical = list(numeric), list(categorical)
    if numeric_strategy not in ("mean", "median", "mode"):
        raise ValueError(f"unknown numeric strategy {numeric_strategy}")
    if categorical_strategy not in ("mode", "constant"):
        raise ValueError(f"unknown categorical strategy {categorical_strategy}")
    if numeric and numeric_strategy == "mean":
        row = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(numeric)]).first()
        values.update({c: row[i] for i, c in enumerate(numeric)})
    elif numeric and numeric_strategy == "median":
        values.update({c: v[0] for c, v in column_quantiles(df, numeric, [0.5]).items()})
    elif numeric:
        values.update(column_modes(df, numeric))
    if categorical and categorical_strategy == "mode":
        modes = column_modes(df, categorical)
        values.update({c: constant if modes[c] is None else modes[c] for c in categorical})
    else:
        values.update({c: constant for c in categorical})
    return Imputer(values)


def handle_missing(df: DataFrame, roles: FeatureRoles, strategy: str = "drop",
                   threshold: float = 0.5, numeric_strategy: str = "median",
                   categorical_strategy: str = "mode") -> DataFrame:
    """``drop``: sparse columns, then rows with any null. ``impute``: fill role columns.
    ``smart``: drop sparse columns, then median and mode. Null targets always go.

    Null shares are measured before rows are dropped. Without nulls nothing changes.
    """
    if strategy not in ("drop", "impute", "smart"):
        raise ValueError(f"unknown strategy {strategy}")
    shares = null_shares(df)
    if not any(shares.values()):
        return df
    out = drop_null_target(df, roles.target) if shares[roles.target] else df
    if strategy in ("drop", "smart"):
        out = out.drop(*sparse_columns(shares, threshold, [roles.target]))
    if strategy == "drop":
        return drop_null_rows(out)
    left = roles.keep(out.columns)
    with_nulls = {c for c, s in shares.items() if s}
    if strategy == "smart":
        numeric_strategy, categorical_strategy = "median", "mode"
    return fit_imputer(out, [c for c in left.numeric if c in with_nulls],
                       [c for c in left.categorical if c in with_nulls],
                       numeric_strategy, categorical_strategy).apply(out)


@dataclass(frozen=True)
class OutlierBounds:
    """Values outside [low, high] are outliers; None means no bound could be fitted."""

    limits: Mapping[str, tuple[float | None, float | None]]

    def outlier(self, column: str) -> Column:
        low, high = self.limits[column]
        if low is None or high is None:
            return F.lit(False)
        x = col(column).cast("double")
        return F.coalesce((x < F.lit(low)) | (x > F.lit(high)), F.lit(False))

    def any_outlier(self) -> Column:
        out = F.lit(False)
        for c in self.limits:
            out = out | self.outlier(c)
        return out

    def remove(self, df: DataFrame) -> DataFrame:
        """Rows without an outlier in any column: a narrow filter."""
        return df.filter(~self.any_outlier())

    def counts(self, df: DataFrame) -> DataFrame:
        """(column, outliers, outlier_pct), columns without outliers left out."""
        names = list(self.limits)
        wide = df.agg(F.count(F.lit(1)).alias("__n"),
                      *[F.count_if(self.outlier(c)).alias(f"n{i}")
                        for i, c in enumerate(names)])
        return rows_from_aggregate(wide, [
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("outliers"),
                     F.try_divide(F.col(f"n{i}") * 100.0, F.col("__n")).alias("outlier_pct"))
            for i, c in enumerate(names)]).filter("outliers > 0")


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> OutlierBounds:
    """Quartiles of all columns from the same input."""
    limits = {}
    for c, (q1, q3) in column_quantiles(df, columns, [0.25, 0.75]).items():
        limits[c] = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return OutlierBounds(limits)


@dataclass(frozen=True)
class ZScoreBounds(OutlierBounds):
    """``limits`` holds mean and sample std; outliers are more than ``k`` stds away."""

    k: float = 3.0

    def outlier(self, column: str) -> Column:
        mean, std = self.limits[column]
        if mean is None or not std:
            return F.lit(False)
        z = F.abs((col(column).cast("double") - F.lit(mean)) / F.lit(std))
        return F.coalesce(z > F.lit(self.k), F.lit(False))


def zscore_bounds(df: DataFrame, columns: Sequence[str], k: float = 3.0) -> ZScoreBounds:
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return ZScoreBounds({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}, k)


def remove_outliers(df: DataFrame, columns: Sequence[str], method: str = "iqr",
                    threshold: float = 1.5, target: str | None = None) -> DataFrame:
    names = [c for c in columns if c != target and c in df.columns]
    if not names:
        return df
    if method == "iqr":
        return iqr_bounds(df, names, threshold).remove(df)
    if method == "zscore":
        return zscore_bounds(df, names, threshold).remove(df)
    raise ValueError(f"unknown method {method}")


def convert_types(df: DataFrame, roles: FeatureRoles) -> DataFrame:
    """Numeric-role texts to double (null where no number), categories to string."""
    def converted(f: T.StructField) -> Column:
        if f.name in roles.numeric and not is_numeric(f.dataType):
            return col(f.name).try_cast("double").alias(f.name)
        if f.name in roles.categorical:
            return col(f.name).cast("string").alias(f.name)
        return col(f.name)

    return df.select(*[converted(f) for f in df.schema.fields])


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows, nulls equal.

    Hashes of the rows are counted first. Rows whose hash occurs once stay where they are;
    only the others are brought together and compared by value.
    """
    hashed = df.withColumn("__h", F.xxhash64(*[col(c) for c in df.columns]))
    again = (hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("__n"))
             .filter("__n > 1").select("__h"))
    rows = again.limit(BROADCAST_ROWS + 1).toArrow()
    if not rows.num_rows:
        return df
    small = (F.broadcast(df.sparkSession.createDataFrame(rows))
             if rows.num_rows <= BROADCAST_ROWS else stored(again, "repeated"))
    return (hashed.join(small, "__h", "left_anti").drop("__h").unionByName(
        hashed.join(small, "__h", "left_semi").drop("__h").dropDuplicates()))


def numeric_matrix(df: DataFrame, target: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Numeric columns only, nulls filled with the median (fitted on ``fit_on``)."""
    names = numeric_columns(df, [target])
    imputer = fit_imputer(fit_on if fit_on is not None else df, names)
    return imputer.apply(df.select(*[col(c) for c in names], col(target)))


def feature_columns(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Without the target and excluded columns; absent names are ignored."""
    return df.drop(target, *exclude)


class ProcessingLog:
    """Steps with the size of the table after each, and the before/after report.

    ``watch`` counts a step's rows while a later job reads them, so no job is run to count;
    the log can be read once such a job has ended.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, str, int | Observation, int]] = []

    def add(self, action: str, details: str, df: DataFrame, rows: int | None = None) -> int:
        """A step whose rows are known, or are counted now."""
        n = df.count() if rows is None else rows
        self._steps.append((action, details, n, len(df.columns)))
        return n

    def watch(self, action: str, details: str, df: DataFrame) -> DataFrame:
        """``df``, whose rows are counted by the first job that reads all of the table given
        back."""
        seen = Observation()
        self._steps.append((action, details, seen, len(df.columns)))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def same_rows(self, action: str, details: str, df: DataFrame) -> None:
        """A step that leaves the rows of the one before."""
        self._steps.append((action, details, self._steps[-1][2], len(df.columns)))

    @property
    def steps(self) -> list[tuple[int, str, str, int, int]]:
        """(step, action, details, rows, columns) of each step."""
        return [(i + 1, a, d, n.get["rows"] if isinstance(n, Observation) else n, c)
                for i, (a, d, n, c) in enumerate(self._steps)]

    def table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(
            self.steps, "step int, action string, details string, rows bigint, columns int")

    def report(self) -> dict[str, Any]:
        first, last = self.steps[0], self.steps[-1]
        lost = first[3] - last[3]
        return {"initial_shape": [first[3], first[4]], "final_shape": [last[3], last[4]],
                "rows_lost": lost, "rows_lost_pct": 100.0 * lost / first[3] if first[3] else 0.0,
                "cols_lost": first[4] - last[4], "processing_steps": len(self.steps),
                "processing_log": [{"action": a, "details": d, "shape": [r, c]}
                                   for _, a, d, r, c in self.steps]}
