"""Evaluation of predictions: one grouped aggregation over a large predictions table.

Every function takes the label and prediction column and ``by`` columns (model,
split, segment); residual is label minus prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expr import band, col, correlation, normal_ppf
from tabulon.operators.common import join_small
from tabulon.operators.profile import histogram
from tabulon.operators.quantiles import column_quantiles, group_quantiles
from tabulon.operators.rowindex import with_group_rank, with_row_index

#: Bins of the absolute error, closed on the right; 0 is in none.
ERROR_EDGES = (0.0, 0.5, 1.0, 1.5, 2.0, float("inf"))
ERROR_LABELS = ("< 0.5", "0.5-1.0", "1.0-1.5", "1.5-2.0", "> 2.0")
#: Tolerances counted in the evaluation report.
TOLERANCES = (0.5, 1.0, 1.5, 2.0)


def _residual(y: str, y_pred: str) -> Column:
    return col(y).cast("double") - col(y_pred).cast("double")


def _keys(by: Sequence[str]) -> list[Column]:
    return [col(b) for b in by]


def metrics(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: Sequence[str] = ()
            ) -> DataFrame:
    """(by..., n, rmse, mae, r2, mape, mse, max_error, mean_residual, std_residual).

    MAPE is in percent over the rows with a label other than 0.
    """
    label, e = col(y).cast("double"), _residual(y, y_pred)
    share = F.when(label != 0, F.abs(F.try_divide(e, label)))
    out = df.groupBy(*_keys(by)).agg(
        F.count(e).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.var_pop(label).alias("__v"), (F.avg(share) * 100).alias("mape"),
        F.max(F.abs(e)).alias("max_error"), F.avg(e).alias("mean_residual"),
        F.stddev_pop(e).alias("std_residual"))
    constant = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("__v") == 0, constant).otherwise(1.0 - F.col("mse") / F.col("__v"))
    return out.select(*_keys(by), "n", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"),
                      "mape", "mse", "max_error", "mean_residual", "std_residual")


def _with_quantiles(df: DataFrame, by: Sequence[str], value: str, aggregated: DataFrame,
                    probs: dict[str, float]) -> DataFrame:
    if by:
        return join_small(aggregated, group_quantiles(df, by, value, probs), list(by))
    found = column_quantiles(df, [value], list(probs.values()))[value]
    return aggregated.select("*", *[F.lit(v).cast("double").alias(n)
                                    for n, v in zip(probs, found)])


def residual_stats(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                   by: Sequence[str] = ()) -> DataFrame:
    """(by..., mean, std, min, max, median, q25, q75) of the residuals, population std."""
    slim = df.select(*_keys(by), _residual(y, y_pred).alias("__e"))
    out = slim.groupBy(*_keys(by)).agg(
        F.avg("__e").alias("mean"), F.stddev_pop("__e").alias("std"),
        F.min("__e").alias("min"), F.max("__e").alias("max"))
    return _with_quantiles(slim, by, "__e", out, {"median": 0.5, "q25": 0.25, "q75": 0.75})


def value_stats(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: Sequence[str] = ()
                ) -> DataFrame:
    """Min, max, mean and std of predictions (population std) and labels (sample std)."""
    p, t = col(y_pred).cast("double"), col(y).cast("double")
    return df.groupBy(*_keys(by)).agg(
        F.min(p).alias("pred_min"), F.max(p).alias("pred_max"), F.avg(p).alias("pred_mean"),
        F.stddev_pop(p).alias("pred_std"), F.min(t).alias("actual_min"),
        F.max(t).alias("actual_max"), F.avg(t).alias("actual_mean"),
        F.stddev_samp(t).alias("actual_std"))


def tolerance_name(t: float) -> str:
    return "within_" + str(float(t)).replace(".", "_")


def within_tolerance(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                     by: Sequence[str] = (), tolerances: Sequence[float] = TOLERANCES
                     ) -> DataFrame:
    e = F.abs(_residual(y, y_pred))
    return df.groupBy(*_keys(by)).agg(*[
        F.count_if(e <= t).alias(tolerance_name(t)) for t in tolerances])


def residual_histogram(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                       by: Sequence[str] = (), bins: int = 40) -> DataFrame:
    slim = df.select(*_keys(by), _residual(y, y_pred).alias("residual"))
    return histogram(slim, "residual", bins, by)


def error_bins(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: Sequence[str] = ()
               ) -> DataFrame:
    """(by..., bin, label, count, pct): share of all rows; empty bins are kept."""
    e = F.abs(_residual(y, y_pred))
    counts = df.groupBy(*_keys(by)).agg(
        F.count(e).alias("__n"),
        *[F.count_if((e > low) & (e <= high)).alias(f"c{i}")
          for i, (low, high) in enumerate(zip(ERROR_EDGES, ERROR_EDGES[1:]))])
    cells = F.array(*[F.struct(
        F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"c{i}").alias("count"),
        F.try_divide(F.col(f"c{i}") * 100.0, F.col("__n")).alias("pct"))
        for i, label in enumerate(ERROR_LABELS)])
    return counts.select(*_keys(by), F.explode(cells).alias("__s")).select(*_keys(by), "__s.*")


def qq_points(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: Sequence[str] = ()
              ) -> DataFrame:
    """(by..., theoretical, ordered): normal quantiles against sorted residuals.

    Positions follow Filliben: (i - 0.3175) / (n + 0.365), and 0.5^(1/n) at the ends.
    """
    slim = df.select(*_keys(by), _residual(y, y_pred).alias("ordered"))
    slim = slim.filter(F.col("ordered").isNotNull())
    if by:
        ranked = with_group_rank(slim, by, ["ordered"], "__r", "__n")
    else:
        ranked = with_row_index(slim, ["ordered"], "__r")
        ranked = ranked.withColumn("__n", F.lit(ranked.agg(F.max("__r") + 1).first()[0]))
    i, n = F.col("__r") + 1, F.col("__n").cast("double")
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    p = (F.when(i == F.col("__n"), last).when(i == 1, F.lit(1.0) - last)
         .otherwise((i - F.lit(0.3175)) / (n + F.lit(0.365))))
    return (ranked.withColumn("__p", p)
            .select(*_keys(by), normal_ppf(F.col("__p")).alias("theoretical"), "ordered"))


def qq_line(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: Sequence[str] = ()
            ) -> DataFrame:
    """(by..., slope, intercept, r) of the line through the Q-Q points."""
    return qq_points(df, y, y_pred, by).groupBy(*_keys(by)).agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        correlation(F.col("theoretical"), F.col("ordered")).alias("r"))


def prediction_points(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                      keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., y, y_pred, residual, within_1): the plotted point set."""
    e = _residual(y, y_pred)
    return df.select(*_keys(keep), col(y).alias("y"), col(y_pred).alias("y_pred"),
                     e.alias("residual"), (F.abs(e) <= 1.0).alias("within_1"))


def prediction_range(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                     by: Sequence[str] = ()) -> DataFrame:
    """(by..., low, high, within_1): the identity line's ends and the +-1 band."""
    return df.groupBy(*_keys(by)).agg(
        F.least(F.min(col(y)), F.min(col(y_pred))).alias("low"),
        F.greatest(F.max(col(y)), F.max(col(y_pred))).alias("high"),
        F.count_if(F.abs(_residual(y, y_pred)) <= 1.0).alias("within_1"))


def fit_quality(r2: Column) -> Column:
    """Label from R^2: an edge itself belongs to the lower label."""
    return band(r2, [0.4, 0.6, 0.8], ["poor", "moderate", "good", "excellent"],
                right_closed=True)


def overfit_label(gap: Column) -> Column:
    """Label from validation minus training RMSE at the largest size."""
    return band(gap, [0.3, 0.5], ["balanced", "slight overfitting",
                                  "significant overfitting"])


def curve_diagnosis(curve: DataFrame) -> DataFrame:
    """(gap, diagnosis) of a learning curve."""
    last = curve.agg(F.max_by(F.struct("train_rmse", "val_rmse"), "step").alias("s"))
    return (last.select((F.col("s.val_rmse") - F.col("s.train_rmse")).alias("gap"))
            .withColumn("diagnosis", overfit_label(F.col("gap"))))


def evaluation_report(df: DataFrame, y: str = "y", y_pred: str = "y_pred",
                      by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per group: structs of metrics, residual, prediction, label and
    tolerance statistics, ready for a JSON sink."""
    by = list(by)
    m = metrics(df, y, y_pred, by)
    out = m.select(*_keys(by), F.col("n").alias("n_samples"), F.struct(
        "rmse", "mae", "r2", "mape", "mse", "max_error", "mean_residual", "std_residual"
    ).alias("metrics"))

    def packed(t: DataFrame, name: str) -> DataFrame:
        rest = [c for c in t.columns if c not in by]
        return t.select(*_keys(by), F.struct(*rest).alias(name))

    for table, name in ((residual_stats(df, y, y_pred, by), "residuals_stats"),
                        (value_stats(df, y, y_pred, by), "value_stats"),
                        (within_tolerance(df, y, y_pred, by), "error_distribution")):
        out = join_small(out, packed(table, name), by)
    return out
