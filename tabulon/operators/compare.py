"""Comparison of models on a long table (model, row key, label, prediction)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.expr import band, col, correlation
from tabulon.operators.common import join_small
from tabulon.operators.evaluate import metrics

METRICS = ("rmse", "mae", "r2", "mape", "mse")
#: Grades from best to worst.
GRADES = ("success", "warning", "danger")
#: Pairs of models compared by one scan.
PAIRS_PER_SCAN = 40


def register(tables: Mapping[str, DataFrame], key: Sequence[str], y: str = "y",
             y_pred: str = "y_pred") -> DataFrame:
    """One long table (model, key..., y, y_pred) from a table per model."""
    out = None
    for name, t in tables.items():
        rows = t.select(F.lit(name).alias("model"), *[col(k) for k in key],
                        col(y).alias("y"), col(y_pred).alias("y_pred"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no models to register")
    return out


def label_mismatches(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose label differs between models: (key..., smallest, largest)."""
    return (df.groupBy(*[col(k) for k in key])
            .agg(F.min("y").alias("smallest"), F.max("y").alias("largest"))
            .filter("smallest <> largest"))


def model_names(df: DataFrame, limit: int = 1000) -> list[str]:
    """Names in alphabetic order; callers pass registration order where ties matter."""
    rows = df.select("model").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} models")
    return sorted(r["model"] for r in rows)


def average_rank(value: Column, by: Sequence[str], descending: bool = False) -> Column:
    """Rank 1, 2, ... within ``by``; equal values share the mean of their ranks."""
    keys = [col(b) for b in by] or [F.lit(0)]
    order = F.desc_nulls_last if descending else F.asc_nulls_last
    lowest = F.rank().over(W.partitionBy(*keys).orderBy(order(value)))
    ties = F.count(F.lit(1)).over(W.partitionBy(*keys, value))
    return F.when(value.isNotNull(), lowest + (ties - 1) / 2.0)


def compare_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y",
                    y_pred: str = "y_pred") -> DataFrame:
    """Metrics of every model with rmse_rank, mae_rank and r2_rank."""
    table = metrics(df, y, y_pred, [*by, "model"])
    return (table.withColumn("rmse_rank", average_rank(F.col("rmse"), by))
            .withColumn("mae_rank", average_rank(F.col("mae"), by))
            .withColumn("r2_rank", average_rank(F.col("r2"), by, descending=True)))


def _position(models: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))


def best_model(table: DataFrame, metric: str = "rmse", models: Sequence[str] = (),
               by: Sequence[str] = ()) -> DataFrame:
    """(by..., best_model, value): greatest R^2 or smallest of the others, the first
    registered model on ties."""
    metric = metric.lower()
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    place = _position(models) if models else F.col("model")
    value = -F.col(metric) if metric == "r2" else F.col(metric)
    best = F.min(F.struct(value.alias("v"), place.alias("p"), F.col("model").alias("m"),
                          F.col(metric).alias("x")))
    return (table.filter(col(metric).isNotNull()).groupBy(*[col(b) for b in by])
            .agg(best.alias("b"))
            .select(*[col(b) for b in by], F.col("b.m").alias("best_model"),
                    F.col("b.x").alias("value")))


def winners(table: DataFrame, models: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """(by..., best_rmse, best_mae, best_r2)."""
    place = _position(models) if models else F.col("model")

    def first(value: Column) -> Column:
        return F.min(F.struct(value.alias("v"), place.alias("p"),
                              F.col("model").alias("m")))["m"]

    return table.groupBy(*[col(b) for b in by]).agg(
        first(F.col("rmse")).alias("best_rmse"), first(F.col("mae")).alias("best_mae"),
        first(-F.col("r2")).alias("best_r2"))


def pairwise_differences(df: DataFrame, key: Sequence[str], models: Sequence[str],
                         by: Sequence[str] = (), y_pred: str = "y_pred") -> DataFrame:
    """(by..., model_a, model_b, mean_diff, std_diff, max_diff, correlation,
    within_0_5, within_1_0), one row per pair in registration order.

    Predictions of a row are brought together once, in as many columns as models; the
    pairs are aggregates over that, so no pair of rows is ever materialised.
    """
    keys = [col(b) for b in by]
    names = {m: f"p{i}" for i, m in enumerate(models)}
    wide = (df.groupBy(*keys, *[col(k) for k in key if k not in by])
            .agg(*[F.max(F.when(F.col("model") == m, col(y_pred).cast("double"))).alias(p)
                   for m, p in names.items()]))
    return wide_differences(wide.select(*keys, *names.values()), names, by)


def wide_differences(df: DataFrame, predictions: Mapping[str, str], by: Sequence[str] = ()
                     ) -> DataFrame:
    """The same from a table with one prediction column per model."""
    keys = [col(b) for b in by]
    pairs = list(combinations(predictions.items(), 2))
    if not pairs:
        raise ValueError("at least two models are needed")
    out = None
    for at in range(0, len(pairs), PAIRS_PER_SCAN):
        chunk = pairs[at:at + PAIRS_PER_SCAN]
        aggs, cells = [], []
        for i, ((a, ca), (b, cb)) in enumerate(chunk):
            d = col(ca) - col(cb)
            aggs += [F.avg(d).alias(f"m{i}"), F.stddev_pop(d).alias(f"s{i}"),
                     F.max(F.abs(d)).alias(f"x{i}"), correlation(col(ca), col(cb)).alias(f"r{i}"),
                     F.count_if(F.abs(d) <= 0.5).alias(f"h{i}"),
                     F.count_if(F.abs(d) <= 1.0).alias(f"o{i}")]
            cells.append(F.struct(
                F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
                F.col(f"m{i}").alias("mean_diff"), F.col(f"s{i}").alias("std_diff"),
                F.col(f"x{i}").alias("max_diff"), F.col(f"r{i}").alias("correlation"),
                F.col(f"h{i}").alias("within_0_5"), F.col(f"o{i}").alias("within_1_0")))
        part = (df.groupBy(*keys).agg(*aggs)
                .select(*keys, F.explode(F.array(*cells)).alias("__s"))
                .select(*keys, "__s.*"))
        out = part if out is None else out.unionByName(part)
    return out


def radar(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., model, rmse_norm, mae_norm, mape_norm, r2_norm): 1 is the best model."""
    w = W.partitionBy(*([col(b) for b in by] or [F.lit(0)]))

    def inverted(c: str) -> Column:
        low, high = F.min(c).over(w), F.max(c).over(w)
        return (1 - (F.col(c) - low) / (high - low + F.lit(1e-10))).alias(f"{c}_norm")

    return table.select(*[col(b) for b in by], "model", inverted("rmse"), inverted("mae"),
                        inverted("mape"), F.col("r2").alias("r2_norm"))


def long_metrics(table: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., model, metric, value)."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), col(n).cast("double").alias("value"))
                      for n in names])
    return (table.select(*[col(b) for b in by], "model", F.explode(cells).alias("__s"))
            .select(*[col(b) for b in by], "model", "__s.metric", "__s.value"))


def metrics_pivot(long: DataFrame, models: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, one column per model), metrics sorted, null where missing."""
    return (long.groupBy(*[col(b) for b in by], "metric").pivot("model", list(models))
            .agg(F.first("value")).orderBy(*[col(b) for b in by], "metric"))


def metrics_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(metric, value_a, value_b, difference) of two (metric, value) tables; metrics
    found in one table only have no difference."""
    left = a.select("metric", F.col("value").alias("value_a"))
    right = b.select("metric", F.col("value").alias("value_b"))
    return (left.join(right, "metric", "full_outer")
            .withColumn("difference", F.col("value_b") - F.col("value_a"))
            .orderBy("metric"))


def metric_grades(table: DataFrame) -> DataFrame:
    """Add rmse_grade, mae_grade and r2_grade."""
    low = list(GRADES)
    return (table
            .withColumn("rmse_grade", band(F.col("rmse"), [0.9, 1.2], low))
            .withColumn("mae_grade", band(F.col("mae"), [0.7, 1.0], low))
            .withColumn("r2_grade", band(F.col("r2"), [0.5, 0.7], low[::-1],
                                         right_closed=True)))


def model_points(df: DataFrame, model: str) -> DataFrame:
    """The point set of one model."""
    return df.filter(F.col("model") == model).select("y", "y_pred")


def comparison_report(df: DataFrame, key: Sequence[str], models: Sequence[str],
                      metric: str = "rmse", by: Sequence[str] = ()) -> DataFrame:
    """One row per segment: models, comparison table, best model, differences, winners."""
    by = list(by)
    keys = [col(b) for b in by]
    table = compare_metrics(df, by)
    rows = [c for c in table.columns if c not in by]
    out = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_models"),
        F.array_sort(F.collect_list(F.struct(*rows))).alias("comparison_table"))

    def one(t: DataFrame, name: str, many: bool) -> DataFrame:
        s = F.struct(*[c for c in t.columns if c not in by])
        agg = F.collect_list(s) if many else F.first(s)
        return t.groupBy(*keys).agg(agg.alias(name))

    parts = [one(best_model(table, metric, models, by), "best_model", False),
             one(winners(table, models, by), "winners", False)]
    if len(models) > 1:
        parts.append(one(pairwise_differences(df, key, models, by), "differences", True))
    # Rows of these tables are segments; without segments, single rows.
    seg = by or ["__one"]
    if not by:
        out = out.withColumn("__one", F.lit(1))
        parts = [p.withColumn("__one", F.lit(1)) for p in parts]
    for p in parts:
        out = join_small(out, p, seg)
    return out.drop("__one").withColumn("models", F.array(*[F.lit(m) for m in models]))
