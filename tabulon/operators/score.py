"""Scoring of tables: predictions with interval, percentile, band and explanation.

All of it is row by row, so it needs no shuffle and also runs on streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expr import as_column, balanced_sum, band, clip, col, normal_cdf
from tabulon.operators.compare import GRADES
from tabulon.operators.linear import LinearModel
from tabulon.operators.profile import dataset_card
from tabulon.operators.quantiles import column_quantiles
from tabulon.operators.validate import RowRules, row_errors

#: Fixed value: standard normal quantile of a 95 % interval.
Z95 = 1.96


@dataclass(frozen=True)
class HistoricalStats:
    """What predictions are limited to and compared with."""

    mean: float
    std: float
    low: float
    high: float


def historical_stats(df: DataFrame, target: str) -> HistoricalStats:
    """The statistics of a table's target."""
    r = dataset_card(df, target).first()
    return HistoricalStats(r["target_mean"], r["target_std"], r["target_min"], r["target_max"])


@dataclass(frozen=True)
class ScoreNames:
    prediction: str = "prediction"
    lower: str = "lower_bound"
    upper: str = "upper_bound"


def add_interval(df: DataFrame, prediction: Column, low: float, high: float, std_error: float,
                 names: ScoreNames = ScoreNames()) -> DataFrame:
    """Prediction limited to [low, high] with its 95 % interval in the same limits."""
    p = col(names.prediction)
    reach = Z95 * std_error
    return (df.withColumn(names.prediction, clip(prediction, low, high))
            .withColumn(names.lower, F.when(p.isNotNull(), F.greatest(p - reach, F.lit(low))))
            .withColumn(names.upper, F.when(p.isNotNull(), F.least(p + reach, F.lit(high)))))


def score_batch(df: DataFrame, prediction: Column, stats: HistoricalStats,
                names: ScoreNames = ScoreNames()) -> DataFrame:
    """Limited predictions; the standard error is taken as half the historical std."""
    return add_interval(df, prediction, stats.low, stats.high, stats.std * 0.5, names)


def percentile(value: Column, mean: float, std: float) -> Column:
    """Share of a normal distribution below ``value``, 0 to 100."""
    return normal_cdf((value - F.lit(mean)) / F.lit(std)) * 100


def interpretation(value: Column, stats: HistoricalStats, labels: Sequence[str]) -> Column:
    """Label by distance to the mean in stds; ``labels`` go from low to high."""
    return band(value, [stats.mean - stats.std, stats.mean, stats.mean + stats.std], labels)


def percentile_band(p: Column, labels: Sequence[str] = GRADES[::-1]) -> Column:
    """Grade of a percentile: from 70 the best, from 40 the middle one."""
    return band(p, [40.0, 70.0], labels)


def score_details(df: DataFrame, prediction: Column, stats: HistoricalStats,
                  labels: Sequence[str], model: LinearModel | None = None,
                  names: ScoreNames = ScoreNames()) -> DataFrame:
    """``score_batch`` with difference to the mean, percentile, label and model info."""
    p = col(names.prediction)
    out = (score_batch(df, prediction, stats, names)
           .withColumn("difference", p - F.lit(stats.mean))
           .withColumn("percentile", percentile(p, stats.mean, stats.std))
           .withColumn("interpretation", interpretation(p, stats, labels)))
    if model is not None:
        out = (out.withColumn("model_type", F.lit(model.kind))
               .withColumn("model_alpha", F.lit(model.alpha)))
    return out


def valid_and_rejected(df: DataFrame, rules: RowRules) -> tuple[DataFrame, DataFrame]:
    """Requests that may be scored, and the others with their errors."""
    checked = row_errors(df, rules)
    return (checked.filter("is_valid").drop("errors", "is_valid"),
            checked.filter(~F.col("is_valid")).drop("is_valid"))


@dataclass(frozen=True)
class RequestDefaults:
    """Medians that stand in for missing inputs, and the label's mean and std."""

    medians: Mapping[str, float | None]
    mean: float
    std: float


def fit_request_defaults(reference: DataFrame, columns: Sequence[str], target: str
                         ) -> RequestDefaults:
    medians = {c: v[0] for c, v in column_quantiles(reference, columns, [0.5]).items()}
    card = dataset_card(reference, target).first()
    return RequestDefaults(medians, card["target_mean"], card["target_std"])


def fill_requests(df: DataFrame, defaults: RequestDefaults) -> DataFrame:
    """Every input as a double, the median where the request has none."""
    rest = [col(c) for c in df.columns if c not in defaults.medians]
    filled = [(F.coalesce(col(c).cast("double"), F.lit(m)) if c in df.columns
               else F.lit(m)).cast("double").alias(c) for c, m in defaults.medians.items()]
    return df.select(*rest, *filled)


def score_requests(df: DataFrame, prediction: Column, defaults: RequestDefaults,
                   labels: Sequence[str], edges: Sequence[float] = (10.0, 12.0, 14.0, 16.0),
                   low: float = 0.0, high: float = 20.0, std_error: float = 0.5,
                   names: ScoreNames = ScoreNames()) -> DataFrame:
    """Requests with missing inputs filled, then limited prediction, interval,
    percentile in [0, 100] and label."""
    out = add_interval(fill_requests(df, defaults), prediction, low, high, std_error, names)
    p = col(names.prediction)
    return (out.withColumn("percentile", clip(percentile(p, defaults.mean, defaults.std),
                                              0.0, 100.0))
            .withColumn("interpretation", band(p, list(edges), labels)))


def contributions(df: DataFrame, model: LinearModel, top_n: int = 10,
                  values: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Add ``top_features`` (feature, value, coefficient, contribution), largest effect
    first, ``total_contribution`` and ``raw_prediction`` (not limited).

    Sorting happens inside each row's array.
    """
    x = {f: as_column((values or {}).get(f, f)).cast("double") for f in model.features}
    last = F.lit(float("inf"))                       # missing values come last
    parts = [F.struct(F.coalesce(-F.abs(x[f] * F.lit(w)), last).alias("o"), F.lit(i).alias("i"),
                      F.lit(f).alias("feature"), x[f].alias("value"),
                      F.lit(w).alias("coefficient"), (x[f] * F.lit(w)).alias("contribution"))
             for i, (f, w) in enumerate(zip(model.features, model.coefficients))]
    total = balanced_sum([x[f] * F.lit(w) for f, w in zip(model.features, model.coefficients)])
    sorted_top = F.slice(F.sort_array(F.array(*parts)), 1, top_n)
    fields = ("feature", "value", "coefficient", "contribution")
    return (df.withColumn("__t", sorted_top)
            .withColumn("top_features", F.arrays_zip(*[F.col(f"__t.{f}") for f in fields]))
            .drop("__t").withColumn("total_contribution", total)
            .withColumn("raw_prediction", F.col("total_contribution") + F.lit(model.intercept)))


@dataclass(frozen=True)
class ExplanationText:
    """The sentences of an explanation."""

    headline: str = "Predicción: %.2f puntos\n\nFactores principales que influyeron:\n"
    positive: str = "positivamente"
    negative: str = "negativamente"
    factor: str = "%d. %s: influyó %s (contribución: %.4f)\n"
    mean: str = "\nComparación:\n• Promedio histórico: %.2f\n"
    distance: str = "• Tu predicción está %.2f puntos %s del promedio\n"
    above: str = "por encima"
    below: str = "por debajo"


def explain(df: DataFrame, stats: HistoricalStats, prediction: str = "prediction",
            text: ExplanationText = ExplanationText(), out: str = "explanation") -> DataFrame:
    """Text from the three largest contributions and the distance to the mean."""
    p = col(prediction)
    factors = F.transform(F.slice("top_features", 1, 3), lambda s, i: F.format_string(
        text.factor, i + 1, s["feature"],
        F.when(s["contribution"] > 0, text.positive).otherwise(text.negative),
        s["contribution"]))
    diff = p - F.lit(stats.mean)
    return df.withColumn(out, F.concat(
        F.format_string(text.headline, p), F.array_join(factors, ""),
        F.format_string(text.mean, F.lit(stats.mean)),
        F.format_string(text.distance, F.abs(diff),
                        F.when(diff > 0, text.above).otherwise(text.below))))
