"""Null-safe column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def col(name: str) -> Column:
    """Column by exact name, also with dots, spaces or accents in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(c: str | Column) -> Column:
    return col(c) if isinstance(c, str) else c


def clip(x: Column, low: float | Column | None, high: float | Column | None) -> Column:
    """Limit to [low, high]; null stays null (``least`` alone would skip it)."""
    limited = x
    if low is not None:
        limited = F.greatest(limited, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        limited = F.least(limited, high if isinstance(high, Column) else F.lit(high))
    return F.when(x.isNotNull(), limited)


def finite_or(x: Column, value: float) -> Column:
    """Replace plus and minus infinity; null stays null."""
    return F.when(x.isin(INF, -INF), F.lit(value)).otherwise(x)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of a missing value: NaN in float columns becomes NULL."""
    return df.select(*[
        F.when(F.isnan(col(f.name)), F.lit(None)).otherwise(col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name)
        for f in df.schema.fields
    ])


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """``default`` for a zero denominator only; null operands give null."""
    return F.when(denominator == 0, F.lit(float(default))).otherwise(
        F.try_divide(numerator, denominator))


def sample_skewness(c: Column) -> Column:
    """Skewness with the small-sample correction; null below three values."""
    n = F.count(c).cast("double")
    g = F.coalesce(F.skewness(c), F.lit(0.0))
    return F.when(n >= 3, g * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: Column) -> Column:
    """Excess kurtosis with the small-sample correction; null below four values."""
    n = F.count(c).cast("double")
    g = F.kurtosis(c)
    corrected = F.try_divide(((n + 1) * g + 6) * (n - 1), (n - 2) * (n - 3))
    return F.when(n >= 4, F.coalesce(corrected, F.lit(0.0)))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both values; null where one is constant
    (``corr`` alone divides by zero there)."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(a) * F.stddev_pop(b))


def band(x: Column, edges: Sequence[float | Column], labels: Sequence[str],
         right_closed: bool = False) -> Column:
    """Label of the interval ``x`` falls in; ``edges`` ascend, one label more than edges.

    An edge belongs to the upper interval, or to the lower one if ``right_closed``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than edges")
    out: Column | None = None
    for edge, label in zip(edges, labels):
        e = edge if isinstance(edge, Column) else F.lit(edge)
        inside = (x <= e) if right_closed else (x < e)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    if out is None:
        return F.when(x.isNotNull(), F.lit(labels[-1]))
    return out.when(x.isNotNull(), F.lit(labels[-1]))


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree, so that thousands of terms do not nest deeply."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a + b, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


# Abramowitz and Stegun 7.1.26, error function.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Acklam's rational approximation of the inverse normal.
PPF_A = (-3.969683028665376e1, 2.209460984245205e2, -2.759285104469687e2,
         1.383577518672690e2, -3.066479806614716e1, 2.506628277459239)
PPF_B = (-5.447609879822406e1, 1.615858368580409e2, -1.556989798598866e2,
         6.680131188771972e1, -1.328068155288572e1)
PPF_C = (-7.784894002430293e-3, -3.223964580411365e-1, -2.400758277161838,
         -2.549732539343734, 4.374664141464968, 2.938163982698783)
PPF_D = (7.784695709041462e-3, 3.224671290700398e-1, 2.445134137142996,
         3.754408661907416)
PPF_LOW = 0.02425


def _horner(x: Column, coefficients: Sequence[float]) -> Column:
    """Polynomial, highest power first."""
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_cdf(z: Column) -> Column:
    """Share of a standard normal below ``z`` (absolute error below 1e-7)."""
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    erf = F.lit(1.0) - _horner(t, ERF_A[::-1]) * t * F.exp(-x * x)
    return (F.lit(1.0) + F.signum(z) * erf) / F.lit(2.0)


def normal_ppf(p: Column) -> Column:
    """Standard normal quantile for 0 < p < 1."""
    def tail(q: Column) -> Column:
        return _horner(q, PPF_C) / _horner(q, PPF_D + (1.0,))

    low = tail(F.sqrt(F.lit(-2.0) * F.ln(p)))
    high = -tail(F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p)))
    q = p - F.lit(0.5)
    centre = _horner(q * q, PPF_A) * q / _horner(q * q, PPF_B + (1.0,))
    return (F.when(p < PPF_LOW, low)
            .when(p > 1.0 - PPF_LOW, high)
            .otherwise(centre))
