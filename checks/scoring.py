"""Scoring: intervals, percentiles, labels, contributions and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import KEY, KEY_SQL, LINEITEM, R, lineitem, normal_cdf_sql, rounded, table
from tabulon.functions.expr import col
from tabulon.operators import score as S
from tabulon.operators.features import FeatureSettings, fit_features
from tabulon.operators.linear import LinearModel, fit_linear
from tabulon.plans.graduates import (
    BATCH_NAMES, HISTORY, INTERPRETATION, REQUEST_INTERPRETATION)
from tabulon.streaming.scoring import score_rows

RULE = "10 + l_quantity / 5 + (l_extendedprice / 52500 - 1) * 1.5"
MODEL = LinearModel("ridge", 1.0, ("l_quantity", "price", "l_discount", "l_tax"),
                    (0.15, -0.75123451237, 20.0, -3.5), 11.0)
MODEL_COLUMNS = ["l_quantity", "l_extendedprice / 10000 as price", "l_discount", "l_tax"]


def score_batch(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, f"{RULE} as raw")
    out = S.score_batch(df, col("raw"), HISTORY, BATCH_NAMES).drop("raw")
    return rounded(out, [c for c in out.columns if c not in KEY])


def score_details(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, f"{RULE} as raw")
    out = S.score_details(df, col("raw"), HISTORY, INTERPRETATION, MODEL).drop("raw")
    return rounded(out, ["prediction", "lower_bound", "upper_bound", "difference",
                         "percentile"], 5)


def score_with_history(spark, sf):
    """Limits and percentile from a table's own statistics."""
    df = table(spark, sf, "orders")
    stats = S.historical_stats(df, "o_totalprice")
    out = S.score_batch(df.select("o_orderkey", "o_totalprice"),
                        col("o_totalprice") * 1.3 - 20000, stats)
    out = out.withColumn("percentile", S.percentile(col("prediction"), stats.mean, stats.std))
    return rounded(out.drop("o_totalprice"), ["prediction", "lower_bound", "upper_bound",
                                              "percentile"], 3)


def score_with_defaults(spark, sf):
    """Requests with missing inputs, filled by the medians of the table."""
    df = lineitem(spark, sf)
    label = "10 + l_quantity / 8"
    reference = df.selectExpr("l_quantity", "l_discount", "l_tax", f"{label} as y")
    defaults = S.fit_request_defaults(reference, ["l_quantity", "l_discount", "l_tax"], "y")
    requests = df.selectExpr(
        *KEY, "case when l_linenumber % 3 = 0 then null else l_quantity end as l_quantity",
        "case when l_linenumber % 4 = 0 then null else l_discount end as l_discount")
    prediction = (F.lit(9.0) + col("l_quantity") / 6 + col("l_discount") * 30
                  + col("l_tax") * 10)
    out = S.score_requests(requests, prediction, defaults, REQUEST_INTERPRETATION)
    return rounded(out, ["l_quantity", "l_discount", "l_tax", "prediction", "lower_bound",
                         "upper_bound", "percentile"], 5)


def percentile_band(spark, sf):
    df = lineitem(spark, sf).selectExpr("l_quantity")
    p = S.percentile(col("l_quantity"), 25.0, 14.0)
    return (df.select(S.percentile_band(p).alias("band"))
            .groupBy("band").agg(F.count(F.lit(1)).alias("n")))


def contributions_topn(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, *MODEL_COLUMNS)
    out = S.contributions(df, MODEL, 2).drop("l_quantity", "price", "l_discount", "l_tax")
    out = out.select(*KEY, "total_contribution", "raw_prediction",
                     F.posexplode_outer("top_features").alias("place", "t"))
    out = out.select(*KEY, "total_contribution", "raw_prediction", "place", "t.*")
    return rounded(out, ["total_contribution", "raw_prediction", "value", "coefficient",
                         "contribution"], 8)


def explain_text(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, *MODEL_COLUMNS)
    scored = S.score_batch(S.contributions(df, MODEL), F.col("raw_prediction"), HISTORY)
    return S.explain(scored, HISTORY).select(*KEY, "explanation")


def valid_and_rejected(spark, sf):
    """Rows of both tables the requests are divided into."""
    from checks.profiling import REQUEST, RULES
    from tabulon.operators.validate import RowRules

    rules = RowRules(["priority"], RULES.numeric, RULES.ranges, RULES.ordered)
    req = table(spark, sf, "orders").selectExpr(*[c.format(text="string") for c in REQUEST])
    good, bad = S.valid_and_rejected(req, rules)
    return (good.select("o_orderkey", F.lit(0).alias("errors"))
            .unionByName(bad.select("o_orderkey", F.size("errors").alias("errors"))))


def score_rows_fitted(spark, sf):
    """Fitted features and model applied to every row, as on a stream."""
    df = lineitem(spark, sf).selectExpr(
        *KEY, "l_quantity", "l_returnflag", "l_discount",
        "10 + l_quantity / 5 + l_discount * 10 as y")
    fitted = fit_features(df, FeatureSettings(("l_quantity", "l_discount"), ("l_returnflag",)))
    matrix = fitted.transform(df, [*KEY, "y"])
    model = fit_linear(matrix, list(fitted.names), "y", "ridge", 0.0)
    out = score_rows(df, fitted, model, HISTORY, [*KEY, "y"])
    return rounded(out, ["y", "prediction", "lower_bound", "upper_bound"], 4)


QUERIES = {f.__name__: f for f in (
    score_batch, score_details, score_with_history, score_with_defaults, percentile_band,
    contributions_topn, explain_text, valid_and_rejected, score_rows_fitted)}

_REACH = "1.96e0 * (1.15e0 * 0.5e0)"


def _interval(p: str, low: str, high: str, reach: str, names, digits: int = 6) -> str:
    a, b, c = names
    return (f"{R(p, digits)} as {a}, {R(f'greatest({p} - {reach}, {low})', digits)} as {b}, "
            f"{R(f'least({p} + {reach}, {high})', digits)} as {c}")


_SCORED = (f"(select {KEY_SQL}, least(greatest({RULE}, 12.23e0), 19.3e0) as p "
           f"from {LINEITEM})")
_BOUNDS = ("prediction", "lower_bound", "upper_bound")
_PARTS = [("l_quantity", "l_quantity", "0.15"), ("price", "(l_extendedprice / 10000)", "-0.75123451237"),
          ("l_discount", "l_discount", "20.0"), ("l_tax", "l_tax", "-3.5")]
_TOTAL = ("((l_quantity * 0.15e0 + (l_extendedprice / 10000) * (-0.75123451237e0)) "
          "+ (l_discount * 20e0 + l_tax * (-3.5e0)))")
_TOP = " union all ".join(
    f"select {KEY_SQL}, {i} as i, '{f}' as feature, {x} as v, cast({w} as double) as w, "
    f"{x} * cast({w} as double) as c, {_TOTAL} as total from {LINEITEM}"
    for i, (f, x, w) in enumerate(_PARTS))
_RANKED = (f"(select *, row_number() over (partition by {KEY_SQL} order by abs(c) desc, i) "
           f"as place from ({_TOP}))")

SQL = {
    "score_batch": f"select {KEY_SQL}, " + _interval(
        "p", "12.23e0", "19.3e0", _REACH,
        ("PROMEDIO_PREDICHO", "LIMITE_INFERIOR", "LIMITE_SUPERIOR")) + f" from {_SCORED}",
    "score_details": f"select {KEY_SQL}, " + _interval(
        "p", "12.23e0", "19.3e0", _REACH, _BOUNDS, 5) + f""", {R('p - 15.96e0', 5)} as difference,
{R('100 * ' + normal_cdf_sql('((p - 15.96e0) / 1.15e0)'), 5)} as percentile,
case when p >= 15.96e0 + 1.15e0 then 'Excelente - Por encima del promedio histórico'
     when p >= 15.96e0 then 'Bueno - Por encima del promedio'
     when p >= 15.96e0 - 1.15e0 then 'Regular - Cerca del promedio'
     else 'Bajo - Por debajo del promedio histórico' end as interpretation,
'ridge' as model_type, cast(1 as double) as model_alpha from {_SCORED}""",
    "score_with_history": f"""with s as (select avg(o_totalprice) m, stddev_samp(o_totalprice) d,
  min(o_totalprice) lo, max(o_totalprice) hi from orders),
t as (select o_orderkey, m, d, lo, hi,
  least(greatest(o_totalprice * 1.3e0 - 20000, lo), hi) as p from orders, s)
select o_orderkey, {_interval('p', 'lo', 'hi', '1.96e0 * (d * 0.5e0)', _BOUNDS, 3)},
{R('100 * ' + normal_cdf_sql('((p - m) / d)'), 3)} as percentile from t""",
    "score_with_defaults": f"""with s as (select quantile_cont(l_quantity, 0.5) q,
  quantile_cont(l_discount, 0.5) d, quantile_cont(l_tax, 0.5) x, avg(10 + l_quantity / 8) m,
  stddev_samp(10 + l_quantity / 8) sd from lineitem),
r as (select {KEY_SQL}, case when l_linenumber % 3 = 0 then q else l_quantity end as l_quantity,
  case when l_linenumber % 4 = 0 then d else l_discount end as l_discount, x as l_tax, m, sd
  from {LINEITEM}, s),
t as (select *, least(greatest(9e0 + l_quantity / 6 + l_discount * 30 + l_tax * 10, 0), 20) as p
  from r)
select {KEY_SQL}, {R('l_quantity', 5)} as l_quantity, {R('l_discount', 5)} as l_discount,
{R('l_tax', 5)} as l_tax, {_interval('p', '0', '20', '1.96e0 * 0.5e0', _BOUNDS, 5)},
{R('least(greatest(100 * ' + normal_cdf_sql('((p - m) / sd)') + ', 0), 100)', 5)} as percentile,
case when p >= 16 then '{REQUEST_INTERPRETATION[4]}' when p >= 14 then
'{REQUEST_INTERPRETATION[3]}' when p >= 12 then '{REQUEST_INTERPRETATION[2]}' when p >= 10 then
'{REQUEST_INTERPRETATION[1]}' else '{REQUEST_INTERPRETATION[0]}' end as interpretation from t""",
    "percentile_band": f"""with t as (select 100 * {normal_cdf_sql('((l_quantity - 25) / 14)')} p
from lineitem) select case when p >= 70 then 'success' when p >= 40 then 'warning'
else 'danger' end as band, count(*) as n from t group by 1""",
    "contributions_topn": f"""select {KEY_SQL}, {R('total', 8)} as total_contribution,
{R('total + 11', 8)} as raw_prediction, cast(place - 1 as integer) as place, feature,
{R('v', 8)} as "value", {R('w', 8)} as coefficient, {R('c', 8)} as contribution
from {_RANKED} where place <= 2""",
    "explain_text": f"""with t as (select {KEY_SQL}, least(greatest(min(total) + 11, 12.23e0), 19.3e0) p,
  string_agg(format('{{}}. {{}}: influyó {{}} (contribución: {{:.4f}})', place, feature,
    case when c > 0 then 'positivamente' else 'negativamente' end, c) || chr(10), ''
    order by place) as f from {_RANKED} where place <= 3 group by {KEY_SQL})
select {KEY_SQL}, format('Predicción: {{:.2f}} puntos', p) || chr(10) || chr(10)
|| 'Factores principales que influyeron:' || chr(10) || f || chr(10) || 'Comparación:' || chr(10)
|| '• Promedio histórico: 15.96' || chr(10) || format('• Tu predicción está {{:.2f}} puntos {{}}'
|| ' del promedio', abs(p - 15.96e0), case when p - 15.96e0 > 0 then 'por encima'
else 'por debajo' end) || chr(10) as explanation from t""",
    "score_rows_fitted": f"""with t as (select {KEY_SQL}, 10 + l_quantity / 5 + l_discount * 10 as y
  from {LINEITEM})
select {KEY_SQL}, {R('y', 4)} as y, """ + _interval(
        "least(greatest(y, 12.23e0), 19.3e0)", "12.23e0", "19.3e0", _REACH, _BOUNDS, 4)
    + " from t",
}


def _errors_sql() -> str:
    from checks.profiling import SQL as PROFILING

    body = PROFILING["validate_rows"].replace("'Feature faltante: campus',", "")
    return (body[:body.index("select o_orderkey, array_to_string")]
            + "select o_orderkey, cast(len(m) as integer) as errors from e")


SQL["valid_and_rejected"] = _errors_sql()
