"""Evaluation and comparison of three fixed prediction formulas."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from checks.base import (
    FORMULAS, KEY, KEY_SQL, LABEL, LINEITEM, MODELS, PREDICTIONS, R, lineitem, model_case,
    normal_ppf_sql, predictions, rounded)
from tabulon.operators import compare as C
from tabulon.operators import evaluate as E

METRICS = ["rmse", "mae", "r2", "mape", "mse", "max_error", "mean_residual", "std_residual"]
BOTH = ["segment", "model"]


def metrics(spark, sf):
    return rounded(E.metrics(predictions(spark, sf), by=BOTH), METRICS)


def metrics_single(spark, sf):
    """One model over the whole table, labels of 0 included."""
    df = lineitem(spark, sf).selectExpr("l_quantity - 25 as y",
                                        "l_quantity - 25 + l_tax * 10 as y_pred")
    return rounded(E.metrics(df), METRICS)


def residual_stats(spark, sf):
    out = E.residual_stats(predictions(spark, sf), by=["model"])
    return rounded(out, ["mean", "std", "min", "max", "median", "q25", "q75"])


def residual_stats_by_part(spark, sf):
    """Many groups: quantiles from value counts."""
    df = lineitem(spark, sf).selectExpr("l_suppkey", f"{LABEL} as y",
                                        f"{FORMULAS['price']} as y_pred")
    out = E.residual_stats(df, by=["l_suppkey"])
    return rounded(out, ["mean", "std", "min", "max", "median", "q25", "q75"])


def value_stats(spark, sf):
    out = E.value_stats(predictions(spark, sf), by=["model"])
    return rounded(out, [c for c in out.columns if c != "model"])


def within_tolerance(spark, sf):
    return E.within_tolerance(predictions(spark, sf), by=BOTH)


def error_bins(spark, sf):
    return rounded(E.error_bins(predictions(spark, sf), by=["model"]), ["pct"])


def residual_histogram(spark, sf):
    out = E.residual_histogram(predictions(spark, sf), by=["model"])
    return rounded(out, ["bin_start", "bin_end"])


def qq_line(spark, sf):
    out = E.qq_line(predictions(spark, sf), by=["model"])
    return rounded(out, ["slope", "intercept", "r"])


def qq_points(spark, sf):
    df = lineitem(spark, sf).selectExpr(f"{LABEL} as y", f"{FORMULAS['price']} as y_pred")
    return rounded(E.qq_points(df), ["theoretical", "ordered"])


def prediction_points(spark, sf):
    df = predictions(spark, sf).filter("model = 'tax'")
    return rounded(E.prediction_points(df, keep=KEY), ["y", "y_pred", "residual"])


def prediction_range(spark, sf):
    return rounded(E.prediction_range(predictions(spark, sf), by=BOTH), ["low", "high"])


def fit_quality(spark, sf):
    m = E.metrics(predictions(spark, sf), by=BOTH)
    return m.select(*BOTH, E.fit_quality(F.col("r2")).alias("quality"),
                    E.overfit_label(F.col("rmse")).alias("gap_label"))


def evaluation_report(spark, sf):
    out = E.evaluation_report(predictions(spark, sf))
    return rounded(out.select(
        "model", "n_samples", F.col("metrics.rmse").alias("rmse"),
        F.col("residuals_stats.median").alias("median"),
        F.col("value_stats.pred_std").alias("pred_std"),
        F.col("error_distribution.within_1_0").alias("within_1_0")),
        ["rmse", "median", "pred_std"])


def compare_models(spark, sf):
    out = C.compare_metrics(predictions(spark, sf), ["segment"])
    return rounded(out, METRICS)


def rank_average(spark, sf):
    """Models with equal metrics share their mean rank."""
    df = predictions(spark, sf)
    twin = df.filter("model = 'tax'").withColumn("model", F.lit("tax_again"))
    out = C.compare_metrics(df.unionByName(twin))
    return out.select("model", "rmse_rank", "mae_rank", "r2_rank")


def best_model(spark, sf):
    table = C.compare_metrics(predictions(spark, sf), ["segment"])
    out = None
    for metric in C.METRICS:
        t = C.best_model(table, metric, MODELS, ["segment"]).withColumn("metric", F.lit(metric))
        out = t if out is None else out.unionByName(t)
    return rounded(out, ["value"])


def winners(spark, sf):
    return C.winners(C.compare_metrics(predictions(spark, sf), ["segment"]), MODELS,
                     ["segment"])


DIFFERENCES = ["mean_diff", "std_diff", "max_diff", "correlation"]


def pairwise_diff(spark, sf):
    out = C.pairwise_differences(predictions(spark, sf), KEY, MODELS, ["segment"])
    return rounded(out, DIFFERENCES)


def wide_diff(spark, sf):
    """Predictions already side by side: no shuffle of rows."""
    df = lineitem(spark, sf).selectExpr(*[f"{f} as {m}" for m, f in FORMULAS.items()])
    return rounded(C.wide_differences(df, {m: m for m in MODELS}), DIFFERENCES)


def label_mismatches(spark, sf):
    df = predictions(spark, sf).withColumn("y", F.expr(
        "case when model = 'tax' and l_linenumber = 3 then y + 1 else y end"))
    return C.label_mismatches(df, KEY)


def radar(spark, sf):
    out = C.radar(C.compare_metrics(predictions(spark, sf), ["segment"]), ["segment"])
    return rounded(out, ["rmse_norm", "mae_norm", "mape_norm", "r2_norm"])


def metrics_pivot(spark, sf):
    table = C.compare_metrics(predictions(spark, sf))
    long = C.long_metrics(table, ["rmse", "mae", "r2"])
    long = long.filter("not (model = 'tax' and metric = 'mae')")
    return rounded(C.metrics_pivot(long, MODELS), MODELS)


def metrics_outer_diff(spark, sf):
    long = C.long_metrics(C.compare_metrics(predictions(spark, sf)), ["rmse", "mae", "r2"])
    a = long.filter("model = 'price' and metric <> 'mae'").select("metric", "value")
    b = long.filter("model = 'discount' and metric <> 'r2'").select("metric", "value")
    return rounded(C.metrics_difference(a, b), ["value_a", "value_b", "difference"])


def metric_grades(spark, sf):
    out = C.metric_grades(C.compare_metrics(predictions(spark, sf), ["segment"]))
    return out.select("segment", "model", "rmse_grade", "mae_grade", "r2_grade")


def model_points(spark, sf):
    return rounded(C.model_points(predictions(spark, sf), "discount"), ["y", "y_pred"])


def comparison_report(spark, sf):
    out = C.comparison_report(predictions(spark, sf), KEY, MODELS, by=["segment"])
    return out.select("segment", "n_models", F.col("best_model.best_model").alias("best"),
                      F.col("winners.best_mae").alias("best_mae"),
                      F.size("differences").alias("pairs"),
                      F.array_join("models", ",").alias("models"))


QUERIES = {f.__name__: f for f in (
    metrics, metrics_single, residual_stats, residual_stats_by_part, value_stats,
    within_tolerance, error_bins, residual_histogram, qq_line, qq_points, prediction_points,
    prediction_range, fit_quality, evaluation_report, compare_models, rank_average, best_model,
    winners, pairwise_diff, wide_diff, label_mismatches, radar, metrics_pivot,
    metrics_outer_diff, metric_grades, model_points, comparison_report)}

_RAW = {
    "rmse": "sqrt(avg((y - y_pred) * (y - y_pred)))", "mae": "avg(abs(y - y_pred))",
    "r2": "1 - avg((y - y_pred) * (y - y_pred)) / var_pop(y)",
    "mape": "100 * avg(case when y <> 0 then abs((y - y_pred) / y) end)",
    "mse": "avg((y - y_pred) * (y - y_pred))", "max_error": "max(abs(y - y_pred))",
    "mean_residual": "avg(y - y_pred)", "std_residual": "stddev_pop(y - y_pred)"}


def _metrics(by: str, rows: str = PREDICTIONS) -> str:
    head = f"{by}, " if by else ""
    return (f"select {head}count(*) as n, " + ", ".join(f"{e} as {m}" for m, e in _RAW.items())
            + f" from {rows}" + (f" group by {by}" if by else ""))


def _round_all(columns, digits: int = 6) -> str:
    return ", ".join(f"{R(c, digits)} as {c}" for c in columns)


def _rank(metric: str, over: str, way: str = "asc") -> str:
    part = f"partition by {over} " if over else ""
    ties = ", ".join(x for x in (over, metric) if x)
    return (f"rank() over ({part}order by {metric} {way}) "
            f"+ (count(*) over (partition by {ties}) - 1) / 2e0 as {metric}_rank")


def _ranks(over: str) -> str:
    return ", ".join((_rank("rmse", over), _rank("mae", over), _rank("r2", over, "desc")))


def _residuals(by: str, rows: str) -> str:
    e = "(y - y_pred)"
    return f"select {by}, " + ", ".join(f"{R(x)} as {n}" for x, n in (
        (f"avg({e})", "mean"), (f"stddev_pop({e})", "std"), (f"min({e})", '"min"'),
        (f"max({e})", '"max"'), (f"quantile_cont({e}, 0.5)", "median"),
        (f"quantile_cont({e}, 0.25)", "q25"), (f"quantile_cont({e}, 0.75)", "q75"))
    ) + f" from {rows} group by {by}"


def _diff(rows: str, group: str) -> str:
    """One row per pair from a table with a column per model."""
    head = f"{group}, " if group else ""
    return " union all ".join(
        f"select {head}'{a}' as model_a, '{b}' as model_b, {R(f'avg({a} - {b})')} as mean_diff, "
        f"{R(f'stddev_pop({a} - {b})')} as std_diff, {R(f'max(abs({a} - {b}))')} as max_diff, "
        f"{R(f'corr({a}, {b})')} as correlation, "
        f"count(*) filter (abs({a} - {b}) <= 0.5) as within_0_5, "
        f"count(*) filter (abs({a} - {b}) <= 1) as within_1_0 from {rows}"
        + (f" group by {group}" if group else "") for a, b in combinations(MODELS, 2))


_WIDE = ("(select l_returnflag as segment, " + ", ".join(
    f"{f} as {m}" for m, f in FORMULAS.items()) + " from lineitem)")
_BINS = [("0", "0.5", "< 0.5"), ("0.5", "1", "0.5-1.0"), ("1", "1.5", "1.0-1.5"),
         ("1.5", "2", "1.5-2.0"), ("2", "1e300", "> 2.0")]
_QQ = """r as (select *, row_number() over ({part} order by e) i, count(*) over ({part}) n from t),
q as (select *, case when i = n then pow(0.5e0, 1e0 / n) when i = 1 then 1e0 - pow(0.5e0, 1e0 / n)
  else (i - 0.3175e0) / (n + 0.365e0) end p from r),
z as (select *, {ppf} as x from q)"""


def _winner(metric: str, way: str = "") -> str:
    return (f"(select model from m m2 where m2.segment = m.segment order by {metric} {way}, "
            f"{model_case('m2.model')} limit 1)")


_M = f"m as ({_metrics('segment, model')})"
_G = f"m as ({_metrics('model')})"

SQL = {
    "metrics": f"with {_M} select segment, model, n, {_round_all(METRICS)} from m",
    "metrics_single": f"with m as (" + _metrics("", """(select l_quantity - 25 as y,
l_quantity - 25 + l_tax * 10 as y_pred from lineitem)""")
    + f") select n, {_round_all(METRICS)} from m",
    "residual_stats": _residuals("model", PREDICTIONS),
    "residual_stats_by_part": _residuals(
        "l_suppkey", f"(select l_suppkey, {LABEL} as y, {FORMULAS['price']} as y_pred "
                     "from lineitem)"),
    "value_stats": "select model, " + ", ".join(f"{R(e)} as {n}" for e, n in (
        ("min(y_pred)", "pred_min"), ("max(y_pred)", "pred_max"), ("avg(y_pred)", "pred_mean"),
        ("stddev_pop(y_pred)", "pred_std"), ("min(y)", "actual_min"), ("max(y)", "actual_max"),
        ("avg(y)", "actual_mean"), ("stddev_samp(y)", "actual_std")))
    + f" from {PREDICTIONS} group by model",
    "within_tolerance": "select segment, model, " + ", ".join(
        f"count(*) filter (abs(y - y_pred) <= {t}) as within_{t.replace('.', '_')}"
        for t in ("0.5", "1.0", "1.5", "2.0")) + f" from {PREDICTIONS} group by all",
    "error_bins": " union all ".join(
        f"select model, {i} as bin, '{label}' as label, count(*) filter (abs(y - y_pred) > {a} "
        f"and abs(y - y_pred) <= {b}) as \"count\", "
        + R(f"100.0 * count(*) filter (abs(y - y_pred) > {a} and abs(y - y_pred) <= {b}) "
            "/ count(*)") + f" as pct from {PREDICTIONS} group by model"
        for i, (a, b, label) in enumerate(_BINS)),
    "residual_histogram": f"""with t as (select model, y - y_pred as v from {PREDICTIONS}),
s as (select model, min(v) lo, (max(v) - min(v)) / 40 w from t group by 1),
g as (select s.*, unnest(range(40)) bin from s),
c as (select model, least(floor((v - lo) / w), 39) bin, count(*) n
      from t join s using (model) group by all)
select g.model, cast(g.bin as integer) bin, {R('lo + g.bin * w')} bin_start,
{R('lo + (g.bin + 1) * w')} bin_end, coalesce(c.n, 0) as "count"
from g left join c on g.bin = c.bin and g.model = c.model""",
    "qq_line": f"""with t as (select model, y - y_pred as e from {PREDICTIONS}),
{_QQ.format(part='partition by model', ppf=normal_ppf_sql('p'))}
select model, {R('regr_slope(e, x)')} as slope, {R('regr_intercept(e, x)')} as intercept,
{R('corr(e, x)')} as r from z group by model""",
    "qq_points": f"""with t as (select {LABEL} - ({FORMULAS['price']}) as e from lineitem),
{_QQ.format(part='', ppf=normal_ppf_sql('p'))}
select {R('x')} as theoretical, {R('e')} as ordered from z""",
    "prediction_points": f"""select {KEY_SQL}, {R('y')} as y, {R('y_pred')} as y_pred,
{R('y - y_pred')} as residual, abs(y - y_pred) <= 1 as within_1 from {PREDICTIONS}
where model = 'tax'""",
    "prediction_range": f"""select segment, model, {R('least(min(y), min(y_pred))')} as low,
{R('greatest(max(y), max(y_pred))')} as high,
count(*) filter (abs(y - y_pred) <= 1) as within_1 from {PREDICTIONS} group by all""",
    "fit_quality": f"""with {_M} select segment, model, case when r2 > 0.8 then 'excellent'
when r2 > 0.6 then 'good' when r2 > 0.4 then 'moderate' else 'poor' end as quality,
case when rmse < 0.3 then 'balanced' when rmse < 0.5 then 'slight overfitting'
else 'significant overfitting' end as gap_label from m""",
    "evaluation_report": f"""select model, count(*) as n_samples, {R(_RAW['rmse'])} as rmse,
{R('quantile_cont(y - y_pred, 0.5)')} as median, {R('stddev_pop(y_pred)')} as pred_std,
count(*) filter (abs(y - y_pred) <= 1) as within_1_0 from {PREDICTIONS} group by model""",
    "compare_models": f"with {_M} select segment, model, n, {_round_all(METRICS)}, "
                      f"rmse_rank, mae_rank, r2_rank from (select *, {_ranks('segment')} from m)",
    "rank_average": f"with m0 as ({_metrics('model')}), m as (select * from m0 union all "
                    "select * replace ('tax_again' as model) from m0 where model = 'tax') "
                    f"select model, rmse_rank, mae_rank, r2_rank from (select *, {_ranks('')} "
                    "from m)",
    "best_model": f"with {_M} " + " union all ".join(
        f"select * from (select distinct on (segment) segment, model as best_model, "
        f"{R(x)} as \"value\", '{x}' as metric from m order by segment, "
        f"{x} {'desc' if x == 'r2' else 'asc'}, {model_case()})" for x in C.METRICS),
    "winners": f"with {_M} select distinct segment, {_winner('rmse')} as best_rmse, "
               f"{_winner('mae')} as best_mae, {_winner('r2', 'desc')} as best_r2 from m",
    "pairwise_diff": _diff(_WIDE, "segment"),
    "wide_diff": _diff(_WIDE, ""),
    "label_mismatches": f"select {KEY_SQL}, {LABEL} as smallest, {LABEL} + 1 as largest "
                        f"from {LINEITEM} where l_linenumber = 3",
    "radar": f"with {_M} select segment, model, " + ", ".join(
        R(f"1 - ({c} - min({c}) over (partition by segment)) / (max({c}) over (partition by "
          f"segment) - min({c}) over (partition by segment) + 1e-10)") + f" as {c}_norm"
        for c in ("rmse", "mae", "mape")) + f", {R('r2')} as r2_norm from m",
    "metrics_pivot": f"with {_G} " + " union all ".join(
        f"select '{x}' as metric, " + ", ".join(
            f"{R(f'''max({x}) filter (model = '{m}')''')} as {m}"
            if (x, m) != ("mae", "tax") else f"cast(null as double) as {m}"
            for m in MODELS) + " from m" for x in ("rmse", "mae", "r2")),
    "metrics_outer_diff": f"""with {_G}, a as (select * from m where model = 'price'),
b as (select * from m where model = 'discount')
select 'rmse' as metric, {R('a.rmse')} as value_a, {R('b.rmse')} as value_b,
{R('b.rmse - a.rmse')} as difference from a, b
union all select 'r2', {R('a.r2')}, null, null from a, b
union all select 'mae', null, {R('b.mae')}, null from a, b""",
    "metric_grades": f"""with {_M} select segment, model,
case when rmse < 0.9 then 'success' when rmse < 1.2 then 'warning' else 'danger' end as rmse_grade,
case when mae < 0.7 then 'success' when mae < 1 then 'warning' else 'danger' end as mae_grade,
case when r2 > 0.7 then 'success' when r2 > 0.5 then 'warning' else 'danger' end as r2_grade
from m""",
    "model_points": f"select {R(LABEL)} as y, {R(FORMULAS['discount'])} as y_pred from lineitem",
    "comparison_report": f"""with {_M} select distinct segment, cast(3 as bigint) as n_models,
{_winner('rmse')} as best, {_winner('mae')} as best_mae, cast(3 as integer) as pairs,
'{','.join(MODELS)}' as models from m""",
}
