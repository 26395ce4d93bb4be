"""Ridge and Lasso: fits, grid search, cross-validation and learning curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import KEY, KEY_SQL, LINEITEM, R, lineitem, rounded, table
from tabulon.operators import linear as L
from tabulon.operators import split as S
from tabulon.plans.pipeline import PlanSettings, quick_training, run_plan
from tabulon.session import scratch_path

# Two features of the value net of discount, in thousands.
TWO = ["price", "discount"]
TWO_COLUMNS = ["l_extendedprice / 1000 as price", "l_discount * 100 as discount",
               "l_extendedprice * (1 - l_discount) / 1000 as net"]
ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
FOLDS = 5
# More features, as many kinds as the data has.
MANY_COLUMNS = [
    "l_quantity", "l_extendedprice / 1000 as price", "l_discount * 100 as discount",
    "l_tax * 100 as tax", "cast(l_returnflag = 'R' as double) as returned",
    "cast(l_returnflag = 'A' as double) as accepted",
    "cast(l_linestatus = 'O' as double) as open", "cast(l_linenumber as double) as line",
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 as net"]
MANY = ["l_quantity", "price", "discount", "tax", "returned", "accepted", "open", "line"]


def _two(spark, sf):
    return lineitem(spark, sf).selectExpr(*KEY, *TWO_COLUMNS)


def _two_folds(spark, sf):
    return S.kfold(_two(spark, sf), KEY, FOLDS)


def _many(spark, sf):
    return S.kfold(lineitem(spark, sf).selectExpr(*KEY, *MANY_COLUMNS), KEY, FOLDS)


def _fitted(spark, model):
    rows = [(f, w) for f, w in zip(model.features, model.coefficients)]
    return rounded(spark.createDataFrame(rows + [("intercept", model.intercept)],
                                         "term string, value double"), ["value"], 5)


def ridge_fit_2f(spark, sf):
    return _fitted(spark, L.fit_linear(_two(spark, sf), TWO, "net", "ridge", 10.0))


def ridge_fit_mllib(spark, sf):
    return _fitted(spark, L.mllib_model(_two(spark, sf), TWO, "net", "ridge", 10.0))


def lasso_fit_1f(spark, sf):
    return _fitted(spark, L.fit_linear(_two(spark, sf), ["price"], "net", "lasso", 2.0))


def lasso_fit_mllib(spark, sf):
    return _fitted(spark, L.mllib_model(_two(spark, sf), ["price"], "net", "lasso", 2.0))


def ridge_grid_2f(spark, sf):
    df = _two_folds(spark, sf)
    scores = L.grid_scores(spark, L.products(df, TWO, "net", F.col("fold")), "ridge", ALPHAS)
    return rounded(scores.select("alpha", "fold", "train_mse", "test_mse"),
                   ["train_mse", "test_mse"], 5)


def ridge_cv_2f(spark, sf):
    out = L.cross_validate(_two_folds(spark, sf), TWO, "net", "fold", "ridge", 10.0)
    return rounded(out, [c for c in out.columns if c != "part"], 5)


def ridge_predict(spark, sf):
    df = _two(spark, sf)
    model = L.fit_linear(df, TWO, "net", "ridge", 10.0)
    return rounded(model.predict(df).select(*KEY, "prediction"), ["prediction"], 4)


def ridge_fit(spark, sf):
    return _fitted(spark, L.fit_linear(_many(spark, sf), MANY, "net", "ridge", 1.0))


def lasso_fit(spark, sf):
    return _fitted(spark, L.fit_linear(_many(spark, sf), MANY, "net", "lasso", 0.1))


def grid_search_ridge(spark, sf):
    _, scores = L.grid_search(_many(spark, sf), MANY, "net", "fold", "ridge", L.RIDGE_GRID)
    return rounded(L.grid_table(scores).drop("position"), [
        "mean_test_mse", "std_test_mse", "mean_train_mse", "std_train_mse"], 5)


def grid_search_lasso(spark, sf):
    _, scores = L.grid_search(_many(spark, sf), MANY, "net", "fold", "lasso", L.LASSO_GRID)
    return rounded(L.grid_table(scores).drop("position"), [
        "mean_test_mse", "std_test_mse", "mean_train_mse", "std_train_mse"], 5)


def cross_validate(spark, sf):
    out = L.cross_validate(_many(spark, sf), MANY, "net", "fold", "lasso", 0.1)
    return rounded(out, [c for c in out.columns if c != "part"], 5)


def learning_curve(spark, sf):
    df = S.kfold(lineitem(spark, sf).selectExpr(*KEY, *MANY_COLUMNS), KEY, 3)
    df = S.learning_subsets(df, KEY, "fold", 3)
    return rounded(L.learning_curve(df, MANY, "net", "steps_from", 3),
                   ["train_rmse", "train_band", "val_rmse", "val_band"], 5)


def learning_curve_2f(spark, sf):
    df = S.learning_subsets(S.kfold(_two(spark, sf), KEY, 3), KEY, "fold", 3)
    return rounded(L.learning_curve(df, TWO, "net", "steps_from", 3, 10, "ridge", 10.0),
                   ["train_rmse", "train_band", "val_rmse", "val_band"], 5)


def coefficient_table(spark, sf):
    model = L.fit_linear(_many(spark, sf), MANY, "net", "lasso", 0.1)
    return rounded(model.coefficient_table(spark), ["coefficient", "abs_coefficient"], 5)


def feature_importance(spark, sf):
    model = L.fit_linear(_two(spark, sf), TWO, "net", "ridge", 10.0)
    return rounded(model.importance(spark, 1).select("feature", "coefficient", "rank"),
                   ["coefficient"], 5)


def model_info(spark, sf):
    """Facts of a stored and re-read Lasso whose penalty leaves one feature out."""
    model = L.fit_linear(_two(spark, sf), TWO, "net", "lasso", 10.0)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    info = L.load_model(spark, path).info()
    return spark.createDataFrame(
        [(info["model_type"], info["alpha"], info["n_features"], info["non_zero"],
          info["sparsity"], info["metadata"]["train_samples"])],
        "model_type string, alpha double, n_features bigint, non_zero bigint, "
        "sparsity double, train_samples bigint")


def full_plan(spark, sf):
    """All steps on orders joined to customers: metrics of both tuned models."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    raw = orders.selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_acctbal",
        "year(o_orderdate) as order_year", "10 + o_totalprice / 50000 + c_acctbal / 3000 "
        "+ cast(o_orderstatus = 'F' as double) as score", "o_totalprice")
    plan = run_plan(raw, PlanSettings(
        "score", ("o_orderkey",), exclude=("o_totalprice",), strata=("o_orderstatus",),
        store_input=True))
    return rounded(plan.comparison, [
        "rmse", "mae", "r2", "mape", "mse", "max_error", "mean_residual", "std_residual"], 5)


def quick_plan(spark, sf):
    raw = lineitem(spark, sf).selectExpr(*KEY, *MANY_COLUMNS)
    _, scores = quick_training(raw, "net", KEY, alpha=1.0)
    return rounded(scores, ["rmse", "mae", "r2", "mape", "train_r2", "test_r2"], 5)


QUERIES = {f.__name__: f for f in (
    ridge_fit_2f, ridge_fit_mllib, lasso_fit_1f, lasso_fit_mllib, ridge_grid_2f, ridge_cv_2f,
    ridge_predict, ridge_fit, lasso_fit, grid_search_ridge, grid_search_lasso, cross_validate,
    learning_curve, learning_curve_2f, coefficient_table, feature_importance, model_info, full_plan, quick_plan)}

_TWO = f"(select {KEY_SQL}, {', '.join(TWO_COLUMNS)} from {LINEITEM})"
# Sums of centred products over the rows of a group.
_SUMS = """count(*) n, avg(price) m1, avg(discount) m2, avg(net) my,
var_pop(price) * count(*) s11, var_pop(discount) * count(*) s22,
covar_pop(price, discount) * count(*) s12, covar_pop(price, net) * count(*) s1y,
covar_pop(discount, net) * count(*) s2y"""
_RIDGE = """((s22 + a) * s1y - s12 * s2y) / ((s11 + a) * (s22 + a) - s12 * s12) w1,
((s11 + a) * s2y - s12 * s1y) / ((s11 + a) * (s22 + a) - s12 * s12) w2"""
_FIT = f"""s as (select {_SUMS}, 10e0 a from t), w as (select *, {_RIDGE} from s),
m as (select *, my - w1 * m1 - w2 * m2 b from w)"""
_RIDGE_FIT = f"""with t as {_TWO}, {_FIT}
select 'price' as term, {R('w1', 5)} as "value" from m
union all select 'discount', {R('w2', 5)} from m union all select 'intercept', {R('b', 5)} from m"""
_LASSO_FIT = f"""with t as {_TWO}, s as (select avg(price) mx, avg(net) my, var_pop(price) v,
  covar_pop(price, net) c from t),
m as (select *, sign(c) * greatest(abs(c) - 2, 0) / v w from s)
select 'price' as term, {R('w', 5)} as "value" from m
union all select 'intercept', {R('my - w * mx', 5)} from m"""


def _by_fold(alphas: str) -> str:
    """Errors of every row under the model of every fold it can be scored with."""
    return f"""with t as (select *, cast(ntile({FOLDS}) over (order by {KEY_SQL}) - 1 as integer)
  fold from {_TWO}),
a as (select unnest([{alphas}])::double a),
f as (select cast(range as integer) f from range({FOLDS})),
s as (select f, {_SUMS} from t, f where fold <> f group by f),
w as (select s.*, a, {_RIDGE} from s, a),
m as (select *, my - w1 * m1 - w2 * m2 b from w),
e as (select a, f, fold = f as test, net, net - b - w1 * price - w2 * discount as e from t, m)"""


SQL = {
    "ridge_fit_2f": _RIDGE_FIT,
    "ridge_fit_mllib": _RIDGE_FIT,
    "lasso_fit_1f": _LASSO_FIT,
    "lasso_fit_mllib": _LASSO_FIT,
    "ridge_grid_2f": _by_fold(", ".join(map(str, ALPHAS)))
    + f""" select a as alpha, f as fold, {R('avg(e * e) filter (not test)', 5)} as train_mse,
{R('avg(e * e) filter (test)', 5)} as test_mse from e group by a, f""",
    "ridge_cv_2f": _by_fold("10") + f""",
p as (select f, case when test then 'test' else 'train' end as part, avg(e * e) mse,
  avg(abs(e)) mae, 1 - avg(e * e) / var_pop(net) r2 from e group by f, test)
select part, {R('avg(mse)', 5)} as mse_mean, {R('stddev_pop(mse)', 5)} as mse_std,
{R('avg(mae)', 5)} as mae_mean, {R('stddev_pop(mae)', 5)} as mae_std,
{R('avg(r2)', 5)} as r2_mean, {R('stddev_pop(r2)', 5)} as r2_std from p group by part""",
    "ridge_predict": f"""with t as {_TWO}, {_FIT}
select {KEY_SQL}, {R('b + w1 * price + w2 * discount', 4)} as prediction from t, m""",
    "learning_curve_2f": f"""with t as (select *, cast(ntile(3) over (order by {KEY_SQL}) - 1
  as integer) fold, md5(concat_ws('|', {KEY_SQL}, '42')) h from {_TWO}),
f as (select cast(range as integer) f from range(3)),
r as (select t.*, f, row_number() over (partition by f order by h) rn,
  count(*) over (partition by f) n_all from t, f where fold <> f),
k as (select r.*, cast(k.range as integer) step from r, range(1, 11) k
  where rn <= (n_all * k.range) // 10),
s as (select f, step, {_SUMS}, 10e0 a from k group by f, step),
w as (select *, {_RIDGE} from s),
m as (select *, my - w1 * m1 - w2 * m2 b from w),
e as (select m.f, m.step, avg((net - b - w1 * price - w2 * discount) ** 2) train,
  any_value(m.n) n from k join m on k.f = m.f and k.step = m.step group by m.f, m.step),
v as (select m.f, m.step, avg((net - b - w1 * price - w2 * discount) ** 2) val
  from t join m on t.fold = m.f group by m.f, m.step)
select step, min(n) as train_rows, {R('sqrt(avg(train))', 5)} as train_rmse,
{R('sqrt(stddev_pop(train))', 5)} as train_band, {R('sqrt(avg(val))', 5)} as val_rmse,
{R('sqrt(stddev_pop(val))', 5)} as val_band from e join v using (f, step) group by step""",
    "feature_importance": f"""with t as {_TWO}, {_FIT}
select case when abs(w1) >= abs(w2) then 'price' else 'discount' end as feature,
{R('case when abs(w1) >= abs(w2) then w1 else w2 end', 5)} as coefficient,
cast(1 as integer) as "rank" from m""",
    "model_info": "select 'lasso' as model_type, cast(10 as double) as alpha, "
                  "cast(2 as bigint) as n_features, cast(1 as bigint) as non_zero, "
                  "cast(0.5 as double) as sparsity, count(*) as train_samples from lineitem",
}
