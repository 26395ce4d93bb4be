"""Missing values, outliers, types and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import KEY, KEY_SQL, LINEITEM, NULLED, R, lineitem, nulled, rounded, table
from tabulon.operators import clean as C

FILLED = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
CHECKED = ["l_quantity", "l_extendedprice", "price_per_unit"]
UNIT = "l_extendedprice / l_quantity as price_per_unit"


def _roles(df):
    return C.identify_roles(df, "l_extendedprice", KEY)


def identify_roles(spark, sf):
    """Role of each column, next to its number of values."""
    df = nulled(spark, sf)
    roles = _roles(df)
    of = {c: "numeric" for c in roles.numeric} | {c: "categorical" for c in roles.categorical}
    of |= {c: "excluded" for c in roles.excluded} | {roles.target: "target"}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(of[c]).alias("role"),
                               F.col(f"n_{c}").alias("n")) for c in of])
    return (df.agg(*[F.count(c).alias(f"n_{c}") for c in of])
            .select(F.explode(cells).alias("s")).select("s.*"))


def drop_null_target(spark, sf):
    return C.drop_null_target(nulled(spark, sf), "l_tax").select(*KEY, "l_tax")


def drop_null_rows(spark, sf):
    return C.drop_null_rows(nulled(spark, sf))


def drop_null_columns(spark, sf):
    """Columns left after dropping those with more than half null, with their values."""
    df = C.drop_sparse_columns(nulled(spark, sf), 0.5)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"))
                      for c in df.columns])
    return (df.agg(*[F.count(c).alias(f"n_{c}") for c in df.columns])
            .select(F.explode(cells).alias("s")).select("s.*"))


def keep_filled_columns(spark, sf):
    df = C.keep_filled_columns(nulled(spark, sf), 0.75)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"))
                      for c in df.columns])
    return (df.agg(*[F.count(c).alias(f"n_{c}") for c in df.columns])
            .select(F.explode(cells).alias("s")).select("s.*"))


def handle_missing_drop(spark, sf):
    df = nulled(spark, sf)
    return C.handle_missing(df, _roles(df), "drop")


def _imputed(spark, sf, numeric, categorical):
    df = nulled(spark, sf)
    out = C.handle_missing(df, _roles(df), "impute", numeric_strategy=numeric,
                           categorical_strategy=categorical)
    return rounded(out.select(*KEY, *FILLED), ["l_discount", "l_tax"])


def impute_mean(spark, sf):
    return _imputed(spark, sf, "mean", "mode")


def impute_median(spark, sf):
    return _imputed(spark, sf, "median", "mode")


def impute_mode(spark, sf):
    return _imputed(spark, sf, "mode", "mode")


def impute_constant(spark, sf):
    return _imputed(spark, sf, "median", "constant")


def smart_impute(spark, sf):
    df = nulled(spark, sf)
    out = C.handle_missing(df, _roles(df), "smart")
    return rounded(out, ["l_discount", "l_tax"])


def iqr_filter(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, "l_quantity", "l_extendedprice", UNIT)
    return C.remove_outliers(df, CHECKED, "iqr", 1.5)


def iqr_counts(spark, sf):
    df = lineitem(spark, sf).selectExpr("l_quantity", "l_extendedprice", UNIT)
    return rounded(C.iqr_bounds(df, CHECKED, 0.5).counts(df), ["outlier_pct"])


def zscore_filter(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, "l_quantity", "l_extendedprice", UNIT)
    return C.remove_outliers(df, CHECKED, "zscore", 2.0)


def zscore_counts(spark, sf):
    df = lineitem(spark, sf).selectExpr("l_quantity", "l_extendedprice", UNIT)
    return rounded(C.zscore_bounds(df, CHECKED, 1.5).counts(df), ["outlier_pct"])


TEXT_NUMBER = ("case when l_linenumber % 3 = 0 then 'n/a' "
               "else cast(cast(l_quantity as int) as {text}) end as quantity_text")


def cast_numeric(spark, sf):
    df = lineitem(spark, sf).selectExpr(*KEY, TEXT_NUMBER.format(text="string"), "l_linestatus")
    roles = C.FeatureRoles(("quantity_text",), ("l_linestatus",), "cents")
    return C.convert_types(df, roles)


def dedupe(spark, sf):
    return C.drop_duplicates(lineitem(spark, sf).select(
        "l_quantity", "l_discount", "l_returnflag", "l_linestatus"))


def numeric_matrix(spark, sf):
    df = nulled(spark, sf).drop(*KEY)
    return rounded(C.numeric_matrix(df, "l_extendedprice"), ["l_discount", "l_tax"])


def feature_columns(spark, sf):
    return C.feature_columns(table(spark, sf, "orders"), "o_totalprice",
                             ["o_orderdate", "o_comment"])


def processing_log(spark, sf):
    df = nulled(spark, sf)
    log = C.ProcessingLog()
    log.add("start", "lineitem", df)
    df = C.handle_missing(df, _roles(df), "drop")
    log.add("missing values", "drop", df)
    df = C.remove_outliers(df, ["l_quantity"], "iqr", 0.2)
    log.add("outliers", "iqr", df)
    return log.table(df)


QUERIES = {f.__name__: f for f in (
    identify_roles, drop_null_target, drop_null_rows, drop_null_columns, keep_filled_columns,
    handle_missing_drop, impute_mean, impute_median, impute_mode, impute_constant,
    smart_impute, iqr_filter, iqr_counts, zscore_filter, zscore_counts, cast_numeric, dedupe,
    numeric_matrix, feature_columns, processing_log)}

_NOT_NULL = " and ".join(f"{c} is not null" for c in (
    "l_discount", "l_tax", "l_returnflag"))
_MODE = ("(select {c} from {t} where {c} is not null group by {c} "
         "order by count(*) desc, {c} limit 1)")


def _fill(numeric: str, categorical: str, more: str = "") -> str:
    def value(c: str) -> str:
        if c in ("l_discount", "l_tax"):
            how = {"mean": f"(select avg({c}) from {NULLED})",
                   "median": f"(select quantile_cont({c}, 0.5) from {NULLED})",
                   "mode": _MODE.format(c=c, t=NULLED)}[numeric]
            return R(f"coalesce({c}, {how})") + f" as {c}"
        how = "'DESCONOCIDO'" if categorical == "constant" else _MODE.format(c=c, t=NULLED)
        return f"coalesce({c}, {how}) as {c}"

    return (f"select {more}{KEY_SQL}, " + ", ".join(value(c) for c in FILLED) + f" from {NULLED}")


_UNIT = f"(select {KEY_SQL}, l_quantity, l_extendedprice, {UNIT} from {LINEITEM})"


def _iqr(c: str, k: float) -> str:
    low, high = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    return (f"{c} between (select {low} - {k} * ({high} - {low}) from t) "
            f"and (select {high} + {k} * ({high} - {low}) from t)")


def _z(c: str, k: float) -> str:
    return f"abs(({c} - (select avg({c}) from t)) / (select stddev_samp({c}) from t)) <= {k}"


def _outliers(inside) -> str:
    return f"with t as {_UNIT} select * from (" + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (not ({inside(c)})) as outliers, "
        + R(f"100.0 * count(*) filter (not ({inside(c)})) / count(*)")
        + " as outlier_pct from t" for c in CHECKED) + ") where outliers > 0"


def _inside(inside) -> str:
    return (f"with t as {_UNIT} select * from t where " + " and ".join(inside(c) for c in CHECKED))


_KEPT = "l_orderkey l_linenumber l_partkey l_suppkey cents l_quantity l_extendedprice".split()


def _value_counts(columns) -> str:
    return " union all ".join(f"select '{c}' as \"column\", count({c}) as n from {NULLED}"
                              for c in columns)


SQL = {
    "identify_roles": " union all ".join(
        f"select '{c}' as \"column\", '{r}' as role, count({c}) as n from {NULLED}"
        for r, cs in {"numeric": ["l_quantity", "l_discount", "l_tax"],
                      "categorical": ["l_returnflag", "l_linestatus"], "excluded": KEY,
                      "target": ["l_extendedprice"]}.items() for c in cs),
    "drop_null_target": f"select {KEY_SQL}, l_tax from {NULLED} where l_tax is not null",
    "drop_null_rows": f"select * from {NULLED} where {_NOT_NULL} and l_linestatus is not null",
    "drop_null_columns": _value_counts(
        [*_KEPT, "l_discount", "l_tax", "l_returnflag"]),
    "keep_filled_columns": _value_counts([*_KEPT, "l_discount", "l_tax", "l_returnflag"]),
    "handle_missing_drop":
        f"select * exclude (l_linestatus) from {NULLED} where {_NOT_NULL}",
    "impute_mean": _fill("mean", "mode"),
    "impute_median": _fill("median", "mode"),
    "impute_mode": _fill("mode", "mode"),
    "impute_constant": _fill("median", "constant"),
    "smart_impute": "select * exclude (l_linestatus) from ("
                    + _fill("median", "mode", "l_quantity, l_extendedprice, ") + ")",
    "iqr_filter": _inside(lambda c: _iqr(c, 1.5)),
    "iqr_counts": _outliers(lambda c: _iqr(c, 0.5)),
    "zscore_filter": _inside(lambda c: _z(c, 2.0)),
    "zscore_counts": _outliers(lambda c: _z(c, 1.5)),
    "cast_numeric": f"select {KEY_SQL}, try_cast(quantity_text as double) as quantity_text, "
                    f"l_linestatus from (select *, {TEXT_NUMBER.format(text='varchar')} "
                    f"from {LINEITEM})",
    "dedupe": "select distinct l_quantity, l_discount, l_returnflag, l_linestatus from lineitem",
    "numeric_matrix": f"select l_quantity, l_extendedprice, " + ", ".join(
        R(f"coalesce({c}, (select quantile_cont({c}, 0.5) from {NULLED}))") + f" as {c}"
        for c in ("l_discount", "l_tax")) + f" from {NULLED}",
    "feature_columns": "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority "
                       "from orders",
    "processing_log": f"""with a as (select * from {NULLED}),
b as (select * from a where {_NOT_NULL}),
c as (select * from b where l_quantity between
  (select quantile_cont(l_quantity, 0.25) - 0.2 * (quantile_cont(l_quantity, 0.75)
   - quantile_cont(l_quantity, 0.25)) from b) and
  (select quantile_cont(l_quantity, 0.75) + 0.2 * (quantile_cont(l_quantity, 0.75)
   - quantile_cont(l_quantity, 0.25)) from b))
select 1 as step, 'start' as "action", 'lineitem' as details,
       (select count(*) from a) as "rows", 11 as columns
union all select 2, 'missing values', 'drop', (select count(*) from b), 10
union all select 3, 'outliers', 'iqr', (select count(*) from c), 10""",
}
