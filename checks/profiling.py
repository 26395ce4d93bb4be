"""Profiling and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import KEY, KEY_SQL, LINEITEM, NULLED, R, lineitem, nulled, rounded, table
from tabulon.operators import profile as P
from tabulon.operators import validate as V

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATS = ["mean", "std", "min", "q25", "median", "q75", "max", "skewness", "kurtosis"]
NULL_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _each(template: str, names, **more) -> str:
    return " union all ".join(template.format(c=c, **more) for c in names)


def preview(spark, sf):
    return P.preview(lineitem(spark, sf).select(*KEY, "l_quantity", "l_returnflag")
                     .orderBy(*KEY), 25)


def table_info(spark, sf):
    df = nulled(spark, sf).select("l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    return rounded(P.table_info(df).drop("dtype"), ["null_pct"])


def null_profile(spark, sf):
    return rounded(P.null_profile(nulled(spark, sf)).drop("dtype"), ["null_pct"])


def duplicate_rows(spark, sf):
    return P.duplicate_rows(nulled(spark, sf).select(
        "l_quantity", "l_discount", "l_returnflag", "l_linestatus"))


def duplicate_rows_wide(spark, sf):
    """Whole rows: none or hardly any repeat."""
    return P.duplicate_rows(table(spark, sf, "lineitem"))


def distinct_counts(spark, sf):
    return P.distinct_counts(nulled(spark, sf), NULL_COLUMNS)


def quality_report(spark, sf):
    return rounded(P.quality_report(nulled(spark, sf), 3).drop("dtype"), ["null_pct"])


def numeric_summary(spark, sf):
    return rounded(P.numeric_summary(lineitem(spark, sf), NUMBERS), STATS, 4)


def describe_target(spark, sf):
    return rounded(P.describe(table(spark, sf, "orders"), "o_totalprice"), STATS[:-2], 3)


def categorical_summary(spark, sf):
    out = P.categorical_summary(table(spark, sf, "part"), ["p_brand", "p_name"], 5)
    text = F.transform("top_categories", lambda t: F.concat_ws(
        "=", t["value"], t["count"].cast("string")))
    return out.withColumn("top_categories", F.array_join(text, ","))


def value_counts_topk(spark, sf):
    return P.value_counts(table(spark, sf, "part"), ["p_brand", "p_type", "p_name"], 10)


def value_counts_summaries(spark, sf):
    """Columns with a value for each row, and one with hot values, by the tasks' summaries."""
    df = table(spark, sf, "customer").selectExpr(
        "c_name", "c_mktsegment", "if(c_custkey % 3 = 0, 'hot', c_name) as mixed")
    return P.value_counts(df, ["c_name", "c_mktsegment", "mixed"], 10, few_values=0)


def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "customer"), "c_mktsegment")


def distinct_values(spark, sf):
    return P.distinct_values(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


def target_correlations(spark, sf):
    df = lineitem(spark, sf).selectExpr(
        *NUMBERS, "l_extendedprice * (1 - l_discount) as net", "1.0 * 3 as constant")
    return rounded(P.target_correlations(df, "net", [*NUMBERS, "constant"]), ["correlation"])


def correlation_matrix(spark, sf):
    return rounded(P.correlation_matrix(nulled(spark, sf), NUMBERS), ["correlation"])


def _sixty() -> list[tuple[str, str]]:
    """Sixty columns with nulls of their own, among them a constant and one without values."""
    base = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]
    made = [(f"x{i}", f"case when (l_orderkey + {i} * l_linenumber) % {3 + i % 7} > 0 then "
                      f"{base[i % 6]} * {1 + i % 4} + {i} * l_linenumber end")
            for i in range(58)]
    return [*made, ("x58", "5.0"), ("x59", "cast(null as double)")]


def correlation_matrix_nulls(spark, sf):
    """Pairwise-complete correlations of sixty columns in one scan."""
    df = table(spark, sf, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in _sixty()])
    return rounded(P.correlation_matrix(df), ["correlation"], 5)


def dataset_card(spark, sf):
    return rounded(P.dataset_card(table(spark, sf, "orders"), "o_totalprice"),
                   ["target_mean", "target_std", "target_min", "target_max"], 3)


def histogram40(spark, sf):
    return rounded(P.histogram(table(spark, sf, "orders"), "o_totalprice"),
                   ["bin_start", "bin_end"], 4)


def histogram_by_group(spark, sf):
    return rounded(P.histogram(table(spark, sf, "customer"), "c_acctbal", 12,
                               ["c_mktsegment"]), ["bin_start", "bin_end"], 4)


def boxplot_stats(spark, sf):
    out = P.box_stats(table(spark, sf, "customer"), ["c_nationkey"], "c_acctbal")
    return rounded(out, ["min", "q25", "median", "q75", "max", "whisker_low", "whisker_high"], 4)


def table_check(spark, sf):
    """Outcome of the table check, next to the number of rows it is about."""
    orders = table(spark, sf, "orders")
    found = V.check_table(orders, ["o_orderkey", "o_comment"], 10)
    return orders.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(found.ok).alias("ok"), F.lit("; ".join(found.problems)).alias("problems"))


def model_input_nulls(spark, sf):
    return V.model_input_nulls(nulled(spark, sf), ["l_quantity", "l_discount", "l_returnflag"],
                               "l_tax")


def target_range(spark, sf):
    return V.target_range(table(spark, sf, "orders"), "o_totalprice", 1000, 400000)


REQUEST = [
    "o_orderkey",
    "case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then '' "
    "else o_orderpriority end as priority",
    "case when o_orderkey % 17 = 0 then 'abc' when o_orderkey % 19 = 0 then null "
    "else cast(o_orderkey % 400 as {text}) end as credits",
    "year(o_orderdate) as grad_year",
    "year(o_orderdate) - (o_orderkey % 6) + 1 as enrol_year",
]
RULES = V.RowRules(text=["priority", "campus"], numeric=["credits", "grad_year"],
                   ranges=[("grad_year", 1996, 2000), ("credits", 0, 300)],
                   ordered=[("enrol_year", "grad_year")])


def validate_rows(spark, sf):
    req = table(spark, sf, "orders").selectExpr(*[c.format(text="string") for c in REQUEST])
    out = V.row_errors(req, RULES)
    return out.select("o_orderkey", F.array_join("errors", "; ").alias("errors"), "is_valid")


QUERIES = {f.__name__: f for f in (
    preview, table_info, null_profile, duplicate_rows, duplicate_rows_wide,
    distinct_counts, quality_report,
    numeric_summary, describe_target, categorical_summary, value_counts_topk, value_counts,
    value_counts_summaries, correlation_matrix_nulls,
    distinct_values, target_correlations, correlation_matrix, dataset_card, histogram40,
    histogram_by_group, boxplot_stats, table_check, model_input_nulls, target_range,
    validate_rows)}

_PCT = R("100.0 * count(*) filter ({c} is null) / count(*)")
_HIST = """with s as (select {by} min({v}) lo, (max({v}) - min({v})) / {n} w from {t} {group}),
g as (select s.*, unnest(range({n})) bin from s),
c as (select {byt} least(floor(({v} - s.lo) / s.w), {n} - 1) bin, count(*) n
      from {t} t {join} group by all)
select {byg} cast(g.bin as integer) bin, {start} bin_start, {end} bin_end,
       coalesce(c.n, 0) as "count"
from g left join c on g.bin = c.bin {and_by}"""

SQL = {
    "preview": f"select {KEY_SQL}, l_quantity, l_returnflag from {LINEITEM} "
               f"order by {KEY_SQL} limit 25",
    "null_profile": _each(
        "select '{c}' as \"column\", count(*) filter ({c} is null) as null_count, "
        + _PCT + " as null_pct from {t}", NULL_COLUMNS, t=NULLED),
    "table_info": f"""with t as (select l_quantity, l_discount, l_returnflag, l_linestatus
                                 from {NULLED}),
d as (select count(*) total_rows, (select count(*) from t) - count(*) as dups
      from (select distinct * from t))
select p.*, (select count(*) from t) as total_rows, cast(4 as bigint) as total_columns,
       (select dups from d) as duplicate_rows
from (""" + _each("select '{c}' as \"column\", count(*) filter ({c} is null) as null_count, "
                  + _PCT + " as null_pct from t",
                  ["l_quantity", "l_discount", "l_returnflag", "l_linestatus"]) + ") p",
    "duplicate_rows": f"""with t as (select l_quantity, l_discount, l_returnflag, l_linestatus
                                     from {NULLED})
select (select count(*) from t) as total_rows,
       (select count(*) from t) - (select count(*) from (select distinct * from t))
       as duplicate_rows""",
    "duplicate_rows_wide": """select count(*) as total_rows, count(*) - (select count(*) from
(select distinct * from lineitem)) as duplicate_rows from lineitem""",
    "distinct_counts": _each("select '{c}' as \"column\", count(distinct {c}) as distinct_count "
                             "from {t}", NULL_COLUMNS, t=NULLED),
    "quality_report": "select * from (" + _each(
        "select '{c}' as \"column\", count(*) filter ({c} is null) as null_count, "
        + _PCT + " as null_pct from {t}", NULL_COLUMNS, t=NULLED)
        + ") where null_count > 0 order by null_count desc, \"column\" limit 3",
    "numeric_summary": _each(
        "select '{c}' as \"column\", count({c}) as \"count\", "
        + ", ".join(R(e, 4) + f" as {n}" for e, n in (
            ("avg({c})", "mean"), ("stddev_samp({c})", "std"), ("min({c})", "\"min\""),
            ("quantile_cont({c}, 0.25)", "q25"), ("quantile_cont({c}, 0.5)", "median"),
            ("quantile_cont({c}, 0.75)", "q75"), ("max({c})", "\"max\""),
            ("skewness({c})", "skewness"), ("kurtosis({c})", "kurtosis")))
        + " from lineitem", NUMBERS),
    "describe_target": "select 'o_totalprice' as \"column\", count(o_totalprice) as \"count\", "
        + ", ".join(R(e, 3) + f" as {n}" for e, n in (
            ("avg(o_totalprice)", "mean"), ("stddev_samp(o_totalprice)", "std"),
            ("min(o_totalprice)", "\"min\""), ("quantile_cont(o_totalprice, 0.25)", "q25"),
            ("quantile_cont(o_totalprice, 0.5)", "median"),
            ("quantile_cont(o_totalprice, 0.75)", "q75"), ("max(o_totalprice)", "\"max\"")))
        + " from orders",
    "categorical_summary": " union all ".join(f"""
select * from (with c as (select {c} v, count(*) n from part where {c} is not null group by 1),
r as (select v, n, row_number() over (order by n desc, v) rn from c)
select '{c}' as "column", (select count(*) from c) as total_unique,
  (select v from r where rn = 1) as most_frequent,
  (select n from r where rn = 1) as most_frequent_count,
  (select string_agg(v || '=' || n, ',' order by rn) from r where rn <= 5) as top_categories)"""
                                              for c in ("p_brand", "p_name")),
    "value_counts_topk": " union all ".join(f"""
select * from (select '{c}' as "column", {c} as "value", count(*) as "count" from part
group by {c} order by count(*) desc, {c} limit 10)""" for c in ("p_brand", "p_type", "p_name")),
    "value_counts_summaries": " union all ".join(f"""
select * from (select '{c}' as "column", v as "value", count(*) as "count"
from (select {e} as v from customer) group by v order by count(*) desc, v limit 10)"""
        for c, e in (("c_name", "c_name"), ("c_mktsegment", "c_mktsegment"),
                     ("mixed", "case when c_custkey % 3 = 0 then 'hot' else c_name end"))),
    "value_counts": "select 'c_mktsegment' as \"column\", c_mktsegment as \"value\", "
                    "count(*) as \"count\" from customer group by c_mktsegment",
    "distinct_values": " union all ".join(
        f"select distinct '{c}' as \"column\", {c} as \"value\" from orders"
        for c in ("o_orderpriority", "o_orderstatus")),
    "target_correlations": _each(
        "select '{c}' as \"column\", " + R("corr({c}, l_extendedprice * (1 - l_discount))")
        + " as correlation from lineitem", NUMBERS),
    "correlation_matrix": " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, {R(f'corr({a}, {b})')} as correlation "
        f"from {NULLED}" for a in NUMBERS for b in NUMBERS),
    "correlation_matrix_nulls": "with t as (select " + ", ".join(
        f"cast({e} as double) as {c}" for c, e in _sixty()) + " from lineitem), r as (select "
    + ", ".join(f"corr({a}, {b}) as {a}_{b}" for i, (a, _) in enumerate(_sixty())
                for b, _ in _sixty()[i:]) + " from t), l as (unpivot r on * into name p value r)"
    + """, n as (select split_part(p, '_', 1) as a, split_part(p, '_', 2) as b,
  case when isfinite(r) then round(r, 5) end as r from l),
every as (select 'x' || i.range as a, 'x' || j.range as b from range(60) i, range(60) j)
select e.a as column_a, e.b as column_b, n.r as correlation from every e
left join n on (n.a = e.a and n.b = e.b) or (n.a = e.b and n.b = e.a and e.a <> e.b)""",
    "dataset_card": f"""select count(*) as total_rows, cast(6 as bigint) as total_columns,
{R('avg(o_totalprice)', 3)} as target_mean, {R('stddev_samp(o_totalprice)', 3)} as target_std,
{R('min(o_totalprice)', 3)} as target_min, {R('max(o_totalprice)', 3)} as target_max
from orders""",
    "histogram40": _HIST.format(
        by="", v="o_totalprice", n=40, t="orders", group="", byt="", join="cross join s",
        byg="", and_by="", start=R("g.lo + g.bin * g.w", 4), end=R("g.lo + (g.bin + 1) * g.w", 4)),
    "histogram_by_group": _HIST.format(
        by="c_mktsegment,", v="c_acctbal", n=12, t="customer", group="group by 1",
        byt="s.c_mktsegment,", join="join s on s.c_mktsegment = t.c_mktsegment",
        byg="g.c_mktsegment,", and_by="and g.c_mktsegment = c.c_mktsegment",
        start=R("g.lo + g.bin * g.w", 4), end=R("g.lo + (g.bin + 1) * g.w", 4)),
    "boxplot_stats": f"""with q as (select c_nationkey, quantile_cont(c_acctbal, 0.25) q1,
  quantile_cont(c_acctbal, 0.5) q2, quantile_cont(c_acctbal, 0.75) q3 from customer group by 1)
select c.c_nationkey, count(*) as "count", {R('min(c_acctbal)', 4)} as "min",
  {R('min(q1)', 4)} as q25, {R('min(q2)', 4)} as median, {R('min(q3)', 4)} as q75,
  {R('max(c_acctbal)', 4)} as "max",
  {R('min(c_acctbal) filter (c_acctbal >= q1 - 1.5 * (q3 - q1))', 4)} as whisker_low,
  {R('max(c_acctbal) filter (c_acctbal <= q3 + 1.5 * (q3 - q1))', 4)} as whisker_high,
  count(*) filter (c_acctbal < q1 - 1.5 * (q3 - q1) or c_acctbal > q3 + 1.5 * (q3 - q1))
    as outliers
from customer c join q on c.c_nationkey = q.c_nationkey group by c.c_nationkey""",
    "table_check": "select count(*) as \"rows\", false as ok, "
                   "'missing columns: o_comment' as problems from orders",
    "model_input_nulls": "select * from (" + _each(
        "select '{c}' as \"column\", count(*) filter ({c} is null) as null_count from {t}",
        ["l_quantity", "l_discount", "l_returnflag", "l_tax"], t=NULLED)
        + ") where null_count > 0",
    "target_range": """select true as "numeric", count(*) filter (o_totalprice < 1000) as below,
count(*) filter (o_totalprice > 400000) as above,
count(*) filter (o_totalprice < 1000 or o_totalprice > 400000) = 0 as ok from orders""",
    "validate_rows": f"""with r as (select {', '.join(c.format(text='varchar') for c in REQUEST)}
  from orders),
e as (select o_orderkey, list_filter([
  case when priority is null or priority = '' then 'Feature vacío: priority' end,
  'Feature faltante: campus',
  case when credits is null then 'Feature vacío: credits'
       when try_cast(credits as double) is null then 'Feature credits debe ser numérico' end,
  case when grad_year < 1996 or grad_year > 2000
       then 'grad_year debe estar entre 1996 y 2000' end,
  case when try_cast(credits as double) < 0 or try_cast(credits as double) > 300
       then 'credits debe estar entre 0 y 300' end,
  case when enrol_year > grad_year then 'enrol_year no puede ser mayor que grad_year' end],
  lambda x: x is not null) as m from r)
select o_orderkey, array_to_string(m, '; ') as errors, len(m) = 0 as is_valid from e""",
}
