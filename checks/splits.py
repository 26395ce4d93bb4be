"""Exact splits, folds and learning-curve prefixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import KEY, KEY_SQL, LINEITEM, lineitem, table
from tabulon.operators import split as S
from tabulon.operators.rowindex import with_row_index


def split_three_way(spark, sf):
    df = lineitem(spark, sf).select(*KEY, "l_returnflag")
    return S.three_way_split(df, KEY, ["l_returnflag"])


def split_sizes(spark, sf):
    df = S.three_way_split(lineitem(spark, sf), KEY, ["l_returnflag", "l_linestatus"])
    return df.groupBy("l_returnflag", "l_linestatus", "split").agg(
        F.count(F.lit(1)).alias("n"))


def split_many_strata(spark, sf):
    """Strata beyond the number handled on the driver."""
    df = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey % 60 as stratum")
    return S.three_way_split(df, ["o_orderkey"], ["stratum"], driver_strata=10)


def split_unstratified(spark, sf):
    return S.train_test_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


def kfold_assign(spark, sf):
    return S.kfold(lineitem(spark, sf).select(*KEY), KEY, 7)


def kfold_text(spark, sf):
    """Folds in the order of a text key, a tenth of which is null."""
    df = table(spark, sf, "customer").selectExpr(
        "case when c_custkey % 10 > 0 then c_name end as name", "c_custkey")
    return S.kfold(df, ["name", "c_custkey"], 7)


def split_text_key(spark, sf):
    df = table(spark, sf, "customer").select("c_name", "c_mktsegment")
    return S.three_way_split(df, ["c_name"], ["c_mktsegment"])


def learning_subsets(spark, sf):
    df = S.kfold(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 3)
    out = S.learning_subsets(df, ["o_orderkey"], "fold", 3)
    return out.select("o_orderkey", "fold",
                      F.posexplode_outer("steps_from").alias("held_out", "step"))


def row_index(spark, sf):
    df = lineitem(spark, sf).select(*KEY)
    return with_row_index(df, KEY)


QUERIES = {f.__name__: f for f in (
    split_three_way, split_sizes, split_many_strata, split_unstratified, kfold_assign,
    kfold_text, split_text_key, learning_subsets, row_index)}


def _three_way(rows: str, key: str, strata: str) -> str:
    """Two draws by largest remainder, rows taken in hash order: test, val, train."""
    return f"""with t as ({rows}),
tot as (select count(*) n, (count(*) * 15 + 99) // 100 n_test from t),
need as (select n, n_test, ((n - n_test) * 3 + 16) // 17 n_val from tot),
st as (select {strata}, count(*) c from t group by all),
f0 as (select st.*, (c * (n - n_test)) // n q, (c * (n - n_test)) % n r, n - n_test d
       from st, need),
kept as (select * exclude (q, r, d), q + cast(row_number() over (order by r desc, {strata})
         <= d - sum(q) over () as bigint) kept from f0),
f1 as (select kept.*, (kept * (n - n_test - n_val)) // (n - n_test) q,
       (kept * (n - n_test - n_val)) % (n - n_test) r, n - n_test - n_val d from kept, need),
quota as (select * exclude (q, r, d), q + cast(row_number() over (order by r desc, {strata})
          <= d - sum(q) over () as bigint) train from f1),
ranked as (select *, row_number() over (partition by {strata}
           order by md5(concat_ws('|', {key}, '42'))) rn from t)
select ranked.* exclude (rn), case when rn <= c - kept then 'test'
  when rn <= c - train then 'val' else 'train' end as split
from ranked join quota using ({strata})"""


SQL = {
    "split_three_way": _three_way(f"select {KEY_SQL}, l_returnflag from {LINEITEM}", KEY_SQL,
                                  "l_returnflag"),
    "split_sizes": "select l_returnflag, l_linestatus, split, count(*) as n from (" + _three_way(
        f"select {KEY_SQL}, l_returnflag, l_linestatus from {LINEITEM}", KEY_SQL,
        "l_returnflag, l_linestatus") + ") group by all",
    "split_many_strata": _three_way(
        "select o_orderkey, o_custkey % 60 as stratum from orders", "o_orderkey", "stratum"),
    "split_unstratified": """select o_orderkey, case when row_number() over (
order by md5(concat_ws('|', o_orderkey, '42'))) <= (select (count(*) + 4) // 5 from orders)
then 'test' else 'train' end as split from orders""",
    "kfold_assign": f"""select {KEY_SQL}, cast(ntile(7) over (order by {KEY_SQL}) - 1 as integer)
as fold from {LINEITEM}""",
    "kfold_text": """select *, cast(ntile(7) over (order by name nulls first, c_custkey) - 1
as integer) as fold from (select case when c_custkey % 10 > 0 then c_name end as name, c_custkey
from customer)""",
    "split_text_key": _three_way("select c_name, c_mktsegment from customer", "c_name",
                                 "c_mktsegment"),
    "learning_subsets": """with t as (select o_orderkey, cast(ntile(3) over (order by o_orderkey)
  - 1 as integer) fold from orders),
x as (select t.*, cast(h.range as integer) held_out from t, range(3) h),
r as (select *, row_number() over (partition by held_out, fold = held_out
      order by md5(concat_ws('|', o_orderkey, '42'))) rn,
      count(*) over (partition by held_out, fold = held_out) n from x)
select o_orderkey, fold, held_out, cast(case when fold = held_out then 0 else
  1 + (select count(*) from range(1, 10) s where rn > (n * s.range) // 10) end as integer) as step
from r""",
    "row_index": f"select {KEY_SQL}, row_number() over (order by {KEY_SQL}) - 1 as row_index "
                 f"from {LINEITEM}",
}
