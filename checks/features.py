"""Derived columns, rare categories, encoders, scalers and the fitted pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    KEY, KEY_SQL, LINEITEM, NULLED, R, lineitem, normal_cdf_sql, normal_ppf_sql, nulled, rounded,
    table)
from tabulon.functions.expr import band, col, normal_cdf, normal_ppf, safe_divide
from tabulon.operators import features as E
from tabulon.operators import sparse as S
from tabulon.operators.split import train_test_split

DERIVED = (
    E.Derived("gap", ("ship_year", "order_year"),
              lambda: E.year_gap(col("ship_year"), col("order_year"), 0, 3)),
    E.Derived("year_norm", ("ship_year",), lambda: E.offset(col("ship_year"), 1995)),
    E.Derived("price_per_year", ("l_extendedprice", "gap"),
              lambda: E.ratio_plus_one(col("l_extendedprice"), col("gap"))),
    E.Derived("is_returned", ("l_returnflag",),
              lambda: E.equals_flag(col("l_returnflag"), "R")),
)


def derived_columns(spark, sf):
    """Two dates joined on the order key; null years stay null."""
    li = lineitem(spark, sf).selectExpr(
        *KEY, "l_extendedprice", "l_returnflag",
        "case when l_linenumber = 7 then null else year(l_shipdate) end as ship_year")
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey as l_orderkey", "year(o_orderdate) as order_year")
    out, names = E.add_derived(li.join(orders, "l_orderkey"), DERIVED)
    return out.select(*KEY, *names)


def safe_division(spark, sf):
    li = lineitem(spark, sf)
    return li.select(*KEY, safe_divide(col("l_extendedprice"), col("l_discount") * 100, -1.0)
                     .alias("ratio"))


def threshold_band(spark, sf):
    li = lineitem(spark, sf)
    return li.select(
        *KEY, band(col("l_quantity"), [10, 25, 40], ["a", "b", "c", "d"]).alias("left_closed"),
        band(col("l_quantity"), [10, 25, 40], ["a", "b", "c", "d"], right_closed=True)
        .alias("right_closed"))


def normal_functions(spark, sf):
    li = lineitem(spark, sf)
    p = (col("l_quantity") - 0.5) / 50
    return rounded(li.select(*KEY, normal_cdf((col("l_quantity") - 25) / 10).alias("cdf"),
                             normal_ppf(p).alias("ppf")), ["cdf", "ppf"])


def _marked(spark, sf):
    return train_test_split(
        table(spark, sf, "customer").selectExpr(
            "c_custkey", "cast(c_nationkey as string) as nation", "c_mktsegment as market",
            "c_acctbal"), ["c_custkey"])


def rare_group(spark, sf):
    """Values of the whole table with few training rows become OTROS."""
    df = _marked(spark, sf)
    counts = E.category_counts(df, ["nation", "market"], F.col("split") == "train")
    return E.group_rare(df, ["nation", "market"], E.rare_categories(counts, 50))


def rare_group_joined(spark, sf):
    """The same with the rare values joined instead of listed."""
    df = _marked(spark, sf)
    counts = E.category_counts(df, ["nation", "market"], F.col("split") == "train")
    return E.group_rare(df, ["nation", "market"], E.rare_categories(counts, 50), inline=0)


def rare_counts(spark, sf):
    df = _marked(spark, sf)
    return E.category_counts(df, ["nation", "market"], F.col("split") == "train")


def onehot_drop_first(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    types = [r[0] for r in E.label_vocabulary(part, "p_type").orderBy("label")
             .select("value").collect()]
    out, _ = E.one_hot(part, {"p_type": types})
    return out


def onehot_index(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return E.one_hot_index(part, "p_name", E.label_vocabulary(part, "p_name"))


def label_encode(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return E.label_encode(part, "p_brand", E.label_vocabulary(part, "p_brand"))


def label_encode_large(spark, sf):
    """Vocabulary numbered by the distributed ranking."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return E.label_encode(c, "c_name", E.label_vocabulary(c, "c_name", driver_rows=10))


def appearance_encode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    vocabulary = E.appearance_vocabulary(orders, "o_orderpriority", ["o_orderkey"])
    coded = E.label_encode(orders, "o_orderpriority", vocabulary, "code")
    return E.label_decode(coded, "code", vocabulary, "decoded")


SCALED = ["l_quantity", "l_extendedprice", "l_tax", "returned", "constant"]
FLAGS = ["case when l_returnflag = 'R' then 1 else 0 end as returned", "5 as constant"]


def standard_scale(spark, sf):
    df = nulled(spark, sf).selectExpr(*KEY, "l_quantity", "l_extendedprice", "l_tax", *FLAGS)
    return rounded(E.fit_scaler(df, SCALED).apply(df), SCALED[:3] + ["constant"])


def minmax_scale(spark, sf):
    df = nulled(spark, sf).selectExpr(*KEY, "l_quantity", "l_extendedprice", "l_tax", *FLAGS)
    out = E.fit_scaler(df, SCALED, "minmax", exclude_binary=False).apply(df)
    return rounded(out, SCALED)


def binary_columns(spark, sf):
    df = nulled(spark, sf).selectExpr("l_tax", "l_discount", *FLAGS,
                                      "case when l_tax > 0.04 then 1.0 end as high_tax")
    names = ["l_tax", "l_discount", "returned", "constant", "high_tax"]
    found = E.binary_columns(df, names)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c in found).alias("is_binary"),
                               F.col(f"n_{c}").alias("n")) for c in names])
    return (df.agg(*[F.count(c).alias(f"n_{c}") for c in names])
            .select(F.explode(cells).alias("s")).select("s.*"))


def struct_flatten(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.struct(F.from_json("props", "k long").alias("json"),
                             F.struct(col("event_type").alias("type"),
                                      col("user_id").alias("by")).alias("meta")).alias("e"))
    return E.flatten_struct(events)


def feature_pipeline(spark, sf):
    """Fit on the training rows, apply to all: which one-hot column of each block is set."""
    df = _marked(spark, sf)
    settings = E.FeatureSettings(
        ("c_acctbal",), ("nation", "market"),
        (E.Derived("in_debt", ("c_acctbal",), lambda: (col("c_acctbal") < 0).cast("int")),),
        rare_threshold=50)
    fitted = E.fit_features(df.filter("split = 'train'"), settings, df)
    out = fitted.transform(df, ["c_custkey"])

    def chosen(block: str):
        names = [n for n in fitted.names if n.startswith(block + "_")]
        return F.coalesce(*[F.when(col(n) == 1, F.lit(n)) for n in names], F.lit("none"))

    return rounded(out.select("c_custkey", "c_acctbal", "in_debt",
                              chosen("nation").alias("nation"),
                              chosen("market").alias("market")), ["c_acctbal"])


def feature_pipeline_saved(spark, sf):
    """The pipeline after a round trip through its Parquet tables."""
    from tabulon.session import scratch_path

    df = _marked(spark, sf)
    fitted = E.fit_features(df.filter("split = 'train'"),
                            E.FeatureSettings(("c_acctbal",), ("market",), rare_threshold=1), df)
    path = scratch_path(spark, "features")
    fitted.save(spark, path)
    out = E.load_features(spark, path).transform(df, ["c_custkey"])
    return rounded(out, ["c_acctbal"])


def _sparse(spark, sf, saved: bool):
    from tabulon.session import scratch_path

    df = train_test_split(
        table(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment as market",
                                                "c_acctbal"), ["c_custkey"])
    fitted = S.fit_sparse_features(
        df.filter("split = 'train'"),
        E.FeatureSettings(("c_acctbal",), ("c_name", "market"), rare_threshold=1), df)
    if saved:
        path = scratch_path(spark, "sparse")
        fitted.save(spark, path)
        fitted = S.load_sparse_features(spark, path)
    cells = fitted.transform(df, ["c_custkey"]).select(
        "c_custkey", F.explode(F.arrays_zip("indices", "values")).alias("e"))
    return rounded(cells.select("c_custkey", F.col("e.indices").alias("index"),
                                F.col("e.values").alias("value")), ["value"])


def sparse_features(spark, sf):
    """The non-zero cells of every row, a column with a category for each row among them."""
    return _sparse(spark, sf, saved=False)


def sparse_features_saved(spark, sf):
    """The same after a round trip of the vocabulary through its table."""
    return _sparse(spark, sf, saved=True)


def sparse_feature_names(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_name", "p_brand")
    settings = E.FeatureSettings(("p_size",), ("p_brand", "p_name"), rare_threshold=2,
                                 drop_first=False)
    return S.fit_sparse_features(part, settings).names()


QUERIES = {f.__name__: f for f in (
    sparse_features, sparse_features_saved, sparse_feature_names, derived_columns, safe_division, threshold_band, normal_functions, rare_group,
    rare_group_joined, rare_counts, onehot_drop_first, onehot_index, label_encode,
    label_encode_large, appearance_encode, standard_scale, minmax_scale, binary_columns,
    struct_flatten, feature_pipeline, feature_pipeline_saved)}

_MARKED = """(select c_custkey, cast(c_nationkey as varchar) nation, c_mktsegment market,
c_acctbal, case when row_number() over (order by md5(concat_ws('|', c_custkey, '42')))
  <= (select (count(*) + 4) // 5 from customer) then 'test' else 'train' end as split
from customer)"""
_COUNTS = """(select 'nation' as "column", nation as "value",
  count(*) filter (split = 'train') as n from m group by nation
union all select 'market', market, count(*) filter (split = 'train') from m group by market)"""
_RARE = f"""with m as {_MARKED}, c as {_COUNTS}
select c_custkey, c_acctbal, split,
 case when nation in (select "value" from c where "column" = 'nation' and n < 50)
      then 'OTROS' else nation end as nation,
 case when market in (select "value" from c where "column" = 'market' and n < 50)
      then 'OTROS' else market end as market from m"""


def _block(c: str) -> str:
    return (f"case when {c} in (select {c} from g where split = 'train') and {c} > (select "
            f"min({c}) from g where split = 'train') then '{c}_' || {c} else 'none' end as {c}")


_SPARSE = f"""with m as (select c_custkey, c_name, c_mktsegment market, c_acctbal,
  case when row_number() over (order by md5(concat_ws('|', c_custkey, '42')))
    <= (select (count(*) + 4) // 5 from customer) then 'test' else 'train' end as split
  from customer),
t as (select * from m where split = 'train'),
w as (select c_name v, row_number() over (order by c_name) as r
  from (select distinct c_name from t)),
k as (select market v, row_number() over (order by market) as r
  from (select distinct market from t)),
cells as (
  select c_custkey, 0 as "index",
    {R("(c_acctbal - (select avg(c_acctbal) from t)) / (select stddev_pop(c_acctbal) from t)")}
      as value from m
  union all select c_custkey, r - 1, 1 from m join w on c_name = v where r > 1
  union all select c_custkey, r - 2 + (select count(*) from w), 1 from m join k on market = v
    where r > 1)
select c_custkey, cast("index" as bigint) as "index", cast(value as double) as value
from cells where value <> 0"""

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SCALE = (f"(select {KEY_SQL}, l_quantity, l_extendedprice, l_tax, {', '.join(FLAGS)} "
          f"from {NULLED})")

SQL = {
    "sparse_features": _SPARSE,
    "sparse_features_saved": _SPARSE,
    "sparse_feature_names": """with c as (
  select 1 as b, 'p_brand' as col, case when count(*) < 2 then 'OTROS' else p_brand end as v
  from part group by p_brand
  union select 2, 'p_name', case when count(*) < 2 then 'OTROS' else p_name end
  from part group by p_name)
select 0 as "index", 'p_size' as name
union all select row_number() over (order by b, v), col || '_' || v from c""",
    "derived_columns": f"""with t as (select {', '.join('l.' + k for k in KEY)}, l_extendedprice,
  l_returnflag, case when l_linenumber = 7 then null else year(l_shipdate) end s,
  year(o_orderdate) o from {LINEITEM} l join orders on l_orderkey = o_orderkey),
g as (select *, case when s is not null then least(greatest(s - o, 0), 3) end gap from t)
select {KEY_SQL}, cast(gap as integer) gap, cast(s - 1995 as integer) year_norm,
  l_extendedprice / (gap + 1) as price_per_year,
  cast(coalesce(l_returnflag = 'R', false) as integer) is_returned from g""",
    "safe_division": f"select {KEY_SQL}, case when l_discount * 100 = 0 then cast(-1 as double) "
                     f"else l_extendedprice / (l_discount * 100) end as ratio from {LINEITEM}",
    "threshold_band": f"""select {KEY_SQL}, case when l_quantity < 10 then 'a' when l_quantity < 25
then 'b' when l_quantity < 40 then 'c' else 'd' end as left_closed,
case when l_quantity <= 10 then 'a' when l_quantity <= 25 then 'b' when l_quantity <= 40 then 'c'
else 'd' end as right_closed from {LINEITEM}""",
    "normal_functions": f"""select {KEY_SQL}, {R(normal_cdf_sql('((l_quantity - 25) / 10)'))}
as cdf, {R(normal_ppf_sql('((l_quantity - 0.5e0) / 50)'))} as ppf from {LINEITEM}""",
    "rare_group": _RARE,
    "rare_group_joined": _RARE,
    "rare_counts": f"with m as {_MARKED} select * from {_COUNTS}",
    "onehot_drop_first": "select p_partkey, p_type, " + ", ".join(
        f"cast(p_type = '{t}' as double) as \"p_type_{t}\"" for t in (
            "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " from part",
    "onehot_index": """select p_partkey, p_name, nullif(dense_rank() over (order by p_name) - 1, 0)
- 1 as p_name_index from part""",
    "label_encode": "select p_partkey, p_brand, dense_rank() over (order by p_brand) - 1 "
                    "as p_brand_label from part",
    "label_encode_large": "select c_custkey, c_name, dense_rank() over (order by c_name) - 1 "
                          "as c_name_label from customer",
    "appearance_encode": """with f as (select o_orderpriority p, row_number() over (
  order by min(o_orderkey)) - 1 as code from orders group by 1)
select o_orderkey, o_orderpriority, code, o_orderpriority as decoded
from orders join f on p = o_orderpriority""",
    "standard_scale": f"with t as {_SCALE} select {KEY_SQL}, " + ", ".join(
        R(f"({c} - (select avg({c}) from t)) / (select stddev_pop({c}) from t)") + f" as {c}"
        for c in SCALED[:3]) + ", returned, cast(0 as double) as constant from t",
    "minmax_scale": f"with t as {_SCALE} select {KEY_SQL}, " + ", ".join(
        R(f"({c} - (select min({c}) from t)) / (select max({c}) - min({c}) from t)")
        + f" as {c}" for c in SCALED[:4]) + ", cast(0 as double) as constant from t",
    "binary_columns": f"""with t as (select l_tax, l_discount, {', '.join(FLAGS)},
  case when l_tax > 0.04 then 1.0 end as high_tax from {NULLED})
select * from (""" + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter ({c} not in (0, 1)) = 0 as is_binary, "
        f"count({c}) as n from t"
        for c in ("l_tax", "l_discount", "returned", "constant", "high_tax")) + ")",
    "struct_flatten": """select event_id, cast(json_extract(props, '$.k') as bigint) as e_json_k,
event_type as e_meta_type, user_id as e_meta_by from events""",
    "feature_pipeline": f"""with g as ({_RARE})
select c_custkey, {R('''(c_acctbal - (select avg(c_acctbal) from g where split = 'train'))
/ (select stddev_pop(c_acctbal) from g where split = 'train')''')} as c_acctbal,
cast(c_acctbal < 0 as double) as in_debt, {_block('nation')}, {_block('market')} from g""",
    "feature_pipeline_saved": f"""with g as {_MARKED}
select c_custkey, {R('''(c_acctbal - (select avg(c_acctbal) from g where split = 'train'))
/ (select stddev_pop(c_acctbal) from g where split = 'train')''')} as c_acctbal, """ + ", ".join(
        f"cast(market = '{s}' as double) as \"market_{s}\"" for s in _SEGMENTS[1:])
    + " from g",
}
