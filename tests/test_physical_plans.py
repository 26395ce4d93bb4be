"""What the physical plans must look like."""

from pyspark.sql import functions as F

from checks.base import lineitem
from tabulon.operators import clean, compare, evaluate, profile, score, split
from tabulon.plans.graduates import HISTORY


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_outlier_filter_is_narrow_and_reaches_the_scan(spark, sf_dir):
    df = lineitem(spark, sf_dir).select("l_quantity", "l_tax")
    text = plan(clean.iqr_bounds(df, ["l_quantity"]).remove(df))
    assert "Exchange" not in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text


def test_split_and_folds_move_no_rows(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(split.three_way_split(orders, ["o_orderkey"], ["o_orderstatus"]))
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text
    assert "BroadcastHashJoin" in text
    assert "Exchange" not in plan(split.kfold(orders, ["o_orderkey"], 5))


def test_rows_are_counted_once_for_all_folds(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    slim = orders.select((F.col("o_orderkey") % 3).cast("int").alias("__own"),
                         F.substring(F.md5(F.col("o_orderpriority")), 1, 2).alias("__b"))
    text = plan(split.outside_counts(slim, 3))
    assert text.count("FileScan") == text.count("Generate explode") == 1
    # The one copy for every fold is made of buckets, after rows have been added up.
    assert "partial_count" in text.split("Generate explode")[1]


def test_top_counts_are_cut_before_the_shuffle(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    text = plan(profile.value_counts(part, ["p_name", "p_brand"], 5))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_reports_are_one_scan(spark, sf_dir):
    df = lineitem(spark, sf_dir)
    for out in (profile.null_profile(df), profile.table_info(df),
                evaluate.metrics(df, "l_quantity", "l_tax", ["l_returnflag"]),
                compare.wide_differences(df, {c: c for c in ("l_tax", "l_discount")})):
        assert plan(out).count("FileScan") == 1


def test_small_sides_are_broadcast_only_within_the_limit(spark):
    from tabulon.operators.common import join_small

    big = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    inside, beyond = join_small(big, small, ["k"]), join_small(big, small, ["k"], limit=10)
    assert "BroadcastHashJoin" in plan(inside)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(beyond)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert inside.exceptAll(beyond).count() == 0 and inside.count() == 1000


def test_scoring_is_narrow(spark, sf_dir):
    df = lineitem(spark, sf_dir)
    assert "Exchange" not in plan(score.score_batch(df, F.col("l_quantity"), HISTORY))


def test_all_pairs_come_from_one_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wide = df.select(*[(F.col("l_quantity") * i + F.col("l_tax")).alias(f"x{i}")
                       for i in range(60)])
    assert plan(profile.correlation_matrix(wide)).count("FileScan") == 1


def test_unique_rows_are_not_exchanged(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    twice = df.unionByName(df.filter("o_orderkey % 50 = 0"))
    out = clean.drop_duplicates(twice)
    text = plan(out)
    kept, repeated = text.split("HashAggregate", 1)       # both sides of the union
    assert "LeftAnti" in kept and "LeftSemi" in repeated
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept
    assert out.exceptAll(df).count() == 0 and out.count() == df.count()
    assert "Exchange" not in plan(clean.drop_duplicates(df))
