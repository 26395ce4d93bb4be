import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.functions.expr import nan_to_null
from tabulon.operators import clean as C
from tabulon.operators import profile as P
from tabulon.operators import validate as V


@pytest.fixture(scope="module")
def holes(spark):
    """100 rows with columns 0, 50, 51, 70 and 71 percent null, and a null target."""
    cols = [F.when(F.col("id") >= n, F.col("id").cast("double")).alias(f"n{n}")
            for n in (0, 50, 51, 70, 71)]
    return spark.range(100).select(
        "id", *cols, F.when(F.col("id") % 10 != 0, F.col("id") * 1.0).alias("y"),
        F.when(F.col("id") % 4 == 0, "b").when(F.col("id") % 4 == 1, "a").alias("c"))


def test_roles(holes):
    with pytest.warns(UserWarning, match="absent"):
        roles = C.identify_roles(holes, "y", ["id", "absent"])
    assert roles.numeric == ("n0", "n50", "n51", "n70", "n71")
    assert roles.categorical == ("c",) and roles.excluded == ("id",)
    with pytest.raises(ValueError):
        C.identify_roles(holes, "nope")


def test_threshold_is_strict(holes):
    assert "n50" in C.drop_sparse_columns(holes, 0.5).columns
    assert "n51" not in C.drop_sparse_columns(holes, 0.5).columns
    kept = C.keep_filled_columns(holes, 0.3).columns
    assert "n70" in kept and "n71" not in kept
    assert "n71" in C.drop_sparse_columns(holes, 0.5, ["n71"]).columns


def test_strategies(holes):
    roles = C.identify_roles(holes, "y", ["id"])
    dropped = C.handle_missing(holes, roles, "drop")
    assert dropped.columns == ["id", "n0", "n50", "y", "c"]
    assert dropped.count() == sum(
        i >= 50 and i % 10 != 0 and i % 4 < 2 for i in range(100))
    filled = C.handle_missing(holes, roles, "smart").toPandas()
    assert len(filled) == 90 and not filled.isna().any().any()
    seen = holes.filter("y is not null").toPandas()
    assert filled.loc[filled["id"] < 50, "n50"].unique() == seen["n50"].median()
    constant = C.handle_missing(holes, roles, "impute", categorical_strategy="constant")
    assert constant.filter("c = 'DESCONOCIDO'").count() > 0
    with pytest.raises(ValueError):
        C.handle_missing(holes, roles, "other")


def test_nothing_missing_returns_the_table(spark):
    df = spark.range(5).withColumn("y", F.lit(1.0))
    assert C.handle_missing(df, C.identify_roles(df, "y")) is df


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (2, "a"), (1, "b"), (9, None), (None, None)],
                               "x int, s string")
    assert C.column_modes(df, ["x", "s"]) == {"x": 1, "s": "a"}
    empty = spark.createDataFrame([(None, 1.0)], "s string, y double")
    assert C.fit_imputer(empty, [], ["s"]).apply(empty).first()["s"] == "DESCONOCIDO"


def test_fractional_median_keeps_its_fraction(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r["x"] for r in C.fit_imputer(df, ["x"]).apply(df).collect()) == [1, 1.5, 2]


def test_outliers_against_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 500), "b": rng.exponential(2, 500), "c": 3.0})
    pdf.loc[::50, "a"] = np.nan
    df = nan_to_null(spark.createDataFrame(pdf))
    q1, q3 = pdf.quantile(0.25), pdf.quantile(0.75)
    bad = (pdf < q1 - 1.5 * (q3 - q1)) | (pdf > q3 + 1.5 * (q3 - q1))
    assert C.remove_outliers(df, ["a", "b", "c"]).count() == (~bad.any(axis=1)).sum()
    counts = {r["column"]: r["outliers"] for r in
              C.iqr_bounds(df, ["a", "b", "c"]).counts(df).collect()}
    assert counts == {c: n for c, n in bad.sum().items() if n}
    z = ((pdf - pdf.mean()) / pdf.std()).abs() > 2
    assert (C.remove_outliers(df, ["a", "b", "c"], "zscore", 2.0).count()
            == (~z.any(axis=1)).sum())
    with pytest.raises(ValueError):
        C.remove_outliers(df, ["a"], "forest")


def test_types_and_duplicates(spark):
    df = spark.createDataFrame([("1.5", "x"), ("bad", "x"), (None, None), (None, None)],
                               "n string, c string")
    out = C.convert_types(df, C.FeatureRoles(("n",), ("c",), "y"))
    assert [r["n"] for r in out.collect()] == [1.5, None, None, None]
    assert C.drop_duplicates(df).count() == 3
    assert P.duplicate_rows(df).first()["duplicate_rows"] == 1


def test_log_report(holes):
    log = C.ProcessingLog()
    log.add("start", "", holes)
    log.add("target", "", C.drop_null_target(holes, "y"))
    report = log.report()
    assert report["rows_lost"] == 10 and report["rows_lost_pct"] == 10.0
    assert [s["action"] for s in report["processing_log"]] == ["start", "target"]


def test_summary_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.gamma(2, 3, 400), "constant": 1.0, "one": [5.0] + [np.nan] * 399})
    df = nan_to_null(spark.createDataFrame(pdf))
    got = {r["column"]: r for r in P.numeric_summary(df).collect()}
    a = got["a"]
    assert a["skewness"] == pytest.approx(pdf["a"].skew())
    assert a["kurtosis"] == pytest.approx(pdf["a"].kurtosis())
    assert a["std"] == pytest.approx(pdf["a"].std())
    assert got["constant"]["skewness"] == 0 and got["constant"]["kurtosis"] == 0
    assert got["one"]["std"] is None and got["one"]["skewness"] is None
    assert P.target_correlations(df, "a").count() == 0      # constants have none


def test_histogram_of_a_constant(spark):
    out = P.histogram(spark.range(10).withColumn("v", F.lit(2.0)), "v", 4).toPandas()
    assert out["count"].sum() == 10 and out["bin_start"].min() == 1.5


def test_table_checks(holes):
    assert V.check_table(holes, ["id"], 100).ok
    assert not V.check_table(holes, ["id"], 101).ok
    assert V.check_table(holes.filter("id < 0")).problems == ("table is empty",)
    assert V.check_table(holes, ["zz"]).problems == ("missing columns: zz",)
    r = V.target_range(holes, "y", 5, 95).first()
    assert (r["below"], r["above"], r["ok"]) == (4, 4, False)


def test_duplicates_with_colliding_hashes(spark, monkeypatch):
    """Nulls do not enter the hash, so (1, null) and (null, 1) share one."""
    rows = [(1, None), (None, 1), (1, None), (2, 2), (3, 3), (3, 3), (3, 3), (None, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert tuple(P.duplicate_rows(df).first()) == (8, 3)
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    assert tuple(P.duplicate_rows(df).first()) == (8, 3)
    assert tuple(P.duplicate_rows(df.distinct()).first()) == (5, 0)
    assert tuple(P.duplicate_rows(df.limit(0)).first()) == (0, 0)
