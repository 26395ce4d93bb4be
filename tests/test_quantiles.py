import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import quantiles as Q
from tabulon.operators.rowindex import with_group_rank, with_row_index

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame():
    rng = np.random.default_rng(5)
    n = 3000
    hot = np.where(rng.random(n) < 0.4, 7.0, np.round(rng.normal(0, 50, n), 3))
    return pd.DataFrame({
        "id": np.arange(n), "g": np.where(rng.random(n) < 0.5, "hot", rng.integers(0, 40, n)
                                          .astype(str)),
        "normal": rng.normal(-3, 1e4, n), "hot": hot, "few": rng.integers(0, 3, n),
        "constant": 4.5, "skewed": np.exp(rng.normal(0, 3, n)),
        "holes": np.where(rng.random(n) < 0.7, np.nan, rng.random(n))})


@pytest.fixture(scope="module")
def pdf():
    return frame()


@pytest.fixture(scope="module")
def df(spark, pdf):
    from tabulon.functions.expr import nan_to_null
    return nan_to_null(spark.createDataFrame(pdf)).persist()


NUMBERS = ["normal", "hot", "few", "constant", "skewed", "holes"]


@pytest.mark.parametrize("limits", [
    {}, {"accuracy": 20, "bracket_rows": 3}])
def test_column_quantiles(df, pdf, limits):
    found = Q.column_quantiles(df, NUMBERS, PROBS, **limits)
    for c in NUMBERS:
        np.testing.assert_allclose(found[c], pdf[c].quantile(PROBS), rtol=1e-12, err_msg=c)


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert Q.column_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}


@pytest.mark.parametrize("limits", [
    {}, {"bracket_groups": 2},
    {"bracket_groups": 2, "group_distinct": 2}])
def test_group_quantiles(df, pdf, limits):
    by = "g" if limits else "few"
    for c in ("hot", "holes"):
        probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
        found = Q.group_quantiles(df, [by], c, probs, **limits).toPandas().set_index(by)
        want = pdf.groupby(by)[c].quantile(list(probs.values())).unstack().dropna()
        np.testing.assert_allclose(found.loc[want.index].values, want.values, rtol=1e-9,
                                   atol=1e-12)


@pytest.mark.parametrize("tie_rows", [1, 10_000])
def test_cut_by_rank_follows_ties_into_the_next_key(df, pdf, tie_rows):
    keys = ["few", "hot", "id"]
    ordered = pdf.sort_values(keys)[keys].reset_index(drop=True)
    ranks = [0, 10, 999, 1500, 2999]
    found = Q.cut_by_rank(df.select(*keys), keys, ranks, tie_rows=tie_rows)
    assert [tuple(map(float, f)) for f in found] == [
        tuple(map(float, ordered.iloc[r])) for r in ranks]


def test_rank_out_of_range(df):
    with pytest.raises(ValueError):
        Q.cut_by_rank(df.select("id"), ["id"], [3000])


def test_row_index_with_a_hot_key(df, pdf):
    out = with_row_index(df.select("hot", "id"), ["hot"]).toPandas().sort_values("row_index")
    assert list(out["row_index"]) == list(range(len(pdf)))
    assert (np.diff(out["hot"]) >= 0).all()


def test_group_rank(df, pdf):
    out = with_group_rank(df.select("g", "normal"), ["g"], [F.col("normal")], "r", "n")
    out = out.toPandas()
    want = out.groupby("g")["normal"].rank(method="first") - 1
    assert (out["r"] == want).all()
    assert (out["n"] == out.groupby("g")["g"].transform("size")).all()
