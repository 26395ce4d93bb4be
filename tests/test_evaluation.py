import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import compare as C
from tabulon.operators import evaluate as E
from tabulon.sources import reports


@pytest.fixture(scope="module")
def long(spark):
    rng = np.random.default_rng(2)
    y = np.round(rng.normal(16, 1.2, 300), 2)
    y[:3] = 0
    pdf = pd.concat([pd.DataFrame({"model": m, "k": np.arange(300), "y": y,
                                   "y_pred": y + rng.normal(0, s, 300)})
                     for m, s in (("ridge", 0.7), ("lasso", 0.6), ("other", 2.0))])
    return spark.createDataFrame(pdf).persist()


def test_metrics_against_numpy(long):
    pdf = long.toPandas()
    got = {r["model"]: r for r in E.metrics(long, by=["model"]).collect()}
    for m, p in pdf.groupby("model"):
        e = p["y"] - p["y_pred"]
        r = got[m]
        assert r["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
        assert r["r2"] == pytest.approx(1 - (e ** 2).sum() / ((p["y"] - p["y"].mean()) ** 2).sum())
        some = p["y"] != 0
        assert r["mape"] == pytest.approx((e / p["y"])[some].abs().mean() * 100)
        # Identities every stored report satisfies.
        assert r["mse"] == pytest.approx(r["mean_residual"] ** 2 + r["std_residual"] ** 2)
        assert r["rmse"] ** 2 == pytest.approx(r["mse"])
    single = E.metrics(long.filter("model = 'ridge'")).first()
    assert single["mae"] == pytest.approx(got["ridge"]["mae"])


def test_constant_labels_and_zero_labels(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 0.0, 0.0), ("b", 0.0, 1.0)],
                               "model string, y double, y_pred double")
    got = {r["model"]: r for r in E.metrics(df, by=["model"]).collect()}
    assert got["a"]["r2"] == 1.0 and got["b"]["r2"] == 0.0 and got["a"]["mape"] is None


def test_error_bins_edges(spark):
    df = spark.createDataFrame([(0.0, e) for e in (0.0, 0.5, -0.5, 0.6, 2.0, 3.0)],
                               "y double, y_pred double")
    got = E.error_bins(df).orderBy("bin").collect()
    assert [r["count"] for r in got] == [2, 1, 0, 1, 1]     # exactly 0 is in no bin
    assert sum(r["pct"] for r in got) == pytest.approx(500 / 6)
    assert E.within_tolerance(df).first()["within_0_5"] == 3


def test_residual_histogram_matches_numpy(long):
    pdf = long.filter("model = 'ridge'").toPandas()
    counts, edges = np.histogram(pdf["y"] - pdf["y_pred"], bins=40)
    got = E.residual_histogram(long.filter("model = 'ridge'")).orderBy("bin").toPandas()
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["bin_end"], edges[1:])


def test_qq_line_of_a_normal_sample(spark):
    from statistics import NormalDist

    n = 500
    positions = [(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)]
    positions[0], positions[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    z = [NormalDist().inv_cdf(p) for p in positions]
    df = spark.createDataFrame([(3 + 2 * x, 0.0) for x in z], "y double, y_pred double")
    line = E.qq_line(df).first()
    assert (line["slope"], line["intercept"], line["r"]) == pytest.approx((2, 3, 1), abs=1e-6)
    flat = spark.createDataFrame([(1.0, 0.0)] * 5, "y double, y_pred double")
    assert E.qq_line(flat).first()["r"] is None


def test_curve_labels(spark):
    curve = spark.createDataFrame([(1, 0.1, 3.0), (10, 0.5, 0.9)],
                                  "step int, train_rmse double, val_rmse double")
    row = E.curve_diagnosis(curve).first()
    assert row["gap"] == pytest.approx(0.4) and row["diagnosis"] == "slight overfitting"
    df = spark.createDataFrame([(0.8,), (0.81,), (0.3,)], "r2 double")
    assert [r[0] for r in df.select(E.fit_quality(F.col("r2"))).collect()] == [
        "good", "excellent", "poor"]


def test_ties_share_ranks_and_go_to_the_first(spark):
    df = spark.createDataFrame(
        [(m, i, float(i), float(i) + d) for m, d in (("z", 1.0), ("a", 1.0), ("c", 2.0))
         for i in range(5)], "model string, k int, y double, y_pred double")
    table = C.compare_metrics(df)
    ranks = {r["model"]: r["rmse_rank"] for r in table.collect()}
    assert ranks == {"z": 1.5, "a": 1.5, "c": 3.0}
    assert C.best_model(table, "rmse", ["z", "a", "c"]).first()["best_model"] == "z"
    assert C.best_model(table, "r2", ["a", "z", "c"]).first()["best_model"] == "a"
    assert C.winners(table, ["z", "a", "c"]).first()["best_mae"] == "z"
    with pytest.raises(ValueError):
        C.best_model(table, "speed")


def test_pairwise_differences(long):
    wide = long.toPandas().pivot(index="k", columns="model", values="y_pred")
    models = ["ridge", "lasso", "other"]
    got = {(r["model_a"], r["model_b"]): r for r in
           C.pairwise_differences(long, ["k"], models).collect()}
    assert list(got) and set(got) == {("ridge", "lasso"), ("ridge", "other"), ("lasso", "other")}
    d = wide["ridge"] - wide["lasso"]
    r = got["ridge", "lasso"]
    assert r["std_diff"] == pytest.approx(d.std(ddof=0))
    assert r["correlation"] == pytest.approx(wide["ridge"].corr(wide["lasso"]))
    assert r["within_0_5"] == (d.abs() <= 0.5).sum()


def test_register_and_report(spark, long, tmp_path):
    parts = {m: long.filter(F.col("model") == m).drop("model") for m in ("ridge", "lasso")}
    table = C.register(parts, ["k"])
    assert C.model_names(table) == ["lasso", "ridge"]
    assert C.label_mismatches(table, ["k"]).count() == 0
    report = C.comparison_report(table, ["k"], ["ridge", "lasso"])
    row = report.first()
    assert row["n_models"] == 2 and len(row["comparison_table"]) == 2
    assert row["best_model"]["best_model"] == row["winners"]["best_rmse"] == "lasso"
    metrics = C.compare_metrics(table)
    path = str(tmp_path / "results")
    reports.save_comparison(metrics, E.evaluation_report(table),
                            C.pairwise_differences(table, ["k"], ["ridge", "lasso"]),
                            C.best_model(metrics), path)
    back = reports.read_comparison(spark, f"{path}/model_comparison").toPandas()
    assert sorted(back["model"]) == ["lasso", "ridge"]
    assert math.isclose(back.set_index("model").loc["lasso", "rmse"], row["best_model"]["value"])
