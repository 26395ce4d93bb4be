import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import linear as L
from tabulon.operators import split as S

P, N = 6, 400
NAMES = [f"x{i}" for i in range(P)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(50, 10, (N, P))
    x[:, 5] = 3 * x[:, 0] + 1                       # collinear
    y = 1000 + x @ np.array([1.5, -2, 0, 0.3, 0, 0]) + rng.normal(0, 2, N)
    return x, y


@pytest.fixture(scope="module")
def df(spark, data):
    x, y = data
    pdf = pd.DataFrame(x, columns=NAMES).assign(y=y, k=np.arange(N))
    return S.kfold(spark.createDataFrame(pdf), ["k"], 5).persist()


def folds():
    return np.repeat(np.arange(5), N // 5)


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(P), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def test_products(df, data):
    x, y = data
    sums = L.products(df, NAMES, "y")
    z = np.column_stack([np.ones(N), x - sums.shift[:-1], y - sums.shift[-1]])
    np.testing.assert_allclose(sums.total(), z.T @ z, atol=1e-6)
    by_fold = L.products(df, NAMES, "y", df["fold"])
    assert [m[0, 0] for _, m in sorted(by_fold.matrices.items())] == [N / 5] * 5


@pytest.mark.parametrize("alpha", [0.1, 10.0])
def test_ridge(df, data, alpha):
    w, b = ridge(*data, alpha)
    for model in (L.fit_linear(df, NAMES, "y", "ridge", alpha),
                  L.mllib_model(df, NAMES, "y", "ridge", alpha)):
        np.testing.assert_allclose(model.coefficients, w, rtol=1e-6, atol=1e-8)
        assert model.intercept == pytest.approx(b)


@pytest.mark.parametrize("alpha", [0.001, 0.5, 20.0])
def test_lasso_meets_its_optimality_conditions(df, data, alpha):
    x, y = data
    model = L.fit_linear(df, NAMES, "y", "lasso", alpha)
    w = np.array(model.coefficients)
    r = y - model.intercept - x @ w
    grad = (x - x.mean(0)).T @ r / N
    assert abs(r.mean()) < 1e-8 and (np.abs(grad) <= alpha + 1e-6).all()
    np.testing.assert_allclose(grad[w != 0], alpha * np.sign(w[w != 0]), atol=1e-6)
    other = L.mllib_model(df, NAMES, "y", "lasso", alpha, 1e-8, 40)
    objective = [((y - m.intercept - x @ np.array(m.coefficients)) ** 2).mean() / 2
                 + alpha * np.abs(m.coefficients).sum() for m in (model, other)]
    assert objective[0] <= objective[1] + 1e-6


def brute_grid(x, y, alphas):
    out = {}
    for i, a in enumerate(alphas):
        for f in range(5):
            t = folds() == f
            w, b = ridge(x[~t], y[~t], a)
            e = y - b - x @ w
            out[i, f] = (e[~t] ** 2).mean(), (e[t] ** 2).mean()
    return out


def test_grid_search(df, data):
    alphas = [0.01, 1.0, 100.0]
    model, scores = L.grid_search(df, NAMES, "y", "fold", "ridge", alphas)
    want = brute_grid(*data, alphas)
    for r in scores.collect():
        assert (r["train_mse"], r["test_mse"]) == pytest.approx(want[r["position"], r["fold"]])
    means = [np.mean([want[i, f][1] for f in range(5)]) for i in range(3)]
    assert model.alpha == alphas[int(np.argmin(means))]
    assert model.metadata["best_cv_score"] == pytest.approx(min(means))
    best = L.grid_table(scores).filter("rank = 1").first()
    assert best["alpha"] == model.alpha


@pytest.fixture
def small_memory(monkeypatch):
    """Blocks of four rows, and matrices that fit neither a task nor the driver."""
    monkeypatch.setattr(L, "BLOCK", 4)
    monkeypatch.setattr(L, "LOCAL_BYTES", 0)
    monkeypatch.setattr(L, "TASK_BYTES", 0)


def rows_of(table):
    return sorted(map(tuple, table.collect()))


@pytest.mark.parametrize("kind", ["ridge", "lasso"])
def test_blocks_give_the_same(df, kind, request):
    """Grid, folds, curve and fit from blocks in the shared folder."""
    sub = S.learning_subsets(df, ["k"], "fold", 5, steps=4).persist()

    def everything():
        sums = L.products(df, NAMES, "y", df["fold"])
        model, scores = L.grid_search(df, NAMES, "y", "fold", kind, [0.01, 1.0, 100.0], sums)
        return (sums, [*model.coefficients, model.intercept, model.alpha], rows_of(scores),
                rows_of(L.fold_scores(df, NAMES, "y", "fold", kind, 1.0, sums)),
                rows_of(L.learning_curve(sub, NAMES, "y", "steps_from", 5, 4, kind, 1.0)))

    local = everything()
    request.getfixturevalue("small_memory")
    wide = everything()
    assert local[0].matrices is not None and wide[0].matrices is None
    assert wide[0].blocks.groupBy("g").count().first()["count"] == 3       # 8 rows, 2 blocks
    np.testing.assert_allclose(local[1], wide[1], rtol=1e-7, atol=1e-7)
    for a, b in zip(local[2:], wide[2:]):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert [v for v in x if isinstance(v, str)] == [v for v in y if isinstance(v, str)]
            np.testing.assert_allclose([v for v in x if not isinstance(v, str)],
                                       [v for v in y if not isinstance(v, str)], rtol=1e-6)


def test_blocks_refuse_nulls(spark, small_memory):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 1.0)], "x double, y double")
    with pytest.raises(Exception, match="nulls or infinities"):
        L.fit_linear(df, ["x"], "y")


def test_screened_descent_meets_the_conditions():
    """Many features, few of them used; the penalties follow each other from large to small."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 300))
    x[:, 100:200] = x[:, :100] + 0.1 * rng.normal(size=(500, 100))
    y = x[:, :20] @ rng.normal(size=20) + rng.normal(size=500)
    xc, yc = x - x.mean(0), y - y.mean()
    start = None
    for alpha in (1.0, 0.3, 0.1, 0.01):
        cold = L._lasso(xc.T @ xc, xc.T @ yc, 500.0, alpha)
        w = L._lasso(xc.T @ xc, xc.T @ yc, 500.0, alpha, start=start)
        start = w
        grad = xc.T @ (yc - xc @ w) / 500
        assert np.abs(grad).max() <= alpha + 1e-8
        np.testing.assert_allclose(grad[w != 0], alpha * np.sign(w[w != 0]), atol=1e-8)
        np.testing.assert_allclose(w, cold, atol=1e-6)


def test_many_features(spark):
    """1,500 features: grid, folds and curve against numpy."""
    rng = np.random.default_rng(3)
    n, p = 1800, 1500
    x = rng.normal(size=(n, p)).round(3)
    y = x[:, :30] @ rng.normal(size=30) + rng.normal(size=n)
    names = [f"x{i}" for i in range(p)]
    pdf = pd.DataFrame(x, columns=names).assign(y=y, k=np.arange(n), fold=np.arange(n) % 3)
    wide = spark.createDataFrame(pdf).repartition(4)
    wide = wide.withColumn("h", F.array(*[
        F.when(F.col("fold") == f, 0).otherwise(F.col("k") % 2 + 1) for f in range(3)]))
    from tabulon.session import stored

    wide = stored(wide, "wide")

    def fit(t, alpha):
        xc, yc = x[t] - x[t].mean(0), y[t] - y[t].mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(p), xc.T @ yc)
        return w, y[t].mean() - x[t].mean(0) @ w

    sums = L.products(wide, names, "y", F.col("fold"))
    _, scores = L.grid_search(wide, names, "y", "fold", "ridge", [10.0, 1000.0], sums)
    for r in scores.collect():
        t = np.arange(n) % 3 != r["fold"]
        w, b = fit(t, r["alpha"])
        assert r["test_mse"] == pytest.approx(((y - b - x @ w)[~t] ** 2).mean(), rel=1e-6)
    curve = L.learning_curve(wide, names, "y", "h", 3, 2, "ridge", 10.0).collect()
    want = []
    for f in range(3):
        w, b = fit((np.arange(n) % 3 != f) & (np.arange(n) % 2 == 0), 10.0)
        want.append(((y - b - x @ w)[np.arange(n) % 3 == f] ** 2).mean())
    assert curve[0]["val_rmse"] == pytest.approx(np.sqrt(np.mean(want)), rel=1e-6)
    lasso = L.fit_linear(wide, names, "y", "lasso", 0.1, sums)
    w = np.array(lasso.coefficients)
    grad = (x - x.mean(0)).T @ (y - lasso.intercept - x @ w) / n
    assert np.abs(grad).max() <= 0.1 + 1e-6 and 20 < (w != 0).sum() < 400
    np.testing.assert_allclose(grad[w != 0], 0.1 * np.sign(w[w != 0]), atol=1e-6)


def test_cross_validation(df, data):
    x, y = data
    out = {r["part"]: r for r in L.cross_validate(df, NAMES, "y", "fold", "ridge", 5.0).collect()}
    mae, r2 = [], []
    for f in range(5):
        t = folds() == f
        w, b = ridge(x[~t], y[~t], 5.0)
        e = (y - b - x @ w)[t]
        mae.append(np.abs(e).mean())
        r2.append(1 - (e ** 2).mean() / y[t].var())
    assert out["test"]["mae_mean"] == pytest.approx(np.mean(mae))
    assert out["test"]["mae_std"] == pytest.approx(np.std(mae))
    assert out["test"]["r2_mean"] == pytest.approx(np.mean(r2))
    assert out["train"]["mse_mean"] < out["test"]["mse_mean"]


def test_learning_curve(df, data):
    x, y = data
    sub = S.learning_subsets(df, ["k"], "fold", 5, steps=4).persist()
    curve = L.learning_curve(sub, NAMES, "y", "steps_from", 5, 4, "ridge", 1.0).toPandas()
    held = sub.toPandas().sort_values("k")
    steps = np.array(held["steps_from"].tolist())
    for s in (1, 4):
        val = []
        for f in range(5):
            t = (steps[:, f] > 0) & (steps[:, f] <= s)
            w, b = ridge(x[t], y[t], 1.0)
            val.append(((y - b - x @ w)[steps[:, f] == 0] ** 2).mean())
        row = curve[curve["step"] == s].iloc[0]
        assert row["val_rmse"] == pytest.approx(np.sqrt(np.mean(val)))
        assert row["val_band"] == pytest.approx(np.sqrt(np.std(val)))
        assert row["train_rows"] == 320 * s // 4


def test_nulls_are_refused(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 1.0)], "x double, y double")
    with pytest.raises(ValueError):
        L.products(df, ["x"], "y")


def test_constant_label(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, y double")
    for kind in ("ridge", "lasso"):
        for model in (L.fit_linear(df, ["x"], "y", kind), L.mllib_model(df, ["x"], "y", kind)):
            assert model.coefficients[0] == pytest.approx(0)
            assert model.intercept == pytest.approx(5)


def test_model_round_trip_and_tables(spark, df, tmp_path):
    model = L.fit_linear(df, NAMES, "y", "lasso", 20.0)
    model.save(spark, str(tmp_path / "m"))
    assert L.load_model(spark, str(tmp_path / "m")) == model
    table = model.coefficient_table(spark).collect()
    assert [r["abs_coefficient"] for r in table] == sorted(
        map(abs, model.coefficients), reverse=True)
    assert [r["rank"] for r in model.importance(spark, 3).orderBy("rank").collect()] == [1, 2, 3]
    info = model.info()
    assert info["non_zero"] == sum(abs(w) > 1e-10 for w in model.coefficients)
    assert info["sparsity"] == info["non_zero"] / P and info["cv_mean"] is None
    got = model.predict(df).select("prediction", "k").orderBy("k").toPandas()["prediction"]
    want = df.toPandas().sort_values("k")[NAMES].values @ model.coefficients + model.intercept
    np.testing.assert_allclose(got, want)
