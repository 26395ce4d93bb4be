import numpy as np
import pandas as pd
import pytest

from tabulon.operators.split import split_sizes
from tabulon.plans import graduates as G
from tabulon.plans.pipeline import PlanSettings, quick_training, run_plan


@pytest.fixture(scope="module")
def graduates(spark):
    """Rows in the shape of the graduates table, with a numeric row key."""
    rng = np.random.default_rng(4)
    n = 900
    year = rng.integers(2020, 2025, n)
    pdf = pd.DataFrame({
        "row": np.arange(n), "UUID": [f"u{i}" for i in range(n)], "FECHA_CORTE": "20241231",
        "FECHA_EGRESO": "x", "MODALIDAD": "P",
        "NIVEL_ACADEMICO": rng.choice(["PREGRADO", "POSGRADO", "SEGUNDA ESPECIALIDAD"], n,
                                      p=[0.7, 0.2, 0.1]),
        "FACULTAD": rng.choice([f"F{i}" for i in range(4)], n),
        "PROGRAMA_ESTUDIOS": rng.choice([f"P{i}" for i in range(30)], n),
        "SITUACIÓN ALUMNO": rng.choice(["EGRESADO", "TITULO"], n),
        "SEDE": rng.choice(["EL RIMAC", "LA MOLINA"], n), "SEXO": rng.choice(["F", "M"], n),
        "SEMESTRE_EGRESO": [f"{y}{s}" for y, s in zip(year, rng.integers(1, 3, n))],
        "DETALLE_TIPO_ESTUDIO": rng.choice(["REGULAR", "ITINERANTE"], n, p=[0.9, 0.1]),
        "ANNIO_EGRESO": year, "CREDITOS_ACUMULADOS": rng.normal(200, 15, n).round(1),
        "ANNIO_MATRICULA1": year - rng.integers(4, 8, n),
        "ANNIO_SOLICITUD_TRAMITE": year + rng.integers(0, 3, n)})
    pdf["PROMEDIO_FINAL"] = (15 + (pdf["SEXO"] == "F") * 0.6 + (year - 2022) * 0.2
                             + rng.normal(0, 0.4, n)).round(2)
    return spark.createDataFrame(pdf)


def test_full_plan(spark, graduates):
    with pytest.warns(UserWarning, match="SITUACION_ALUMNO"):
        plan = run_plan(graduates, PlanSettings(
            G.TARGET, ("row",), G.EXCLUDED, (G.STRATA,), G.DERIVED, folds=3,
            grids={"ridge": [0.1, 10.0], "lasso": [0.001, 1.0]}))
    steps = [s[1] for s in plan.log.steps]
    assert steps == ["start", "roles", "missing values", "outliers", "types", "split"]
    rows = plan.log.steps[-1][3]
    assert plan.split_rows == dict(zip(("train", "val", "test"), split_sizes(rows)))
    names = plan.features.names
    assert names[:11] == (*G.NUMERIC, *[d.name for d in G.DERIVED])
    assert "SITUACIÓN ALUMNO_TITULO" in names and "SEXO_M" in names and "SEXO_F" not in names
    assert "PROGRAMA_ESTUDIOS_OTROS" in names or plan.features.categories[
        "PROGRAMA_ESTUDIOS"][0] == "OTROS"
    table = {r["model"]: r for r in plan.comparison.collect()}
    assert set(table) == {"ridge", "lasso"}
    assert all(r["r2"] > 0.3 and r["rmse"] < 0.6 for r in table.values())
    assert plan.models["lasso"].alpha == 0.001
    assert plan.predictions.count() == 2 * plan.split_rows["test"]
    report = plan.report().first()
    assert report["n_features_engineered"] == len(names)
    assert report["best_model"] in table and len(report["metrics"]) == 2


def test_quick_training(spark, graduates):
    doubled = graduates.unionByName(graduates.limit(50))
    models, scores = quick_training(doubled.withColumnRenamed("row", "k"), G.TARGET, ["k"],
                                    alpha=0.01)
    got = scores.collect()
    assert [r["model"] for r in got] == sorted(
        models, key=lambda m: next(r["rmse"] for r in got if r["model"] == m))
    assert models["ridge"].features == G.NUMERIC
    assert models["ridge"].metadata["train_samples"] == 720
