import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import score as S
from tabulon.operators.features import FeatureSettings, fit_features
from tabulon.operators.linear import LinearModel, fit_linear
from tabulon.operators.validate import row_errors
from tabulon.plans import graduates as G
from tabulon.streaming.scoring import score_rows, write_scores

GOOD = {"FACULTAD": "CIENCIAS", "PROGRAMA_ESTUDIOS": "P1", "NIVEL_ACADEMICO": "PREGRADO",
        "SEDE": "LA MOLINA", "SEXO": "F", "DETALLE_TIPO_ESTUDIO": "REGULAR",
        "ANNIO_EGRESO": "2024", "SEMESTRE_EGRESO": "20241", "CREDITOS_ACUMULADOS": "216",
        "ANNIO_MATRICULA1": "2020", "ANNIO_SOLICITUD_TRAMITE": "2024"}


def test_request_rules(spark):
    cases = [
        ({}, []),
        ({"SEDE": ""}, ["Feature vacío: SEDE"]),
        ({"SEXO": None, "CREDITOS_ACUMULADOS": None},
         ["Feature vacío: SEXO", "Feature vacío: CREDITOS_ACUMULADOS"]),
        ({"CREDITOS_ACUMULADOS": "many"}, ["Feature CREDITOS_ACUMULADOS debe ser numérico"]),
        ({"ANNIO_EGRESO": "2019"}, ["ANNIO_EGRESO debe estar entre 2020 y 2030",
                                    "ANNIO_MATRICULA1 no puede ser mayor que ANNIO_EGRESO"]),
        ({"ANNIO_EGRESO": "2031"}, ["ANNIO_EGRESO debe estar entre 2020 y 2030"]),
        ({"CREDITOS_ACUMULADOS": "-1"}, ["CREDITOS_ACUMULADOS debe estar entre 0 y 300"]),
        ({"CREDITOS_ACUMULADOS": "301"}, ["CREDITOS_ACUMULADOS debe estar entre 0 y 300"]),
    ]
    names = list(GOOD)
    df = spark.createDataFrame(
        [(i, *[(GOOD | change)[n] for n in names]) for i, (change, _) in enumerate(cases)],
        "i int, " + ", ".join(f"{n} string" for n in names))
    out = row_errors(df, G.REQUEST_RULES).orderBy("i").collect()
    assert [list(r["errors"]) for r in out] == [want for _, want in cases]
    assert [r["is_valid"] for r in out] == [not want for _, want in cases]
    absent = row_errors(df.drop("FACULTAD"), G.REQUEST_RULES).filter("i = 0").first()
    assert absent["errors"] == ["Feature faltante: FACULTAD"]
    good, bad = S.valid_and_rejected(df, G.REQUEST_RULES)
    assert good.count() == 1 and bad.count() == len(cases) - 1 and "errors" in bad.columns


def test_intervals_and_labels(spark):
    df = spark.createDataFrame([(p,) for p in (10.0, 14.0, 15.0, 15.96, 17.2, 25.0, None)],
                               "p double")
    out = S.score_details(df, F.col("p"), G.HISTORY, G.INTERPRETATION).collect()
    assert [r["prediction"] for r in out] == [12.23, 14.0, 15.0, 15.96, 17.2, 19.30, None]
    assert out[0]["lower_bound"] == 12.23 and out[5]["upper_bound"] == 19.30
    assert out[2]["upper_bound"] == pytest.approx(15 + 1.96 * 0.575)
    assert out[3]["percentile"] == pytest.approx(50, abs=1e-4)
    assert [r["interpretation"] for r in out] == [G.INTERPRETATION[i] for i in (0, 0, 1, 2, 3, 3)
                                                  ] + [None]
    assert out[6]["lower_bound"] is None


def test_requests_with_defaults(spark):
    reference = spark.createDataFrame([(float(i), 2.0 * i, 10.0 + i) for i in range(9)],
                                      "a double, b double, y double")
    defaults = S.fit_request_defaults(reference, ["a", "b"], "y")
    assert defaults.medians == {"a": 4.0, "b": 8.0} and defaults.mean == 14.0
    requests = spark.createDataFrame([(1, None), (2, 30.0)], "id int, a double")
    out = S.score_requests(requests, F.col("a") + F.col("b"), defaults,
                           G.REQUEST_INTERPRETATION).orderBy("id").collect()
    assert [r["prediction"] for r in out] == [12.0, 20.0]
    assert out[1]["upper_bound"] == 20.0 and 0 <= out[0]["percentile"] < 50
    assert out[0]["interpretation"] == G.REQUEST_INTERPRETATION[2]


MODEL = LinearModel("ridge", 1.0, ("a", "b", "c"), (1.0, -2.0, 0.5), 10.0)


def test_contributions_add_up(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (20, 3)), columns=["a", "b", "c"]))
    for r in S.contributions(MODEL.predict(df), MODEL, 3).collect():
        parts = [t["contribution"] for t in r["top_features"]]
        assert sum(parts) == pytest.approx(r["total_contribution"])
        assert r["raw_prediction"] == pytest.approx(r["prediction"])
        assert [abs(p) for p in parts] == sorted(map(abs, parts), reverse=True)
    assert len(S.contributions(df, MODEL, 2).first()["top_features"]) == 2


def test_explanation(spark):
    df = spark.createDataFrame([(1.0, -2.5, 0.1)], "a double, b double, c double")
    df = S.score_batch(S.contributions(df, MODEL), F.col("raw_prediction"), G.HISTORY)
    assert S.explain(df, G.HISTORY).first()["explanation"] == (
        "Predicción: 16.05 puntos\n\nFactores principales que influyeron:\n"
        "1. b: influyó positivamente (contribución: 5.0000)\n"
        "2. a: influyó positivamente (contribución: 1.0000)\n"
        "3. c: influyó positivamente (contribución: 0.0500)\n"
        "\nComparación:\n• Promedio histórico: 15.96\n"
        "• Tu predicción está 0.09 puntos por encima del promedio\n")


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    rows = pd.DataFrame({"id": np.arange(40), "x": np.arange(40) * 1.0,
                         "c": ["u", "v"] * 20}).assign(y=lambda d: 10 + d["x"] / 5)
    df = spark.createDataFrame(rows)
    fitted = fit_features(df, FeatureSettings(("x",), ("c",), rare_threshold=1))
    model = fit_linear(fitted.transform(df, ["y"]), list(fitted.names), "y", "ridge", 0.1)
    source = str(tmp_path / "in")
    df.write.parquet(source)
    batch = score_rows(df, fitted, model, G.HISTORY, ["id"])
    stream = spark.readStream.schema(df.schema).parquet(source)
    query = write_scores(score_rows(stream, fitted, model, G.HISTORY, ["id"]),
                         str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert got == batch.orderBy("id").collect() and len(got) == 40
