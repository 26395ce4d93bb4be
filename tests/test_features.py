import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.functions.expr import (
    band, clip, col, correlation, normal_cdf, normal_ppf, safe_divide)
from tabulon.operators import features as E
from tabulon.plans.graduates import DERIVED


def test_expressions_keep_null_apart(spark):
    df = spark.createDataFrame([(20.0, 0.0), (None, 2.0), (-3.0, None), (4.0, 2.0)],
                               "a double, b double")
    out = df.select(clip(col("a"), 0, 15).alias("clip"),
                    safe_divide(col("a"), col("b"), -1.0).alias("ratio"),
                    band(col("a"), [0, 15], ["low", "mid", "high"]).alias("band"),
                    E.equals_flag(col("a"), 4.0).alias("flag")).collect()
    assert [r["clip"] for r in out] == [15.0, None, 0.0, 4.0]
    assert [r["ratio"] for r in out] == [-1.0, None, None, 2.0]
    assert [r["band"] for r in out] == ["high", None, "low", "mid"]
    assert [r["flag"] for r in out] == [0, 0, 0, 1]
    constant = df.withColumn("b", F.lit(1.0))
    assert constant.agg(correlation(col("a"), col("b"))).first()[0] is None


def test_normal_distribution(spark):
    ps = [1e-4, 0.01, 0.02425, 0.3, 0.5, 0.9, 0.99, 0.9999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for r in df.select("p", normal_ppf(col("p")).alias("z")).collect():
        exact = 0.5 * math.erfc(-r["z"] / math.sqrt(2))
        assert exact == pytest.approx(r["p"], abs=1e-8)
    zs = spark.createDataFrame([(z / 4,) for z in range(-16, 17)], "z double")
    for r in zs.select("z", normal_cdf(col("z")).alias("p")).collect():
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), abs=1e-7)


def test_derived_columns(spark):
    df = spark.createDataFrame(
        [(2024, 2000, 200.0, 2026, "POSGRADO", "F", "REGULAR"),
         (2020, 2022, 100.0, 2019, "PREGRADO", "M", "OTRO"),
         (None, 2018, None, 2021, None, None, None)],
        "ANNIO_EGRESO int, ANNIO_MATRICULA1 int, CREDITOS_ACUMULADOS double, "
        "ANNIO_SOLICITUD_TRAMITE int, NIVEL_ACADEMICO string, SEXO string, "
        "DETALLE_TIPO_ESTUDIO string")
    out, names = E.add_derived(df, DERIVED)
    assert names == ["DURACION_ESTUDIOS", "ANNIO_EGRESO_NORM", "CREDITOS_POR_ANNIO",
                     "ES_POSTGRADO", "SEXO_BIN", "TIEMPO_TRAMITE", "ES_REGULAR"]
    rows = [tuple(r[n] for n in names) for r in out.collect()]
    assert rows == [(15, 4, 12.5, 1, 1, 2, 1), (0, 0, 100.0, 0, 0, 0, 0),
                    (None, None, None, 0, 0, None, 0)]
    # Applying twice adds nothing new, and a missing input only drops its own columns.
    assert E.add_derived(out, DERIVED)[0].columns == out.columns
    assert "SEXO_BIN" not in E.add_derived(df.drop("SEXO"), DERIVED)[1]
    ratio = spark.createDataFrame([(5.0, -1), (0.0, -1), (6.0, 2)], "c double, d int")
    assert [r[0] for r in ratio.select(E.ratio_plus_one(col("c"), col("d"))).collect()] == [
        0.0, None, 2.0]


@pytest.fixture(scope="module")
def table(spark):
    """a: 50 training rows, b: 49, c: 3 rows, all in test; z occurs at scoring only."""
    rows = [("a", 1)] * 50 + [("b", 1)] * 49 + [("c", 0)] * 3 + [("a", 0)] * 2
    return spark.createDataFrame([(i, v, t, float(i % 7), i % 2) for i, (v, t) in
                                  enumerate(rows)], "id int, k string, train int, x double, f int")


def test_rare_categories(table):
    counts = E.category_counts(table, ["k"], col("train") == 1)
    assert {r["value"]: r["n"] for r in counts.collect()} == {"a": 50, "b": 49, "c": 0}
    rare = E.rare_categories(counts, 50)
    for inline in (10, 0):
        out = E.group_rare(table, ["k"], rare, inline=inline)
        assert {r["k"] for r in out.collect()} == {"a", "OTROS"}
        assert out.columns == table.columns


def test_fitted_features(spark, table, tmp_path):
    train = table.filter("train = 1")
    settings = E.FeatureSettings(("x", "f"), ("k",))
    fitted = E.fit_features(train, settings, table)
    assert fitted.categories == {"k": ("OTROS", "a")} and fitted.rare == {"k": ("b", "c")}
    assert fitted.names == ("x", "f", "k_a")
    # A single row neither changes which columns are binary nor their scale.
    new = spark.createDataFrame([(1, "z", 3.0, 1), (2, "c", None, 0), (3, "a", 1.0, 0)],
                                "id int, k string, x double, f int")
    out = fitted.transform(new, ["id"]).orderBy("id").collect()
    x = train.toPandas()["x"]
    assert out[0]["x"] == pytest.approx((3.0 - x.mean()) / x.std(ddof=0))
    assert [r["f"] for r in out] == [1.0, 0.0, 0.0] and [r["k_a"] for r in out] == [0, 0, 1]
    assert out[1]["x"] is None
    path = str(tmp_path / "features")
    fitted.save(spark, path)
    again = E.load_features(spark, path)
    assert again.names == fitted.names and again.rare == fitted.rare
    assert again.transform(new, ["id"]).orderBy("id").collect() == out
    assert fitted.transform(new).drop("x").schema.simpleString() == "struct<f:double,k_a:double>"


def test_transform_needs_no_shuffle(spark, table):
    fitted = E.fit_features(table, E.FeatureSettings(("x",), ("k",)))
    plan = fitted.transform(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_scalers(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 6.0], "c": [4.0] * 3, "b": [0.0, 1.0, 1.0]})
    df = spark.createDataFrame(pdf)
    out = E.fit_scaler(df, ["a", "c", "b"]).apply(df).toPandas()
    assert out["a"].tolist() == pytest.approx(((pdf["a"] - 3) / pdf["a"].std(ddof=0)).tolist())
    assert out["c"].tolist() == [0, 0, 0] and out["b"].tolist() == [0, 1, 1]
    out = E.fit_scaler(df, ["a", "c", "b"], "minmax", False).apply(df).toPandas()
    assert out["a"].tolist() == [0, 0.2, 1] and out["c"].tolist() == [0, 0, 0]
    assert E.binary_columns(df, ["a", "b", "c"]) == ["b"]
    with pytest.raises(ValueError):
        E.fit_scaler(df, ["a"], "robust")


def test_encoders(spark):
    df = spark.createDataFrame([(1, "b"), (2, "ñ"), (3, "a"), (4, None), (5, "b")],
                               "id int, k string")
    labels = E.label_encode(df, "k", E.label_vocabulary(df, "k")).orderBy("id").collect()
    assert [r["k_label"] for r in labels] == [1, 2, 0, None, 1]
    first = E.appearance_vocabulary(df, "k", ["id"])
    coded = E.label_encode(df, "k", first, "c")
    assert [r["c"] for r in coded.orderBy("id").collect()] == [0, 1, 2, None, 0]
    back = E.label_decode(coded, "c", first, "d").orderBy("id").collect()
    assert [r["d"] for r in back] == ["b", "ñ", "a", None, "b"]
    big = E.label_encode(df, "k", E.label_vocabulary(df, "k", driver_rows=1))
    assert [r["k_label"] for r in big.orderBy("id").collect()] == [1, 2, 0, None, 1]
    wide, names = E.one_hot(df, {"k": ["a", "b"]})
    assert names == ["k_b"] and [r["k_b"] for r in wide.orderBy("id").collect()] == [1, 0, 0, 0, 1]
    nested = spark.range(1).select(F.struct(F.struct(F.lit(1).alias("c")).alias("b"),
                                            F.lit(2).alias("x y")).alias("a"))
    assert E.flatten_struct(nested).columns == ["a_b_c", "a_x y"]
