"""Sparse feature rows against the dense columns, and saves that are whole or not there."""

import numpy as np
import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tabulon.operators import features as E
from tabulon.operators import linear
from tabulon.operators import sparse as S


def dense_rows(out, size):
    made = {}
    for r in out.collect():
        assert list(r["indices"]) == sorted(set(r["indices"]))
        row = [0.0] * size
        for i, v in zip(r["indices"], r["values"]):
            row[i] = v
        made[r["id"]] = row
    return made


@pytest.fixture(scope="module")
def table(spark):
    """Rare values, values only outside the training rows, nulls, ties and a value named like the
    group of rare ones."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        k = str(rng.choice(["a", "b", "c", "d", "OTROS", None], p=[.4, .3, .1, .05, .05, .1]))
        rows.append((i, None if k == "None" else k, f"v{rng.integers(40)}",
                     float(rng.normal()) if i % 9 else None, int(i % 2), int(i % 5 > 0)))
    rows += [(1000, "only", "v999", 1.0, 1, 0), (1001, "", "", 0.0, 0, 1)]
    return spark.createDataFrame(
        rows, "id int, k string, w string, x double, f int, train int").repartition(3)


@pytest.mark.parametrize("drop_first", [True, False])
@pytest.mark.parametrize("threshold", [None, 1, 15, 10_000])
def test_equal_to_the_columns(table, drop_first, threshold):
    settings = E.FeatureSettings(("x", "f"), ("k", "w", "absent"), rare_threshold=threshold,
                                 drop_first=drop_first)
    train = table.filter("train = 1")
    dense = E.fit_features(train, settings, table)
    sparse = S.fit_sparse_features(train, settings, table)
    assert sparse.size == len(dense.names)
    new = table.unionByName(table.sparkSession.createDataFrame(
        [(2000, "unseen", None, 2.0, 1, 0)], table.schema))
    want = {r["id"]: [r[n] for n in dense.names]
            for r in dense.transform(new, ["id"]).collect()}
    assert dense_rows(sparse.transform(new, ["id"]), sparse.size) == want
    names = {r["index"]: r["name"] for r in sparse.names().collect()}
    assert [names[i] for i in range(sparse.size)] == list(dense.names)


def test_shuffled_vocabularies_give_the_same(table, monkeypatch):
    settings = E.FeatureSettings(("x",), ("k", "w"), rare_threshold=2)
    fitted = S.fit_sparse_features(table, settings)
    want = dense_rows(fitted.transform(table, ["id"]), fitted.size)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert dense_rows(fitted.transform(table, ["id"]), fitted.size) == want


def test_no_categories_and_no_rows(spark, table):
    fitted = S.fit_sparse_features(table, E.FeatureSettings(("x",), ()))
    assert fitted.size == 1 and fitted.names().count() == 1
    assert fitted.transform(table.limit(0), ["id"]).collect() == []
    none = S.fit_sparse_features(table.limit(0), E.FeatureSettings((), ("k",)))
    assert none.size == 0 and none.transform(table, ["id"]).where(F.size("indices") > 0).count() == 0


def test_no_driver_copy_of_a_large_vocabulary(spark, tmp_path, monkeypatch):
    """50,000 values through fit, save, load and transform; the driver collects a row a column."""
    n = 50_000
    df = spark.range(2 * n).select(
        "id", F.format_string("v%06d", F.col("id") % n).alias("word"),
        (F.col("id") % 3).cast("string").alias("small"))
    collected = []
    real = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect",
                        lambda self: collected.append(r := real(self)) or r)
    fitted = S.fit_sparse_features(df, E.FeatureSettings((), ("word", "small"), rare_threshold=1))
    path = str(tmp_path / "sparse")
    fitted.save(spark, path)
    loaded = S.load_sparse_features(spark, path)
    out = loaded.transform(df, ["id"])
    monkeypatch.setattr(DataFrame, "collect", real)
    assert max(map(len, collected), default=0) <= 2
    assert loaded.size == fitted.size == n - 1 + 2
    bad = out.where(~F.expr(
        f"indices <=> filter(array(if(id % {n} > 0, id % {n} - 1, null), "
        f"if(id % 3 > 0, {n - 1} + id % 3 - 1, null)), x -> x is not null)"))
    assert bad.count() == 0 and out.count() == 2 * n


def test_transform_needs_no_shuffle(table):
    fitted = S.fit_sparse_features(table, E.FeatureSettings(("x",), ("k", "w")))
    plan = fitted.transform(table)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("kind", ["model", "dense", "sparse"])
def test_a_save_that_dies_leaves_the_version_before(spark, table, tmp_path, monkeypatch, kind):
    path = str(tmp_path / kind)

    def make(second):
        if kind == "model":
            return linear.LinearModel("ridge", 2.0 if second else 1.0, ("x", "f"),
                                      (3.0, 4.0) if second else (1.0, 2.0), 0.5)
        settings = E.FeatureSettings(("x", "f") if second else ("x",), ("k",), rare_threshold=1)
        return (E.fit_features if kind == "dense" else S.fit_sparse_features)(table, settings)

    def load():
        if kind == "model":
            return linear.load_model(spark, path).coefficients
        load = E.load_features if kind == "dense" else S.load_sparse_features
        return load(spark, path).numeric

    first, second = make(False), make(True)
    first.save(spark, path)
    before = load()
    real, calls = DataFrameWriter.parquet, []

    def dies(self, *args, **options):
        calls.append(args)
        if len(calls) == stop:
            raise RuntimeError("lost")
        return real(self, *args, **options)

    writes = 4 if kind == "dense" else 3
    for stop in range(1, writes + 1):
        calls.clear()
        monkeypatch.setattr(DataFrameWriter, "parquet", dies)
        with pytest.raises(RuntimeError):
            second.save(spark, path)
        monkeypatch.setattr(DataFrameWriter, "parquet", real)
        assert load() == before
    second.save(spark, path)
    assert load() != before
