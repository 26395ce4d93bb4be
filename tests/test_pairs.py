"""Pairwise-complete correlations against numpy, and duplicates against a set."""

import math

import numpy as np
import pandas as pd
import pytest

from tabulon.operators import clean, profile


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    n = 500
    base = rng.normal(size=n)
    pdf = pd.DataFrame({
        "a": base, "b": base + rng.normal(size=n), "far": 1e9 + rng.normal(size=n),
        "holes": np.where(rng.random(n) < 0.4, np.nan, base ** 2),
        "more": np.where(rng.random(n) < 0.7, np.nan, -base),
        "constant": 0.1, "none": np.nan,
        "outlier": np.where(np.arange(n) == 7, 1e6, base)})
    # Constant only where both are there.
    pdf["half"] = np.where(np.arange(n) % 2, 3.3, rng.normal(size=n))
    pdf["odd"] = np.where(np.arange(n) % 2, base, np.nan)
    return pdf


@pytest.mark.parametrize("few, block, parts", [(12, 700, 3), (0, 700, 1), (0, 700, 7), (0, 3, 7)])
def test_correlations(spark, table, few, block, parts, monkeypatch):
    monkeypatch.setattr(profile, "FEW_COLUMNS", few)
    monkeypatch.setattr(profile, "PAIR_COLUMNS", block)
    df = spark.createDataFrame(table.astype(object).where(table.notna(), None).values.tolist(),
                               ", ".join(f"{c} double" for c in table)).repartition(parts)
    got = {(r["column_a"], r["column_b"]): r["correlation"]
           for r in profile.correlation_matrix(df).collect()}
    assert len(got) == len(table.columns) ** 2
    for a in table:
        for b in table:
            both = table[a].notna() & table[b].notna()
            x, y = table[a][both], table[b][both]
            if len(x) < 2 or x.nunique() == 1 or y.nunique() == 1:
                assert got[a, b] is None, (a, b)
            else:
                assert math.isclose(got[a, b], np.corrcoef(x, y)[0, 1], abs_tol=1e-6), (a, b)


@pytest.mark.parametrize("few", [12, 0])
def test_no_rows(spark, few, monkeypatch):
    monkeypatch.setattr(profile, "FEW_COLUMNS", few)
    df = spark.createDataFrame([], "a double, b double")
    assert [r["correlation"] for r in profile.correlation_matrix(df).collect()] == [None] * 4


@pytest.mark.parametrize("limit", [200_000, 0])
def test_drop_duplicates(spark, limit, monkeypatch):
    monkeypatch.setattr(clean, "BROADCAST_ROWS", limit)
    rows = [(i % 40, None if i % 3 else "x", float(i % 2)) for i in range(500)]
    rows += [(None, None, None)] * 5 + [(1000 + i, "only", 0.0) for i in range(30)]
    rows += [(7, "zero", 0.0), (7, "zero", -0.0), (8, "nan", float("nan")),
             (8, "nan", float("nan"))]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(4)
    got = clean.drop_duplicates(df)
    assert got.columns == df.columns
    want = df.dropDuplicates()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert clean.drop_duplicates(df.limit(0)).count() == 0


def test_watched_steps_are_counted_by_the_job_that_reads_them(spark):
    log = clean.ProcessingLog()
    df = log.watch("start", "all", spark.range(100))
    log.same_rows("roles", "none", df)
    df = log.watch("filter", "even", df.filter("id % 2 = 0"))
    df.write.format("noop").mode("overwrite").save()
    assert [s[3] for s in log.steps] == [100, 100, 50]
    assert log.report()["rows_lost"] == 50
