import pytest
from pyspark.sql import functions as F

from tabulon.operators import split as S


def numbered(spark, n, strata=None):
    df = spark.range(n).withColumnRenamed("id", "k")
    return df if strata is None else df.withColumn("s", strata)


def test_sizes_of_the_published_run():
    assert S.split_sizes(9308) == (6514, 1397, 1397)


def test_largest_remainder():
    assert S.largest_remainder({"a": 5, "b": 3, "c": 2}, 5) == {"a": 3, "b": 1, "c": 1}
    assert sum(S.largest_remainder({i: 7 for i in range(13)}, 40).values()) == 40


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 3}, {"driver_strata": 1}])
def test_split_is_exact_and_ignores_partitioning(spark, limits):
    hot = F.when(F.col("k") % 3 == 0, "hot").otherwise((F.col("k") % 4).cast("string"))
    df = numbered(spark, 1203, hot)
    a = S.three_way_split(df, ["k"], ["s"], **limits).toPandas()
    b = S.three_way_split(df.repartition(7, "s"), ["k"], ["s"]).toPandas()
    assert len(a) == 1203 and a["k"].is_unique
    n_train, n_val, n_test = S.split_sizes(1203)
    assert a["split"].value_counts().to_dict() == {
        "train": n_train, "val": n_val, "test": n_test}
    merged = a.merge(b, on="k")
    assert (merged["split_x"] == merged["split_y"]).all()
    for _, part in a.groupby("s"):
        share = (part["split"] == "test").mean()
        assert abs(share - 0.15) < 1.5 / len(part) + 0.01


def test_seed_changes_the_split(spark):
    df = numbered(spark, 300)
    a = S.train_test_split(df, ["k"], seed=1).toPandas().sort_values("k")["split"].tolist()
    b = S.train_test_split(df, ["k"], seed=2).toPandas().sort_values("k")["split"].tolist()
    assert a != b and a.count("test") == b.count("test") == 60


def test_null_stratum(spark):
    df = numbered(spark, 200, F.when(F.col("k") % 2 == 0, "x"))
    out = S.three_way_split(df, ["k"], ["s"]).groupBy("s", "split").count().collect()
    assert sum(r["count"] for r in out) == 200
    assert {r["split"] for r in out if r["s"] is None} == {"train", "val", "test"}


@pytest.mark.parametrize("driver_strata", [100, 1])
def test_single_row_stratum_is_an_error(spark, driver_strata):
    df = numbered(spark, 100, F.when(F.col("k") == 5, "lonely").otherwise("many"))
    with pytest.raises(ValueError):
        S.three_way_split(df, ["k"], ["s"], driver_strata=driver_strata)


def test_folds_are_contiguous_and_even(spark):
    df = numbered(spark, 11).select((F.col("k") % 3).alias("a"), "k")
    out = S.kfold(df, ["a", "k"], 3).toPandas().sort_values(["a", "k"])
    assert out["fold"].tolist() == [0] * 4 + [1] * 4 + [2] * 3
    with pytest.raises(ValueError):
        S.kfold(numbered(spark, 2), ["k"], 3)


@pytest.mark.parametrize("bucket_rows", [2, 20_000])
def test_learning_subsets_are_nested(spark, bucket_rows):
    df = S.kfold(numbered(spark, 100), ["k"], 4)
    out = S.learning_subsets(df, ["k"], "fold", 4, steps=5, bucket_rows=bucket_rows).toPandas()
    for f in range(4):
        steps = out["steps_from"].str[f]
        assert (steps[out["fold"] == f] == 0).all()
        for s in range(1, 6):
            assert ((steps > 0) & (steps <= s)).sum() == 75 * s // 5


def test_learning_subsets_of_an_empty_fold_and_rows_without_fold(spark):
    df = numbered(spark, 90).withColumn("fold", F.when(F.col("k") >= 10, F.col("k") % 2))
    out = S.learning_subsets(df, ["k"], "fold", 3, steps=4, bucket_rows=5).toPandas()
    known = out[out["k"] >= 10]
    for f, n in ((0, 40), (1, 40), (2, 80)):
        steps = known["steps_from"].str[f]
        assert [((steps > 0) & (steps <= s)).sum() for s in (1, 2, 3, 4)] \
            == [n * s // 4 for s in (1, 2, 3, 4)]


TEXTS = ["", "a", "a\x00", "a\x00b", "aa", "abcdef", "abcdefg", "abcdefgh" * 4, "ä", "漢字", "😀",
         "z" * 40 + "1", "z" * 40 + "2", "Z"]


@pytest.mark.parametrize("bracket", [1, 3, 50_000])
def test_ranks_of_texts(spark, bracket):
    """Short ones, shared beginnings, a value on a third of the rows, characters beyond ASCII."""
    from tabulon.operators.quantiles import text_ranks

    rows = [t for i, t in enumerate(TEXTS) for _ in range(1 + i % 3)] + ["mmmmmmmm"] * 15
    rows += [f"common-prefix-{i:04d}" for i in range(20)]
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(3)
    ordered = sorted(rows, key=str.encode)
    got = text_ranks(df, F.col("t"), range(len(rows)), bracket)
    assert got == {r: (t, ordered.index(t), ordered.count(t)) for r, t in enumerate(ordered)}


@pytest.mark.parametrize("bracket", [2, 50_000])
def test_folds_by_texts_and_nulls(spark, bracket, monkeypatch):
    from tabulon.operators import quantiles

    monkeypatch.setattr(quantiles.cut_by_rank, "__defaults__", (bracket, None, None))
    rows = [(t if i % 4 else None, d if i % 3 else None, i)
            for i, (t, d) in enumerate((t, d) for t in [*TEXTS, "same", "same"]
                                       for d in ("x", "y", "z", "same-day"))]
    df = spark.createDataFrame(rows, "t string, d string, k int").repartition(3)
    order = sorted(rows, key=lambda r: [(x is not None, x.encode() if isinstance(x, str) else x)
                                        for x in r])
    for k in (2, 5, 9):
        want = {}
        starts = S.fold_starts(len(rows), k)
        for i, r in enumerate(order):
            want[r[2]] = sum(i >= s for s in starts) - 1
        assert {r["k"]: r["fold"] for r in S.kfold(df, ["t", "d", "k"], k).collect()} == want


def test_plan_by_a_text_key(spark):
    from tabulon.plans.pipeline import PlanSettings, run_plan

    df = spark.range(300).selectExpr("uuid() as id", "cast(id % 17 as double) as x",
                                     "id % 17 + 0.5 * (id % 3) as y")
    from tabulon.session import stored

    result = run_plan(stored(df), PlanSettings("y", ("id",), models=("ridge",), outliers=None))
    assert sum(result.split_rows.values()) == 300
    assert result.metrics.first()["r2"] > 0.5
