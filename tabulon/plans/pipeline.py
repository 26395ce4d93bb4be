"""The full plan: clean, split, engineer features, tune, evaluate, compare, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.operators import clean, compare, evaluate, linear, split
from tabulon.operators.common import numeric_columns
from tabulon.operators.features import Derived, FeatureSettings, FittedFeatures, fit_features
from tabulon.session import stored

GRIDS = {"ridge": linear.RIDGE_GRID, "lasso": linear.LASSO_GRID}


@dataclass(frozen=True)
class PlanSettings:
    target: str
    #: Columns that tell rows apart and order them: numbers, dates, timestamps or texts.
    key: tuple[str, ...]
    exclude: tuple[str, ...] = ()
    strata: tuple[str, ...] = ()
    derived: tuple[Derived, ...] = ()
    missing: str = "drop"
    missing_threshold: float = 0.5
    outliers: str | None = "iqr"
    outlier_threshold: float = 1.5
    test: float = 0.15
    val: float = 0.15
    seed: int = 42
    folds: int = 5
    curve_folds: int = 3
    rare_threshold: int = 50
    models: tuple[str, ...] = ("ridge", "lasso")
    grids: Mapping[str, Sequence[float]] = field(default_factory=lambda: dict(GRIDS))
    #: Write the loaded table first: worth it where reading it again is dear (text files,
    #: joins), not for Parquet tables, whose scans read the needed columns only.
    store_input: bool = False
    #: Fixed penalty instead of a search.
    quick: bool = False
    alpha: float = 1.0


@dataclass(frozen=True)
class PlanResult:
    features: FittedFeatures
    models: Mapping[str, linear.LinearModel]
    grid_scores: Mapping[str, DataFrame]
    cross_validation: Mapping[str, DataFrame]
    predictions: DataFrame
    metrics: DataFrame
    comparison: DataFrame
    log: clean.ProcessingLog
    split_rows: Mapping[str, int]
    matrix: DataFrame

    def report(self) -> DataFrame:
        """The run in one row, ready for a JSON sink."""
        spark = self.metrics.sparkSession
        steps = self.log.report()
        best = compare.best_model(self.comparison, "rmse", list(self.models)).first()
        rows = [r.asDict() for r in self.comparison.collect()]      # one per model
        doc = spark.createDataFrame(
            [(self.split_rows.get("train", 0), self.split_rows.get("val", 0),
              self.split_rows.get("test", 0), len(self.features.names),
              list(self.features.names[:20]), steps["rows_lost"], steps["rows_lost_pct"],
              steps["processing_steps"], list(self.models), best["best_model"],
              [(r["model"], r["rmse"], r["mae"], r["r2"], r["mape"]) for r in rows])],
            "train_samples bigint, val_samples bigint, test_samples bigint, "
            "n_features_engineered int, feature_names array<string>, rows_lost bigint, "
            "rows_lost_pct double, processing_steps int, models array<string>, "
            "best_model string, metrics array<struct<model:string,rmse:double,mae:double,"
            "r2:double,mape:double>>")
        return doc


def run_plan(raw: DataFrame, settings: PlanSettings) -> PlanResult:
    """Run all steps on a loaded table.

    The cleaned, split table and the feature matrix are written once to the shared
    folder, because several fits and scores read them.
    """
    s = settings
    raw = stored(raw, "loaded") if s.store_input else raw
    log = clean.ProcessingLog()
    raw = log.watch("start", f"target {s.target}", raw)
    roles = clean.identify_roles(raw, s.target, list(s.exclude) + list(s.key))
    log.same_rows("roles", f"numeric {len(roles.numeric)}, categorical "
                  f"{len(roles.categorical)}", raw)
    table = clean.handle_missing(raw, roles, s.missing, s.missing_threshold)
    table = log.watch("missing values", s.missing, clean.drop_null_target(table, s.target))
    roles = roles.keep(table.columns)
    if s.outliers and roles.numeric:
        table = log.watch("outliers", s.outliers, clean.remove_outliers(
            table, roles.numeric, s.outliers, s.outlier_threshold, s.target))
    table = clean.convert_types(table, roles)
    log.same_rows("types", f"{len(roles.categorical)} categorical", table)
    table = split.three_way_split(table, s.key, s.strata, s.test, s.val, s.seed, "__split")
    table = stored(table, "cleaned")
    sizes = {r["__split"]: r["n"] for r in
             table.groupBy("__split").agg(F.count(F.lit(1)).alias("n")).collect()}
    log.add("split", ", ".join(f"{k} {sizes.get(k, 0)}" for k in ("train", "val", "test")),
            table.drop("__split"), sum(sizes.values()))

    train = table.filter(F.col("__split") == "train")
    fitted = fit_features(
        train, FeatureSettings(roles.numeric, roles.categorical, s.derived, s.rare_threshold),
        table)
    keep = [*s.key, s.target, "__split"]
    matrix = stored(fitted.transform(table, keep), "matrix")
    names, train = list(fitted.names), matrix.filter(F.col("__split") == "train")
    folded = stored(split.kfold(train, s.key, s.folds, "__fold"), "folds")

    sums = linear.products(folded, names, s.target, F.col("__fold"))
    models, grids, cv = {}, {}, {}
    for kind in s.models:
        if s.quick:
            models[kind] = linear.fit_linear(folded, names, s.target, kind, s.alpha, sums)
        else:
            models[kind], grids[kind] = linear.grid_search(
                folded, names, s.target, "__fold", kind, s.grids[kind], sums)
            cv[kind] = linear.cross_validate(
                folded, names, s.target, "__fold", kind, models[kind].alpha, sums)
    test = matrix.filter(F.col("__split") == "test")
    predictions = compare.register(
        {k: m.predict(test, "y_pred").withColumn("y", col(s.target)) for k, m in
         models.items()}, s.key)
    scores = evaluate.metrics(predictions, by=["model"])
    return PlanResult(fitted, models, grids, cv, predictions, scores,
                      compare.compare_metrics(predictions), log, sizes, matrix)


def quick_training(raw: DataFrame, target: str, key: Sequence[str],
                   models: Sequence[str] = ("ridge", "lasso"), alpha: float = 1.0,
                   seed: int = 42) -> tuple[dict[str, linear.LinearModel], DataFrame]:
    """Numeric columns only: drop duplicates and null targets, keep filled columns, fill
    with training medians, split 80/20, scale, fit with a fixed penalty.

    Returns the models, in scaled units, and a table (model, rmse, mae, r2, mape,
    train_r2, test_r2) by RMSE.
    """
    from tabulon.operators.features import fit_scaler

    # Removing duplicates shuffles the table, so that is done once.
    table = stored(clean.drop_null_target(clean.drop_duplicates(raw), target), "distinct")
    table = clean.keep_filled_columns(table)
    table = split.train_test_split(table, key, 0.2, seed, "__split")
    names = numeric_columns(table, [target, *key, "__split"])
    table = stored(table.select(*[col(c) for c in (*key, target, "__split", *names)]),
                   "quick")
    is_train = F.col("__split") == "train"
    imputer = clean.fit_imputer(table.filter(is_train), names)
    filled = imputer.apply(table)
    scaler = fit_scaler(filled.filter(is_train), names, exclude_binary=False)
    scaled = stored(scaler.apply(filled), "scaled")
    train = scaled.filter(is_train)
    sums = linear.products(train, names, target)
    fitted = {k: linear.fit_linear(train, names, target, k, alpha, sums) for k in models}
    predicted = compare.register(
        {k: m.predict(scaled, "y_pred").withColumn("y", col(target)) for k, m in
         fitted.items()}, ["__split", *key])
    both = evaluate.metrics(predicted, by=["model", "__split"])
    table = both.groupBy("model").agg(
        *[F.max(F.when(F.col("__split") == "test", F.col(m))).alias(m)
          for m in ("rmse", "mae", "r2", "mape")],
        F.max(F.when(is_train, F.col("r2"))).alias("train_r2"),
        F.max(F.when(~is_train, F.col("r2"))).alias("test_r2")).orderBy("rmse")
    return fitted, table
