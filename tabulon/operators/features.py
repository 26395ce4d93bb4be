"""Derived columns, rare categories, encoders and scalers, fitted once and applied
without moving rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import clip, col, finite_or
from tabulon.operators.common import has_at_most, join_small, melt
from tabulon.operators.rowindex import with_row_index
from tabulon.sources.versions import save_together, saved_folder

#: Fixed value: the name rare categories are grouped under.
OTHERS = "OTROS"
#: Most categories per fitted pipeline that may become columns; the sparse rows of
#: ``tabulon.operators.sparse`` have no such bound.
MAX_CATEGORIES = 4096
#: Rare values listed in the expression itself; beyond that they are joined.
INLINE_RARE = 2000


# --- derived columns ---------------------------------------------------------------

def year_gap(later: Column, earlier: Column, low: float = 0, high: float = 15) -> Column:
    """Difference limited to [low, high]; null stays null."""
    return clip(later - earlier, low, high)


def offset(year: Column, base: float) -> Column:
    return year - F.lit(base)


def ratio_plus_one(total: Column, duration: Column) -> Column:
    """total / (duration + 1) with infinities as 0."""
    divisor = duration + 1
    return F.when((divisor == 0) & (total != 0), F.lit(0.0)).otherwise(
        finite_or(F.try_divide(total.cast("double"), divisor), 0.0))


def equals_flag(c: Column, value: Any) -> Column:
    """1 where the column has the value, else 0, also for null."""
    return F.coalesce(c == F.lit(value), F.lit(False)).cast("int")


@dataclass(frozen=True)
class Derived:
    """A named derived column, added when all columns it ``needs`` are there."""

    name: str
    needs: tuple[str, ...]
    build: Callable[[], Column]
    description: str = ""


def add_derived(df: DataFrame, specs: Sequence[Derived]) -> tuple[DataFrame, list[str]]:
    """Add the derived columns; later ones may use earlier ones."""
    added = []
    for spec in specs:
        if all(n in df.columns for n in spec.needs):
            df = df.withColumn(spec.name, spec.build())
            added.append(spec.name)
    return df, added


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct fields become columns named by their path."""
    def walk(fields: Sequence[T.StructField], path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in fields:
            here = path + (f.name,)
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType.fields, here)
            else:
                ref = ".".join("`" + p.replace("`", "``") + "`" for p in here)
                out.append(F.col(ref).alias(sep.join(here)))
        return out

    return df.select(*walk(df.schema.fields, ()))


# --- vocabularies and rare categories ----------------------------------------------

def category_counts(table: DataFrame, columns: Sequence[str], train: Column | None = None
                    ) -> DataFrame:
    """(column, value, n): training rows of every value found in the whole table."""
    flag = train if train is not None else F.lit(True)
    marked = table.withColumn("__t", flag.cast("int"))
    cells = melt(marked, columns, by=["__t"], cast="string").filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.sum("__t").alias("n"))


def rare_categories(counts: DataFrame, threshold: int = 50) -> DataFrame:
    """(column, value) with fewer than ``threshold`` training rows, none included."""
    return counts.filter(F.col("n") < threshold).select("column", "value")


def group_rare(df: DataFrame, columns: Sequence[str], rare: DataFrame, other: str = OTHERS,
               inline: int = INLINE_RARE) -> DataFrame:
    """Replace rare values by ``other``; values never seen stay as they are."""
    rows = rare.filter(F.col("column").isin(list(columns))).limit(inline + 1).collect()
    if len(rows) <= inline:
        listed: dict[str, list[str]] = {}
        for r in rows:
            listed.setdefault(r["column"], []).append(r["value"])
        return df.select(*[
            F.when(col(c).isin(listed[c]), F.lit(other)).otherwise(col(c)).alias(c)
            if c in listed else col(c) for c in df.columns])
    for c in columns:
        values = rare.filter(F.col("column") == c).select(
            F.col("value").alias(c), F.lit(True).alias("__rare"))
        df = join_small(df, values, [c])
        df = df.withColumn(c, F.when(F.col("__rare"), F.lit(other)).otherwise(col(c)))
        df = df.drop("__rare")
    return df


def label_vocabulary(df: DataFrame, column: str, driver_rows: int = 100_000) -> DataFrame:
    """(value, label): sorted distinct values as text, numbered from 0."""
    values = df.select(col(column).cast("string").alias("value")).filter(
        F.col("value").isNotNull()).distinct()
    return _numbered(values, ["value"], driver_rows)


def _numbered(values: DataFrame, order: Sequence[str], driver_rows: int) -> DataFrame:
    if has_at_most(values, driver_rows):
        # A vocabulary of checked size: one window over it.
        place = W.partitionBy(F.lit(0)).orderBy(*order)
        return values.select("value", (F.row_number().over(place) - 1).cast("bigint")
                             .alias("label"))
    return with_row_index(values, order, "label").select("value", "label")


def label_encode(df: DataFrame, column: str, vocabulary: DataFrame, out: str | None = None
                 ) -> DataFrame:
    """Add the number of the value (null for unknown ones)."""
    out = out or f"{column}_label"
    keyed = vocabulary.select(F.col("value").alias("__value"), F.col("label").alias(out))
    return join_small(df.withColumn("__value", col(column).cast("string")), keyed,
                      ["__value"]).drop("__value")


def appearance_vocabulary(df: DataFrame, column: str, order: Sequence[str],
                          driver_rows: int = 100_000) -> DataFrame:
    """(value, label): distinct values numbered by their first row in ``order``."""
    first = (df.groupBy(col(column).cast("string").alias("value"))
             .agg(F.min(F.struct(*[col(o) for o in order])).alias("__first")))
    return _numbered(first.filter(F.col("value").isNotNull()), ["__first"], driver_rows)


def label_decode(df: DataFrame, column: str, vocabulary: DataFrame, out: str) -> DataFrame:
    """The value behind a label; unmapped labels give null."""
    keyed = vocabulary.select(F.col("label").alias("__label"), F.col("value").alias(out))
    return join_small(df.withColumn("__label", col(column).cast("bigint")), keyed,
                      ["__label"]).drop("__label")


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], drop_first: bool = True
            ) -> tuple[DataFrame, list[str]]:
    """0/1 columns ``COLUMN_value`` for the given sorted categories.

    The first category of each column gets none; unknown values and null are 0
    everywhere.
    """
    made, names = [], []
    for c, values in categories.items():
        for v in list(values)[1 if drop_first else 0:]:
            name = f"{c}_{v}"
            made.append(F.coalesce(col(c).cast("string") == F.lit(v), F.lit(False))
                        .cast("double").alias(name))
            names.append(name)
    return df.select("*", *made), names


def one_hot_index(df: DataFrame, column: str, vocabulary: DataFrame, drop_first: bool = True
                  ) -> DataFrame:
    """Add the position of the 1 in the column's one-hot block, null where all are 0.

    The sparse form for vocabularies too large to become columns.
    """
    out = f"{column}_index"
    encoded = label_encode(df, column, vocabulary, out)
    if not drop_first:
        return encoded
    return encoded.withColumn(out, F.when(col(out) > 0, col(out) - 1))


# --- scaling -----------------------------------------------------------------------

def binary_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Numeric columns whose non-null values are all 0 or 1."""
    row = df.agg(*[F.count_if(~col(c).isin(0, 1)).alias(f"n{i}")
                   for i, c in enumerate(columns)]).first() if columns else ()
    return [c for i, c in enumerate(columns) if row[i] == 0]


@dataclass(frozen=True)
class Scaler:
    """x -> (x - centre) / width; a width of 0 gives 0. Columns are frozen at the fit."""

    method: str
    centre: Mapping[str, float]
    width: Mapping[str, float]

    def expr(self, c: str) -> Column:
        x = col(c).cast("double")
        if c not in self.centre or self.centre[c] is None:
            return x
        if not self.width[c]:
            return F.when(x.isNotNull(), F.lit(0.0))
        return (x - F.lit(self.centre[c])) / F.lit(self.width[c])

    def apply(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.expr(c).alias(c) if c in self.centre else col(c)
                           for c in df.columns])


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard",
               exclude_binary: bool = True) -> Scaler:
    """Mean and population std, or min and range, of all columns in one scan."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling {method}")
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += ([F.avg(x).alias(f"c{i}"), F.stddev_pop(x).alias(f"w{i}")]
                 if method == "standard" else
                 [F.min(x).alias(f"c{i}"), (F.max(x) - F.min(x)).alias(f"w{i}")])
        aggs += [F.count_if(~x.isin(0.0, 1.0)).alias(f"b{i}")]
    if not aggs:
        return Scaler(method, {}, {})
    row = df.agg(*aggs).first()
    kept = [i for i in range(len(columns)) if not exclude_binary or row[f"b{i}"] > 0]
    return Scaler(method, {columns[i]: row[f"c{i}"] for i in kept},
                  {columns[i]: row[f"w{i}"] for i in kept})


# --- the fitted pipeline -----------------------------------------------------------

@dataclass(frozen=True)
class FeatureSettings:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    derived: tuple[Derived, ...] = ()
    rare_threshold: int | None = 50
    other: str = OTHERS
    drop_first: bool = True
    scaling: str | None = "standard"
    exclude_binary: bool = True


@dataclass(frozen=True)
class FittedFeatures:
    """Everything learned from the training rows; ``transform`` is a narrow select."""

    settings: FeatureSettings
    numeric: tuple[str, ...]
    categories: Mapping[str, tuple[str, ...]]
    rare: Mapping[str, tuple[str, ...]]
    scaler: Scaler
    names: tuple[str, ...] = field(default=())

    def _raw(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        df, _ = add_derived(df, self.settings.derived)
        out = [col(k).alias(f"__k_{k}") for k in keep]
        out += [col(c).cast("double").alias(c) for c in self.numeric]
        for c, values in self.categories.items():
            v = col(c).cast("string")
            if self.rare.get(c):
                v = F.when(v.isin(list(self.rare[c])), F.lit(self.settings.other)).otherwise(v)
            out.append(v.alias(f"__c_{c}"))
        return df.select(*out)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns and one double column per feature, in the order of ``names``."""
        raw = self._raw(df, keep)
        out = [F.col(f"`__k_{k}`").alias(k) for k in keep]
        out += [self.scaler.expr(c).alias(c) for c in self.numeric]
        for c, values in self.categories.items():
            for v in values[1 if self.settings.drop_first else 0:]:
                out.append(F.coalesce(col(f"__c_{c}") == F.lit(v), F.lit(False))
                           .cast("double").alias(f"{c}_{v}"))
        return raw.select(*out)

    def save(self, spark: SparkSession, path: str) -> None:
        """Vocabulary, scaler and names as Parquet tables below ``path``, all or none."""
        rows = [(c, v, i, "kept") for c, vs in self.categories.items()
                for i, v in enumerate(vs)]
        rows += [(c, v, i, "rare") for c, vs in self.rare.items() for i, v in enumerate(vs)]
        scaler = [(c, float(self.scaler.centre[c]) if self.scaler.centre[c] is not None else None,
                   float(self.scaler.width[c]) if self.scaler.width[c] is not None else None)
                  for c in self.scaler.centre]
        s = self.settings
        meta = {"numeric_in": s.numeric, "categorical": s.categorical, "numeric": self.numeric,
                "names": self.names, "other": s.other, "drop_first": s.drop_first,
                "scaling": s.scaling, "exclude_binary": s.exclude_binary,
                "rare_threshold": s.rare_threshold, "derived": [d.name for d in s.derived],
                "category_order": list(self.categories)}
        save_together(spark, path, {
            "vocabulary": spark.createDataFrame(
                rows, "column string, value string, position int, kind string"),
            "scaler": spark.createDataFrame(scaler, "column string, centre double, width double"),
            "metadata": spark.createDataFrame([(json.dumps(meta),)], "metadata string")})


def load_features(spark: SparkSession, path: str, derived: Sequence[Derived] = ()
                  ) -> FittedFeatures:
    """Read a saved pipeline; derived columns are code and are passed in again."""
    path = saved_folder(spark, path)
    meta = json.loads(spark.read.parquet(f"{path}/metadata").first()[0])
    by_name = {d.name: d for d in derived}
    absent = [n for n in meta["derived"] if n not in by_name]
    if absent:
        raise ValueError("no definition for derived columns " + ", ".join(absent))
    kept: dict[str, list] = {c: [] for c in meta["category_order"]}
    rare: dict[str, list] = {}
    for r in spark.read.parquet(f"{path}/vocabulary").collect():
        into = kept if r["kind"] == "kept" else rare
        into.setdefault(r["column"], []).append((r["position"], r["value"]))
    scaler = spark.read.parquet(f"{path}/scaler").collect()
    settings = FeatureSettings(
        tuple(meta["numeric_in"]), tuple(meta["categorical"]),
        tuple(by_name[n] for n in meta["derived"]), meta["rare_threshold"], meta["other"],
        meta["drop_first"], meta["scaling"], meta["exclude_binary"])
    return FittedFeatures(
        settings, tuple(meta["numeric"]),
        {c: tuple(v for _, v in sorted(vs)) for c, vs in kept.items()},
        {c: tuple(v for _, v in sorted(vs)) for c, vs in rare.items()},
        Scaler(meta["scaling"] or "standard", {r["column"]: r["centre"] for r in scaler},
               {r["column"]: r["width"] for r in scaler}),
        tuple(meta["names"]))


def fit_features(train: DataFrame, settings: FeatureSettings, table: DataFrame | None = None
                 ) -> FittedFeatures:
    """Derive, group rare categories, one-hot encode and scale, fitted on ``train``.

    ``table`` is the whole cleaned table (``train`` is part of it): a value that
    occurs there but in no training row counts as rare.
    """
    derived, added = add_derived(train, settings.derived)
    numeric = tuple(c for c in settings.numeric if c in derived.columns) + tuple(added)
    categorical = tuple(c for c in settings.categorical if c in derived.columns)
    categories: dict[str, tuple[str, ...]] = {}
    rare: dict[str, tuple[str, ...]] = {}
    if categorical:
        counts = category_counts(train, categorical)
        if settings.rare_threshold is not None and table is not None:
            known = category_counts(table, categorical).select("column", "value")
            counts = known.join(counts, ["column", "value"], "left").na.fill(0, ["n"])
        rows = counts.limit(16 * MAX_CATEGORIES + 1).collect()
        if len(rows) > 16 * MAX_CATEGORIES:
            raise ValueError("too many category values to become columns; "
                             "use fit_sparse_features")
        threshold = settings.rare_threshold or 0
        for c in categorical:
            mine = {r["value"]: r["n"] for r in rows if r["column"] == c}
            few = {v for v, n in mine.items() if n < threshold}
            seen = {settings.other if v in few else v for v, n in mine.items() if n > 0}
            if few:
                rare[c] = tuple(sorted(few))
            categories[c] = tuple(sorted(seen))
        if sum(map(len, categories.values())) > MAX_CATEGORIES:
            raise ValueError("too many categories to become columns; use fit_sparse_features")
    scaler = (fit_scaler(derived, numeric, settings.scaling, settings.exclude_binary)
              if settings.scaling else Scaler("standard", {}, {}))
    skip = 1 if settings.drop_first else 0
    names = numeric + tuple(f"{c}_{v}" for c, vs in categories.items() for v in vs[skip:])
    return FittedFeatures(settings, numeric, categories, rare, scaler, names)
