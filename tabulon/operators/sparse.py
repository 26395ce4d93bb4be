"""Feature rows as sorted index and value arrays, for vocabularies of any size.

The fitted vocabulary is a table, not a list in the driver: every value of a categorical column
with the place of its 1, and values grouped as rare with the place of their group. It is numbered
by ranges of values and joined to the rows, by broadcast behind a check of its size. A row holds
its non-zero numbers only, whatever the number of categories.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.operators.common import has_at_most, join_small
from tabulon.operators.features import (
    Derived, FeatureSettings, Scaler, add_derived, category_counts, fit_scaler)
from tabulon.operators.rowindex import with_row_index
from tabulon.session import BROADCAST_ROWS, stored
from tabulon.sources.versions import save_together, saved_folder

_ROW = "array<struct<index: bigint, value: double>>"


@dataclass(frozen=True)
class SparseFeatures:
    """Fitted features whose rows are sparse; ``vocabulary`` is (column, value, index).

    Places count the numeric features first, then the blocks of the categorical columns in
    order, each sorted by value, without its first category if ``drop_first``. ``index`` is null
    for values that are zeros everywhere: a dropped category, or rare ones without a group.
    """

    settings: FeatureSettings
    numeric: tuple[str, ...]
    blocks: Mapping[str, tuple[int, int]]      # column -> place of its first feature, features
    scaler: Scaler
    vocabulary: DataFrame

    @property
    def size(self) -> int:
        """How many features there are."""
        return len(self.numeric) + sum(n for _, n in self.blocks.values())

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns, ``indices`` (sorted) and ``values`` of each row.

        Zeros have no entry; a null number has one, with a null value. Null and unknown
        categories have none. Rows are not moved where the vocabulary of a column can be
        broadcast; beyond that each column is a shuffle join, in which hot values are split.
        """
        df, _ = add_derived(df, self.settings.derived)
        rows = df.select(*[col(k).alias(f"__k_{k}") for k in keep],
                         *[col(c).cast("double").alias(c) for c in self.numeric],
                         *[col(c).cast("string").alias(f"__c_{c}") for c in self.blocks])
        for c in self.blocks:
            words = (self.vocabulary.where((F.col("column") == c) & F.col("index").isNotNull())
                     .select(F.col("value").alias(f"__c_{c}"), F.col("index").alias(f"__i_{c}")))
            fits = has_at_most(words, BROADCAST_ROWS)
            rows = join_small(rows, words, [f"__c_{c}"], fits=fits)
        entries = []
        for i, c in enumerate(self.numeric):
            x = self.scaler.expr(c)
            entries.append(F.when(x.isNull() | (x != 0), _entry(F.lit(i).cast("bigint"), x)))
        entries += [F.when(col(f"__i_{c}").isNotNull(),
                           _entry(col(f"__i_{c}"), F.lit(1.0))) for c in self.blocks]
        packed = F.array_compact(F.array(*entries)).cast(_ROW) if entries else F.expr(
            f"cast(array() as {_ROW})")
        return (rows.withColumn("__row", packed)
                .select(*[col(f"__k_{k}").alias(k) for k in keep],
                        F.col("__row.index").alias("indices"),
                        F.col("__row.value").alias("values")))

    def names(self) -> DataFrame:
        """(index, name) of every feature, ``COLUMN_value`` for categories."""
        spark = self.vocabulary.sparkSession
        first = spark.createDataFrame(list(enumerate(self.numeric)), "index long, name string")
        return first.unionByName(
            self.vocabulary.where("named and index is not null")
            .select("index", F.concat_ws("_", "column", "value").alias("name")))

    def save(self, spark: SparkSession, path: str) -> None:
        """Vocabulary, scaler and settings below ``path``, all of them or none."""
        s = self.settings
        meta = {"numeric_in": s.numeric, "categorical": s.categorical, "numeric": self.numeric,
                "blocks": {c: list(b) for c, b in self.blocks.items()}, "other": s.other,
                "drop_first": s.drop_first, "scaling": s.scaling,
                "exclude_binary": s.exclude_binary, "rare_threshold": s.rare_threshold,
                "derived": [d.name for d in s.derived],
                "centre": dict(self.scaler.centre), "width": dict(self.scaler.width)}
        save_together(spark, path, {
            "vocabulary": self.vocabulary,
            "metadata": spark.createDataFrame([(json.dumps(meta),)], "metadata string")})


def _entry(index: Column, value: Column) -> Column:
    return F.struct(index.alias("index"), value.alias("value"))


def load_sparse_features(spark: SparkSession, path: str, derived: Sequence[Derived] = ()
                         ) -> SparseFeatures:
    """Read saved features; derived columns are code and are passed in again."""
    folder = saved_folder(spark, path)
    meta = json.loads(spark.read.parquet(f"{folder}/metadata").first()[0])
    by_name = {d.name: d for d in derived}
    absent = [n for n in meta["derived"] if n not in by_name]
    if absent:
        raise ValueError("no definition for derived columns " + ", ".join(absent))
    settings = FeatureSettings(
        tuple(meta["numeric_in"]), tuple(meta["categorical"]),
        tuple(by_name[n] for n in meta["derived"]), meta["rare_threshold"], meta["other"],
        meta["drop_first"], meta["scaling"], meta["exclude_binary"])
    return SparseFeatures(
        settings, tuple(meta["numeric"]), {c: tuple(b) for c, b in meta["blocks"].items()},
        Scaler(meta["scaling"] or "standard", meta["centre"], meta["width"]),
        spark.read.parquet(f"{folder}/vocabulary"))


def fit_sparse_features(train: DataFrame, settings: FeatureSettings,
                        table: DataFrame | None = None) -> SparseFeatures:
    """Derive, group rare categories, number them and scale, fitted on ``train``.

    The meaning is that of ``fit_features``, without its bound on the number of categories.
    ``table`` is the whole cleaned table: a value that occurs there but in no training row counts
    as rare. The driver holds a pair of numbers for each categorical column.
    """
    derived, added = add_derived(train, settings.derived)
    numeric = tuple(c for c in settings.numeric if c in derived.columns) + tuple(added)
    categorical = tuple(c for c in settings.categorical if c in derived.columns)
    scaler = (fit_scaler(derived, numeric, settings.scaling, settings.exclude_binary)
              if settings.scaling else Scaler("standard", {}, {}))
    spark = train.sparkSession
    if not categorical:
        empty = spark.createDataFrame([], "column string, value string, index long, named boolean")
        return SparseFeatures(settings, numeric, {}, scaler, empty)
    counts = category_counts(train, categorical)
    if settings.rare_threshold is not None and table is not None:
        known = category_counts(table, categorical).select("column", "value")
        counts = known.join(counts, ["column", "value"], "left").na.fill(0, ["n"])
    place = F.element_at(F.create_map(*[x for i, c in enumerate(categorical)
                                        for x in (F.lit(c), F.lit(i))]), F.col("column"))
    rare = F.col("n") < (settings.rare_threshold or 0)
    grouped = stored(counts.select(
        "column", place.alias("block"), "value", "n",
        F.when(rare, F.lit(settings.other)).otherwise(F.col("value")).alias("category")),
        "categories")
    kept = grouped.where("n > 0").select("column", "block", "category").distinct()
    numbered = stored(with_row_index(kept, ["block", "category"], "row"), "numbered")
    ends = {r["column"]: (r["low"], r["n"]) for r in numbered.groupBy("column").agg(
        F.min("row").alias("low"), F.count("*").alias("n")).collect()}
    skip = 1 if settings.drop_first else 0
    blocks, at, shifts = {}, len(numeric), []
    for c in categorical:
        low, n = ends.get(c, (0, 0))
        blocks[c] = (at, max(n - skip, 0))
        shifts.append((c, low, at))
        at += blocks[c][1]
    # A row for each categorical column.
    shift = F.broadcast(spark.createDataFrame(shifts, "column string, low long, first long"))
    indexed = (numbered.join(shift, "column")
               .select("column", "category",
                       F.when(F.col("row") - F.col("low") >= skip,
                              F.col("first") + F.col("row") - F.col("low") - skip)
                       .alias("index")))
    few = (grouped.where(rare).where(F.col("value") != F.lit(settings.other))
           .select("column", "value", "category")
           .join(indexed, ["column", "category"], "left")
           .select("column", "value", "index", F.lit(False).alias("named")))
    # A rare value equal to the group's own name is the group.
    vocabulary = indexed.select("column", F.col("category").alias("value"), "index",
                                F.lit(True).alias("named")).unionByName(few)
    return SparseFeatures(settings, numeric, blocks, scaler, stored(vocabulary, "vocabulary"))
