"""Parquet tables, the default format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulon.functions.expr import nan_to_null


def read_table(spark: SparkSession, folder: str, name: str, nan_as_null: bool = False
               ) -> DataFrame:
    """The table's Parquet file or folder; columns and filters are pushed into the scan."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return nan_to_null(df) if nan_as_null else df


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)
