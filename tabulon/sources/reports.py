"""Reports and result tables as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col

#: Fixed value: columns of a stored comparison table.
COMPARISON_SCHEMA = ("Model string, RMSE double, MAE double, R2 double, MAPE double, "
                     "MSE double, Max_Error double, RMSE_Rank double, MAE_Rank double, "
                     "R2_Rank double")


def write_json_report(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON document per row, nested structs kept, in UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def as_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*[col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias(out))


def read_json_reports(spark: SparkSession, path: str, schema: T.StructType | str,
                      multi_line: bool = True) -> DataFrame:
    """Many run reports as one table; ``multi_line`` for indented documents."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def comparison_columns(table: DataFrame) -> DataFrame:
    """A comparison table under its stored column names."""
    names = [f.name for f in T.StructType.fromDDL(COMPARISON_SCHEMA).fields]
    return table.select(*[col(n.lower()).alias(n) for n in names])


def write_comparison(table: DataFrame, path: str, mode: str = "error") -> None:
    (comparison_columns(table).write.mode(mode).option("header", True).csv(path))


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(COMPARISON_SCHEMA).option("header", True).csv(path)
            .toDF(*[f.name.lower() for f in T.StructType.fromDDL(COMPARISON_SCHEMA).fields]))


def save_comparison(table: DataFrame, metrics_report: DataFrame, differences: DataFrame,
                    best: DataFrame, path: str, mode: str = "error") -> None:
    """Comparison table as CSV, and metrics, differences and best model as JSON."""
    write_comparison(table, f"{path}/model_comparison", mode)
    write_json_report(metrics_report, f"{path}/detailed_metrics", mode)
    write_json_report(differences, f"{path}/model_differences", mode)
    write_json_report(best, f"{path}/best_model_info", mode)
