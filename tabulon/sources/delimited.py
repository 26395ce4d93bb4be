"""Delimited text: tolerant scan, rejects, delimiter detection, repair and sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.operators.common import numeric_columns
from tabulon.operators.profile import describe, dtype_counts, duplicate_rows, null_profile

LINE = "__line"
#: Texts that mean "no value".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Candidate delimiters; the first wins ties.
DELIMITERS = (";", ",", "\t", "|")


@dataclass(frozen=True)
class DelimitedOptions:
    sep: str = ";"
    encoding: str = "ISO-8859-1"
    header: bool = True
    #: Quoted line breaks; such files cannot be split between tasks.
    multi_line: bool = False
    missing: Sequence[str] = MISSING_TEXTS


def _text_scan(spark: SparkSession, path: str | list[str], schema: T.StructType,
               options: DelimitedOptions) -> DataFrame:
    """All fields as text, and the whole line where the number of fields is wrong."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                       + [T.StructField(LINE, T.StringType())])
    return (spark.read.schema(raw)
            .option("sep", options.sep).option("encoding", options.encoding)
            .option("header", options.header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE)
            .option("escape", '"').option("multiLine", options.multi_line).csv(path))


def _too_long(schema: T.StructType, options: DelimitedOptions) -> Column:
    """Whether the line has more fields than the schema, separators in quotes aside."""
    # The reader judges a line by the columns a query asks for, and refuses queries on the
    # line alone; asking for all fields keeps the judgement the same for every query.
    # Without coalesce it would be asked for lines that are not null before it sets them.
    bare = F.regexp_replace(F.coalesce(LINE, F.lit("")), '"[^"]*"', "")
    separators = (F.length(bare) - F.length(F.replace(bare, F.lit(options.sep), F.lit("")))
                  ) / len(options.sep)
    read = F.length(F.concat_ws("", *[col(f.name) for f in schema.fields])) >= 0
    return (separators >= len(schema.fields)) & read


def _typed(f: T.StructField, missing: Sequence[str]) -> Column:
    text = F.when(~col(f.name).isin(list(missing)), col(f.name))
    if isinstance(f.dataType, T.StringType):
        return text.alias(f.name)
    return F.trim(text).try_cast(f.dataType).alias(f.name)


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                   options: DelimitedOptions = DelimitedOptions()) -> DataFrame:
    """Rows of the files; lines with too many fields are skipped, short ones padded.

    The schema is declared, never inferred; a text that is no number gives null.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = _text_scan(spark, path, schema, options).filter(~_too_long(schema, options))
    return rows.select(*[_typed(f, options.missing) for f in schema.fields])


def read_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                 options: DelimitedOptions = DelimitedOptions()) -> DataFrame:
    """The skipped lines: leading fields as text and the whole ``line``."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = _text_scan(spark, path, schema, options).filter(_too_long(schema, options))
    return rows.withColumnRenamed(LINE, "line")


def scan_counts(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                options: DelimitedOptions = DelimitedOptions()) -> DataFrame:
    """(accepted, rejected) in one scan."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = _too_long(schema, options)
    return _text_scan(spark, path, schema, options).agg(
        F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "error",
                    encoding: str = "UTF-8") -> None:
    """Delimited files with a header, no index; parent folders are made."""
    (df.write.mode(mode).option("header", True).option("sep", sep)
     .option("encoding", encoding).option("escape", '"').csv(path))


def field_counts(lines: DataFrame, sep: str, file: str = "file", line: str = "value"
                 ) -> DataFrame:
    """(file, fields, lines): how many lines of each file have how many fields."""
    n = F.length(line) - F.length(F.replace(F.col(line), F.lit(sep), F.lit(""))) + 1
    return lines.groupBy(file, n.alias("fields")).agg(F.count(F.lit(1)).alias("lines"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): every line of a folder of text files."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def detect_delimiter(lines: DataFrame, file: str = "file", line: str = "value",
                     candidates: Sequence[str] = DELIMITERS) -> DataFrame:
    """(file, delimiter, occurrences): the candidate found most often in each file."""
    names = [f"c{i}" for i in range(len(candidates))]
    counts = lines.groupBy(file).agg(*[
        F.sum(F.length(line) - F.length(F.replace(F.col(line), F.lit(c), F.lit("")))).alias(n)
        for c, n in zip(candidates, names)])
    most = F.greatest(*names)
    pick = reduce(lambda w, p: w.when(F.col(p[1]) == most, F.lit(p[0])),
                  list(zip(candidates, names))[1:],
                  F.when(F.col(names[0]) == most, F.lit(candidates[0])))
    return counts.select(file, pick.alias("delimiter"), most.alias("occurrences"))


@dataclass(frozen=True)
class RepairReport:
    nulls: DataFrame
    duplicates: DataFrame
    dtypes: DataFrame


def repair_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                     out: str, options: DelimitedOptions = DelimitedOptions()
                     ) -> tuple[DataFrame, RepairReport]:
    """Tolerant scan, rewrite with the same delimiter, and the quality of the result."""
    write_delimited(read_delimited(spark, path, schema, options), out, options.sep,
                    encoding=options.encoding)
    clean = read_delimited(spark, out, schema, options)
    return clean, RepairReport(null_profile(clean), duplicate_rows(clean), dtype_counts(clean))


def verify_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                     options: DelimitedOptions = DelimitedOptions()) -> DataFrame:
    """Re-read a written file: description of its first numeric column, with the rows."""
    df = read_delimited(spark, path, schema, options)
    numbers = numeric_columns(df)
    if not numbers:
        return df.agg(F.count(F.lit(1)).alias("rows"))
    n = df.count()
    return describe(df, numbers[0]).withColumn("rows", F.lit(n).cast("bigint"))

