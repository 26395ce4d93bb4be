"""From raw documents to packed batches: five stages over the whole table.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept.
All but the last return the columns of ``docs`` as they were, whatever their names. Models are
learned from the labels of the table in ``sf_dir``, never from what a stage before has left,
which has few bad documents to learn from. Labels that are held out for measuring (see
``tabulon.llm.queries.held_out``) are not used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.llm import decontaminate, jaccard_join, line_crf, packing, quality_rules
from tabulon.llm.queries import held_out
from tabulon.session import stored
from tabulon.sources.tables import read_table


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """Rows for which ``keep`` holds after ``judge``, with the columns they came with."""
    whole = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_document"),
                        F.col("text"))
    return judge(whole).where(keep).select("_document.*")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    rules = quality_rules.fit_rules(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels"), usable=~held_out("_id"))
    return _judged(docs, lambda d: quality_rules.judge(d, rules), F.col("kept"))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model predicts to be good."""
    model = line_crf.fit_lines(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "labels"), usable=~held_out("_id"))
    return _judged(docs, lambda d: line_crf.score_documents(d, model), F.col("predicted") == 1)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its length bucket, batch and place."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("jaccard_join", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned rules, the line model and the dynamic program are beyond SQL; tests compare with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
