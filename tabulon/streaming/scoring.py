"""Scoring a stream: the batch operator on a streaming table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabulon.operators.features import FittedFeatures
from tabulon.operators.linear import LinearModel
from tabulon.operators.score import HistoricalStats, ScoreNames, score_batch


def score_rows(df: DataFrame, features: FittedFeatures, model: LinearModel,
               stats: HistoricalStats, keep: list[str], names: ScoreNames = ScoreNames()
               ) -> DataFrame:
    """Features, prediction and interval of each row; stateless, batch or stream."""
    prepared = features.transform(df, keep)
    scored = score_batch(prepared, model.expr(), stats, names)
    return scored.drop(*[f for f in features.names if f not in keep])


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the scores of everything available, then stop. ``checkpoint`` is a folder
    all executors share."""
    return (scored.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
