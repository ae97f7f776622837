"""Scoring answers while a model is still writing them.

Parsing and field scores need one row at a time, so the batch operators take a
stream of answers as they are, with gold as the stored side of the join. There is
no state and no watermark. Run metrics need all rows and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from gleanframe.operators.score import scored_answers
from gleanframe.sources.predictions import predictions_type
from gleanframe.spec import RecordSpec


def stream_predictions(spark: SparkSession, path: str, fmt: str = "parquet",
                       row_id: T.DataType | None = None,
                       files_per_trigger: int | None = None) -> DataFrame:
    """A4 on files that keep arriving."""
    reader = spark.readStream.schema(predictions_type(row_id))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def score_stream(gold: DataFrame, answers: DataFrame, spec: RecordSpec) -> DataFrame:
    """Row scores (E3) of each answer as it comes; answers not yet there give no row."""
    return scored_answers(gold, answers, spec)
