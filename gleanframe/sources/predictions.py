"""A4: model answers as a table (run, row_id, raw_text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def predictions_type(row_id: T.DataType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("run", T.StringType()),
        T.StructField("row_id", row_id or T.StringType()),
        T.StructField("raw_text", T.StringType()),
    ])


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet",
                     row_id: T.DataType | None = None) -> DataFrame:
    """Stored answers from Parquet or JSON lines. Folders run=... prune by run."""
    reader = spark.read.schema(predictions_type(row_id))
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST").option("lineSep", "\n")
    return reader.format(fmt).load(path)
