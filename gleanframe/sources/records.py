"""A1-A3, A5: labelled records and chat rows as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanframe.functions.json_text import json_object, json_string, record_json
from gleanframe.spec import RecordSpec


def read_records(spark: SparkSession, path: str, spec: RecordSpec) -> DataFrame:
    """A1: (posting, labels) from JSON lines in UTF-8. Blank lines are skipped, a bad line raises.

    Files under split=... folders also give a `split` column, and a filter on it
    reads only its own folder.
    """
    return (spark.read.schema(spec.record_type())
            .option("mode", "FAILFAST").option("encoding", "UTF-8").option("lineSep", "\n")
            .json(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, value, file): the raw lines of record files, for `parse.checked_lines`.

    `row_id` is the place of a line in the scan. Nothing is parsed, so no line is lost or raises.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.monotonically_increasing_id().alias("row_id"), "value", F.col("_metadata.file_path").alias("file"))


def split_lines(checked: DataFrame, records: str, quarantine: str) -> None:
    """Stores checked lines: those without a breach as Parquet records (row_id, text, labels), the others as
    they came, with their breaches. Every line that is not blank is in exactly one of the two."""
    clean = F.size("breaches") == 0
    checked.where(clean).drop("value", "breaches").write.parquet(records)
    checked.where(~clean).select("row_id", "value", "breaches").write.parquet(quarantine)


def with_row_ids(records: DataFrame) -> DataFrame:
    """Adds `row_id`, the place of each record in the scan of its files.

    The same files read with the same settings give the same ids. Store the result
    and use the stored table wherever the ids meet again.
    """
    return records.withColumn("row_id", F.monotonically_increasing_id())


def write_records(df: DataFrame, path: str, spec: RecordSpec) -> None:
    """A2: one object per line; nulls and non-ASCII text kept; replaces what is there."""
    df.selectExpr(f"{record_json(spec)} AS value").write.mode("overwrite").text(path)


def write_splits(df: DataFrame, path: str, spec: RecordSpec) -> None:
    """A3: as A2, in one folder per `split`. Written where the rows are, without a shuffle."""
    (df.selectExpr(f"{record_json(spec)} AS value", "split")
     .write.mode("overwrite").partitionBy("split").text(path))


def export_chat(chat: DataFrame, path: str, fmt: str = "parquet", shards: int | None = None) -> None:
    """A5: chat rows by `split`, as Parquet or as JSON lines {"messages": [...]}.

    `shards` sets how many files hold the data, at the price of one shuffle.
    """
    if shards:
        chat = chat.repartition(shards)
    if fmt == "json":
        turn = json_object([("role", json_string("m.role")), ("content", json_string("m.content"))])
        body = f"concat('[', array_join(transform(messages, m -> {turn}), ', '), ']')"
        chat = chat.selectExpr(f"{json_object([('messages', body)])} AS value", "split")
        chat.write.mode("overwrite").partitionBy("split").text(path)
    elif fmt == "parquet":
        chat.write.mode("overwrite").partitionBy("split").parquet(path)
    else:
        raise ValueError(f"fmt must be 'parquet' or 'json', not {fmt!r}")
