"""Gold and answers stored by buckets of `row_id`, so that scoring them joins without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gleanframe.functions.sql import name


def store_by_row(df: DataFrame, table: str, buckets: int, path: str | None = None, by_run: bool = False) -> DataFrame:
    """Writes a catalog table in `buckets` files by row_id, each sorted, and reads it back; replaces what is there.

    Two tables of equal `buckets` join on row_id where they lie: what is shuffled once here is not
    shuffled by any set of runs that is scored later. A bucket should hold some hundred MB. `by_run` makes a folder of
    each run, so that others are not read. `path` keeps the files there, outside the warehouse.
    """
    writer = df.repartition(buckets, "row_id").write.mode("overwrite").format("parquet").bucketBy(buckets, "row_id").sortBy("row_id")
    if by_run:
        writer = writer.partitionBy("run")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name(table))
    return df.sparkSession.table(name(table))


def store_gold(gold: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """(row_id, labels, ...) by buckets."""
    return store_by_row(gold, table, buckets, path)


def store_answers(preds: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """(run, row_id, raw_text) in folders by run and buckets by row."""
    return store_by_row(preds.select("run", "row_id", "raw_text"), table, buckets, path, by_run=True)
