"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def allow_duplicate_keys(spark: SparkSession) -> None:
    """A repeated key in a JSON object takes its last value instead of failing the parse."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under a folder that driver and executors share.

    That folder is spark.checkpoint.dir, else spark.sql.warehouse.dir. Both are settings of
    the cluster; no machine-local folder is made here. The warehouse folder that Spark falls back to lies
    on the driver's machine, so executors elsewhere need the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share, not {root}")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: later readers compute nothing again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the driver found it.

    Once per Spark context; the archive is fetched from the driver as any file of a job is.
    """
    context = spark.sparkContext
    if getattr(context, "_gleanframe_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gleanframe-")) / "gleanframe.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._gleanframe_shipped = True
