"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where it is unset (tests on
    one machine) a temporary folder, which the context then keeps."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="mosaiq-"))
        root = context.getCheckpointDir()
    return str(root)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below it."""
    return f"{shared_root(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` by way of Parquet in the shared folder: made once, whatever is lost later."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
