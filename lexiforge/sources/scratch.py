"""Scratch tables in the shared checkpoint folder: they cut lineage and outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset (one machine), a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("lexiforge.scratch.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="lexiforge-scratch-")
        spark.conf.set("lexiforge.scratch.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: what is used several times is computed once."""
    path = f"{root(df.sparkSession)}/lexiforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
