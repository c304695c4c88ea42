"""Scratch tables in the folder that all executors share: they cut a lineage and outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the one that ``spark.checkpoint.dir`` names; only local mode may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{tempfile.gettempdir()}/clipwise-checkpoints"
    return f"{root.rstrip('/')}/clipwise/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path. Results read from these, so they stay until ``drop_scratch`` of the application."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(path := scratch(df.sparkSession, name))
    return df.sparkSession.read.schema(df.schema).parquet(path)
