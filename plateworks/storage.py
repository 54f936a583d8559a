"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of this machine if the master is local, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/plateworks-checkpoints"
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/plateworks/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: its lineage is cut, and lost executors lose nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
