"""The shared folder for tables that cut lineage or stage a write."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemill-")


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster names for checkpoints; a temporary one only in local mode."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master.startswith("local"):
        return _own_folder()
    raise RuntimeError(f"set {SETTING} to a folder every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> tuple[DataFrame, str]:
    """Write rows to a new shared folder and read them back.

    The result has no lineage to recompute when an executor is lost, and Spark knows
    its size before it plans the joins that use it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
