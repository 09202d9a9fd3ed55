"""Queries over the driver's tables, each beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries() -> dict[str, Entry]:
    from tidemill.registry import certificates, checks, loading, upkeep

    return certificates.ENTRIES | loading.ENTRIES | upkeep.ENTRIES | checks.ENTRIES
