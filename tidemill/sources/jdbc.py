"""Read a database table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. The three partition settings come together or not at all.

    Without them one task reads the whole table. Rows outside `bounds` are still read,
    by the first and the last task; NULLs in the column by the first.
    """
    split = (partition_column, bounds, partitions)
    if any(s is not None for s in split) and any(s is None for s in split):
        raise ValueError("partition_column, bounds and partitions go together")
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if partition_column is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return {k: v for k, v in options.items() if v is not None}


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """The table with all its columns, typed by the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()
