"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "tidemill") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_lock = Lock()
_held: dict[tuple[int, str], tuple[int, str | None]] = {}  # users, and the value before


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as any thread is inside; then as it was."""
    of = (id(spark), key)
    with _lock:
        users, before = _held.get(of) or (0, spark.conf.get(key, None))
        _held[of] = (users + 1, before)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            users, before = _held.pop(of)
            if users > 1:
                _held[of] = (users - 1, before)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)
