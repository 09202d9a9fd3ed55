"""Replace a parquet table whole without ever overwriting what is being read.

Rows are written to a new folder beside the old ones and counted; one small file then
names the folder that holds the table from now on. The file is numbered and created
only if no one else has created it, so of two writers one fails instead of being lost.
For tables that change often, or by several writers, use a catalog
(`tidemill.sources.catalog`); for changes to parts of a table see `plans.change`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.sources import files

_PUBLISHED = "_published"
# A reader of the version before last may still be at work when a new one appears.
RETAINED = 2


class CountMismatch(RuntimeError):
    """The written rows are not as many as they should be; they were not published."""


class Conflict(RuntimeError):
    """Someone else has published since the version that this one builds on."""


def _numbers(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(p.rsplit("/", 1)[1]) for p, _ in files.children(spark, f"{base}/{_PUBLISHED}/*"))


def _folder(spark: SparkSession, base: str, number: int) -> str:
    return f"{base}/{files.read_marker(spark, f'{base}/{_PUBLISHED}/{number:012d}')}"


def newest(spark: SparkSession, base: str) -> int:
    """Number of the current version; 0 if there is none."""
    numbers = _numbers(spark, base)
    return numbers[-1] if numbers else 0


def table_exists(spark: SparkSession, base: str) -> bool:
    return newest(spark, base) > 0


def current(spark: SparkSession, base: str) -> DataFrame:
    number = newest(spark, base)
    if not number:
        raise FileNotFoundError(f"no published version under {base}")
    return spark.read.parquet(_folder(spark, base, number))


def publish(
    df: DataFrame,
    base: str,
    expected: int | None = None,
    partition_by: Sequence[str] = (),
    read_version: int | None = None,
    counts: Mapping[str, Column] | None = None,
    gate: Callable[[DataFrame, dict[str, int]], None] | None = None,
) -> DataFrame:
    """Write `df`, check its count, make it the table.

    `counts` are aggregates that the write job computes on the way. `gate` sees the
    written rows and these numbers before anyone else; if it raises, the rows are removed
    and the table stays as it was.

    `expected` defaults to the number of rows the write itself saw, counted on the way;
    the count of what was written comes from the parquet footers. `read_version` is the
    version that `df` was made from, if it was: a newer one is then a `Conflict`, as is
    one that appears while the rows are being written.
    """
    spark = df.sparkSession
    before = newest(spark, base) if read_version is None else read_version
    folder = f"data-{uuid.uuid4().hex}"
    path = f"{base}/{folder}"
    # Counted inside the write job, from tasks that succeeded.
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    watched.write.partitionBy(*partition_by).parquet(path)
    found = seen.get
    written = spark.read.schema(df.schema).parquet(path)
    expected, got = found["rows"] if expected is None else expected, written.count()
    if got != expected:
        raise CountMismatch(f"{path} holds {got} rows, expected {expected}")
    if gate is not None:
        try:
            gate(written, {n: found[n] for n in counts or {}})
        except Exception:
            files.remove(spark, path)
            raise
    if newest(spark, base) != before or not files.create(
        spark, f"{base}/{_PUBLISHED}/{before + 1:012d}", folder
    ):
        files.remove(spark, path)
        raise Conflict(f"{base} has a newer version than {before}")
    _tidy(spark, base, before + 1 - RETAINED)
    return written


def _tidy(spark: SparkSession, base: str, last: int) -> None:
    """Remove versions up to a number; the file that names one goes last."""
    for number in _numbers(spark, base):
        if number <= last:
            files.remove(spark, _folder(spark, base, number))
            files.remove(spark, f"{base}/{_PUBLISHED}/{number:012d}")
