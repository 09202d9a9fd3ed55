"""Which snapshots and which files may go."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.names import fresh_name
from tidemill.functions.paths import unified
from tidemill.sources.files import store_of, store_options

# Public defaults: snapshots expire after five days, orphans go after three.
SNAPSHOT_AGE = timedelta(days=5)
ORPHAN_AGE = timedelta(days=3)


def cutoff(age: timedelta, now: datetime | None = None) -> datetime:
    """A UTC instant; it means the same in every session time zone."""
    return (now or datetime.now(timezone.utc)) - age


def _column(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment)


def retained(snaps: DataFrame, retain_last: int) -> DataFrame:
    """The newest snapshots of each table.

    Spark drops all but `retain_last` per table in every task before the shuffle.
    """
    newest = Window.partitionBy("table").orderBy(
        F.col("committed_at").desc_nulls_last(), F.col("snapshot_id").desc()
    )
    row = fresh_name(snaps.columns, "_row")
    ranked = snaps.withColumn(row, F.row_number().over(newest))
    return ranked.filter(F.col(row) <= retain_last).drop(row)


def expire_plan(
    snaps: DataFrame, retain_last: int = 2, older_than: datetime | Column | None = None
) -> DataFrame:
    """Snapshots older than the cutoff and outside the newest `retain_last`.

    Written as all old ones without the retained: ranking every snapshot of a table
    would put a table with very many into one task, while this join spreads by
    snapshot.
    """
    if retain_last < 1:
        raise ValueError("at least one snapshot must stay")
    limit = _column(cutoff(SNAPSHOT_AGE) if older_than is None else older_than)
    keep = retained(snaps, retain_last).select("table", "snapshot_id")
    return snaps.filter(F.col("committed_at") < limit).join(
        keep, ["table", "snapshot_id"], "left_anti"
    )


def orphan_plan(
    listing: DataFrame, live: DataFrame, older_than: datetime | Column | None = None
) -> DataFrame:
    """Listed files that no snapshot refers to and that are old enough to be no one's
    unfinished write.

    The paths are compared in one spelling. A file that many snapshots refer to is
    reduced to one row before the join.
    """
    limit = _column(cutoff(ORPHAN_AGE) if older_than is None else older_than)
    key = fresh_name(listing.columns, "_key")
    known = live.select(unified(F.col("path")).alias(key)).distinct()
    old = listing.filter(F.col("modificationTime") < limit)
    return old.withColumn(key, unified(F.col("path"))).join(known, key, "left_anti").drop(key)


def _delete(path: str, options: dict[str, str]) -> str:
    """`deleted`, `absent`, or what went wrong. The path is taken as it is listed."""
    try:
        system, inner, _ = store_of(path, options)
        system.delete_file(inner)
    except FileNotFoundError:
        return "absent"
    except Exception as error:  # a row per file, whatever became of it
        return f"failed: {error}"
    return "deleted"


def delete_files(files: DataFrame, dry_run: bool = True) -> DataFrame:
    """(path, outcome) per file: planned, deleted, absent (as when another attempt of
    the task got there first), or failed and why.

    Deletes only without `dry_run`, and inside the tasks. As with any DataFrame nothing
    happens until the result is read.
    """
    paths = files.select("path")
    if dry_run:
        return paths.withColumn("outcome", F.lit("planned"))
    options = store_options(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(outcome=[_delete(p, options) for p in batch["path"]])

    return paths.mapInPandas(run, "path string, outcome string")
