"""Apply changes to stored parquet tables, at the cost of what changes.

A table with keys is stored in one folder per bucket of its keys: an upsert rewrites the
buckets it touches, once. A table without is stored in one folder per load: a load
writes its own folder, and a load that is repeated replaces it. Both are dynamic
overwrites of partition folders: Spark writes the new folders beside the table, then
deletes each old one and renames the new one to its place. A change that dies before
that leaves the table as it was, and repeating it is enough. One that dies between the
two has lost the rows of the folders it had deleted, which a repeat cannot bring back.
Tables that need changes to be atomic, or have several writers at a time, belong into a
catalog.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.names import col, fresh_name
from tidemill.operators.upsert import align_columns, check_unique, upsert
from tidemill.sources import files, scratch, versions

LOAD = "load"
_LAYOUT = re.compile(r"((?:bucket_of_(\d+)|load)_*)=")
_LOCK = "_writing"


def full_refresh(df: DataFrame, base: str) -> DataFrame:
    """Replace the table with `df`, columns included, and give the new rows."""
    return versions.publish(df, base)


def _layout(spark: SparkSession, base: str) -> tuple[str, int | None] | None:
    """Name of the folders' column and number of buckets, as the folders show them."""
    for path, _ in files.children(spark, f"{base}/*=*"):
        found = _LAYOUT.match(path.rsplit("/", 1)[1])
        if found:
            return found[1], found[2] and int(found[2])
    return None


def stored(spark: SparkSession, base: str) -> bool:
    return _layout(spark, base) is not None


def _scan(spark: SparkSession, base: str) -> DataFrame:
    """All rows with the folders' column; columns that came later are NULL before."""
    return spark.read.option("mergeSchema", True).parquet(base)


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """The rows of a stored table, whichever way it is stored."""
    layout = _layout(spark, base)
    return versions.current(spark, base) if layout is None else _scan(spark, base).drop(layout[0])


def _overwrite(df: DataFrame, base: str, by: str) -> None:
    # Rebalanced by folder: small ones share a task, large ones are split.
    (
        df.hint("rebalance", col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(base)
    )


@contextmanager
def _writing(spark: SparkSession, base: str, owner: str | None) -> Iterator[None]:
    """Refuse a second writer. A writer of the same name takes over what died."""
    owner = owner or uuid.uuid4().hex
    lock = f"{base}/{_LOCK}"
    if not files.create(spark, lock, owner) and files.read_marker(spark, lock) != owner:
        raise versions.Conflict(f"{base} is being written; if that writer died, remove {lock}")
    try:
        yield
    finally:
        files.remove(spark, lock)


@dataclass(frozen=True)
class BucketedTable:
    """A parquet table in one folder per key bucket.

    `buckets` counts for a new table; the folders' name then keeps the number.
    """

    base: str
    keys: tuple[str, ...]
    buckets: int = 64

    def _bucketed(self, df: DataFrame, name: str, buckets: int) -> DataFrame:
        # The typed values: the text of an instant differs from one session's zone to the next.
        number = F.pmod(F.xxhash64(*map(col, self.keys)), F.lit(buckets))
        return df.withColumn(name, number.cast("int"))

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.base)

    def create(self, df: DataFrame) -> None:
        name = fresh_name(df.columns, f"bucket_of_{self.buckets}")
        _overwrite(self._bucketed(df, name, self.buckets), self.base, name)

    def upsert(
        self,
        source: DataFrame,
        newer_than: str | None = None,
        check_source: bool = True,
        owner: str | None = None,
    ) -> None:
        """Merge into the touched buckets and replace these.

        The source is staged first: it is read several times, and once stored its size
        is known. Its values are cast to the table's types before keys are hashed, so a
        key finds its bucket however the source spells it. Columns the table lacks are
        added; buckets left alone read as NULL there.
        """
        spark = source.sparkSession
        staged, path = scratch.stage(source, "upsert")
        try:
            if check_source:
                check_unique(staged, self.keys)
            with _writing(spark, self.base, owner):
                layout = _layout(spark, self.base)
                if layout is None:
                    self.create(staged)
                    return
                name, buckets = layout
                if name.lower() in {c.lower() for c in staged.columns}:
                    raise ValueError(f"{self.base} keeps its buckets under the name {name}")
                table = _scan(spark, self.base)
                source = self._bucketed(align_columns(table.drop(name), staged)[1], name, buckets)
                # At most one row per bucket reaches the driver.
                touched = [r[0] for r in source.select(name).distinct().collect()]
                held = table.filter(F.col(name).isin(touched))
                merged = upsert(held, source, (*self.keys, name), newer_than, check_source=False)
                _overwrite(merged, self.base, name)
        finally:
            files.remove(spark, path)


def upsert_table(
    source: DataFrame,
    base: str,
    keys: Sequence[str],
    newer_than: str | None = None,
    check_source: bool = True,
    owner: str | None = None,
) -> DataFrame:
    """Upsert into a table in key buckets, creating it if need be."""
    table = BucketedTable(base, tuple(keys))
    table.upsert(source, newer_than, check_source, owner)
    return table.read(source.sparkSession)


def append_table(source: DataFrame, base: str, load: str, by: str | None = None) -> DataFrame:
    """Store rows as one load, creating the table if need be.

    Only the new rows are written. A load of the same name is replaced, so a repeated
    load changes nothing. With `by` the column of that name holds each row's load.
    """
    spark = source.sparkSession
    layout = _layout(spark, base)
    rows = source if by is None else source.drop(by)
    name = layout[0] if layout else fresh_name(rows.columns, LOAD)
    if layout and name.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"{base} keeps its loads under the name {name}")
    value = F.lit(load) if by is None else F.coalesce(F.col(by), F.lit(load))
    _overwrite(source.withColumn(name, value).select(*map(col, rows.columns), name), base, name)
    return read_table(spark, base)


def drop_load(spark: SparkSession, base: str, load: str) -> None:
    """Remove one load, if it is there."""
    layout = _layout(spark, base)
    if layout:
        for path, _ in files.children(spark, f"{base}/{layout[0]}=*"):
            if unquote(path.rsplit("/", 1)[1].partition("=")[2]) == load:
                files.remove(spark, path)
