"""Find input files and work out which table each one loads."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import paths
from tidemill.functions.names import fresh_name
from tidemill.sources import files, scratch


_LISTING = "path string, length bigint, modificationTime timestamp"


def discover_files(
    spark: SparkSession,
    base: str,
    day: str | None = None,
    suffix: str = ".json",
    day_depth: int = 2,
) -> DataFrame:
    """(path, length, modificationTime) of the files under `base`.

    Contents are never read. With `day`, only the day's folders `day_depth` levels
    below `base` are listed, so a daily run does not walk the history. Without it all
    files are, whatever the layout; narrow them down with `filter_day`.
    """
    start = base.rstrip("/")
    if day is not None:
        start = "/".join([start, *["*"] * day_depth, day])
        if not files.children(spark, start):
            return spark.createDataFrame([], _LISTING)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(start)
        .select("path", "length", "modificationTime")
    )


def list_files(spark: SparkSession, base: str, suffix: str = ".json") -> DataFrame:
    """All files under `base`, in any depth, listed by the tasks.

    Gives what `discover_files` gives for a whole tree, but folders and files are rows:
    each round lists the folders that the last one found and stores what it sees, so
    the driver holds no listing. Folders and files whose names begin with `_` or `.` are
    left out, as by every Spark scan. Stores that the tasks cannot reach are listed by
    `discover_files`.
    """
    if not files.in_reach_of_tasks(base):
        return discover_files(spark, base, suffix=suffix)
    options = files.store_options(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner, before = files.store_of(path, options)
                found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                found = [f for f in found if not f.base_name.startswith(("_", "."))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before + f.path for f in found], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                        pa.array([f.size or 0 for f in found], pa.int64()),
                        pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                    ],
                    ["path", "folder", "length", "modificationTime"],
                )

    rounds: list[DataFrame] = []
    folders = spark.createDataFrame([(base.rstrip("/"),)], "path string")
    while True:
        # Dealt out by name, so a round's folders are listed side by side.
        found = folders.repartition("path").mapInArrow(run, f"path string, folder boolean, {_LISTING.split(', ', 1)[1]}")
        seen, _ = scratch.stage(found, "listing")
        rounds.append(seen)
        folders = seen.filter("folder").select("path")
        if folders.isEmpty():
            break
    listed = reduce(DataFrame.unionByName, rounds)
    return listed.filter(~F.col("folder") & F.col("path").endswith(suffix)).drop("folder")


def filter_day(
    listing: DataFrame, ds: str, full_scan: bool = False, suffix: str = ".json"
) -> DataFrame:
    """Keep files with the suffix that lie under the day's folder, or all of them."""
    wanted = listing.filter(F.col("path").endswith(suffix))
    return wanted if full_scan else wanted.filter(F.col("path").contains(f"/{ds}/"))


def parse_path(listing: DataFrame, root: str = "") -> DataFrame:
    """Add namespace, table, date, folder and target table name.

    The date is the last folder that starts with one; the two folders above it are
    the table and the namespace. Paths without that shape are left out. Only folders
    count, so a file named after a date does not shift the rest.
    """
    dated = fresh_name(listing.columns, "_dated")
    parts = F.split(dated, "/")
    return (
        listing.withColumn(dated, paths.dated_folders(F.col("path")))
        .filter(F.col(dated) != "")
        .withColumns(
            {
                "namespace": F.get(parts, F.lit(0)),
                "table": F.get(parts, F.lit(1)),
                "date": F.get(parts, F.lit(2)),
                "folder": paths.directory(F.col("path")),
            }
        )
        .withColumn("target", paths.target_name(F.col("namespace"), F.col("table"), root))
        .drop(dated)
    )


def unparsed(listing: DataFrame) -> DataFrame:
    """The files `parse_path` leaves out."""
    return listing.filter(paths.dated_folders(F.col("path")) == "")


def group_files(parsed: DataFrame) -> DataFrame:
    """Per target table and folder: number of files and bytes.

    The list stays one row per folder. A reader opens folders, so no row has to hold
    all file names of a table.
    """
    return parsed.groupBy("target", "folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes")
    )


def table_counts(parsed: DataFrame) -> DataFrame:
    """Per target table: folders, files, bytes, first and last date."""
    return (
        parsed.groupBy("target", "folder", "date")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
        .groupBy("target")
        .agg(
            F.count(F.lit(1)).alias("n_folders"),
            F.sum("n_files").alias("n_files"),
            F.sum("bytes").alias("bytes"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )
