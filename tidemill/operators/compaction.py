"""Which small files to rewrite together, planned over a listing of data files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: size to aim for, 128 MB.
TARGET_BYTES = 128 * 1024 * 1024
# Default selection: a file is left alone between 75 % and 180 % of the target size,
# and a group is worth rewriting from five files on.
MIN_INPUT_FILES = 5
TARGETS_PER_GROUP = 8


def _outside(length: Column, target_bytes: int) -> Column:
    return (length * 4 < target_bytes * 3) | (length * 5 > target_bytes * 9)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def candidates(files: DataFrame, target_bytes: int = TARGET_BYTES, rewrite_all: bool = False) -> DataFrame:
    """Files to plan for, with their paths' digests and one of 256 parts by these."""
    wanted = files if rewrite_all else files.filter(_outside(F.col("length"), target_bytes))
    partition = F.col("partition") if "partition" in files.columns else F.lit("")
    digest = F.md5("path")
    part = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")  # 0 to 255
    return wanted.select(
        "table", partition.alias("partition"), "path", "length", digest.alias("digest"), part.alias("part")
    )


def assign_groups(
    files: DataFrame,
    target_bytes: int = TARGET_BYTES,
    rewrite_all: bool = False,
    targets_per_group: int = TARGETS_PER_GROUP,
) -> DataFrame:
    """Candidate files with the number of their group.

    Within a partition of a table, files in the order of their paths' digests fill
    groups of `targets_per_group` times the target size. The running sum is made in two
    steps, inside parts of the digest's range and over the sums of the parts, so no task
    takes all files of a partition; the result is that of one running sum. Without a
    column `partition` a table is one partition.
    """
    wanted = candidates(files, target_bytes, rewrite_all)
    of = ["table", "partition"]
    before = (Window.unboundedPreceding, -1)
    sums = wanted.groupBy(*of, "part").agg(F.sum("length").alias("bytes"))
    over_parts = Window.partitionBy(*of).orderBy("part").rowsBetween(*before)
    bases = sums.select(*of, "part", F.coalesce(F.sum("bytes").over(over_parts), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*of, "part").orderBy("digest", "path").rowsBetween(*before)
    placed = wanted.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    start = F.col("base") + F.col("inside")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*of, "part")]
    return (
        placed.alias("f")
        .join(bases.alias("b"), reduce(and_, same))
        .select(*[f"f.{c}" for c in (*of, "path", "length")], _div(start, target_bytes * targets_per_group).alias("group_no"))
    )


def compaction_plan(
    files: DataFrame,
    target_bytes: int = TARGET_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
    rewrite_all: bool = False,
    targets_per_group: int = TARGETS_PER_GROUP,
    grouping: Callable[..., DataFrame] = assign_groups,
) -> DataFrame:
    """Groups to rewrite: table, partition, group, files in, bytes, files out.

    `grouping` deals the files: `assign_groups` in the order of their digests,
    `packing_by_size.pack_groups` by their sizes.

    A group qualifies with enough files, with more than a target's worth of bytes in
    at least two files, or with one file so large that it should be split. The number
    of files out is rounded; over several targets per group that keeps each of them
    within the range that the next run leaves alone.
    """
    groups = (
        grouping(files, target_bytes, rewrite_all, targets_per_group)
        .groupBy("table", "partition", "group_no")
        .agg(F.count(F.lit(1)).alias("files_in"), F.sum("length").alias("bytes"))
    )
    if not rewrite_all:
        several = F.col("files_in") > 1
        enough = F.col("files_in") >= min_input_files
        groups = groups.filter(
            (several & (enough | (F.col("bytes") > target_bytes)))
            | (F.col("bytes") * 5 > target_bytes * 9)
        )
    rounded = _div(F.col("bytes") * 2 + target_bytes, 2 * target_bytes)
    return groups.withColumn("files_out", F.greatest(F.lit(1), rounded).cast("bigint"))
