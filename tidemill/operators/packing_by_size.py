"""Files packed into groups by their size, planned over a histogram.

First-fit decreasing places the largest files first, each into the first group with room
for it. Files of one size class are alike for that, so the plan is made from the number of
files per class: it has a few rows a class, however many files there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators import compaction

# A size class holds the lengths that round up to the same number of so many leading
# binary digits, so a class is at most a sixteenth wider than its files.
DIGITS = 5

_RUNS = "size array<bigint>, start array<bigint>, fits array<bigint>, first array<bigint>"


def size_class(length: Column) -> Column:
    """The length rounded up to DIGITS leading binary digits; 1 for an empty file."""
    length = F.greatest(F.coalesce(length, F.lit(0)), F.lit(1)).cast("bigint")
    dropped = F.greatest(F.length(F.bin(length)) - DIGITS, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), dropped)
    return F.call_function("div", length + step - 1, step) * step


def first_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """Where the files of each class go, as runs (size, start, fits, first).

    From the file of rank `start` on, every `fits` files of the class fill the next group,
    beginning with group `first`. `sizes` descend. Groups that are filled alike are kept
    as one row (room, groups, first), in the order of their numbers.
    """
    runs, opened = [], 0
    room, groups, first = (np.zeros(0, np.int64) for _ in range(3))
    for size, count in zip(sizes.tolist(), counts.tolist()):
        fits = room // size
        could = fits * groups
        start = np.cumsum(could) - could
        taken = np.clip(count - start, 0, could)
        used = np.flatnonzero(taken)
        runs += [(size, int(start[i]), int(fits[i]), int(first[i])) for i in used]
        left = count - int(taken.sum())
        # Every row falls into full groups, one that is partly filled, and untouched ones.
        per = np.maximum(fits, 1)
        full, over = taken // per, taken % per
        split = np.stack([full, (over > 0).astype(np.int64), groups - full - (over > 0)], 1)
        rooms = np.stack([room - fits * size, room - over * size, room], 1)
        firsts = np.stack([first, first + full, first + full + (over > 0)], 1)
        room, groups, first = rooms.ravel(), split.ravel(), firsts.ravel()
        if left:
            fit = max(1, capacity // size)  # a file beyond the capacity is a group of its own
            runs.append((size, count - left, fit, opened))
            full, over = divmod(left, fit)
            room = np.append(room, [capacity - fit * size, capacity - over * size])
            groups = np.append(groups, [full, int(over > 0)])
            first = np.append(first, [opened, opened + full])
            opened += full + (over > 0)
        kept = (groups > 0) & (room >= sizes[-1])
        room, groups, first = room[kept], groups[kept], first[kept]
    return runs


def _runs(capacity: int):
    @F.pandas_udf(_RUNS)
    def plan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sizes, counts in batches:
            placed = [np.array(first_fit(s, c, capacity), np.int64).T for s, c in zip(sizes, counts)]
            yield pd.DataFrame({name: [p[i] for p in placed] for i, name in enumerate(("size", "start", "fits", "first"))})

    return plan


def pack_groups(
    files: DataFrame,
    target_bytes: int = compaction.TARGET_BYTES,
    rewrite_all: bool = False,
    targets_per_group: int = compaction.TARGETS_PER_GROUP,
) -> DataFrame:
    """Candidate files with the number of their group, as `compaction.assign_groups` gives.

    Groups hold at most `targets_per_group` times the target size in bytes, but for files
    beyond that, which are alone. Files of one class are ranked by their paths' digests,
    in parts of the digest's range and by the counts of the parts, so no task takes all
    files of a partition or class. An unknown length counts as 0.
    """
    wanted = compaction.candidates(files, target_bytes, rewrite_all).withColumn("size", size_class(F.col("length")))
    of = ["table", "partition"]
    before = (Window.unboundedPreceding, -1)
    counts = wanted.groupBy(*of, "size", "part").agg(F.count(F.lit(1)).alias("n"))
    over_parts = Window.partitionBy(*of, "size").orderBy("part").rowsBetween(*before)
    bases = counts.select(*of, "size", "part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("base"))

    classes = counts.groupBy(*of, "size").agg(F.sum("n").alias("n"))
    # A row a class: at most 16 for each doubling of the length.
    histogram = classes.groupBy(*of).agg(
        F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("classes")
    )
    planned = histogram.select(*of, _runs(target_bytes * targets_per_group)("classes.size", "classes.n").alias("runs"))
    runs = (
        planned.select(*of, F.inline(F.arrays_zip("runs.size", "runs.start", "runs.fits", "runs.first")))
        .groupBy(*of, "size")
        .agg(F.sort_array(F.collect_list(F.struct("start", "fits", "first"))).alias("runs"))
    )
    known = bases.alias("b").join(runs.alias("r"), _same("b", "r", (*of, "size")))
    known = known.select(*[f"b.{c}" for c in (*of, "size", "part", "base")], "runs")

    inside = Window.partitionBy(*of, "size", "part").orderBy("digest", "path")
    ranked = wanted.withColumn("inside", F.row_number().over(inside) - 1)
    rank = F.col("base") + F.col("inside")
    run = F.element_at(F.filter("runs", lambda r: r["start"] <= F.col("rank")), -1)
    return (
        ranked.alias("f")
        .join(known.alias("k"), _same("f", "k", (*of, "size", "part")))
        .select(*[f"f.{c}" for c in (*of, "path", "length")], "runs", rank.alias("rank"))
        .withColumn("run", run)
        .select(
            *of,
            "path",
            "length",
            (F.col("run.first") + F.call_function("div", F.col("rank") - F.col("run.start"), F.col("run.fits"))).alias(
                "group_no"
            ),
        )
    )


def _same(left: str, right: str, names: tuple[str, ...]) -> Column:
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])
