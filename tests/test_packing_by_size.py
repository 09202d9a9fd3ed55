"""Files packed by size: the plan over classes against files placed one by one."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.plans import text_plan
from tidemill.operators import compaction, packing_by_size

SCHEMA = "table string, partition string, path string, length bigint"


def rounded(length):
    length = max(length, 1)
    unit = 1 << max(length.bit_length() - packing_by_size.DIGITS, 0)
    return -(-length // unit) * unit


def one_by_one(sizes, capacity):
    """First-fit decreasing, file by file: the sizes of every group in their order."""
    groups = []
    for size in sorted(sizes, reverse=True):
        for group in groups:
            if sum(group) + size <= capacity:
                group.append(size)
                break
        else:
            groups.append([size])
    return groups


def lengths(rng, n, capacity):
    kinds = [
        lambda: rng.randint(0, 3),
        lambda: rng.randint(1, capacity // 8),
        lambda: rng.choice([capacity // 3, capacity // 2, capacity]),
        lambda: rng.randint(capacity // 2, 2 * capacity),
    ]
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("seed", range(40))
def test_classes_are_placed_as_their_files_would_be(seed):
    rng = random.Random(seed)
    capacity = rng.choice([100, 800, 1 << 20])
    sizes = [rounded(x) for x in lengths(rng, rng.randint(1, 200), capacity)]
    classes = sorted(Counter(sizes).items(), reverse=True)
    runs = packing_by_size.first_fit(*(np.array(x, np.int64) for x in zip(*classes)), capacity)
    groups: dict[int, list[int]] = {}
    for size, count in classes:
        own = sorted((start, fits, first) for s, start, fits, first in runs if s == size)
        for rank in range(count):
            start, fits, first = [run for run in own if run[0] <= rank][-1]
            groups.setdefault(first + (rank - start) // fits, []).append(size)
    assert [groups[i] for i in sorted(groups)] == one_by_one(sizes, capacity)


def test_plan_grows_with_classes_not_with_files():
    sizes = np.arange(1000, 0, -1, dtype=np.int64)
    runs = {n: len(packing_by_size.first_fit(sizes, np.full(1000, n, np.int64), 8000)) for n in (10**3, 10**9)}
    assert runs[10**9] < 8 * len(sizes) and runs[10**9] < 2 * runs[10**3]


def test_size_classes(spark):
    values = [None, 0, 1, 31, 32, 33, 63, 64, 65, 1000, (1 << 40) + 1, (1 << 62) - 1]
    df = spark.createDataFrame([(v,) for v in values], "length bigint")
    got = df.select(packing_by_size.size_class(F.col("length")).alias("c")).collect()
    assert [r["c"] for r in got] == [rounded(v or 0) for v in values]


def test_groups_hold_what_fits(spark):
    """A hot partition, a null one, empty files, repeated paths and files beyond a group."""
    rng = random.Random(1)
    rows = [("t", "hot", f"f{i}", size) for i, size in enumerate(lengths(rng, 600, 800))]
    rows += [("t", None, f"g{i}", 30) for i in range(60)] + [(None, "p", "same", 10)] * 3
    rows += [("u", "p", "empty", 0), ("u", "p", "unknown", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    grouped = packing_by_size.pack_groups(df, 100, rewrite_all=True).collect()
    assert Counter((r["table"], r["partition"], r["path"], r["length"]) for r in grouped) == Counter(rows)
    groups: dict[tuple, list[int]] = {}
    for r in grouped:
        groups.setdefault((r["table"], r["partition"], r["group_no"]), []).append(rounded(r["length"] or 0))
    assert all(sum(group) <= 800 or len(group) == 1 for group in groups.values())
    for of in {(t, p) for t, p, _, _ in rows}:
        want = one_by_one([rounded(x or 0) for *key, _, x in rows if tuple(key) == of], 800)
        own = sorted(k[2] for k in groups if k[:2] == of)
        assert [sorted(groups[(*of, i)], reverse=True) for i in own] == want


def test_fewer_groups_than_by_digest(spark):
    """Files that fill a group in pairs or threes are put together."""
    rows = [("t", "p", f"f{i:04}", 500 if i % 2 else 300) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = compaction.compaction_plan(df, 100, 2, rewrite_all=True, grouping=packing_by_size.pack_groups)
    got = plan.agg(F.count("*").alias("n"), F.sum("files_in").alias("files"), F.max("bytes").alias("most")).head()
    # 500 counts as 512 and 300 as 304, so a 500 and a 300 do not meet in 800 but two 300 do.
    assert (got["n"], got["files"], got["most"]) == (200 + 100, 400, 600)


def test_empty_listing(spark):
    assert packing_by_size.pack_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_window_over_a_whole_partition(spark):
    plan = text_plan(packing_by_size.pack_groups(spark.createDataFrame([("t", "p", "f", 1)], SCHEMA)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
