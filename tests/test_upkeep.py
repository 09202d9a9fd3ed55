"""Maintenance plans and their application; catalog helpers."""

import hashlib
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.plans import text_plan
from tidemill.functions.paths import unified
from tidemill.operators import compaction, retention, upkeep
from tidemill.plans import runbook
from tidemill.sources import catalog

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def files(spark, *rows):
    return spark.createDataFrame(list(rows), "table string, path string, length bigint")


def test_small_files_are_grouped(spark):
    df = files(spark, *[("t", f"f{i}", 30) for i in range(8)], ("t", "ok", 100), ("u", "one", 10))
    grouped = compaction.assign_groups(df, target_bytes=100, targets_per_group=1)
    got = sorted(r["group_no"] for r in grouped.filter("table = 't'").collect())
    assert got == [i * 30 // 100 for i in range(8)]
    plan = compaction.compaction_plan(df, 100, min_input_files=2, targets_per_group=1).collect()
    assert {(r["table"], r["group_no"], r["files_in"]) for r in plan} == {
        ("t", 0, 4),
        ("t", 1, 3),
    }


def test_which_groups_are_worth_it(spark):
    few = files(spark, ("t", "a", 30), ("t", "b", 30))
    assert compaction.compaction_plan(few, 100).count() == 0
    assert compaction.compaction_plan(few, 100, min_input_files=2).count() == 1
    assert compaction.compaction_plan(few, 100, rewrite_all=True).count() == 1
    full = files(spark, ("t", "a", 70), ("t", "b", 70))
    assert compaction.compaction_plan(full, 100).head()["files_out"] == 1
    large = compaction.compaction_plan(files(spark, ("t", "a", 1000)), 100).head()
    assert (large["files_in"], large["files_out"]) == (1, 10)
    fine = files(spark, ("t", "a", 75), ("t", "b", 180))
    assert compaction.compaction_plan(fine, 100, min_input_files=1).count() == 0


def test_compaction_settles(spark):
    """The files that come out are left alone by the next plan."""
    plan = compaction.compaction_plan(
        files(spark, *[("t", f"{i:03}", 7 + i % 50) for i in range(300)]), 100, min_input_files=2
    )
    after = [r["bytes"] / r["files_out"] for r in plan.collect()]
    assert sum(1 for size in after if not 75 <= size <= 180) <= 1


def test_running_sums_are_made_in_parts(spark):
    """A table of any size gives the groups of one running sum, without one big task."""
    df = spark.range(5000).select(
        F.lit("hot").alias("table"), F.format_string("%05d", "id").alias("path"), (F.col("id") % 7 + 1).alias("length")
    )
    grouped = compaction.assign_groups(df, 100, rewrite_all=True, targets_per_group=1)
    order = sorted((r["path"] for r in df.collect()), key=lambda p: (hashlib.md5(p.encode()).hexdigest(), p))
    want, start = {}, 0
    for path in order:
        want[path] = start // 100
        start += int(path) % 7 + 1
    assert {r["path"]: r["group_no"] for r in grouped.collect()} == want


def test_groups_stay_inside_a_partition(spark):
    rows = [("t", f"p={i % 3}", f"f{i}", 30) for i in range(30)]
    df = spark.createDataFrame(rows, "table string, partition string, path string, length bigint")
    plan = compaction.compaction_plan(df, 100, min_input_files=2).collect()
    assert {(r["partition"], r["files_in"]) for r in plan} == {(f"p={i}", 10) for i in range(3)}


def snaps(spark, *rows):
    return spark.createDataFrame(list(rows), "table string, snapshot_id bigint, committed_at timestamp")


def test_expiry_needs_age_and_rank(spark):
    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    df = snaps(spark, *[("t", d, at(d)) for d in (1, 2, 3, 30)], ("u", 1, at(1)), ("v", 1, at(29)))
    plan = lambda **k: {
        (r["table"], r["snapshot_id"]) for r in retention.expire_plan(df, **k).collect()
    }
    before = retention.cutoff(timedelta(days=5), NOW)
    assert plan(retain_last=2, older_than=before) == {("t", 1), ("t", 2)}
    assert plan(retain_last=1, older_than=NOW) == {("t", 1), ("t", 2), ("t", 3)}
    assert plan(retain_last=2, older_than=at(2)) == {("t", 1)}
    with pytest.raises(ValueError):
        retention.expire_plan(df, 0)


def test_expiry_limits_before_the_shuffle(spark):
    plan = text_plan(retention.expire_plan(snaps(spark), 2, NOW))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_orphans(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 31, 20)
    listed = spark.createDataFrame(
        [("s3a://b/a.parquet", old), ("s3a://b/x.parquet", old), ("s3a://b/y.parquet", new)],
        "path string, modificationTime timestamp",
    )
    live = spark.createDataFrame([("s3://b//a.parquet",)] * 3, "path string")
    plan = retention.orphan_plan(listed, live, retention.cutoff(timedelta(days=1), NOW))
    assert [r["path"] for r in plan.collect()] == ["s3a://b/x.parquet"]


@pytest.mark.parametrize(
    "path, same",
    [
        ("s3a://b//k/f", "s3://b/k/f"),
        ("s3n://b/k", "s3://b/k"),
        ("file:/t/f", "/t/f"),
        ("file:///t//f", "/t/f"),
        ("hdfs://n:1/t//f", "hdfs://n:1/t/f"),
    ],
)
def test_unified_paths(spark, path, same):
    assert spark.range(1).select(unified(F.lit(path))).head()[0] == same


def test_delete_files(spark, tmp_path):
    paths = [tmp_path / n for n in ("a", "b c", "d%3Ae", "keep")]
    for p in paths:
        p.write_text("x")
    df = spark.createDataFrame([(f"file:{p}",) for p in [*paths[:3], tmp_path / "gone"]], "path string")
    assert {r["outcome"] for r in retention.delete_files(df).collect()} == {"planned"}
    assert all(p.exists() for p in paths)
    got = {os.path.basename(r["path"]): r["outcome"] for r in retention.delete_files(df, dry_run=False).collect()}
    assert got == {"a": "deleted", "b c": "deleted", "d%3Ae": "deleted", "gone": "absent"}
    assert [p.exists() for p in paths] == [False, False, False, True]


def test_summary(spark):
    plan = compaction.compaction_plan(files(spark, *[("t", f"{i}", 30) for i in range(8)]), 100, 2, targets_per_group=1)
    expired = snaps(spark, ("t", 1, NOW), ("u", 1, NOW), ("u", 2, NOW))
    orphans = files(spark, ("v", "x", 7))
    summary = upkeep.maintenance_summary(plan, expired, orphans)
    rows = {r["table"]: r.asDict() for r in summary.collect()}
    assert (rows["t"]["groups"], rows["t"]["files_in"], rows["t"]["expired_snapshots"]) == (2, 7, 1)
    assert rows["u"]["expired_snapshots"] == 2 and rows["u"]["files_in"] == 0
    assert (rows["v"]["orphan_files"], rows["v"]["orphan_bytes"]) == (1, 7)
    totals = upkeep.maintenance_totals(summary).head()
    assert (totals["tables"], totals["expired_snapshots"], totals["orphan_bytes"]) == (3, 3, 7)
    with pytest.raises(ValueError):
        upkeep.maintenance_summary()


def test_compact_rewrites_chosen_partitions_only(spark, tmp_path):
    base = f"{tmp_path}/t"
    df = spark.range(30_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 3).alias("p"))
    df.filter("p < 2").repartition(20).write.partitionBy("p").parquet(base)
    df.filter("p = 2").coalesce(1).write.mode("append").partitionBy("p").parquet(base)
    files_of = lambda p: {f.name: f.read_bytes() for f in (tmp_path / "t").glob(f"p={p}/*.parquet")}
    before = [files_of(p) for p in range(3)]
    size = sum(map(len, before[0].values()))
    assert runbook.compact(spark, base, target_bytes=size) == ["p=0", "p=1"]
    after = [files_of(p) for p in range(3)]
    assert after[2] == before[2]
    assert all(1 <= len(a) <= 4 and not set(a) & set(b) for a, b in zip(after[:2], before[:2]))
    assert spark.read.parquet(base).select(*df.columns).exceptAll(df.withColumn("p", F.col("p").cast("int"))).count() == 0
    assert spark.read.parquet(base).count() == 30_000
    # What was compacted is left alone, and so are the session's own settings.
    assert runbook.compact(spark, base, target_bytes=size) == []
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(size)


def test_a_flat_folder_is_not_compacted(spark, tmp_path):
    spark.range(100).repartition(10).write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="outside partition folders"):
        runbook.compact(spark, f"{tmp_path}/t")


def test_statements_in_order():
    steps = runbook.statements("lake.ns.t'1", runbook.DAILY, NOW)
    assert tuple(steps) == runbook.ALL_STEPS
    assert steps["data"] == (
        "CALL `lake`.system.rewrite_data_files(table => 'lake.ns.t\\'1', options => "
        "map('target-file-size-bytes', '134217728', 'rewrite-all', 'true'))"
    )
    assert "retain_last => 1" in steps["snapshots"]
    assert "older_than => TIMESTAMP '2024-02-01 00:00:00.000000+00:00'" in steps["snapshots"]
    assert "TIMESTAMP '2024-01-31 00:00:00.000000+00:00'" in steps["orphans"]
    assert "'write.metadata.previous-versions-max'='2'" in steps["properties"]
    weekly = runbook.statements("lake.ns.t", runbook.WEEKLY, NOW)["data"]
    assert "'min-input-files', '2'" in weekly and "rewrite-all" not in weekly
    assert runbook.expire_sql("lake.t").endswith("retain_last => 2)")
    assert runbook.orphans_sql("lake.t") == "CALL `lake`.system.remove_orphan_files(table => 'lake.t')"


def test_instants_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Ho_Chi_Minh"):
            spark.conf.set("spark.sql.session.timeZone", name)
            literal = runbook._timestamp(NOW)
            assert spark.sql(f"SELECT unix_seconds({literal})").head()[0] == NOW.timestamp()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_merge_statement():
    assert catalog.merge_sql("lake.ns.t", "src", ["id"]) == (
        "MERGE INTO `lake`.`ns`.`t` t USING `src` s ON t.`id` = s.`id` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


@pytest.mark.parametrize(
    "root, listed, full",
    [
        ("lake.raw", "a", "lake.raw.a"),
        ("lake.raw", "raw.a", "lake.raw.a"),
        ("lake.raw", "lake.raw.a", "lake.raw.a"),
        ("lake.raw", "rawer", "lake.raw.rawer"),
        ("lake", "a", "lake.a"),
    ],
)
def test_listed_namespaces_are_prefixed_once(root, listed, full):
    assert catalog.under(root, listed) == full


@pytest.fixture
def namespace(spark, tmp_path):
    name = "spark_catalog.tidemill_test"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS tidemill_test LOCATION '{tmp_path}/wh'")
    yield name
    spark.sql("DROP NAMESPACE tidemill_test CASCADE")


def test_catalog_tables(spark, namespace):
    name = f"{namespace}.tbl_x"
    df = spark.createDataFrame([(1, {"a": [1]})], "id int, `odd name` map<string,array<int>>")
    assert not catalog.table_exists(spark, name)
    catalog.create_like(df, name, using="parquet", table_properties={"k": "v"})
    assert catalog.table_exists(spark, name)
    assert spark.table(name).schema == df.schema and spark.table(name).count() == 0
    catalog.set_properties(spark, name, {"it's": "a \\ value"})
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert shown["k"] == "v" and shown["it's"] == "a \\ value"
    assert name in catalog.list_tables(spark, "spark_catalog")


def test_maintenance_reports_failures_at_the_end(spark, namespace):
    # Parquet tables have no maintenance procedures: properties work, the next step fails.
    catalog.create_like(spark.range(1), f"{namespace}.a", "parquet", {})
    status = runbook.maintain_table(spark, f"{namespace}.a")
    assert status.error and list(status.steps) == ["properties"]
    assert runbook.maintain_table(spark, f"{namespace}.none").steps == {"skipped": {}}
    with pytest.raises(runbook.MaintenanceFailed, match="tidemill_test.a"):
        runbook.maintain_all(spark, "spark_catalog")
    done = runbook.maintain_all(spark, "spark_catalog", steps=["properties"])
    assert [s.error for s in done] == [None]


RAW = ["007", "7", "1e3", "true", "a b", "50%", "2024-01-31 10:00", "é/=", None]


def stored_files(spark, base):
    found = runbook.listing(spark, str(base)).select("partition", "length").collect()
    sizes = {}
    for row in found:
        sizes.setdefault(row["partition"], []).append(row["length"])
    return sizes


def test_compaction_keeps_the_text_of_partitions(spark, tmp_path):
    """Values that look like numbers, or hold signs that paths escape, stay as they are."""
    base = str(tmp_path / "t")
    rows = [(i, RAW[i % len(RAW)], i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, zip string, _first int")
    df.repartition(6, "id").write.partitionBy("zip", "_first").parquet(base)
    before = stored_files(spark, base)
    chosen = runbook.compact(spark, base, min_input_files=2)
    after = stored_files(spark, base)
    assert sorted(chosen) == sorted(before) == sorted(after)
    assert all(len(sizes) == 1 for sizes in after.values())
    raw = runbook._raw_rows(spark, [base], base, ["zip"])
    assert sorted(map(tuple, raw.select("id", "zip", "_first").collect())) == sorted(rows)
    assert runbook.compact(spark, base, min_input_files=2) == []


def test_compacted_files_are_near_the_target(spark, tmp_path):
    """One folder of many files and one of a single large file; other folders share tasks."""
    base, target = str(tmp_path / "t"), 60_000
    text = F.concat_ws("", *[F.md5((F.col("id") * 8 + k).cast("string")) for k in range(8)])
    rows = spark.range(4000).select("id", text.alias("text"), F.lit("many").alias("p"))
    rows.repartition(40).write.partitionBy("p").parquet(base)
    rows.withColumn("p", F.lit("one")).coalesce(1).write.mode("append").partitionBy("p").parquet(base)
    for i in range(3):
        small = rows.limit(20).withColumn("p", F.lit(f"small{i}"))
        small.repartition(3, "id").write.mode("append").partitionBy("p").parquet(base)
    runbook.compact(spark, base, target, min_input_files=2)
    sizes = stored_files(spark, base)
    for part in ("p=many", "p=one"):
        assert len(sizes[part]) > 5
        assert all(0.75 * target <= size <= 1.8 * target for size in sizes[part])
    assert [len(sizes[f"p=small{i}"]) for i in range(3)] == [1, 1, 1]
    assert spark.read.parquet(base).count() == 8060


def test_small_folders_share_a_task():
    rows, tasks = runbook._file_numbers([("p=a", 10), ("p=b", 250), ("p=c", 80), ("p=d", 20)], 100)
    assert rows == [("a", 0, 1), ("b", 1, 3), ("c", 0, 1), ("d", 4, 1)] and tasks == 5


def test_many_folders_take_several_tasks():
    parts = [(f"p={i:03}", 1) for i in range(2 * runbook.FOLDERS_PER_TASK + 1)]
    rows, tasks = runbook._file_numbers(parts, 1000)
    firsts = [first for _, first, _ in rows]
    assert tasks == 3 and max(map(firsts.count, firsts)) == runbook.FOLDERS_PER_TASK


def test_compaction_does_not_sort_its_rows(spark, tmp_path, monkeypatch):
    """A task writes its folders side by side, without a sort; the session's own setting
    comes back."""
    base, key = str(tmp_path / "t"), "spark.sql.maxConcurrentOutputFileWriters"
    rows = spark.range(0, 200_000, 1, 4).select("id", (F.col("id") % 3).alias("p"))
    rows.write.partitionBy("p").parquet(base)
    before, seen = spark.conf.get(key), []
    store = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: seen.append(spark.conf.get(key)) or store(*a, **k))
    assert len(runbook.compact(spark, base, min_input_files=2)) == 3
    assert seen == [str(runbook.FOLDERS_PER_TASK)] and spark.conf.get(key) == before
    assert spark.read.parquet(base).count() == 200_000
    assert [len(sizes) for sizes in stored_files(spark, base).values()] == [1, 1, 1]
