"""Upsert and append, in memory and stored."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.plans import final_plan, text_plan
from tidemill.operators.upsert import DuplicateKeys, align_columns, append, upsert
from tidemill.plans import change
from tidemill.sources import scratch, versions

SCHEMA = "id int, v string, t string"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def table(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_replace_insert_keep(spark):
    target = table(spark, [(1, "old", "a"), (2, "keep", "a")])
    source = table(spark, [(1, "new", "b"), (3, "add", "b")])
    assert rows(upsert(target, source, ["id"])) == Counter(
        [(1, "new", "b"), (2, "keep", "a"), (3, "add", "b")]
    )


def test_source_nulls_overwrite(spark):
    got = upsert(table(spark, [(1, "old", "a")]), table(spark, [(1, None, None)]), ["id"])
    assert rows(got) == Counter([(1, None, None)])


def test_repeated_target_keys_and_null_keys(spark):
    target = table(spark, [(1, "a", "x"), (1, "b", "x"), (None, "n", "x")])
    source = table(spark, [(1, "s", "y"), (None, "m", "y"), (None, "o", "y")])
    assert rows(upsert(target, source, ["id"])) == Counter(
        {(1, "s", "y"): 2, (None, "n", "x"): 1, (None, "m", "y"): 1, (None, "o", "y"): 1}
    )


def test_repeated_source_keys_are_refused(spark):
    with pytest.raises(DuplicateKeys, match="'id': 1"):
        upsert(table(spark, []), table(spark, [(1, "a", "x"), (1, "b", "x")]), ["id"])


def test_twice_is_once(spark):
    target = table(spark, [(1, "old", "a"), (2, "keep", "a")])
    source = table(spark, [(1, "new", "b"), (3, "add", "b")])
    once = upsert(target, source, ["id"])
    assert rows(upsert(once, source, ["id"])) == rows(once)


def test_source_derived_from_the_target(spark):
    target = table(spark, [(1, "a", "x"), (2, "b", "x")])
    source = target.filter("id = 1").withColumn("v", F.lit("z"))
    assert rows(upsert(target, source, ["id"])) == Counter([(1, "z", "x"), (2, "b", "x")])


def test_several_keys(spark):
    schema = "a int, b int, v string"
    target = table(spark, [(1, 1, "x"), (1, 2, "y")], schema)
    source = table(spark, [(1, 2, "new"), (2, 1, "add")], schema)
    got = upsert(target, source, ["a", "b"])
    assert rows(got) == Counter([(1, 1, "x"), (1, 2, "new"), (2, 1, "add")])


def test_older_rows_do_not_replace_newer(spark):
    target = table(spark, [(1, "held", "2024-02"), (2, "held", None), (3, "held", "2024-02")])
    source = table(spark, [(1, "late", "2024-01"), (2, "new", "2024-01"), (3, "none", None)])
    assert rows(upsert(target, source, ["id"], newer_than="t")) == Counter(
        [(1, "held", "2024-02"), (2, "new", "2024-01"), (3, "held", "2024-02")]
    )


def test_new_and_missing_columns(spark):
    target = table(spark, [(1, "a", "x")])
    source = table(spark, [(1, 5), (2, 6)], "id bigint, extra int")
    got = upsert(target, source, ["id"])
    assert got.columns == ["id", "v", "t", "extra"]
    assert got.schema["id"].dataType.simpleString() == "int"
    assert rows(got) == Counter([(1, None, None, 5), (2, None, None, 6)])
    assert align_columns(target, source, on_new="ignore")[1].columns == ["id", "v", "t"]
    with pytest.raises(ValueError, match="new columns"):
        align_columns(target, source, on_new="fail")
    with pytest.raises(ValueError, match="lacks columns"):
        align_columns(target, source, on_missing="fail")


def test_append_adds_again(spark):
    target = table(spark, [("a", 1)], "name string, n int")
    more = table(spark, [("b",)], "name string")
    once = append(target, more)
    assert rows(once) == Counter([("a", 1), ("b", None)])
    assert rows(append(once, more))[("b", None)] == 2


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(100_000).selectExpr("id", "id v").write.parquet(f"{tmp_path}/t")
    spark.range(50).selectExpr("id", "-id v").write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    plan = text_plan(upsert(target, source, ["id"], check_source=False))
    # The one exchange is over the target's keys that the source has.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan


def test_large_source_splits_a_hot_target_key(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        target = spark.range(0, 300_000, 1, 8).select(key.alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        source = spark.range(0, 1000).select("id", F.lit("s").alias("v"))
        got = upsert(target, source, ["id"], check_source=False)
        assert "skew=true" in final_plan(got)
        # Of the 1000 source keys, those divisible by three have no row in the target.
        absent = len([i for i in range(0, 1000, 3)])
        assert got.count() == 300_000 + absent
        assert got.filter("id = 7 and v = 's'").count() == 100_001
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_upsert(spark, tmp_path):
    base = f"{tmp_path}/t"
    source = table(spark, [(1, "a", "x"), (2, "b", "x")])
    change.upsert_table(source, base, ["id"])
    change.upsert_table(table(spark, [(2, "c", "y"), (3, "d", "y")]), base, ["id"])
    assert rows(change.read_table(spark, base)) == Counter(
        [(1, "a", "x"), (2, "c", "y"), (3, "d", "y")]
    )


def test_odd_column_names(spark):
    names = ["id", "_source", "_row", "bucket", "a.b", "_key0_"]
    held = spark.createDataFrame([(1, "a", "b", "c", "d", "e"), (2, "x", "x", "x", "x", "x")], "id int, v1 string, v2 string, v3 string, v4 string, v5 string").toDF(*names)
    source = spark.createDataFrame([(1, "A", "B", "C", "D", "E"), (3, "n", "n", "n", "n", "n")], "id int, v1 string, v2 string, v3 string, v4 string, v5 string").toDF(*names)
    got = upsert(held, source, ["id"], newer_than="a.b")
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == [(1, "a", "b", "c", "d", "e"), (2, *"xxxxx"), (3, *"nnnnn")]
    by_dotted = upsert(held, source.filter("id = 1"), ["a.b"])
    assert by_dotted.count() == 3


def test_bucketed_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    stored = change.BucketedTable(f"{tmp_path}/b", ("id",), buckets=8)
    stored.create(spark.range(1000).selectExpr("id", "'old' v"))
    files = lambda: {
        p.parent.name: p.name for p in (tmp_path / "b").glob("bucket_of_8=*/*.parquet")
    }
    before = files()
    stored.upsert(spark.createDataFrame([(5, "new"), (2000, "add")], "id bigint, v string"))
    after = files()
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2
    got = stored.read(spark)
    assert got.count() == 1001
    assert got.filter("v = 'new'").head()["id"] == 5


def test_keys_find_their_bucket_in_any_type(spark, tmp_path):
    stored = change.BucketedTable(f"{tmp_path}/b", ("id",), buckets=8)
    stored.create(spark.range(20).selectExpr("id", "'old' v"))
    stored.upsert(spark.createDataFrame([(1.0, "new"), (7.0, "new")], "id double, v string"))
    assert stored.read(spark).count() == 20
    assert stored.read(spark).filter("v = 'new'").count() == 2


def test_columns_named_like_the_folders_stay(spark, tmp_path):
    stored = change.BucketedTable(f"{tmp_path}/b", ("id",), buckets=4)
    stored.create(spark.range(9).selectExpr("id", "'photos' bucket_of_4"))
    stored.upsert(spark.createDataFrame([(1, "videos")], "id bigint, bucket_of_4 string"))
    assert stored.read(spark).groupBy("bucket_of_4").count().filter("count = 8").head()[0] == "photos"
    plain = change.BucketedTable(f"{tmp_path}/p", ("id",), buckets=4)
    plain.create(spark.range(3).toDF("id"))
    with pytest.raises(ValueError, match="bucket_of_4"):
        plain.upsert(spark.createDataFrame([(1, "x")], "id bigint, bucket_of_4 string"))


def test_new_columns_reach_all_buckets(spark, tmp_path):
    stored = change.BucketedTable(f"{tmp_path}/b", ("id",), buckets=8)
    stored.create(spark.range(100).selectExpr("id", "'old' v"))
    stored.upsert(spark.createDataFrame([(5, "new", 1)], "id bigint, v string, w int"))
    got = stored.read(spark)
    assert got.columns == ["id", "v", "w"] and got.filter("w is null").count() == 99


def test_a_second_writer_is_refused(spark, tmp_path):
    stored = change.BucketedTable(f"{tmp_path}/b", ("id",), buckets=4)
    stored.create(spark.range(10).selectExpr("id", "'old' v"))
    (tmp_path / "b/_writing").write_text("someone")
    source = spark.range(5).selectExpr("id", "'new' v")
    with pytest.raises(versions.Conflict):
        stored.upsert(source)
    stored.upsert(source, owner="someone")  # the one who died comes back
    stored.upsert(source)
    assert stored.read(spark).filter("v = 'new'").count() == 5


def test_an_append_writes_the_new_rows_only(spark, tmp_path):
    base = f"{tmp_path}/a"
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    change.append_table(big, base, "2024-01-01")
    size = lambda: {p: p.stat().st_size for p in (tmp_path / "a").rglob("*.parquet")}
    before = size()
    for _ in range(2):
        change.append_table(big.limit(1), base, "2024-01-02")
    after = size()
    assert all(after[p] == n for p, n in before.items())
    assert sum(after.values()) - sum(before.values()) < 10_000
    assert change.read_table(spark, base).count() == 200_001
    change.drop_load(spark, base, "2024-01-01")
    assert change.read_table(spark, base).count() == 1


def test_of_two_refreshes_one_fails(spark, tmp_path):
    base = f"{tmp_path}/t"
    change.full_refresh(spark.range(3), base)
    read = versions.newest(spark, base)
    versions.publish(versions.current(spark, base).union(spark.range(1)), base, read_version=read)
    with pytest.raises(versions.Conflict):
        versions.publish(spark.range(9), base, read_version=read)
    assert versions.current(spark, base).count() == 4
    for n in range(5):
        change.full_refresh(spark.range(n), base)
    assert len(list((tmp_path / "t").glob("data-*"))) == versions.RETAINED


def test_full_refresh_replaces_columns_too(spark, tmp_path):
    base = f"{tmp_path}/t"
    change.full_refresh(spark.range(5), base)
    first = versions.current(spark, base)
    change.full_refresh(table(spark, [(1, "a", "x")]), base)
    assert versions.current(spark, base).columns == ["id", "v", "t"]
    # Whoever reads the old version still can.
    assert first.count() == 5
    # A refresh may read what it replaces.
    change.full_refresh(versions.current(spark, base).withColumn("w", F.lit(1)), base)
    assert versions.current(spark, base).columns == ["id", "v", "t", "w"]


def test_unpublished_versions_are_invisible(spark, tmp_path):
    base = f"{tmp_path}/t"
    versions.publish(spark.range(3), base)
    with pytest.raises(versions.CountMismatch):
        versions.publish(spark.range(4), base, expected=5)
    assert versions.current(spark, base).count() == 3


class Session:
    """As much of a session as the folder lookup asks for."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_scratch_folder_follows_the_session():
    named = Session(spark_checkpoint_dir="s3a://shared/checkpoints/", spark_master="yarn")
    assert scratch.shared_folder(named) == "s3a://shared/checkpoints"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session(spark_master="yarn"))
    local = scratch.shared_folder(Session(spark_master="local[8]"))
    assert local == scratch.shared_folder(Session(spark_master="local[8]"))


def test_instants_find_their_bucket_in_any_zone(spark, tmp_path):
    """A key's bucket does not depend on the zone of the session that writes it."""
    base = str(tmp_path / "t")
    keys = spark.range(50).select(F.timestamp_seconds(F.col("id") * 86_400 + 7).alias("at"), F.lit("old").alias("v"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    stored = change.BucketedTable(base, ("at",), 8)
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        stored.create(keys)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        stored.upsert(keys.withColumn("v", F.lit("new")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {(r["v"], r["n"]) for r in stored.read(spark).groupBy("v").agg(F.count("at").alias("n")).collect()} == {("new", 50)}


def test_loads_with_signs_that_paths_escape(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.range(4).withColumnRenamed("id", "x")
    for load in ("2024-01-31 10:00", "50%", "007", "7"):
        change.append_table(rows, base, load)
    for load, left in (("2024-01-31 10:00", 12), ("007", 8), ("50", 8), ("50%", 4)):
        change.drop_load(spark, base, load)
        assert change.read_table(spark, base).count() == left
