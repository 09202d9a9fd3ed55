"""Discovery, JSON, and the daily load from end to end."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests.plans import text_plan
from tidemill.operators.upsert import DuplicateKeys
from tidemill.plans import change, ingest
from tidemill.registry import loading
from tidemill.sources import catalog, discovery, documents, jdbc
from tidemill.streaming.ingest import stream_json, upsert_stream

DAY = "2024-01-31"


def put(base, path, content):
    file = base / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(content if isinstance(content, str) else json.dumps(content, indent=1))
    return str(file)


def listing(spark, *paths):
    return spark.createDataFrame([(p, 10) for p in paths], "path string, length bigint")


@pytest.mark.parametrize(
    "path, namespace, table, target",
    [
        ("a/b/app-1/user-log/2024-01-31/x.json", "app-1", "user-log", "stg_app_1.tbl_user_log"),
        ("a/app/TBL_x/2024-01-31/x.json", "app", "TBL_x", "stg_app.TBL_x"),
        ("a/app/tbl-x/2024-01-31/x.json", "app", "tbl-x", "stg_app.tbl_x"),
        ("app/t/2024-01-31/x.json", "app", "t", "stg_app.tbl_t"),
        ("a/app/t/2024-01-31/part/x.json", "app", "t", "stg_app.tbl_t"),
        ("a/app/t/2024-01-31T05/x.json", "app", "t", "stg_app.tbl_t"),
        # The last folder that starts with a date counts.
        ("2023-01-01/app/t/2024-01-31/x.json", "app", "t", "stg_app.tbl_t"),
        # A file named after a date is not a folder.
        ("a/app/t/2024-01-31/2024-02-01.json", "app", "t", "stg_app.tbl_t"),
    ],
)
def test_parse_path(spark, path, namespace, table, target):
    row = discovery.parse_path(listing(spark, path)).head()
    assert (row["namespace"], row["table"], row["target"]) == (namespace, table, target)
    assert row["folder"] == path.rsplit("/", 1)[0]


@pytest.mark.parametrize(
    "path", ["app/t/x.json", "t/2024-01-31/x.json", "2024-01-31/x.json", "x.json", "a/b/2024-01-31"]
)
def test_paths_without_the_layout_are_told_apart(spark, path):
    files = listing(spark, path)
    assert discovery.parse_path(files).count() == 0
    assert discovery.unparsed(files).count() == 1


def test_target_under_a_root(spark):
    row = discovery.parse_path(listing(spark, "a/t/2024-01-31/x.json"), root="lake.raw").head()
    assert row["target"] == "lake.raw.stg_a.tbl_t"


def test_filter_day(spark):
    files = listing(
        spark, f"a/t/{DAY}/x.json", f"a/t/{DAY}/x.csv", "a/t/2024-01-30/x.json", f"a/t/{DAY}x/y.json"
    )
    assert discovery.filter_day(files, DAY).count() == 1
    assert discovery.filter_day(files, DAY, full_scan=True).count() == 3


def test_discover_lists_without_reading(spark, tmp_path):
    for day in ("2024-01-30", DAY):
        put(tmp_path, f"in/app/t/{day}/a.json", {"id": 1})
    put(tmp_path, f"in/app/t/{DAY}/b.txt", "x")
    base = f"{tmp_path}/in"
    found = discovery.discover_files(spark, base)
    assert found.count() == 2
    assert "content" not in text_plan(found)
    only = discovery.discover_files(spark, base, day=DAY)
    assert [r["path"].endswith(f"{DAY}/a.json") for r in only.collect()] == [True]
    assert discovery.discover_files(spark, base, day="1999-01-01").count() == 0
    assert discovery.discover_files(spark, base, day=DAY, day_depth=1).count() == 0


def test_group_files(spark):
    files = listing(spark, f"a/t/{DAY}/x.json", f"a/t/{DAY}/y.json", "a/t/2024-01-30/x.json")
    parsed = discovery.parse_path(files)
    groups = {r["folder"]: (r["n_files"], r["bytes"]) for r in discovery.group_files(parsed).collect()}
    assert groups == {f"a/t/{DAY}": (2, 20), "a/t/2024-01-30": (1, 10)}
    row = discovery.table_counts(parsed).head()
    assert (row["n_folders"], row["n_files"], row["bytes"]) == (2, 3, 30)
    assert (row["first_date"], row["last_date"]) == ("2024-01-30", DAY)


def test_corrupt_documents(spark, tmp_path):
    good = put(tmp_path, "a.json", [{"id": 1, "v": "x"}, {"id": 2, "v": "y"}])
    bad = put(tmp_path, "b.json", '{"id": 3, "v":')
    df = documents.read_json(spark, [good, bad])
    assert documents.CORRUPT in df.columns
    kept = documents.drop_corrupt(df)
    assert documents.CORRUPT not in kept.columns and kept.count() == 3
    load, aside = documents.split_corrupt(df.cache(), ["id"])
    assert sorted(r["id"] for r in load.collect()) == [1, 2]
    assert '"id": 3' in aside.head()[documents.CORRUPT]


def test_documents_are_parsed_once(spark, tmp_path):
    """Columns as the reader infers them, from one pass over the files."""
    put(tmp_path, "a.json", [{"id": 1, "v": 1.5, "n": {"k": [1, 2]}}, {"id": 2, "v": 2, "OBJECT": None, "a b": "q", "w": True}])
    put(tmp_path, "b.json", {"id": 99999999999999999999, "w": "s", "v": 1e300, "n": {"VOID": 1}})
    put(tmp_path, "c.json", '{"id": ')
    put(tmp_path, "d.json", " \n\t")
    put(tmp_path, "e.json", "null")
    put(tmp_path, "f.json", "[]")
    put(tmp_path, "g.json", [7, {"id": 3}])
    parsed = documents.parse_documents(spark, [str(tmp_path)])
    assert text_plan(parsed).count("FileScan") == 1
    rows = documents.typed_documents(parsed)
    plain = documents.read_json(spark, [str(tmp_path)])
    assert dict(rows.dtypes) == dict(plain.dtypes)
    order = sorted(c for c in plain.columns if c != documents.CORRUPT)
    whole = lambda df: sorted(map(str, df.filter("id is not null").select(*order).collect()))
    assert set(whole(plain)) < set(whole(rows))
    assert whole(rows.filter("id <> 3")) == whole(plain)
    assert sorted(r[0] for r in rows.filter("_corrupt_record is not null").select("_corrupt_record").collect()) == ["7", "null", '{"id": ']


def test_no_documents_that_parse(spark, tmp_path):
    put(tmp_path, "c.json", "{")
    rows = documents.typed_documents(documents.parse_documents(spark, [str(tmp_path)]))
    assert rows.columns == [documents.CORRUPT] and rows.count() == 1


def test_documents_too_long_for_a_variant(spark, tmp_path, monkeypatch):
    """They are read with an inferred schema instead; here any broken one counts as too long."""
    put(tmp_path, "in/app/t/2024-01-31/a.json", [{"id": 1, "x": "a"}])
    put(tmp_path, "in/app/t/2024-01-31/b.json", "{")
    monkeypatch.setattr(documents, "VARIANT_BYTES", 0)
    with pytest.raises(documents.TooLong):
        documents.typed_documents(documents.parse_documents(spark, [str(tmp_path / "in/app/t/2024-01-31")]))
    ingest.ingest_to_folders(spark, str(tmp_path / "in"), DAY, str(tmp_path / "out"))
    assert [r["id"] for r in change.read_table(spark, str(tmp_path / "out/stg_app/tbl_t")).collect()] == [1]


def test_the_tasks_list_a_tree(spark, tmp_path):
    """The same rows as the driver's file index, from folders of any depth."""
    for path in ("a/t/2024-01-31/x.json", "a/t/2024-01-30/y é.json", "b/z.json", "top.json", "b/no.csv", "_tmp/h.json", "b/.h.json"):
        put(tmp_path, path, {"id": path})
    (tmp_path / "empty").mkdir()
    for base in (str(tmp_path), f"file:{tmp_path}/"):
        mine, index = (f(spark, base, suffix=".json") for f in (discovery.list_files, discovery.discover_files))
        assert mine.schema.names == index.schema.names
        seen = lambda df: sorted(map(tuple, df.select("path", "length", F.date_trunc("second", "modificationTime")).collect()))
        assert seen(mine) == seen(index) and len(seen(mine)) == 4
    assert discovery.list_files(spark, str(tmp_path / "absent")).count() == 0


def test_given_schema(spark, tmp_path):
    path = put(tmp_path, "a.json", {"id": 1, "other": 2})
    schema = spark.createDataFrame([], "id bigint, v string").schema
    assert documents.read_json(spark, [path], schema).columns == ["id", "v"]
    kept = documents.read_json(spark, [path], schema, keep_corrupt=True)
    assert kept.columns == ["id", "v", documents.CORRUPT]


def test_folder_names_are_not_patterns(spark, tmp_path):
    put(tmp_path, "a[1]/x.json", {"id": 1})
    put(tmp_path, "a1/x.json", {"id": 2})
    globs = documents.folder_globs([f"{tmp_path}/a[1]"])
    assert [r["id"] for r in documents.read_json(spark, globs).collect()] == [1]


def test_daily_load(spark, tmp_path):
    put(tmp_path, f"in/app-1/users/{DAY}/a.json", [
        {"id": 1, "updated_at": "2024-01-31T01", "v": "old", "nested": {"a": [1, 2]}},
        {"id": 1, "updated_at": "2024-01-31T02", "v": "new", "nested": {"a": []}},
        {"id": 2, "updated_at": None, "v": "only", "nested": None},
    ])
    put(tmp_path, f"in/app-1/users/{DAY}/b.json", '{"id": 9, "v":')
    put(tmp_path, f"in/app-1/TBL_notes/{DAY}/a.json", [{"text": "x"}, {"text": "x"}])
    put(tmp_path, f"in/app-1/any/{DAY}/a.json", [{"id": 1, "v": "b"}, {"id": 1, "v": "a"}])
    put(tmp_path, "in/app-1/users/2024-02-01/a.json", {"id": 3, "updated_at": "t", "v": "z", "more": 1})
    base, root = f"{tmp_path}/in", f"{tmp_path}/tables"

    done = ingest.ingest_to_folders(spark, base, DAY, root)
    assert {(r.target, r.mode, r.n_files) for r in done} == {
        ("stg_app_1.tbl_users", "upsert", 2),
        ("stg_app_1.TBL_notes", "append", 1),
        ("stg_app_1.tbl_any", "upsert", 1),
    }
    users = lambda: change.read_table(spark, f"{root}/stg_app_1/tbl_users")
    assert {r["id"]: r["v"] for r in users().collect()} == {1: "new", 2: "only"}
    assert change.read_table(spark, f"{root}/stg_app_1/tbl_any").head()["v"] == "a"
    # The broken document is kept, beside the table.
    aside = change.read_table(spark, f"{root}/_aside/stg_app_1/tbl_users")
    assert '\\"id\\": 9' in aside.head()["document"]

    # The same day again changes nothing, in tables with keys or without.
    for _ in range(2):
        ingest.ingest_to_folders(spark, base, DAY, root)
    assert users().count() == 2
    assert change.read_table(spark, f"{root}/stg_app_1/TBL_notes").count() == 2
    assert change.read_table(spark, f"{root}/_aside/stg_app_1/tbl_users").count() == 1

    # Another day brings a new field; the rows that lack it keep NULL.
    ingest.ingest_to_folders(spark, base, "2024-02-01", root)
    assert {r["id"]: r["more"] for r in users().collect()} == {1: None, 2: None, 3: 1}

    # All days at once.
    done = ingest.ingest_to_folders(spark, base, "", root, full_scan=True)
    assert sum(r.n_files for r in done) == 5
    assert users().count() == 3
    assert change.read_table(spark, f"{root}/stg_app_1/TBL_notes").count() == 2
    # Once the broken document is gone, so is what was set aside of its day.
    put(tmp_path, f"in/app-1/users/{DAY}/b.json", {"id": 9, "v": "mended"})
    ingest.ingest_to_folders(spark, base, DAY, root)
    assert users().count() == 4
    assert not list((tmp_path / "tables/_aside/stg_app_1/tbl_users").rglob("*.parquet"))


def test_fields_named_like_helpers(spark, tmp_path):
    odd = {"_row": "r", "_day": "d", "_source": {"x": 1}, "a.b": "p", "bucket_of_64": "q", "load": "l"}
    put(tmp_path, f"in/a/t/{DAY}/a.json", [{"id": 1, "updated_at": "1", **odd}])
    put(tmp_path, f"in/a/n/{DAY}/a.json", [odd])
    for _ in range(2):
        ingest.ingest_to_folders(spark, f"{tmp_path}/in", DAY, f"{tmp_path}/out")
    for name in ("t", "n"):
        rows = change.read_table(spark, f"{tmp_path}/out/stg_a/tbl_{name}").collect()
        assert len(rows) == 1
        got = rows[0].asDict(recursive=True)
        assert {k: got[k] for k in odd} == odd


def test_rows_without_key_can_be_loaded_as_they_are(spark, tmp_path):
    put(tmp_path, f"in/a/t/{DAY}/a.json", [{"id": 1, "v": "x"}, {"id": None, "v": "y"}])
    for _ in range(2):
        ingest.ingest_to_folders(spark, f"{tmp_path}/in", DAY, f"{tmp_path}/out", null_keys="load")
    rows = change.read_table(spark, f"{tmp_path}/out/stg_a/tbl_t")
    assert rows.filter("id is null").count() == 2
    assert rows.filter("id = 1").count() == 1


def test_only_broken_documents(spark, tmp_path):
    put(tmp_path, f"in/a/t/{DAY}/a.json", '{"id": 1,')
    put(tmp_path, f"in/a/notes/{DAY}/a.json", '{"text"')
    put(tmp_path, f"in/a/notes/{DAY}/b.json", {"text": "x"})
    done = ingest.ingest_to_folders(spark, f"{tmp_path}/in", DAY, f"{tmp_path}/out")
    assert {(r.target, r.mode) for r in done} == {
        ("stg_a.tbl_t", "nothing"),
        ("stg_a.tbl_notes", "append"),
    }
    assert change.read_table(spark, f"{tmp_path}/out/stg_a/tbl_notes").count() == 1
    for name in ("tbl_t", "tbl_notes"):
        assert change.read_table(spark, f"{tmp_path}/out/_aside/stg_a/{name}").count() == 1


def test_known_schema_and_depth(spark, tmp_path):
    put(tmp_path, f"in/a/t/{DAY}/a.json", [{"id": 1, "v": 5, "other": "x"}])
    put(tmp_path, f"in/a/t/{DAY}/b.json", '{"id": 2, "v"')
    put(tmp_path, f"in/deep/a/t/{DAY}/a.json", [{"id": 2, "v": 5}])
    schema = spark.createDataFrame([], "id bigint, v string").schema
    root = f"{tmp_path}/out"
    ingest.ingest_to_folders(
        spark, f"{tmp_path}/in", DAY, root, day_depth=2, schemas={"stg_a.tbl_t": schema}
    )
    table = change.read_table(spark, f"{root}/stg_a/tbl_t")
    assert table.schema == schema and [tuple(r) for r in table.collect()] == [(1, "5")]
    assert change.read_table(spark, f"{root}/_aside/stg_a/tbl_t").count() == 1
    assert ingest.ingest_to_folders(spark, f"{tmp_path}/in", "1999-01-01", root, day_depth=2) == []
    ingest.ingest_to_folders(spark, f"{tmp_path}/in", DAY, root, day_depth=None)
    assert change.read_table(spark, f"{root}/stg_a/tbl_t").count() == 2


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    put(tmp_path, f"in/a/bad/{DAY}/a.json", {"id": 1})
    put(tmp_path, f"in/a/good/{DAY}/a.json", {"id": 1})
    loaded = []

    def load(rows, target):
        if target.endswith("bad"):
            raise ValueError("no such place")
        loaded.append(target)
        return "upsert"

    with pytest.raises(ingest.IngestFailed, match="tbl_bad: no such place"):
        ingest.ingest_day(spark, f"{tmp_path}/in", DAY, load)
    assert loaded == ["stg_a.tbl_good"]


def test_times_compare_as_text_unless_parsed(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02 00:00:00", "early"), (1, "2024-01-02T05:00:00+09:00", "earlier")],
        "id int, updated_at string, v string",
    )
    assert ingest.newest_rows(df).head()["v"] == "earlier"
    assert ingest.newest_rows(df, parse_time=True).head()["v"] == "early"


def test_stream_takes_up_new_files_only(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, updated_at string, v string").schema
    base, progress = f"{tmp_path}/table", f"{tmp_path}/progress"

    def run():
        rows = stream_json(spark, f"{tmp_path}/in", schema)
        upsert_stream(rows, base, ["id"], "updated_at", progress)
        return {r["id"]: r["v"] for r in change.read_table(spark, base).collect()}

    put(tmp_path, f"in/a/t/{DAY}/a.json", [
        {"id": 1, "updated_at": "2024-01-31", "v": "a"},
        {"id": 1, "updated_at": "2024-01-30", "v": "b"},
    ])
    assert run() == {1: "a"}
    put(tmp_path, "in/a/t/2024-01-29/b.json", [
        {"id": 1, "updated_at": "2024-01-29", "v": "late"},
        {"id": 2, "updated_at": "2024-01-29", "v": "c"},
        {"updated_at": "2024-01-29", "v": "no key"},
    ])
    assert run() == {1: "a", 2: "c"}
    assert [r["v"] for r in spark.read.parquet(f"{base}/_aside").collect()] == ["no key"]
    assert run() == {1: "a", 2: "c"}
    # Another checkpoint numbers its batches anew and takes up everything again.
    put(tmp_path, "in/a/t/2024-01-29/b.json", [{"updated_at": "2024-01-29", "v": "other"}])
    upsert_stream(stream_json(spark, f"{tmp_path}/in", schema), base, ["id"], "updated_at", f"{progress}2")
    assert {r["v"] for r in spark.read.parquet(f"{base}/_aside").collect()} == {"no key", "other"}


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x://host/db", "public.chat", user="u", password="p", driver="d")
    assert plain == {
        "url": "jdbc:x://host/db",
        "dbtable": "public.chat",
        "user": "u",
        "password": "p",
        "driver": "d",
        "fetchsize": "10000",
    }
    split = jdbc.jdbc_options("u", "t", partition_column="id", bounds=(0, 100), partitions=4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError, match="together"):
        jdbc.jdbc_options("u", "t", partition_column="id")


def test_upkeep_after_a_load_only_warns(spark, monkeypatch, caplog):
    stored = []
    monkeypatch.setattr(ingest.catalog, "replace_table", lambda df, name: stored.append(name))
    ingest.refresh_catalog_table(spark.range(1), "spark_catalog.ns.t")
    assert stored == ["spark_catalog.ns.t"]
    # This catalog has neither procedure.
    assert caplog.text.count("upkeep failed") == 2


def test_duplicate_keys_are_named(spark, tmp_path):
    from tidemill.plans.change import upsert_table

    with pytest.raises(DuplicateKeys):
        upsert_table(spark.createDataFrame([(1,), (1,)], "id int"), f"{tmp_path}/t", ["id"])


def test_columns_are_fitted_before_a_merge(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS tidemill_fit LOCATION '{tmp_path}/wh'")
    name = "spark_catalog.tidemill_fit.t"
    merged = []
    monkeypatch.setattr(ingest.catalog, "merge_into", lambda df, table, keys: merged.append(df))
    try:
        first = spark.createDataFrame([(1, ("x",))], "id bigint, nested struct<`user-id`:string>")
        catalog.create_like(first, name, "parquet", {})
        assert spark.table(name).schema == first.schema
        other = spark.createDataFrame([("2", 5)], "id string, `new-field` int")
        ingest.load_catalog_table(other, name)
        assert spark.table(name).columns == ["id", "nested", "new-field"]
        assert merged[0].schema.names == ["id", "nested", "new-field"]
        assert tuple(merged[0].head()) == (2, None, 5)
    finally:
        spark.sql("DROP NAMESPACE tidemill_fit CASCADE")


def test_files_that_were_taken_up_are_moved(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, at string").schema
    for lot in range(3):
        put(tmp_path, f"in/d/{lot}.json", [{"id": 1, "at": f"{lot}"}, {"id": lot + 10, "at": "0"}])
        rows = stream_json(spark, str(tmp_path / "in"), schema, archive=str(tmp_path / "taken"))
        upsert_stream(rows, str(tmp_path / "t"), ["id"], "at", str(tmp_path / "progress"))
    got = sorted(map(tuple, change.read_table(spark, str(tmp_path / "t")).select("id", "at").collect()))
    assert got == [(1, "2"), (10, "0"), (11, "0"), (12, "0")]
    assert len(list((tmp_path / "taken").rglob("*.json"))) >= 1
    assert (tmp_path / "in/d/2.json").exists()


def test_listed_files_of_one_folder_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Every file but a folder's last is full, whichever task writes it."""
    rows = spark.range(20_030).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 20_020, "cold").alias("event_type"),
        F.lit("x").alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(loading.scratch, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    got = {r["folder"]: (r["n_files"], r["bytes"]) for r in loading.path_listing(spark, f"{tmp_path}/sf").collect()}
    day = "day=2024-01-01"
    assert got == {f"event_type=hot/{day}": (400, 40_000), f"event_type=cold/{day}": (1, 40), f"event_type=__HIVE_DEFAULT_PARTITION__/{day}": (1, 20)}
    files = [f.name for f in tmp_path.glob(f"listed-*/event_type=hot/{day}/*.txt")]
    assert len(files) == 400 and len({name.split("-")[1] for name in files}) > 1
