"""Ingest queries: discovery, newest rows, upsert, append, full refresh."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.latest import dedup_any, dedup_latest
from tidemill.operators.upsert import append, upsert
from tidemill.plans import change, ingest
from tidemill.registry import Entry, table
from tidemill.sources import discovery, scratch
from tidemill.streaming.ingest import stream_json, upsert_stream


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _newest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        "o_orderdate",
        [F.col("o_orderkey").desc()],
    )


def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = dedup_latest(
        table(spark, sf_dir, "events"), ["user_id"], "ts", [F.col("event_id").desc()]
    )
    return newest.withColumn("ts", _text(F.col("ts")))


def dedup_any_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dedup_any(table(spark, sf_dir, "events"), ["user_id", "event_type"])
    return events.withColumn("ts", _text(F.col("ts")))


def changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose newest order is finished, with NULLs, and suppliers as new ones."""
    finished = _newest_orders(spark, sf_dir).filter("o_orderstatus = 'F'")
    changed = finished.select(
        F.col("o_custkey").alias("c_custkey"),
        F.lit(None).cast("string").alias("c_name"),
        F.lit(None).cast("int").alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
    )
    new = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"),
    )
    return changed.unionByName(new)


_NEWEST_SQL = (
    "WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders), "
    "changes AS (SELECT o_custkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, "
    "CAST(NULL AS INTEGER) AS c_nationkey, o_totalprice AS c_acctbal, "
    "o_orderpriority AS c_mktsegment FROM ranked WHERE rn = 1 AND o_orderstatus = 'F' "
    "UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'NEW' FROM supplier) "
)
_UPSERT_SQL = (
    _NEWEST_SQL + "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer "
    "WHERE c_custkey NOT IN (SELECT c_custkey FROM changes) UNION ALL SELECT * FROM changes"
)
_LATEST_EVENT_SQL = (
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, "
    "props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, "
    "event_id DESC) AS rn FROM events) WHERE rn = 1"
)


# Columns as JSON exports name them; no helper column may get in their way.
_ODD = {"c_name": "_source", "c_nationkey": "bucket", "c_acctbal": "a.b", "c_mktsegment": "_row"}


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnsRenamed(_ODD)
    # Stored first: the upsert reads its source more than once.
    changes, _ = scratch.stage(changed_customers(spark, sf_dir).withColumnsRenamed(_ODD), "changes")
    merged = upsert(customer, changes, ["c_custkey"])
    return merged.toDF(*["c_custkey", *_ODD])


def upsert_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert as a replacement of the whole stored table, run twice."""
    base = scratch.scratch_path(spark, "customer")
    change.full_refresh(table(spark, sf_dir, "customer"), base)
    changes, _ = scratch.stage(changed_customers(spark, sf_dir), "changes")
    for _ in range(2):
        change.full_refresh(upsert(change.read_table(spark, base), changes, ["c_custkey"]), base)
    return change.read_table(spark, base)


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert into a table stored in key buckets, the keys spelled as decimals."""
    stored = change.BucketedTable(scratch.scratch_path(spark, "customer"), ("c_custkey",), 16)
    stored.create(table(spark, sf_dir, "customer"))
    changes = changed_customers(spark, sf_dir)
    stored.upsert(changes.withColumn("c_custkey", F.col("c_custkey").cast("decimal(20,2)")))
    return stored.read(spark)


def append_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers added to stored customers by name only: no key, one column missing. The
    load of suppliers is repeated, which changes nothing."""
    base = scratch.scratch_path(spark, "names")
    change.append_table(table(spark, sf_dir, "customer").drop("c_custkey"), base, "2024-01-30")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("c_acctbal"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
    )
    for _ in range(2):
        change.append_table(suppliers, base, "2024-01-31")
    return change.read_table(spark, base)


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers under customers without storing either."""
    customers = table(spark, sf_dir, "customer").select("c_name", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier")
    return append(customers, suppliers.select(F.col("s_name").alias("c_name")))


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of labels replaced whole by conversations, columns included."""
    base = scratch.scratch_path(spark, "conversations")
    change.full_refresh(table(spark, sf_dir, "labels"), base)
    change.full_refresh(table(spark, sf_dir, "conversations"), base)
    return change.read_table(spark, base)


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with one file per event; errors lie outside any day's folder."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    day = F.when(F.col("event_type") == "error", "late").otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    kind = F.when(F.col("value") > 20, "TBL_high").otherwise("low-value")
    suffix = F.when(F.col("value") > 5, ".json").otherwise(".csv")
    return e.select(
        F.concat(
            F.lit("s3a://lake/in/svc-"),
            F.col("event_type"),
            F.lit("/"),
            kind,
            F.lit("/"),
            day,
            F.lit("/part-"),
            F.col("event_id").cast("string"),
            suffix,
        ).alias("path"),
        F.floor(F.col("value") * 100).cast("bigint").alias("length"),
    )


_PATHS_SQL = (
    "WITH listing AS (SELECT 's3a://lake/in/svc-' || event_type || '/' || "
    "CASE WHEN value > 20 THEN 'TBL_high' ELSE 'low-value' END || '/' || "
    "CASE WHEN event_type = 'error' THEN 'late' ELSE strftime(ts, '%Y-%m-%d') END || "
    "'/part-' || event_id || CASE WHEN value > 5 THEN '.json' ELSE '.csv' END AS path, "
    "CAST(floor(value * 100) AS BIGINT) AS length FROM events)"
)
_PARSED_SQL = (
    _PATHS_SQL + ", parsed AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, "
    r"regexp_extract(path, '/(\d{4}-\d{2}-\d{2}[^/]*)/[^/]*$', 1) AS day, "
    r"replace(regexp_extract(path, '([^/]+)/[^/]+/\d{4}-\d{2}-\d{2}[^/]*/[^/]*$', 1), '-', '_') "
    r"AS ns, replace(regexp_extract(path, '([^/]+)/\d{4}-\d{2}-\d{2}[^/]*/[^/]*$', 1), '-', '_') "
    "AS tb FROM listing WHERE path LIKE '%.json'), named AS (SELECT *, 'lake.stg_' || ns || '.' "
    "|| CASE WHEN lower(tb) LIKE 'tbl!_%' ESCAPE '!' THEN tb ELSE 'tbl_' || tb END AS target "
    "FROM parsed WHERE day <> '')"
)


def path_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = discovery.filter_day(_paths(spark, sf_dir), "", full_scan=True)
    return discovery.table_counts(discovery.parse_path(files, root="lake"))


def path_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = discovery.filter_day(_paths(spark, sf_dir), "", full_scan=True)
    return discovery.group_files(discovery.parse_path(files, root="lake"))


def incremental_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.filter_day(_paths(spark, sf_dir), "2024-01-15")


_PER_FILE = 5000


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Two days of JSON files of two tables, loaded, the second day twice; the folder.

    Users are keyed by id; one row in 101 has none, one document a day is broken.
    Notes have no id at all. An event's day is its number's parity.
    """
    base = scratch.scratch_path(spark, "documents")
    events = table(spark, sf_dir, "events").withColumn(
        "day", F.when(F.col("event_id") % 2 == 0, "2024-01-30").otherwise("2024-01-31")
    )
    user = F.struct(
        F.when(F.col("event_id") % 101 != 0, F.col("user_id")).alias("id"),
        _text(F.col("ts")).alias("updated_at"),
        "event_id",
        "event_type",
        "value",
        "props",
    )
    note = F.struct(F.col("event_type").alias("kind"), "value")

    def put(row: Column, name: str) -> None:
        # One array per file, of at most _PER_FILE rows: event ids are unique.
        arrays = events.groupBy("day", F.floor(F.col("event_id") / (2 * _PER_FILE)))
        arrays = arrays.agg(F.to_json(F.collect_list(row), {"ignoreNullFields": "false"}).alias("value"))
        for day in ("2024-01-30", "2024-01-31"):
            own = arrays.filter(F.col("day") == day).select("value")
            own.write.option("maxRecordsPerFile", 1).text(f"{base}/in/app-log/{name}/{day}")

    put(user, "events")
    put(note, "notes")
    for day in ("2024-01-30", "2024-01-31"):
        broken = events.filter(F.col("day") == day).agg(F.max("event_id").cast("string").alias("id"))
        broken = broken.select(F.concat(F.lit('{"id": '), "id", F.lit(", ")).alias("value"))
        broken.write.mode("append").text(f"{base}/in/app-log/events/{day}")
    for day in ("2024-01-30", "2024-01-31", "2024-01-31"):
        ingest.ingest_to_folders(spark, f"{base}/in", day, f"{base}/tables", suffix=".txt", parallel=4)
    return f"{base}/tables"


def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users: of each day the newest row per key, the second day over the first."""
    return change.read_table(spark, f"{_ingested(spark, sf_dir)}/stg_app_log/tbl_events")


def json_ingest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes, which have no key: every day once, however often it is loaded."""
    return change.read_table(spark, f"{_ingested(spark, sf_dir)}/stg_app_log/tbl_notes")


def json_ingest_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was set aside: rows without a key and broken documents."""
    aside = change.read_table(spark, f"{_ingested(spark, sf_dir)}/_aside/stg_app_log/tbl_events")
    event = F.get_json_object("document", "$.event_id").cast("bigint")
    return aside.select(event.alias("event_id"), event.isNull().alias("broken"))


_DAILY_SQL = (
    "WITH daily AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 2 "
    "ORDER BY ts DESC, event_id) AS rn, event_id % 2 AS day FROM events WHERE event_id % 101 <> 0) "
)
_JSON_SQL = (
    _DAILY_SQL + "SELECT user_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at, event_id, "
    "event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY day DESC) AS last FROM daily WHERE rn = 1) WHERE last = 1"
)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken up as a stream into a table of the newest event per user."""
    base = scratch.scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    # A pattern, so that a file and a folder of part files are read alike.
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    upsert_stream(
        rows, f"{base}/table", ["user_id"], "ts", f"{base}/progress", [F.col("event_id").desc()]
    )
    newest = change.read_table(spark, f"{base}/table")
    return newest.withColumn("ts", _text(F.col("ts")))


def _event_arrays(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Arrays of the events of odd or even numbers, as JSON texts of bounded length."""
    events = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == day).withColumn("ts", _text(F.col("ts")))
    arrays = events.groupBy(F.floor(F.col("event_id") / (2 * _PER_FILE)))
    row = F.struct("event_id", "ts", "user_id", "event_type", "value", "props")
    return arrays.agg(F.to_json(F.collect_list(row)).alias("value")).select("value")


def stream_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files that arrive in two lots, each taken up by a run of its own from the same
    checkpoint; what has been taken up is moved away."""
    base = scratch.scratch_path(spark, "json-stream")
    schema = table(spark, sf_dir, "events").withColumn("ts", F.lit("")).schema
    for day in (0, 1):
        lot = _event_arrays(spark, sf_dir, day)
        lot.write.option("maxRecordsPerFile", 1).mode("append").text(f"{base}/in/events")
        rows = stream_json(spark, f"{base}/in", schema, suffix=".txt", archive=f"{base}/taken")
        tie = [F.col("event_id").desc()]
        upsert_stream(rows, f"{base}/table", ["user_id"], "ts", f"{base}/progress", tie)
    return change.read_table(spark, f"{base}/table")


_LINES = 50
# Files of one task, and parts of a folder that are counted side by side.
_FILES_PER_TASK, _PARTS = 200, 16


def _whole_files(rows: DataFrame, key: str, folder: list[str]) -> DataFrame:
    """`rows` dealt to tasks that hold all _LINES rows of each of their files.

    A row's place in its folder says its file, and files are numbered over all folders;
    so a folder of any size is written by many tasks, and only its last file is short.
    """
    part = F.pmod(F.xxhash64(key), F.lit(_PARTS)).cast("int")
    placed = rows.withColumn("part", part)
    before = (Window.unboundedPreceding, -1)
    counts = placed.groupBy(*folder, "part").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*folder).orderBy("part").rowsBetween(*before)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    sizes = counts.groupBy(*folder).agg(F.ceil(F.sum("n") / _LINES).alias("files"))
    # A row per folder.
    first = F.coalesce(F.sum("files").over(Window.orderBy(*folder).rowsBetween(*before)), F.lit(0))
    sizes = sizes.withColumn("first", first).withColumnsRenamed({c: f"s_{c}" for c in folder})
    same = lambda of, names: reduce(and_, [F.col(c).eqNullSafe(F.col(f"{of}_{c}")) for c in names])
    found = counts.join(F.broadcast(sizes), same("s", folder)).select(*folder, "part", "base", "first", "files")
    places, _ = scratch.stage(found.withColumnsRenamed({c: f"p_{c}" for c in (*folder, "part")}), "places")
    total = places.agg(F.max(F.col("first") + F.col("files"))).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy(*folder, "part").orderBy(key)) - 1
    file = F.col("first") + F.floor((F.col("base") + F.col("nth")) / _LINES)
    dealt = placed.withColumn("nth", nth).join(F.broadcast(places), same("p", [*folder, "part"]))
    task = F.floor(file / _FILES_PER_TASK).cast("int")
    return dealt.repartitionById(max(1, -(-total // _FILES_PER_TASK)), task).select(*rows.columns)


def path_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files, a folder per kind and day of events, listed by the tasks."""
    base = scratch.scratch_path(spark, "listed")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("props").alias("value")
    )
    whole = _whole_files(events, "event_id", ["event_type", "day"]).drop("event_id")
    # Files are put in place by their tasks, not one by one by the driver.
    write = whole.write.option("maxRecordsPerFile", _LINES).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    write.partitionBy("event_type", "day").text(base)
    found = discovery.list_files(spark, base, ".txt")
    below = F.regexp_extract("path", "(event_type=[^/]*/day=[^/]*)/[^/]*$", 1)
    return discovery.group_files(found.select(F.lit("events").alias("target"), below.alias("folder"), "length"))


ENTRIES = {
    "dedup_latest": Entry(dedup_latest_events, _LATEST_EVENT_SQL),
    "dedup_any": Entry(
        dedup_any_events,
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, "
        "props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
        "ORDER BY event_id) AS rn FROM events) WHERE rn = 1",
    ),
    "upsert_merge": Entry(upsert_merge, _UPSERT_SQL),
    "upsert_versioned": Entry(upsert_versioned, _UPSERT_SQL),
    "upsert_buckets": Entry(upsert_buckets, _UPSERT_SQL),
    "append_fallback": Entry(
        append_fallback,
        "SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL "
        "SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier",
    ),
    "append_rows": Entry(
        append_rows,
        "SELECT c_name, c_nationkey FROM customer UNION ALL SELECT s_name, NULL FROM supplier",
    ),
    "full_refresh": Entry(full_refresh, "SELECT * FROM conversations"),
    "path_discovery": Entry(
        path_discovery,
        _PARSED_SQL + " SELECT target, count(DISTINCT folder) AS n_folders, count(*) AS n_files, "
        "CAST(sum(length) AS BIGINT) AS bytes, min(day) AS first_date, max(day) AS last_date "
        "FROM named GROUP BY target",
    ),
    "path_groups": Entry(
        path_groups,
        _PARSED_SQL + " SELECT target, folder, count(*) AS n_files, "
        "CAST(sum(length) AS BIGINT) AS bytes FROM named GROUP BY target, folder",
    ),
    "incremental_day_filter": Entry(
        incremental_day_filter,
        _PATHS_SQL + " SELECT path, length FROM listing WHERE path LIKE '%.json' "
        "AND path LIKE '%/2024-01-15/%'",
    ),
    "json_ingest": Entry(json_ingest, _JSON_SQL),
    "json_ingest_append": Entry(
        json_ingest_append, "SELECT event_type AS kind, value FROM events"
    ),
    "json_ingest_aside": Entry(
        json_ingest_aside,
        "SELECT event_id, false AS broken FROM events WHERE event_id % 101 = 0 UNION ALL "
        "SELECT NULL, true FROM range(2)",
    ),
    "stream_upsert": Entry(stream_upsert, _LATEST_EVENT_SQL),
    "stream_json": Entry(stream_json_files, _LATEST_EVENT_SQL),
    "path_listing": Entry(
        path_listing,
        f"SELECT 'events' AS target, folder, CAST(sum(ceil(n / {_LINES}.0)) AS BIGINT) AS n_files, CAST(sum(b) AS BIGINT) AS bytes FROM "
        "(SELECT 'event_type=' || event_type || '/day=' || strftime(ts, '%Y-%m-%d') AS folder, count(*) AS n, "
        "sum(strlen(props) + 1) AS b FROM events GROUP BY 1) GROUP BY 2",
    ),
}
