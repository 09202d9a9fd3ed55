"""Maintenance queries over listings derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import compaction, packing_by_size, retention, upkeep
from tidemill.plans import runbook
from tidemill.registry import Entry, table
from tidemill.sources import scratch

_TARGET = 20_000


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a data file of its language's table, by source."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("table"),
        F.col("source").alias("partition"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"),
        F.col("n_chars").alias("length"),
    )


def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.compaction_plan(
        document_files(spark, sf_dir), _TARGET, min_input_files=2
    )


def compaction_rewrite_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.compaction_plan(
        document_files(spark, sf_dir), _TARGET, rewrite_all=True
    )


def compaction_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.compaction_plan(
        document_files(spark, sf_dir), _TARGET, min_input_files=2, grouping=packing_by_size.pack_groups
    )


def compaction_by_size_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.compaction_plan(
        document_files(spark, sf_dir), _TARGET, rewrite_all=True, grouping=packing_by_size.pack_groups
    )


def _groups_sql(listing: str, candidates: str, keep: str) -> str:
    return (
        f"WITH listing AS ({listing}), wanted AS (SELECT * FROM listing WHERE {candidates}), "
        "placed AS (SELECT *, CAST(sum(length) OVER (PARTITION BY \"table\", \"partition\" "
        "ORDER BY md5(path), path) AS BIGINT) - length AS start FROM wanted), "
        f"numbered AS (SELECT *, start // {_TARGET * compaction.TARGETS_PER_GROUP} AS group_no FROM placed), "
        "plan AS (SELECT \"table\", \"partition\", group_no, count(*) AS files_in, "
        "CAST(sum(length) AS BIGINT) AS bytes FROM numbered GROUP BY ALL), "
        f"chosen AS (SELECT *, greatest(1, (2 * bytes + {_TARGET}) // {2 * _TARGET}) AS files_out "
        f"FROM plan WHERE {keep})"
    )


def _by_size_sql(listing: str, candidates: str, keep: str) -> str:
    """First-fit decreasing, a size class a step: `open` holds groups filled alike."""
    room = _TARGET * compaction.TARGETS_PER_GROUP
    each = "list_transform(range(1, len(open) + 1), lambda i: {})".format
    return (
        f"WITH RECURSIVE listing AS ({listing}), "
        "sized AS (SELECT *, greatest(coalesce(length, 0), 1) AS bytes, "
        f"CAST(1 AS BIGINT) << greatest(length(bin(greatest(coalesce(length, 0), 1))) - {packing_by_size.DIGITS}, 0) "
        f"AS unit FROM listing WHERE {candidates}), "
        "classed AS (SELECT \"table\", \"partition\", path, length, (bytes + unit - 1) // unit * unit AS size FROM sized), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY \"table\", \"partition\", size "
        "ORDER BY md5(path), path) - 1 AS nth FROM classed), "
        "classes AS (SELECT *, row_number() OVER (PARTITION BY \"table\", \"partition\" ORDER BY size DESC) AS step "
        "FROM (SELECT \"table\", \"partition\", size, count(*) AS n FROM classed GROUP BY ALL)), "
        "fill AS ("
        "SELECT DISTINCT \"table\", \"partition\", CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS size, "
        "CAST([] AS STRUCT(room BIGINT, groups BIGINT, first BIGINT)[]) AS open, CAST(0 AS BIGINT) AS opened, "
        "CAST([] AS STRUCT(start BIGINT, fits BIGINT, first BIGINT)[]) AS runs FROM classes "
        "UNION ALL "
        "SELECT \"table\", \"partition\", step, size, "
        # What every row of groups becomes, and the new groups for what is left.
        "list_filter(flatten(" + each(
            "[{'room': open[i].room - fits[i] * size, 'groups': taken[i] // greatest(fits[i], 1), 'first': open[i].first}, "
            "{'room': open[i].room - (taken[i] % greatest(fits[i], 1)) * size, "
            "'groups': CAST(taken[i] % greatest(fits[i], 1) > 0 AS BIGINT), "
            "'first': open[i].first + taken[i] // greatest(fits[i], 1)}, "
            "{'room': open[i].room, 'groups': open[i].groups - (taken[i] + greatest(fits[i], 1) - 1) // greatest(fits[i], 1), "
            "'first': open[i].first + (taken[i] + greatest(fits[i], 1) - 1) // greatest(fits[i], 1)}]"
        ) + ") || [{'room': " + f"{room} - fit * size, 'groups': remaining // fit, 'first': opened" + "}, "
        "{'room': " + f"{room} - (remaining % fit) * size, 'groups': CAST(remaining % fit > 0 AS BIGINT), "
        "'first': opened + remaining // fit" + "}], lambda g: g.groups > 0), "
        "CAST(opened + (remaining + fit - 1) // fit AS BIGINT), "
        "list_filter(" + each("{'start': start[i], 'fits': CASE WHEN taken[i] > 0 THEN fits[i] ELSE 0 END, 'first': open[i].first}")
        + " || [{'start': n - remaining, 'fits': CASE WHEN remaining > 0 THEN fit ELSE 0 END, 'first': opened}], "
        "lambda r: r.fits > 0) "
        "FROM (SELECT *, CAST(n - coalesce(list_sum(taken), 0) AS BIGINT) AS remaining FROM ("
        "SELECT *, " + each("greatest(0, least(fits[i] * open[i].groups, n - start[i]))") + " AS taken FROM ("
        "SELECT *, " + each("CAST(coalesce(list_sum(list_transform(range(1, i), lambda j: fits[j] * open[j].groups)), 0) AS BIGINT)")
        + " AS start FROM ("
        "SELECT f.\"table\", f.\"partition\", c.step, c.size, c.n, f.open, f.opened, "
        f"greatest(1, {room} // c.size) AS fit, list_transform(f.open, lambda g: g.room // c.size) AS fits "
        "FROM fill f JOIN classes c ON f.\"table\" IS NOT DISTINCT FROM c.\"table\" "
        "AND f.\"partition\" IS NOT DISTINCT FROM c.\"partition\" AND c.step = f.step + 1))))), "
        "runs AS (SELECT \"table\", \"partition\", size, unnest(runs) AS run FROM fill), "
        "numbered AS (SELECT r.*, run.\"first\" + (nth - run.\"start\") // run.fits AS group_no FROM ranked r "
        "ASOF JOIN (SELECT *, run.\"start\" AS since, coalesce(\"table\", chr(1)) AS t, coalesce(\"partition\", chr(1)) AS p "
        "FROM runs) u ON coalesce(r.\"table\", chr(1)) = u.t AND coalesce(r.\"partition\", chr(1)) = u.p "
        "AND r.size = u.size AND r.nth >= u.since), "
        "plan AS (SELECT \"table\", \"partition\", group_no, count(*) AS files_in, "
        "CAST(sum(length) AS BIGINT) AS bytes FROM numbered GROUP BY ALL), "
        f"chosen AS (SELECT *, greatest(1, (2 * bytes + {_TARGET}) // {2 * _TARGET}) AS files_out "
        f"FROM plan WHERE {keep})"
    )


_DOCUMENTS_SQL = (
    "SELECT lang AS \"table\", source AS \"partition\", 'doc-' || doc_id AS path, "
    "n_chars AS length FROM documents"
)
_SMALL_OR_LARGE = f"length < {_TARGET} * 0.75 OR length > {_TARGET} * 1.8"
_WORTH_IT = (
    f"(files_in > 1 AND (files_in >= 2 OR bytes > {_TARGET})) OR bytes > {_TARGET} * 1.8"
)


def expire_snapshots_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("table"),
        F.col("event_id").alias("snapshot_id"),
        F.col("ts").alias("committed_at"),
    )
    plan = retention.expire_plan(snaps, 2, _instant("2024-01-25 00:00:00"))
    return plan.select("table", "snapshot_id")


def expire_keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one snapshot kept, as the daily upkeep does."""
    snaps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("table"),
        F.col("event_id").alias("snapshot_id"),
        F.col("ts").alias("committed_at"),
    )
    return retention.expire_plan(snaps, 1, _instant("2024-01-25 00:00:00")).select("table", "snapshot_id")


def orphan_files_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files, one minute apart; those under https are live, and are named with
    another spelling of the same store."""
    pages = table(spark, sf_dir, "pages")
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    listing = pages.select(
        F.concat(F.lit("s3a://lake/"), name).alias("path"),
        F.length("html").cast("bigint").alias("length"),
        F.timestamp_add("MINUTE", F.col("page_id").cast("int"), _instant("2024-01-01 00:00:00")).alias(
            "modificationTime"
        ),
    )
    live = pages.filter(F.col("url").startswith("https:")).select(
        F.concat(F.lit("s3://lake//"), name).alias("path")
    )
    plan = retention.orphan_plan(listing, live, _instant("2024-01-01 03:00:00"))
    return plan.select("path", "length")


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table"),
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("path"),
        F.floor(F.col("value") * 100).cast("bigint").alias("length"),
        F.col("ts").alias("modificationTime"),
        F.col("event_id").alias("snapshot_id"),
        F.col("ts").alias("committed_at"),
        "value",
    )


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = event_files(spark, sf_dir)
    before = _instant("2024-01-25 00:00:00")
    return upkeep.maintenance_summary(
        compaction.compaction_plan(
            files, _TARGET, min_input_files=2
        ),
        retention.expire_plan(files.select("table", "snapshot_id", "committed_at"), 2, before),
        retention.orphan_plan(files, files.filter("value > 10").select("path"), before),
    )


def maintenance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans(spark, sf_dir)


def maintenance_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upkeep.maintenance_totals(_plans(spark, sf_dir))


_EVENTS_SQL = (
    "SELECT event_type AS \"table\", '' AS \"partition\", 'event-' || event_id AS path, "
    "CAST(floor(value * 100) AS BIGINT) AS length FROM events"
)
_SUMMARY_SQL = (
    _groups_sql(_EVENTS_SQL, _SMALL_OR_LARGE, _WORTH_IT)
    + ", c AS (SELECT \"table\", count(*) AS groups, sum(files_in) AS files_in, "
    "sum(files_out) AS files_out, sum(bytes) AS bytes_in FROM chosen GROUP BY 1), "
    "e AS (SELECT event_type AS \"table\", count(*) AS expired_snapshots FROM (SELECT *, "
    "row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn "
    "FROM events) WHERE rn > 2 AND ts < TIMESTAMP '2024-01-25' GROUP BY 1), "
    "o AS (SELECT event_type AS \"table\", count(*) AS orphan_files, "
    "sum(CAST(floor(value * 100) AS BIGINT)) AS orphan_bytes FROM events "
    "WHERE NOT (value > 10) AND ts < TIMESTAMP '2024-01-25' GROUP BY 1), "
    "summary AS (SELECT \"table\", "
    + ", ".join(
        f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}"
        for c in (
            "groups",
            "files_in",
            "files_out",
            "bytes_in",
            "expired_snapshots",
            "orphan_files",
            "orphan_bytes",
        )
    )
    + " FROM c FULL JOIN e USING (\"table\") FULL JOIN o USING (\"table\"))"
)


def compact_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored in many small files by status and by a text that looks like a
    number, then compacted: the same rows in the same folders."""
    base = scratch.scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    branch = F.format_string("%03d", F.col("o_custkey") % 3)
    spread = orders.withColumn("branch", branch).repartition(32, "o_orderkey")
    spread.write.partitionBy("o_orderstatus", "branch").parquet(base)
    runbook.compact(spark, base)
    rows = spark.read.parquet(base).select(*orders.columns)
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


ENTRIES = {
    "compaction_plan": Entry(
        compaction_plan,
        _groups_sql(_DOCUMENTS_SQL, _SMALL_OR_LARGE, _WORTH_IT) + " SELECT * FROM chosen",
    ),
    "compaction_rewrite_all": Entry(
        compaction_rewrite_all,
        _groups_sql(_DOCUMENTS_SQL, "true", "true") + " SELECT * FROM chosen",
    ),
    "compaction_by_size": Entry(
        compaction_by_size,
        _by_size_sql(_DOCUMENTS_SQL, _SMALL_OR_LARGE, _WORTH_IT) + " SELECT * FROM chosen",
    ),
    "compaction_by_size_all": Entry(
        compaction_by_size_all,
        _by_size_sql(_DOCUMENTS_SQL, "true", "true") + " SELECT * FROM chosen",
    ),
    "expire_snapshots_plan": Entry(
        expire_snapshots_plan,
        "SELECT user_id AS \"table\", event_id AS snapshot_id FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) "
        "WHERE rn > 2 AND ts < TIMESTAMP '2024-01-25'",
    ),
    "expire_keep_one": Entry(
        expire_keep_one,
        "SELECT user_id AS \"table\", event_id AS snapshot_id FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) "
        "WHERE rn > 1 AND ts < TIMESTAMP '2024-01-25'",
    ),
    "orphan_files_plan": Entry(
        orphan_files_plan,
        "SELECT 's3a://lake/' || page_id || '.html' AS path, length(html) AS length FROM pages "
        "WHERE url NOT LIKE 'https:%' AND page_id < 180",
    ),
    "maintenance_summary": Entry(maintenance_summary, _SUMMARY_SQL + " SELECT * FROM summary"),
    "maintenance_totals": Entry(
        maintenance_totals,
        _SUMMARY_SQL
        + " SELECT count(*) AS tables, "
        + ", ".join(
            f"CAST(sum({c}) AS BIGINT) AS {c}"
            for c in (
                "groups",
                "files_in",
                "files_out",
                "bytes_in",
                "expired_snapshots",
                "orphan_files",
                "orphan_bytes",
            )
        )
        + " FROM summary",
    ),
    "compact_apply": Entry(
        compact_apply,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
    ),
}
