"""Maintenance in its order: properties, data files, manifests, snapshots, orphans."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.util import inheritable_thread_target

from tidemill.functions.names import col, fresh_name, quoted
from tidemill.operators import compaction, packing_by_size
from tidemill.session import setting
from tidemill.sources import catalog


@dataclass(frozen=True)
class Policy:
    """How a table is kept. Ages are relative to the start of the run."""

    target_bytes: int = compaction.TARGET_BYTES
    rewrite_all: bool = False
    min_input_files: int | None = None
    rewrite_manifests: bool = True
    retain_last: int = 2
    snapshot_age: timedelta | None = timedelta(0)
    orphan_age: timedelta | None = None


# Daily rewrites everything and keeps one snapshot; weekly, with its own steps, packs
# small files only; the policy for a single table keeps two snapshots.
DAILY = Policy(rewrite_all=True, retain_last=1, orphan_age=timedelta(days=1))
WEEKLY = Policy(min_input_files=2)
SINGLE_TABLE = Policy()
WEEKLY_STEPS = ("data", "orphans")
# Folders that one task of a compaction writes side by side at most.
FOLDERS_PER_TASK = 32
ALL_STEPS = ("properties", "data", "manifests", "snapshots", "orphans")


class MaintenanceFailed(RuntimeError):
    """At least one table could not be maintained; the others were."""


@dataclass
class TableStatus:
    table: str
    steps: dict[str, dict] = field(default_factory=dict)
    error: str | None = None


def _timestamp(moment: datetime) -> str:
    """A literal with its zone, so the session's zone does not shift it."""
    utc = moment.astimezone(timezone.utc)
    return f"TIMESTAMP '{utc:%Y-%m-%d %H:%M:%S.%f}+00:00'"


def _call(table: str, procedure: str, *more: str) -> str:
    system = table.partition(".")[0]
    arguments = ", ".join([f"table => {catalog.literal(table)}", *more])
    return f"CALL {catalog.quoted_part(system)}.system.{procedure}({arguments})"


def rewrite_sql(
    table: str,
    target_bytes: int = compaction.TARGET_BYTES,
    rewrite_all: bool = False,
    min_input_files: int | None = None,
) -> str:
    options = {"target-file-size-bytes": str(target_bytes)}
    if rewrite_all:
        options["rewrite-all"] = "true"
    if min_input_files is not None:
        options["min-input-files"] = str(min_input_files)
    pairs = ", ".join(f"{catalog.literal(k)}, {catalog.literal(v)}" for k, v in options.items())
    return _call(table, "rewrite_data_files", f"options => map({pairs})")


def manifests_sql(table: str) -> str:
    return _call(table, "rewrite_manifests")


def expire_sql(table: str, retain_last: int = 2, older_than: datetime | None = None) -> str:
    more = [f"retain_last => {retain_last}"]
    if older_than is not None:
        more.append(f"older_than => {_timestamp(older_than)}")
    return _call(table, "expire_snapshots", *more)


def orphans_sql(table: str, older_than: datetime | None = None) -> str:
    more = [] if older_than is None else [f"older_than => {_timestamp(older_than)}"]
    return _call(table, "remove_orphan_files", *more)


def statements(table: str, policy: Policy, now: datetime) -> dict[str, str]:
    """Step name -> statement, in the order they run."""
    snapshots_before = None if policy.snapshot_age is None else now - policy.snapshot_age
    orphans_before = None if policy.orphan_age is None else now - policy.orphan_age
    steps = {
        "properties": f"ALTER TABLE {catalog.quoted(table)} SET TBLPROPERTIES "
        f"({catalog.properties(catalog.METADATA_PROPERTIES)})",
        "data": rewrite_sql(
            table, policy.target_bytes, policy.rewrite_all, policy.min_input_files
        ),
        "manifests": manifests_sql(table),
        "snapshots": expire_sql(table, policy.retain_last, snapshots_before),
        "orphans": orphans_sql(table, orphans_before),
    }
    if not policy.rewrite_manifests:
        del steps["manifests"]
    return steps


def maintain_table(
    spark: SparkSession,
    table: str,
    policy: Policy = SINGLE_TABLE,
    steps: Sequence[str] = ALL_STEPS,
    now: datetime | None = None,
) -> TableStatus:
    """Run the steps on one catalog table and keep the counts each returns."""
    status = TableStatus(table)
    now = now or datetime.now(timezone.utc)
    try:
        if not catalog.table_exists(spark, table):
            status.steps["skipped"] = {}
            return status
        for step, sql in statements(table, policy, now).items():
            if step in steps:
                result = spark.sql(sql)
                # Orphan removal answers with a row per file, the others with counts.
                if step == "orphans":
                    status.steps[step] = {"orphan_files": result.count()}
                    continue
                row = result.head()
                status.steps[step] = {} if row is None else row.asDict()
    except Exception as error:  # reported per table, raised by maintain_all
        status.error = str(error)
    return status


def maintain_all(
    spark: SparkSession,
    root: str,
    policy: Policy = DAILY,
    steps: Sequence[str] = ALL_STEPS,
    maintain: Callable[..., TableStatus] = maintain_table,
    parallel: int = 4,
) -> list[TableStatus]:
    """Every table under the namespace, several at a time; raise at the end if any of
    them failed."""
    one = lambda table: maintain(spark, table, policy, steps)
    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one), catalog.list_tables(spark, root)))
    failed = [s for s in done if s.error]
    if failed:
        raise MaintenanceFailed("; ".join(f"{s.table}: {s.error}" for s in failed))
    return done


def listing(spark: SparkSession, base: str) -> DataFrame:
    """Data files under a folder as (table, partition, path, length, modificationTime).

    The partition is the path of the file's folder below the base.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    below = F.regexp_extract(folder, r"/([^/=]+=[^/]*(?:/[^/=]+=[^/]*)*)$", 1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select(F.lit(base).alias("table"), below.alias("partition"), "path", "length", "modificationTime")
    )


def compact(
    spark: SparkSession,
    base: str,
    target_bytes: int = compaction.TARGET_BYTES,
    min_input_files: int = compaction.MIN_INPUT_FILES,
    rewrite_all: bool = False,
) -> list[str]:
    """Rewrite the partition folders whose files are worth it; gives these.

    Planning is a query over the listing. Only folders that hold a group worth rewriting
    are read and replaced, by a dynamic overwrite; all other files keep name and bytes,
    and folder names keep their text. The bytes of a folder say how many files it becomes;
    its rows are dealt to as many tasks, so files come out near the target size however
    the rows lay before, and small folders share a task. A task writes its folders side by
    side, so it does not sort its rows, which take many times the bytes of their file. The
    table must be partitioned.
    """
    found = listing(spark, base)
    plan = compaction.compaction_plan(
        found, target_bytes, min_input_files, rewrite_all, grouping=packing_by_size.pack_groups
    )
    sizes = found.groupBy("partition").agg(F.sum("length").alias("bytes"))
    # A row per folder, as many as the scan's own file index holds.
    chosen = sizes.join(plan.select("partition").distinct(), "partition", "left_semi").collect()
    if not chosen:
        return []
    parts = sorted((r["partition"], r["bytes"]) for r in chosen)
    if parts[0][0] == "":
        raise ValueError(f"{base} has data files outside partition folders")
    names = [unquote(part.partition("=")[0]) for part in parts[0][0].split("/")]
    rows = _raw_rows(spark, [f"{base}/{part}" for part, _ in parts], base, names)
    numbers, total = _file_numbers(parts, target_bytes)
    held = [fresh_name(rows.columns, f"_{c}") for c in ("first", "files")]
    keys = [fresh_name(rows.columns, f"_part{i}_") for i in range(len(names))]
    schema = ", ".join([*(f"{quoted(k)} string" for k in keys), *(f"{quoted(h)} int" for h in held)])
    numbered = rows.join(
        F.broadcast(spark.createDataFrame(numbers, schema)),
        reduce(and_, [col(n).eqNullSafe(col(k)) for n, k in zip(names, keys)]),
    )
    number = col(held[0]) + F.pmod(F.monotonically_increasing_id(), col(held[1]))
    dealt = numbered.repartitionById(total, number.cast("int")).select(*map(col, rows.columns))
    write = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names)
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(FOLDERS_PER_TASK)):
        write.parquet(base)
    return [part for part, _ in parts]


def _raw_rows(spark: SparkSession, paths: Sequence[str], base: str, names: Sequence[str]) -> DataFrame:
    """Rows of partition folders with the folders' own text as values: `007` is no 7."""
    reader = spark.read.option("basePath", base)
    fields = reader.option("mergeSchema", True).parquet(*paths).schema
    raw = StructType([StructField(f.name, StringType()) if f.name in names else f for f in fields])
    return spark.read.option("basePath", base).schema(raw).parquet(*paths)


def _file_numbers(parts: Sequence[tuple[str, int]], target_bytes: int) -> tuple[list[tuple], int]:
    """(values of the folder, its first file's number, its files) of every folder, and the
    number of tasks. Folders of one file follow each other in a task up to the target, or
    up to the number that a task writes side by side."""
    rows, next_number, shared, filled, held = [], 0, -1, 0, 0
    for part, size in parts:
        values = [unquote(p.partition("=")[2]) for p in part.split("/")]
        values = [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]
        n = max(1, (2 * size + target_bytes) // (2 * target_bytes))
        if n == 1 and shared >= 0 and filled + size <= target_bytes and held < FOLDERS_PER_TASK:
            first, filled, held = shared, filled + size, held + 1
        else:
            first, next_number = next_number, next_number + n
            if n == 1:
                shared, filled, held = first, size, 1
        rows.append((*values, first, n))
    return rows, next_number
