"""Load a day of JSON files: newest row per key into each target table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from tidemill.functions.names import col, fresh_name
from tidemill.operators.latest import choose_order_column, dedup_any, dedup_latest
from tidemill.plans import change
from tidemill.plans.runbook import expire_sql, orphans_sql
from tidemill.sources import catalog, discovery, documents, files, scratch

log = logging.getLogger(__name__)

DEFAULT_KEY = "id"


class IngestFailed(RuntimeError):
    """At least one table could not be loaded; the others were."""


@dataclass(frozen=True)
class TableResult:
    target: str
    n_files: int
    mode: str
    error: str | None = None


def newest_rows(
    df: DataFrame, key: str = DEFAULT_KEY, order_by: str | None = None, parse_time: bool = False
) -> DataFrame:
    """One row per key. Without a time column any one, without the key all of them.

    JSON times are text and compare as text; `parse_time` orders by the instant they
    stand for.
    """
    if key not in df.columns:
        return df
    order_by = order_by or choose_order_column(c for c in df.columns if c != key)
    if order_by is None:
        return dedup_any(df, [key])
    newest = F.col(order_by)
    return dedup_latest(df, [key], F.try_to_timestamp(newest) if parse_time else newest)


def load_folder_table(
    df: DataFrame,
    base: str,
    load: str,
    key: str = DEFAULT_KEY,
    newer_than: str | None = None,
    day: str | None = None,
) -> str:
    """Upsert rows that are unique by key into a parquet table; without the key store
    them as the load of their day."""
    if key in df.columns:
        rows = df if day is None else df.drop(day)
        change.upsert_table(rows, base, [key], newer_than, check_source=False, owner=load)
        return "upsert"
    change.append_table(df, base, load, by=day)
    return "append"


def load_catalog_table(df: DataFrame, name: str, key: str = DEFAULT_KEY) -> str:
    """Same for a catalog table with row-level changes, created empty if need be."""
    spark = df.sparkSession
    if not catalog.table_exists(spark, name):
        catalog.create_like(df, name)
    df = catalog.fit_columns(df, name)
    if key in df.columns:
        catalog.merge_into(df, name, [key])
        mode = "upsert"
    else:
        catalog.append_to(df, name)
        mode = "append"
    _tidy(spark, expire_sql(name, retain_last=2))
    return mode


def refresh_catalog_table(df: DataFrame, name: str, now: datetime | None = None) -> None:
    """Replace a catalog table by `df` (such as `jdbc.read_jdbc` gives), then drop what
    the replacement left behind."""
    catalog.replace_table(df, name)
    now = now or datetime.now(timezone.utc)
    _tidy(df.sparkSession, expire_sql(name, retain_last=2, older_than=now), orphans_sql(name))


def _tidy(spark: SparkSession, *statements: str) -> None:
    """Upkeep after a load: the rows are in, so a failure is only reported."""
    for statement in statements:
        try:
            spark.sql(statement)
        except Exception as error:
            log.warning("upkeep failed: %s: %s", statement, error)


def folder_target(root: str) -> Callable[[str], str]:
    """Target names to folders: `stg_a.tbl_b` to `<root>/stg_a/tbl_b`."""
    return lambda target: f"{root.rstrip('/')}/{target.replace('.', '/')}"


def ingest_day(
    spark: SparkSession,
    base: str,
    ds: str,
    load: Callable[..., str],
    full_scan: bool = False,
    key: str = DEFAULT_KEY,
    null_keys: str = "aside",
    set_aside: Callable[..., None] | None = None,
    suffix: str = ".json",
    parallel: int = 4,
    only: Sequence[str] | None = None,
    schemas: Mapping[str, StructType] | None = None,
    day_depth: int | None = 2,
    with_day: bool = False,
) -> list[TableResult]:
    """Load the files of one day, or of all days, table by table.

    `load(rows, target)` stores the rows and names what it did. Rows without a key and
    broken documents go to `set_aside`; with `null_keys="load"` they are loaded as they
    are, one per run. Tables are independent: one that fails does not stop the others,
    and `IngestFailed` is raised at the end. Only one row per folder and table comes to
    the driver.

    Every file is read once: documents are stored as they are parsed, and their schema
    is taken from the stored rows. `schemas` gives the columns of a target, which saves
    that too. `day_depth` says how many levels below `base` the day's folders lie, so
    that only these are listed; with None everything is, and a day's folder counts at any
    depth.

    `with_day` hands `load` and `set_aside` a third value: the name of a column with the
    day of each row's file.
    """
    if null_keys == "aside" and set_aside is None:
        set_aside = _refuse_aside
    if full_scan or day_depth is None:
        found = discovery.list_files(spark, base, suffix)
    else:
        found = discovery.discover_files(spark, base, ds, suffix, day_depth)
    listing = discovery.filter_day(found, ds, full_scan, suffix)
    folders: dict[str, list[str]] = {}
    counts: dict[str, int] = {}
    for row in discovery.group_files(discovery.parse_path(listing)).toLocalIterator():
        if only is None or row["target"] in only:
            folders.setdefault(row["target"], []).append(row["folder"])
            counts[row["target"]] = counts.get(row["target"], 0) + row["n_files"]

    def one(target: str) -> TableResult:
        try:
            paths = documents.folder_globs(sorted(folders[target]), suffix)
            schema = (schemas or {}).get(target)
            rows, staged, day = _parsed(spark, paths, schema, with_day)
            try:
                if null_keys == "aside":
                    keys = [key] if key in rows.columns else []
                    rows, broken = documents.split_corrupt(rows, keys)
                    set_aside(broken, target, *day)
                rows = documents.drop_corrupt(rows)
                # Without columns every document was broken, and there is nothing to load.
                some = set(rows.columns) - set(day)
                mode = load(newest_rows(rows, key), target, *day) if some else "nothing"
                return TableResult(target, counts[target], mode)
            finally:
                files.remove(spark, staged)
        except Exception as error:  # reported per table, raised below
            return TableResult(target, counts[target], "failed", str(error))

    run = inheritable_thread_target(spark)(one) if parallel > 1 else one
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        results = list(pool.map(run, sorted(folders)))
    failed = [r for r in results if r.error]
    if failed:
        raise IngestFailed("; ".join(f"{r.target}: {r.error}" for r in failed))
    return results


def _parsed(
    spark: SparkSession, paths: Sequence[str], schema: StructType | None, with_day: bool
) -> tuple[DataFrame, str, list[str]]:
    """The documents' columns from stored rows, the folder of these, and the day's column."""
    if schema is None:
        held = ["_day"] if with_day else []
        parsed, staged = scratch.stage(documents.parse_documents(spark, paths, *held), "parsed")
        try:
            rows = documents.typed_documents(parsed)
        except documents.TooLong:
            files.remove(spark, staged)  # read with an inferred schema below
        else:
            return rows, staged, rows.columns[len(rows.columns) - len(held) :]
    read = documents.read_json(spark, paths, schema, keep_corrupt=True)
    day = [fresh_name(read.columns, "_day")] if with_day else []
    for name in day:
        read = documents.with_day(read, name)
    rows, staged = scratch.stage(read, "parsed")
    return rows, staged, day


def _refuse_aside(broken: DataFrame, target: str, day: str | None = None) -> None:
    if broken.head() is not None:
        raise ValueError(f"{target} has rows without a key and no place to set them aside")


def ingest_to_folders(
    spark: SparkSession, base: str, ds: str, root: str, key: str = DEFAULT_KEY, **options
) -> list[TableResult]:
    """`ingest_day` into parquet tables under `root`.

    Rows without a key are kept in `<root>/_aside/<target>`, by the day of their file; a
    day that is loaded again replaces its rows there.
    """
    place = folder_target(root)

    def set_aside(broken: DataFrame, target: str, day: str) -> None:
        folder = place(f"_aside.{target}")
        if broken.isEmpty():
            if ds:
                change.drop_load(spark, folder, ds)
            return
        document = F.to_json(F.struct(*[col(c) for c in broken.columns if c != day]))
        change.append_table(broken.select(document.alias("document"), col(day)), folder, ds or "undated", by=day)

    def load(rows: DataFrame, target: str, day: str) -> str:
        return load_folder_table(rows, place(target), ds or "undated", key, day=day)

    return ingest_day(
        spark, base, ds, load, key=key, set_aside=set_aside, with_day=True, **options
    )
