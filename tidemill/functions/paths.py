"""Parts of object-store paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A folder whose name starts with a date, with the two folders above it. The leading
# part is greedy, so the last such folder is found; the file name is never one.
_DATED = r"^(?:.*/)?([^/]*/[^/]*/\d{4}-\d{2}-\d{2}[^/]*)/"


def directory(path: Column) -> Column:
    """Everything before the last slash."""
    name = F.length(F.substring_index(path, "/", -1))
    return F.substring(path, F.lit(1), F.length(path) - name - 1)


def dated_folders(path: Column) -> Column:
    """`<namespace>/<table>/<date...>` of a path; `''` if it has no such folders."""
    return F.regexp_extract(path, _DATED, 1)


def table_name(raw: Column) -> Column:
    """Dashes to underscores, and a `tbl_` prefix unless there is one in any case."""
    name = F.replace(raw, F.lit("-"), F.lit("_"))
    return F.when(F.lower(name).startswith("tbl_"), name).otherwise(F.concat(F.lit("tbl_"), name))


def namespace_name(raw: Column) -> Column:
    return F.concat(F.lit("stg_"), F.replace(raw, F.lit("-"), F.lit("_")))


def target_name(namespace: Column, table: Column, root: str = "") -> Column:
    """Full name of the table a source directory loads."""
    parts = [namespace_name(namespace), table_name(table)]
    return F.concat_ws(".", *([F.lit(root)] if root else []), *parts)


def unified(path: Column) -> Column:
    """One spelling per file: no doubled slashes, `s3` for its aliases, no bare `file:`."""
    one = F.regexp_replace(path, "^s3[an]://", "s3://")
    local = F.regexp_replace(one, "^file:/+", "/")
    return F.regexp_replace(local, "(?<!:)/{2,}", "/")
