"""One row per key: the newest, or any."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.names import col, fresh_name

# Names that hold a change time, best first.
TIME_COLUMNS = ("updated_at", "modified_at", "created_at", "timestamp", "time")


def choose_order_column(
    columns: Iterable[str],
    candidates: Sequence[str] = TIME_COLUMNS,
    by_column_order: bool = False,
) -> str | None:
    """Column to order versions by, compared without regard to case.

    By default the best candidate wins. `by_column_order` takes the first column that
    is any candidate instead; inferred JSON columns come sorted by name, so that
    prefers `created_at` to `updated_at`.
    """
    columns = list(columns)
    if by_column_order:
        return next((c for c in columns if c.lower() in candidates), None)
    by_name = {c.lower(): c for c in reversed(columns)}
    return next((by_name[c] for c in candidates if c in by_name), None)


def row_order(df: DataFrame, skip: Iterable[str] = ()) -> list[Column]:
    """Sort keys that order rows by all their values.

    As trailing sort keys they are compared only where the leading ones tie.
    """
    skipped = set(skip)
    keys = []
    for field in df.schema.fields:
        if field.name in skipped:
            continue
        column = col(field.name)
        if not _orderable(field.dataType):
            column = F.to_json(column)
        keys.append(column.asc_nulls_last())
    return keys


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column,
    tie: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the newest row per key; a NULL time counts as oldest.

    Equal times are settled by `tie`, else by the whole row, so the result does not
    depend on how rows are spread. Spark limits each key to one row per task before
    the shuffle, so a key with a third of all rows costs no more than one with few.
    """
    newest = (col(order_by) if isinstance(order_by, str) else order_by).desc_nulls_last()
    ties = row_order(df, keys) if tie is None else list(tie)
    return _first(df, keys, [newest, *ties])


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key where nothing says which: the first by its own values."""
    return _first(df, keys, row_order(df, keys) or [col(k) for k in keys])


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    row = fresh_name(df.columns, "_row")
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn(row, F.row_number().over(window)).filter(F.col(row) == 1).drop(row)
