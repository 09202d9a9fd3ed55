"""Data-quality tests. Each gives rows of (test, column, failures); 0 is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import INVALID


class QualityFailure(AssertionError):
    """At least one data test failed."""


def _stacked(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate all aggregate checks in one pass and turn them into rows."""
    counted = df.agg(*[check.alias(f"_{i}") for i, (_, _, check) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(test).alias("test"),
                F.lit(column).alias("column"),
                F.col(f"_{i}").cast("bigint").alias("failures"),
            )
            for i, (test, column, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def _null_checks(cols: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.count_if(F.col(c).isNull())) for c in cols]


def _invalid_check(cols: Sequence[str]) -> tuple[str, str, Column]:
    any_invalid = reduce(or_, [F.col(c).eqNullSafe(INVALID) for c in cols])
    return ("no_invalid_dates", "*", F.count_if(any_invalid))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    return _stacked(df, _null_checks(cols))


def duplicate_values(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once, with their count. NULLs are ignored."""
    seen = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return seen.filter("n > 1")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Number of values that occur more than once."""
    return _stacked(duplicate_values(df, col), [("unique", col, F.count(F.lit(1)))])


def unexpected_values(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Values outside the list, with their count. NULL passes."""
    # Grouped before the list is looked at: it is then searched once per value.
    seen = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return seen.filter(~F.col(col).isin(*values))


def accepted_values(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Number of distinct values outside the list."""
    return _stacked(
        unexpected_values(df, col, values), [("accepted_values", col, F.count(F.lit(1)))]
    )


def invalid_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with an invalid marker in any of the columns."""
    return df.filter(reduce(or_, [F.col(c).eqNullSafe(INVALID) for c in cols]))


def no_invalid_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of rows with an invalid marker in any of the columns."""
    return _stacked(df, [_invalid_check(cols)])


def row_checks(not_null_cols: Sequence[str] = (), date_cols: Sequence[str] = ()) -> list[tuple[str, str, Column]]:
    """(test, column, number of failures) of the tests that look at one row at a time.

    They are plain aggregates, so a job that writes the rows can count them on the way.
    """
    return _null_checks(not_null_cols) + ([_invalid_check(date_cols)] if date_cols else [])


def dq_report(
    df: DataFrame,
    not_null_cols: Sequence[str] = (),
    unique_cols: Sequence[str] = (),
    accepted: dict[str, Sequence[object]] | None = None,
    date_cols: Sequence[str] = (),
    counted: dict[tuple[str, str], int] | None = None,
) -> DataFrame:
    """All tests as one report, in one pass over the rows.

    Each column that is tested as a whole is a grouping set of its own, and all rows
    are one more, over which the row-wise tests are counted. `counted` has the numbers
    of those that have been counted before, by test and column.
    """
    accepted = accepted or {}
    known = dict(counted or {})
    row_wise = [c for c in row_checks(not_null_cols, date_cols) if c[:2] not in known]
    tests = [c[:2] for c in row_checks(not_null_cols, date_cols)]
    tests += [("unique", c) for c in unique_cols] + [("accepted_values", c) for c in accepted]
    if not tests:
        raise ValueError("no test given")
    columns = list(dict.fromkeys([*unique_cols, *accepted]))
    if not columns:
        found = _stacked(df, row_wise) if row_wise else None
        return _with_known(df.sparkSession, found, known, tests)
    sets = [[F.col(c)] for c in columns] + ([[]] if row_wise else [])
    # The bit of a column is set in the groups that are not of this column.
    every = (1 << len(columns)) - 1
    group = {c: every ^ (1 << (len(columns) - 1 - i)) for i, c in enumerate(columns)}
    held = {c: f"_{i}" for i, c in enumerate(columns)}
    grouped = (
        df.groupingSets(sets, *columns)
        .agg(
            F.grouping_id().alias("_group"),
            F.count(F.lit(1)).alias("_n"),
            *[check.alias(f"_row{i}") for i, (_, _, check) in enumerate(row_wise)],
        )
        .withColumnsRenamed(held)
    )
    of = lambda c, failed: F.count_if((F.col("_group") == group[c]) & F.col(held[c]).isNotNull() & failed)
    checks = [
        (test, c, F.coalesce(F.sum(F.when(F.col("_group") == every, F.col(f"_row{i}"))), F.lit(0)))
        for i, (test, c, _) in enumerate(row_wise)
    ]
    checks += [("unique", c, of(c, F.col("_n") > 1)) for c in unique_cols]
    checks += [("accepted_values", c, of(c, ~F.col(held[c]).isin(*v))) for c, v in accepted.items()]
    return _with_known(df.sparkSession, _stacked(grouped, checks), known, tests)


def _with_known(
    spark: SparkSession, found: DataFrame | None, known: dict[tuple[str, str], int], tests: Sequence[tuple[str, str]]
) -> DataFrame:
    rows = [(*test, int(known[test])) for test in tests if test in known]
    if not rows:
        return found
    held = spark.createDataFrame(rows, "test string, column string, failures bigint")
    return held if found is None else held.unionByName(found)


def enforce(report: DataFrame) -> DataFrame:
    """Raise `QualityFailure` naming the failed tests, else give the report back."""
    failed = report.filter("failures > 0").collect()
    if failed:
        raise QualityFailure(
            "; ".join(f"{r['test']}({r['column']}): {r['failures']}" for r in failed)
        )
    return report


def avg_count(df: DataFrame, col: str) -> DataFrame:
    """Mean of a column and number of rows."""
    return df.agg(F.avg(col).alias(f"avg_{col}"), F.count(F.lit(1)).alias("n_rows"))
