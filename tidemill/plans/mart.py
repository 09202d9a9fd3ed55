"""Build, store and test the certificate status mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import certs, quality
from tidemill.sources import catalog, versions

TESTED_NOT_NULL = ("id", "cong_ty", certs.KIND, "co_dinh_chi", "last_dc_pos")


def build_mart(
    sources: Mapping[str, DataFrame], run_ts: Column | None = None, strict: bool = False
) -> DataFrame:
    """Source tables by kind to mart rows: one narrow pass per table, no shuffle."""
    now = F.current_timestamp() if run_ts is None else run_ts
    return certs.status_mart(certs.coerce(sources), now, strict)


def write_mart(df: DataFrame, name: str, using: str = "iceberg") -> None:
    """Rebuild the mart as a catalog table."""
    known = catalog.FORMAT_PROPERTIES if using == "iceberg" else {}
    catalog.replace_table(df, name, using, known)


def write_mart_folder(df: DataFrame, base: str) -> DataFrame:
    """Rebuild the mart as the next version of a parquet table."""
    return versions.publish(df, base)


_TESTS = {"unique_cols": ["id"], "accepted": {certs.KIND: tuple(certs.CERTIFICATE_TABLES)}}


def _row_tests(strict: bool) -> dict:
    return {"not_null_cols": TESTED_NOT_NULL, "date_cols": certs.SHORT_NAMES if strict else ()}


def mart_report(mart: DataFrame, strict: bool = False) -> DataFrame:
    """The tests declared for the mart; `strict` adds the one on invalid cells."""
    return quality.dq_report(mart, **_row_tests(strict), **_TESTS)


def build_tested(df: DataFrame, base: str, strict: bool = False, enforced: bool = True) -> tuple[DataFrame, DataFrame]:
    """Store the mart and test it in the same run: the stored rows and the report.

    The row-wise tests are counted by the job that writes the rows. The others read two
    columns of what was written. With `enforced` a failed test raises, and the table
    stays at the version before.
    """
    checks = quality.row_checks(**_row_tests(strict))
    report: list[DataFrame] = []

    def gate(written: DataFrame, counts: dict[str, int]) -> None:
        counted = {(test, column): counts[f"{test} {column}"] for test, column, _ in checks}
        report.append(quality.dq_report(written, **_row_tests(strict), **_TESTS, counted=counted))
        if enforced:
            quality.enforce(report[0])

    stored = versions.publish(df, base, counts={f"{t} {c}": check for t, c, check in checks}, gate=gate)
    return stored, report[0]


def run_mart(
    sources: Mapping[str, DataFrame], base: str, strict: bool = False, enforced: bool = False
) -> DataFrame:
    """Build, store and test; the report."""
    return build_tested(build_mart(sources), base, strict, enforced)[1]
