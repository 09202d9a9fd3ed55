"""Data-quality queries and the sample aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import certs, quality
from tidemill.plans.mart import TESTED_NOT_NULL, build_tested, mart_report
from tidemill.registry import Entry, table
from tidemill.registry.certificates import MART_SQL, mart, stored_mart
from tidemill.sources import scratch

_EXPECTED_EVENTS = ("click", "view", "error", "purchase")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(mart(spark, sf_dir), (*TESTED_NOT_NULL, "vi_tri_dinh_chi_dau_tien"))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = quality.unique(mart(spark, sf_dir), "id")
    repeats = quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return keys.unionByName(repeats)


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = quality.accepted_values(
        mart(spark, sf_dir), certs.KIND, tuple(certs.CERTIFICATE_TABLES)
    )
    events = quality.accepted_values(
        table(spark, sf_dir, "events"), "event_type", _EXPECTED_EVENTS
    )
    return kinds.unionByName(events)


def dq_no_invalid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.no_invalid_dates(mart(spark, sf_dir), certs.SHORT_NAMES)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_report(stored_mart(spark, sf_dir), strict=True)


def dq_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the job that builds and stores the mart."""
    base = scratch.scratch_path(spark, "mart")
    return build_tested(mart(spark, sf_dir), base, strict=True, enforced=False)[1]


def avg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.avg_count(table(spark, sf_dir, "customer"), "c_acctbal")
    return found.withColumn("avg_c_acctbal", F.round("avg_c_acctbal", 4))


def _null_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS test, '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM mart"
        for c in columns
    )


def _unique_sql(relation: str, column: str) -> str:
    return (
        f"SELECT 'unique' AS test, '{column}' AS \"column\", count(*) AS failures FROM "
        f"(SELECT {column} FROM {relation} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _accepted_sql(relation: str, column: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return (
        f"SELECT 'accepted_values' AS test, '{column}' AS \"column\", "
        f"count(DISTINCT {column}) AS failures FROM {relation} WHERE {column} NOT IN ({listed})"
    )


_KIND_SQL = _accepted_sql("mart", certs.KIND, certs.CERTIFICATE_TABLES)
_INVALID_SQL = (
    "SELECT 'no_invalid_dates' AS test, '*' AS \"column\", count(*) AS failures FROM mart WHERE "
    + " OR ".join(f"{c} = 'SAI'" for c in certs.SHORT_NAMES)
)

_REPORT_SQL = (
    f"{MART_SQL} {_null_sql(TESTED_NOT_NULL)} UNION ALL {_INVALID_SQL} UNION ALL "
    f"{_unique_sql('mart', 'id')} UNION ALL {_KIND_SQL}"
)

ENTRIES = {
    "dq_not_null": Entry(
        dq_not_null,
        f"{MART_SQL} {_null_sql((*TESTED_NOT_NULL, 'vi_tri_dinh_chi_dau_tien'))}",
    ),
    "dq_unique": Entry(
        dq_unique,
        f"{MART_SQL} {_unique_sql('mart', 'id')} UNION ALL "
        f"{_unique_sql('lineitem', 'l_orderkey')}",
    ),
    "dq_accepted_values": Entry(
        dq_accepted_values,
        f"{MART_SQL} {_KIND_SQL} UNION ALL "
        f"{_accepted_sql('events', 'event_type', _EXPECTED_EVENTS)}",
    ),
    "dq_no_invalid_dates": Entry(dq_no_invalid_dates, f"{MART_SQL} {_INVALID_SQL}"),
    "dq_report": Entry(dq_report, _REPORT_SQL),
    "dq_build": Entry(dq_build, _REPORT_SQL),
    "avg_count": Entry(
        avg_count,
        "SELECT round(avg(c_acctbal), 4) AS avg_c_acctbal, count(*) AS n_rows FROM customer",
    ),
}
