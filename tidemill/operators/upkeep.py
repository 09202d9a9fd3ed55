"""One report over the maintenance plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COUNTS = (
    "groups",
    "files_in",
    "files_out",
    "bytes_in",
    "expired_snapshots",
    "orphan_files",
    "orphan_bytes",
)


def _counts(df: DataFrame, **values) -> DataFrame:
    filled = [
        F.coalesce(values.get(name, F.lit(0)).cast("bigint"), F.lit(0).cast("bigint")).alias(name)
        for name in _COUNTS
    ]
    return df.select("table", *filled)


def maintenance_summary(
    compaction: DataFrame | None = None,
    expired: DataFrame | None = None,
    orphans: DataFrame | None = None,
) -> DataFrame:
    """Per table: what the plans would rewrite, expire and delete.

    The plans are stacked and summed once, so tables that appear in only some of them
    need no outer joins.
    """
    one = F.lit(1)
    parts = []
    if compaction is not None:
        parts.append(
            _counts(
                compaction,
                groups=one,
                files_in=F.col("files_in"),
                files_out=F.col("files_out"),
                bytes_in=F.col("bytes"),
            )
        )
    if expired is not None:
        parts.append(_counts(expired, expired_snapshots=one))
    if orphans is not None:
        parts.append(_counts(orphans, orphan_files=one, orphan_bytes=F.col("length")))
    if not parts:
        raise ValueError("no plan given")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("table").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def maintenance_totals(summary: DataFrame) -> DataFrame:
    """One row: number of tables and the sums over them."""
    return summary.agg(
        F.count(F.lit(1)).alias("tables"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS],
    )
