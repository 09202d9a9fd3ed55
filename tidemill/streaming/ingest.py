"""New files into an upserted table, without listing days."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemill.operators.latest import dedup_latest
from tidemill.plans.change import upsert_table
from tidemill.sources import documents, files, scratch


def stream_json(
    spark: SparkSession,
    base: str,
    schema: StructType,
    files_per_batch: int = 1000,
    suffix: str = ".json",
    archive: str | None = None,
) -> DataFrame:
    """JSON files under `base`, in any depth; a stream needs its schema up front.

    With `archive`, files that have been taken up are moved to that folder, under their
    whole path, while later ones are; then listing them never grows with the history.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(base)


def upsert_stream(
    rows: DataFrame,
    base: str,
    keys: Sequence[str],
    order_by: str,
    checkpoint: str,
    tie: Sequence[str] | None = None,
) -> None:
    """Take up all rows that are new since the last run, then stop.

    Each batch keeps its newest row per key and is upserted, into the key buckets it
    touches, with `order_by` as guard. Rows without a key are kept in
    `<base>/_aside/stream=<id>/batch=<n>`; the id stays with the checkpoint, so another
    checkpoint, whose numbers start anew, replaces nothing. A batch that is repeated
    after a failure changes nothing, so rows arrive once.
    """
    started, stream = Event(), []

    def apply(batch: DataFrame, number: int) -> None:
        started.wait()
        rows, staged = scratch.stage(batch, "batch")
        try:
            load, broken = documents.split_corrupt(rows, keys)
            if not broken.isEmpty():
                aside = f"{base}/_aside/stream={stream[0]}/batch={number}"
                broken.write.mode("overwrite").parquet(aside)
            newest = dedup_latest(load, keys, order_by, tie)
            upsert_table(newest, base, keys, order_by, check_source=False, owner=stream[0])
        finally:
            files.remove(batch.sparkSession, staged)

    query = (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(str(query.id))
    started.set()
    query.awaitTermination()
