"""Token ids of whole documents in files of compressed runs, and back.

Documents are dealt out by ranges of their id and sorted, so a file holds documents that
follow each other and the files follow each other too. A row of a file is a run: whole
documents in order, their ids and lengths, and the ids of all their tokens as one run of
`codec`. Runs are closed at a number of tokens, so one is decoded in bounded memory
however large the file is; a longer document is a row of its own, of several runs. The rows are kept in
Parquet, whose writer commits whole files when tasks are repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import codec, tokens
from tidemill.llm.common import column

RUN_TOKENS = 1 << 21
ROWS = "part int, run int, doc_ids array<long>, lengths array<long>, payload binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    vocabulary: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
) -> None:
    """Encode whole texts and write them in ascending order of id.

    Null texts are empty and hold the end id alone. Null ids come first, and repeated
    ids follow each other in order of text. No documents give no rows.
    """
    spark = docs.sparkSession
    place = vocabulary or tokens.vocabulary_path()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = tokens.encoder(place)
        ids: list[np.ndarray] = []
        names: list = []
        lengths: list[np.ndarray] = []
        held, number = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, number
            payload = codec.encode(np.concatenate(ids))
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                ["part", "run", "doc_ids", "lengths", "payload"],
            )
            for gone in (ids, names, lengths):
                gone.clear()
            held, number = 0, number + 1
            return row

        for batch in rows:
            for a, b in tokens.slices(batch.column(1)):
                own = batch.slice(a, b - a)
                found, n = encoder.encode(own.column(1))
                found = np.insert(found, np.cumsum(n), end_id)
                n = n + 1
                ends = np.cumsum(n)
                at = 0
                while at < len(n):
                    begin = int(ends[at] - n[at])
                    # As many whole documents as the run has room for, one at least.
                    stop = int(np.searchsorted(ends, begin + RUN_TOKENS - held, "right"))
                    if stop <= at and held:
                        yield close()
                        continue
                    stop = max(stop, at + 1)
                    ids.append(found[begin : int(ends[stop - 1])])
                    names.extend(own.column(0)[at:stop].to_pylist())
                    lengths.append(n[at:stop])
                    held += int(ends[stop - 1]) - begin
                    at = stop
        if names:
            yield close()

    (
        docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, ROWS)
        .write.parquet(path)
    )


DOCS = "part int, run int, nth int, doc_id long, before long, n_tokens long, ids_crc32 long"


def read_tokens(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """Decode all files: doc_id, start, n_tokens and ids_crc32 of every document.

    `start` counts the tokens of all documents before it. The sums it needs are made
    per run and per file; the one window over all files has a row for each of them.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in range(batch.num_rows):
                part, number, names, sizes, payload = (batch.column(i)[row] for i in range(5))
                ids = codec.decode(payload.as_py())
                n = sizes.values.to_numpy()
                ends = np.cumsum(n)
                if int(ends[-1]) != len(ids):
                    raise ValueError("lengths of documents differ from the ids of their run")
                view = memoryview(ids).cast("B")
                crcs = [zlib.crc32(view[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, part.as_py()), pa.int32()),
                        pa.array(np.full(k, number.as_py()), pa.int32()),
                        pa.array(np.arange(k), pa.int32()),
                        names.values,
                        pa.array(ends - n),
                        pa.array(n),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "run", "nth", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    rows = spark.read.schema(ROWS).parquet(path)
    docs = rows.mapInArrow(run, DOCS)
    sizes = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    runs = rows.select("part", "run", sizes.alias("n"))
    upto = Window.unboundedPreceding, -1
    files = runs.groupBy("part").agg(F.sum("n").alias("n"))
    files = files.select(
        F.col("part").alias("f_part"),
        F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*upto)), F.lit(0)).alias("f_base"),
    )
    within = Window.partitionBy("part").orderBy("run").rowsBetween(*upto)
    bases = runs.withColumn("r_base", F.coalesce(F.sum("n").over(within), F.lit(0))).join(
        files, F.col("part") == F.col("f_part")
    )
    bases = bases.select(
        F.col("part").alias("b_part"), F.col("run").alias("b_run"), (F.col("f_base") + F.col("r_base")).alias("base")
    )
    return docs.join(bases, (F.col("part") == F.col("b_part")) & (F.col("run") == F.col("b_run"))).select(
        F.col("doc_id").alias(doc_id),
        (F.col("base") + F.col("before")).cast("long").alias("start"),
        "n_tokens",
        "ids_crc32",
    )
