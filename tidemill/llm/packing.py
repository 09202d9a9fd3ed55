"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only lengths matter to a packing, and there are at most `capacity` of them. So the plan
is made from the number of pieces per length alone, a table whose size depends on the
capacity and not on the data, and is then carried out by Spark on all pieces: each piece
gets its rank among the pieces of its length, and the plan says which sequence, and which
place in it, the pieces of a length with ranks in an interval go to.

The plan fills sequences from the longest piece on. The gap left is looked up in an
index of the sums of one, two and three available lengths; an exact complement is used
as often as the availability of its lengths allows. Where none exists, the longest piece
that fits is added and the rest of the gap is looked up again.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import column, stage

# Pieces of one length are ranked in so many parts.
PARTS = 128


class _Available:
    """How many pieces of each length are left, with an index of their sums."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self._pairs: np.ndarray | None = None
        self._stale = True

    def take(self, lengths: Counter, times: int) -> None:
        for length, n in lengths.items():
            self.counts[length] -= n * times
            self._stale |= self.counts[length] <= 2

    def longest(self, most: int) -> int:
        """The longest available length up to `most`, or 0."""
        found = np.flatnonzero(self.counts[1 : most + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def pair(self, total: int) -> tuple[int, ...] | None:
        """Two available lengths with a given sum, the longer one as long as can be."""
        if total < 2:
            return None
        small = np.arange(1, total // 2 + 1)
        fits = (self.counts[small] > 0) & (self.counts[total - small] > 0)
        fits &= (small * 2 != total) | (self.counts[small] > 1)
        found = np.flatnonzero(fits)
        return (total - int(small[found[0]]), int(small[found[0]])) if len(found) else None

    def pair_sums(self) -> np.ndarray:
        """Which sums two available lengths have; a sum of twice one length may be off."""
        if self._stale:
            there = (self.counts > 0).astype(np.float32)
            size = 1 << (2 * len(there)).bit_length()
            spectrum = np.fft.rfft(there, size)
            self._pairs = np.fft.irfft(spectrum * spectrum, size)[: len(there)] > 0.5
            self._stale = False
        return self._pairs

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill a gap exactly."""
        if self.counts[gap] > 0:
            return (gap,)
        if two := self.pair(gap):
            return two
        longest = np.arange(gap - 2, 0, -1)
        if not len(longest):
            return None
        hopeful = longest[(self.counts[longest] > 0) & self.pair_sums()[gap - longest]]
        for first in hopeful.tolist():
            self.counts[first] -= 1
            two = self.pair(gap - first)
            self.counts[first] += 1
            if two:
                return (first, *two)
        return None


def plan_packing(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each.

    `counts[l]` is the number of pieces of length l, up to the capacity. Every pattern
    is repeated until a length of it runs short, so the number of patterns grows with
    the capacity and only with the logarithm of the number of pieces.
    """
    left = _Available(np.array(counts, np.int64))
    plan = []
    while first := left.longest(capacity):
        chosen, gap = [first], capacity - first
        left.counts[first] -= 1
        while gap:
            exact = left.complement(gap)
            more = exact or tuple(filter(None, (left.longest(gap),)))
            if not more:
                break
            for length in more:
                left.counts[length] -= 1
            chosen += more
            gap -= sum(more)
        for length in chosen:
            left.counts[length] += 1
        need = Counter(chosen)
        times = min(int(left.counts[length]) // n for length, n in need.items())
        left.take(need, times)
        plan.append((tuple(chosen), times))
    return plan


def intervals(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows of length, first rank, first sequence and offset, sorted by the former two."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str, doc_id: str, text: str) -> DataFrame:
    """One row per piece: ids of a document and the end id, cut at the capacity."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        for batch in rows:
            for a, b in tokens.slices(batch.column(1)):
                part = batch.slice(a, b - a)
                ids, lengths = encoder.encode(part.column(1))
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                total = lengths + 1
                pieces = -(-total // capacity)
                of = np.repeat(np.arange(len(total)), pieces)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (np.cumsum(total) - total)[of] + nth * capacity
                size = np.minimum(capacity, total[of] - nth * capacity)
                view = memoryview(ids).cast("B")
                crcs = [zlib.crc32(view[4 * p : 4 * (p + n)]) for p, n in zip(first.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(of)),
                        pa.array(nth, pa.int32()),
                        pa.array(nth * capacity, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    named = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    return named.mapInArrow(run, PIECES)


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    vocabulary: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece with sequence_id and offset; sequences have no gaps.

    A null or empty text is a document of the end id alone. Repeated rows are documents
    of their own, a null id is carried along, and no documents give no rows. Only
    documents longer than the capacity are cut.
    """
    pieces = stage(
        cut_pieces(docs, capacity, end_id, vocabulary or tokens.vocabulary_path(), doc_id, text),
        "pieces",
    )
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)).cast("int")
    parted = pieces.withColumn("part", part)
    sizes = parted.groupBy("length", "part").agg(F.count("*").alias("n"))
    sizes = stage(sizes, "lengths")  # at most capacity x PARTS rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        counts[row["length"]] = row["n"]
    table = intervals(plan_packing(counts, capacity))
    # Sorted by length and rank, as one number; ranks stay below 2^48.
    keys = (table[:, 0] << 48) | table[:, 1]

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("length").alias("b_length"),
        F.col("part").alias("b_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = parted.withColumn("nth", F.row_number().over(within) - 1).join(
        bases, (F.col("length") == F.col("b_length")) & (F.col("part") == F.col("b_part"))
    )

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = np.searchsorted(keys, (length << 48) | rank, "right") - 1
            sequence = table[row, 2] + rank - table[row, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(table[row, 3])],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    rank = (F.col("base") + F.col("nth")).cast("long").alias("rank")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return (
        ranked.select(*names, rank)
        .mapInArrow(place, PIECES + ", sequence_id long, offset long")
        .withColumnRenamed("doc_id", doc_id)
    )
