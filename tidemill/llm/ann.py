"""Nearest neighbours by largest inner product, with multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more component that brings each to
length one, so the largest inner product is the smallest distance. A table's hash is
`reach` projections on normal directions, shifted and cut into intervals; its bucket is
their combination. A query visits its own bucket and then perturbed ones, in order of
the sum of squared distances to the interval borders that were crossed, which is the
order of estimated success. Candidates of all tables are ranked by the exact product.

Buckets are dealt into cells of a bounded number of rows, a large bucket over several,
and a cell is one group: queries and rows meet there and only the best of each query
leave it. So neither a popular bucket nor a popular vector makes a large group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column, stage

CELL_ROWS = 16_384
BUCKET_ROWS = 4_096
LEAST_CELLS = 16


@dataclass(frozen=True)
class Tables:
    """Directions and shifts of all tables; the same for the same settings."""

    tables: int = 4
    reach: int = 6
    width: float = 1.8
    probes: int = 130
    seed: int = 7

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Projections in units of the interval width: rows x tables x reach."""
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(size=(x.shape[1], self.tables * self.reach))
        shifts = rng.uniform(0, 1, self.tables * self.reach)
        return (x @ directions / self.width + shifts).reshape(len(x), self.tables, self.reach)


def bucket_codes(cut: np.ndarray) -> np.ndarray:
    """One 64-bit number per row of interval numbers."""
    code = np.zeros(cut.shape[:-1], np.int64)
    for i in range(cut.shape[-1]):
        code = (code * 1_000_003) ^ cut[..., i]
    return code


def probe_order(inside: np.ndarray, most: int) -> Iterator[list[tuple[int, int]]]:
    """Perturbations as lists of (projection, step), the likeliest first.

    `inside` is how far each projection lies in its interval, from 0 to 1. The first is
    the bucket itself.
    """
    yield []
    n = len(inside)
    moves = sorted([(inside[j] ** 2, j, -1) for j in range(n)] + [((1 - inside[j]) ** 2, j, 1) for j in range(n)])
    heap = [(moves[0][0], (0,))]
    found = 1
    while heap and found < most:
        score, chosen = heapq.heappop(heap)
        if len({moves[i][1] for i in chosen}) == len(chosen):
            found += 1
            yield [moves[i][1:] for i in chosen]
        last = chosen[-1] + 1
        if last < 2 * n:
            heapq.heappush(heap, (score - moves[last - 1][0] + moves[last][0], (*chosen[:-1], last)))
            heapq.heappush(heap, (score + moves[last][0], (*chosen, last)))


def _matrix(values: pa.Array) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _padded(x: np.ndarray, norm: float) -> np.ndarray:
    x = x / norm
    rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
    return np.hstack([x, rest[:, None]])


def _valid(df: DataFrame, name: str, vector: str, dimension: int | None = None) -> DataFrame:
    """id and vector of rows that take part, one row per id."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(column(name).cast("long").alias("id"), column(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    if dimension is not None:
        rows = rows.filter(F.size(v) == dimension)
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def search(
    base: DataFrame,
    queries: DataFrame,
    k: int = 20,
    tables: Tables = Tables(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k nearest found.

    Score is the inner product of the vectors as they are, in double precision. Ties go
    to the smaller id. A query never finds its own id; of rows that repeat an id the
    lowest vector counts. Vectors that are null, zero, or hold a null or non-finite
    component take no part, nor do those of another size than most. A query that finds
    fewer than k in its buckets is compared with every row.
    """
    sizes = base.select(F.size(column(vector)).alias("n")).filter("n > 0").groupBy("n").count()
    size = sizes.orderBy(F.desc("count"), "n").first()
    if size is None:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stage(_valid(base, vec_id, vector, size["n"]), "vectors")
    wanted = stage(_valid(queries, vec_id, vector, size["n"]), "queries")
    norm_of = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    norm = rows.agg(F.max(norm_of).alias("m")).first()["m"]
    if norm is None:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _padded(_matrix(batch.column(1)), norm)
                codes = bucket_codes(np.floor(tables.projected(x)).astype(np.int64))
                for t in range(tables.tables):
                    of = pa.array(np.full(batch.num_rows, t, np.int32))
                    yield pa.RecordBatch.from_arrays([of, pa.array(codes[:, t]), *batch.columns], ["of", "bucket", "id", "vector"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            x = _padded(x / np.linalg.norm(x, axis=1, keepdims=True), 1.0)
            where = tables.projected(x)
            cut = np.floor(where)
            for i, name in enumerate(batch.column(0).to_pylist()):
                for t in range(tables.tables):
                    own = cut[i, t].astype(np.int64)
                    steps = list(probe_order(where[i, t] - cut[i, t], tables.probes))
                    boxes = np.tile(own, (len(steps), 1))
                    for row, moves in enumerate(steps):
                        for j, by in moves:
                            boxes[row, j] += by
                    n = len(steps)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, name)), pa.array(np.full(n, t, np.int32)), pa.array(bucket_codes(boxes))],
                        ["id", "of", "bucket"],
                    )

    placed = stage(rows.mapInArrow(hashed, "of int, bucket long, id long, vector array<double>"), "hashed")
    counts = placed.groupBy("of", "bucket").agg(F.count("*").alias("n"))
    counts = stage(counts.withColumn("split", F.ceil(F.col("n") / BUCKET_ROWS).cast("int")).drop("n"), "buckets")
    cells = max(LEAST_CELLS, -(-placed.count() // CELL_ROWS))

    def dealt(df: DataFrame, salt) -> DataFrame:
        code = F.xxhash64("of", "bucket", salt)
        return df.withColumn("code", code).withColumn("cell", F.pmod(F.xxhash64("code"), F.lit(cells)).cast("int"))

    data = dealt(
        placed.join(counts, ["of", "bucket"]), F.pmod(F.xxhash64("id"), F.col("split")).cast("int")
    ).select("cell", "code", "of", "id", "vector")
    visits = wanted.mapInArrow(probed, "id long, of int, bucket long").join(counts, ["of", "bucket"])
    visits = visits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
    visits = dealt(visits, F.col("salt")).groupBy("cell", "id").agg(F.collect_set("code").alias("codes"))
    asked = visits.join(wanted, "id").select("cell", "id", "vector", "codes")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best k of each query (left) among the rows of the cell that it visits."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, ids = _matrix(right["vector"]), right["id"].to_numpy()
        names, of_row = np.unique(right["code"].to_numpy(), return_inverse=True)
        first_table = right["of"].to_numpy() == 0
        # Rows by how often their id came before: a row comes once from each table.
        uniques, of_id = np.unique(ids, return_inverse=True)
        by_id = np.argsort(of_id, kind="stable")
        nth_of_id = np.empty(len(ids), np.int64)
        nth_of_id[by_id] = np.arange(len(ids)) - np.searchsorted(of_id[by_id], of_id[by_id])
        repeats = [np.flatnonzero(nth_of_id == n) for n in range(nth_of_id.max() + 1)]
        q, asks = _matrix(left["vector"]), left["id"].to_numpy()
        codes = left["codes"].combine_chunks()
        out = []
        for a in range(0, len(q), 256):
            part = codes[a : a + 256]
            lengths = np.diff(part.offsets.to_numpy())
            flat = part.flatten().to_numpy()
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
            hit = names[at] == flat
            visited = np.zeros((len(lengths), len(names)), bool)
            visited[row[hit], at[hit]] = True
            seen = visited[:, of_row]
            seen[lengths == 0] = first_table  # compared with every row, each of which is once in a table
            seen &= asks[a : a + 256, None] != ids
            if len(repeats) > 1:
                # A row that several tables offer takes one of the k places.
                taken = np.zeros((len(lengths), len(uniques)), bool)
                for rows_of in repeats:
                    fresh = seen[:, rows_of] & ~taken[:, of_id[rows_of]]
                    seen[:, rows_of] = fresh
                    taken[:, of_id[rows_of]] |= fresh
            s = np.where(seen, q[a : a + 256] @ x.T, -np.inf)
            # Rows of nearly equal product are kept for the exact order.
            low = s.max(axis=1) if s.shape[1] <= 1 else np.partition(s, -min(k, s.shape[1]), axis=1)[:, -min(k, s.shape[1])]
            size = np.linalg.norm(q[a : a + 256], axis=1) * norm
            i, j = np.nonzero((s >= (low - 1e-9 * size)[:, None]) & seen)
            exact = (q[a + i] * x[j]).sum(axis=1)
            order = np.lexsort((ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            nth = np.arange(len(i)) - np.searchsorted(i, i)
            top = nth < k
            out.append((asks[a + i[top]], ids[j[top]], exact[top]))
        return pa.Table.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], schema=schema)

    def ranked(asked: DataFrame) -> DataFrame:
        found = asked.groupBy("cell").cogroup(data.groupBy("cell")).applyInArrow(best, "query_id long, vec_id long, score double")
        return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = stage(top(ranked(asked)), "found")
    there = found.groupBy("query_id").agg(F.count("*").alias("n"))
    others = min(k, rows.count() - 1)
    short = wanted.join(there, F.col("id") == F.col("query_id"), "left")
    short = stage(short.filter(F.coalesce("n", F.lit(0)) < others).select("id", "vector"), "short")
    if not short.isEmpty():
        everywhere = short.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
        nowhere = F.array().cast("array<bigint>").alias("codes")
        again = top(ranked(everywhere.select("cell", "id", "vector", nowhere)))
        found = found.join(short, F.col("query_id") == F.col("id"), "left_anti").unionByName(again)
    return found.select("query_id", "rank", F.col("vec_id").alias(vec_id), "score")
