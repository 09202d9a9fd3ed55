"""Document fingerprints by winnowing, and how alike the fingerprints of neighbours are.

The k-grams of a text are hashed by a rolling polynomial; of every window of `window`
hashes in a row the least is kept, the rightmost one if several are least, together with
its place. Two texts that share a passage of `k + window - 1` characters therefore share
a fingerprint, and none is kept of a passage shorter than `k`. Places let a reader find
the passage again.

Documents are compared with their successor in the order of ids. They are dealt out by
ranges of the id, whose ends are quantiles of all ids, and go through a task from the
largest id to the smallest, so that the successor is the text just seen; only the first
text of each range is sent to one more task. An id that holds more rows than a range
does is a range of its own and dealt to several tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import column

# Of a text to be read at a time, in code points; bounds the arrays made of it.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Winnow:
    """`k` characters a gram and `window` grams a window: passages of `k + window - 1`
    characters are never missed."""

    k: int = 16
    window: int = 33

    def hashes(self, points: np.ndarray) -> np.ndarray:
        """A 32-bit hash of every k-gram, or one of the whole text if it is shorter.

        The polynomial of a gram is put together from those of its halves, so a text
        takes a few operations on whole arrays instead of one step per character.
        """
        if not len(points):
            return np.empty(0, np.uint64)
        k = min(self.k, len(points))
        with np.errstate(over="ignore"):
            part, power, width = _mixed(points.astype(np.uint64) + np.uint64(1)), _BASE, 1
            whole, covered = None, 0
            while True:
                if k & width:
                    whole = part if whole is None else _joined(whole, covered, part, power)
                    covered += width
                if covered == k:
                    return _mixed(whole[: len(points) - k + 1]) >> np.uint64(32)
                part = _joined(part, width, part, power)
                power, width = power * power % (1 << 64), 2 * width

    def select(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, places) of the fingerprints, in the order of their places."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        overlap, last = self.k + self.window - 2, -1
        for start in range(0, max(len(points) - overlap, 1), SLICE):
            hashes = self.hashes(points[start : start + SLICE + overlap])
            if not len(hashes):
                break
            # The place, counted from the right, decides between equal hashes.
            ranked = hashes << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)[::-1]
            least = _sliding_min(ranked, min(self.window, len(ranked)))
            least = least[np.concatenate(([True], least[1:] != least[:-1]))]
            places = start + len(hashes) - 1 - (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            new = places > last
            found.append(((least >> np.uint64(32))[new], places[new]))
            last = int(places[-1])
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.concatenate([h for h, _ in found]), np.concatenate([p for _, p in found])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _joined(left: np.ndarray, width: int, right: np.ndarray, power: int) -> np.ndarray:
    """Polynomials of grams `width` long followed by grams to which `power` belongs."""
    n = min(len(left), len(right) - width)
    return left[:n] * np.uint64(power) + right[width : width + n]


def _sliding_min(values: np.ndarray, window: int) -> np.ndarray:
    size = 1
    least = values
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = window - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_of(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """`hash:place` of every fingerprint, the hash in eight hex digits."""
    hashes, places = fingerprint
    return " ".join(map("%08x:%d".__mod__, zip(hashes.tolist(), places.tolist())))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the larger set of hashes that both hold; 1 if neither holds any."""
    a, b = np.unique(a), np.unique(b)
    most = max(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / most if most else 1.0


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of another."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_neighbours(
    docs: DataFrame, winnow: Winnow = Winnow(), doc_id: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    The edited text ends in the beginning of the next document: the one with the next
    larger id, after the last the first. Null texts are empty. Null ids come before all
    others. Rows of one id have the same successor, the first row of the next id, and
    are represented by their text of lowest hash; a single id follows itself. Texts
    without a character have an empty fingerprint, texts shorter than a k-gram a single
    one. No documents give no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    own = docs.select(column(doc_id).cast("long").alias("id"), F.coalesce(column(text), F.lit("")).alias("text"))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts, shares, null_share = _ranges(own, ranges)
    if not starts and not null_share:
        return spark.createDataFrame([], _ROWS)

    # Range 0 holds null ids, range i the ids from starts[i - 1] on.
    number = F.when(F.col("id").isNull(), 0).otherwise(_upto(starts, F.col("id")))
    tasks = [null_share, *shares]
    salt = F.monotonically_increasing_id() % F.get(F.array(*map(F.lit, tasks)), F.col("range")).cast("long")
    dealt = own.withColumn("range", number).withColumn("salt", salt.cast("int")).withColumn("ahead", F.lit(False))

    # The first text of a range goes ahead of the range before; that of the first, of the last.
    present = [i for i, n in enumerate(tasks) if n]
    before = dict(zip(present, [present[-1], *present[:-1]]))
    target = F.get(F.array(*[F.lit(before.get(i)) for i in range(len(tasks))]), number)
    heads = _heads(own, starts, bool(null_share)).withColumn("range", target)
    salts = F.sequence(F.lit(0), F.get(F.array(*map(F.lit, tasks)), F.col("range")) - 1)
    heads = heads.withColumn("salt", F.explode(salts)).withColumn("ahead", F.lit(True))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = key = None
        following = first = None
        for batch in rows:
            out: list[tuple] = []
            held = 0
            columns = (batch.column(i) for i in range(5))
            for name, body, part, nth, ahead in zip(*map(_values, columns)):
                if ahead:
                    at, following, first, key = (part, nth), _read(body, winnow), None, None
                    continue
                if (part, nth) != at:
                    raise ValueError("a range of documents without its successor")
                mine = _read(body, winnow)
                if first is not None and name != key:
                    following = first
                key, first = name, mine
                changed = edited(body, following[0])
                marks = mine[1] if changed == body else winnow.select(code_points(changed))
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                near = likeness(mine[1][0], marks[0]), likeness(mine[1][0], following[1][0])
                out.append((name, len(body), digest, text_of(mine[1]), text_of(marks), *near))
                held += len(body)
                if held > SLICE:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)

    both = dealt.unionByName(heads)
    order = [F.col("range"), F.col("salt"), F.desc("ahead"), F.desc_nulls_last("id"), F.xxhash64("text").desc(), F.desc("text")]
    found = both.repartition(max(ranges, 1), "range", "salt").sortWithinPartitions(*order).mapInArrow(run, _ROWS)
    return found.withColumnRenamed("doc_id", doc_id)


def _read(body: str, winnow: Winnow) -> tuple[str, tuple[np.ndarray, np.ndarray]]:
    return body, winnow.select(code_points(body))


def _values(values: pa.Array) -> Iterator:
    """One value after the other, so that not all texts of a batch are held twice."""
    return (value.as_py() for value in values)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _upto(starts: list[int], value: Column) -> Column:
    """How many of the sorted starts are not above the value, by bisection."""
    if not starts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(starts).bit_length()))]
    held = F.array(*map(F.lit, starts))
    further = lambda at, step: F.coalesce(F.get(held, at + step - 1) <= value, F.lit(False))
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at)
    )


def _ranges(docs: DataFrame, ranges: int) -> tuple[list[int], list[int], int]:
    """First id of every range, the tasks that each is dealt to, and those of null ids.

    The quantiles are ids of documents, found over all of them in a scan of the ids
    alone. An id that is several quantiles in a row holds the rows of several ranges;
    the next id starts a range, too, so that it shares a range with no other id.
    """
    steps = [i / ranges for i in range(ranges)]
    quantiles, least, rows, filled = docs.agg(
        F.percentile_approx("id", steps, 100 * ranges), F.min("id"), F.count(F.lit(1)), F.count("id")
    ).head()
    nulls = -(-(rows - filled) * ranges // rows) if rows else 0
    times: dict[int, int] = {}
    for value in quantiles or []:
        times[value] = times.get(value, 0) + 1
    often = [v for v, n in times.items() if n > 1]
    if often:
        after = docs.agg(*[F.min(F.when(F.col("id") > v, F.col("id"))).alias(f"after{i}") for i, v in enumerate(often)])
        for value in after.head():
            if value is not None:
                times.setdefault(value, 1)
    if filled:
        times.setdefault(least, 1)  # however the quantiles are rounded
    starts = sorted(times)
    return starts, [times[s] for s in starts], nulls


def _heads(docs: DataFrame, starts: list[int], nulls: bool) -> DataFrame:
    """The text of lowest hash of the first id of every range: a row a range."""
    wanted = F.lit(False) if not starts else F.col("id").isin(*starts)
    if nulls:
        wanted = F.col("id").isNull() | wanted
    found = docs.filter(wanted).groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return found.select("id", "text")
