"""A graded quality classifier: ordinal regression with cumulative links.

A text is scored once, by a weight per hashed feature of the whole text; ordered
thresholds cut the score into grades: P(grade > k) = sigmoid(score - threshold k). The
weights are shared by all grades. From the probabilities follow the expected grade and,
for selection, the probability of reaching a grade.

Grades are 0 (low quality), 1 (toxic) and 2 (good). The regression is fitted on a
bounded sample of rated texts, at most `per_grade` of each grade by the lowest hash;
scoring covers whole texts of all rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column, free_name, stage

DIMENSIONS = 1 << 18
GRADES = 3
# Least chi-square between a feature's presence and the grade; below it the weight is 0.
# Chance alone passes it for one feature in two million.
LEAST_CHI_SQUARE = 29.0

_SIGNS = re.compile(r"[^\w\s]+")
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values, the strongest known set for short and long texts.

    Words without signs at their edges count once each; what describes the manner of
    the text (signs, capitals, words said again at once) counts by its share of words.
    """
    words = (text or "").split()
    if not words:
        return np.array([zlib.crc32(b"empty") % DIMENSIONS]), np.ones(1)
    n = len(words)
    bare = {w.strip(_EDGES).lower() for w in words}
    names = [zlib.crc32(b"w" + w.encode("utf-8", "replace")) % DIMENSIONS for w in bare]
    # The first letters bring the forms of a word together.
    names += [zlib.crc32(b"p" + p.encode("utf-8", "replace")) % DIMENSIONS for p in {w[:4] for w in bare if len(w) > 4}]
    values = [1.0] * len(names)
    signs: dict[str, int] = {}
    for run in _SIGNS.findall(text):
        key = run[:3]
        signs[key] = signs.get(key, 0) + 1
    manner = {f"s{k}": v / n for k, v in signs.items()}
    manner["capitals"] = sum(map(str.isupper, words)) / n
    manner["again"] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    manner["variety"] = len(bare) / n if n >= 20 else 0.0
    manner["length"] = min(n, 200) / 200
    for k, v in manner.items():
        if v > 0:
            names.append(zlib.crc32(b"m" + k.encode("utf-8", "replace")) % DIMENSIONS)
            values.append(4.0 * min(v, 1.0) ** 0.5)
    return np.array(names), np.array(values)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) per text and k."""
        score = np.empty(len(texts))
        for i, text in enumerate(texts):
            names, values = features(text)
            score[i] = self.weights[names] @ values
        return _sigmoid(score[:, None] - self.thresholds)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _telling(seen: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Which features go with a grade more than chance has it, from the number of texts
    of each grade that hold them.

    Without this choice the many words that say nothing add up to noise in long texts.
    """
    share = grades / grades.sum()
    total = seen.sum(axis=1, keepdims=True)
    expected = np.maximum(total * share, 1e-12)
    spread = np.maximum(1 - total / grades.sum(), 1e-6)  # a feature of all texts tells nothing
    chi = ((seen - expected) ** 2 / (expected * spread)).sum(axis=1)
    return (chi >= LEAST_CHI_SQUARE) & (total[:, 0] >= 3)


def fit(texts: list[str | None], grades: list[int], **options) -> Model | None:
    """`fit_rows` on the telling features of some texts."""
    grade = np.array(grades)
    rows = [features(t) for t in texts]
    own = [np.unique(names) for names, _ in rows]
    of = np.repeat(grade, [len(names) for names in own])
    seen = np.bincount(np.concatenate(own) * GRADES + of, minlength=DIMENSIONS * GRADES)
    usual = _telling(seen.reshape(DIMENSIONS, GRADES).astype(float), np.bincount(grade, minlength=GRADES))
    return fit_rows([(names[usual[names]], values[usual[names]]) for names, values in rows], grades, **options)


def fit_rows(
    rows: list[tuple[np.ndarray, np.ndarray]],
    grades: list[int],
    rounds: int = 15,
    rate: float = 0.3,
    penalty: float = 1e-4,
    prior: list[int] | None = None,
) -> Model | None:
    """Adaptive gradient descent on the ordinal likelihood, in a fixed random order.

    `rows` holds features and values of every rated text. `prior`: how often each grade
    occurs among all ratings; a sample that holds another mix is weighted back to it.
    None if fewer than two grades occur.
    """
    grade = np.array(grades)
    if len(set(grades)) < 2:
        return None
    counts = np.bincount(grade, minlength=GRADES)
    weight = np.array(counts if prior is None else prior) / np.maximum(counts, 1)
    weight = (weight / (weight * counts).sum() * len(grade))[grade]
    w, g2 = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-6)
    base, gap = -1.0, np.zeros(GRADES - 2)  # thresholds: base, base + exp(gap), ...
    tg2 = np.full(GRADES - 1, 1e-6)
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for chunk in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            theta = base + np.concatenate([[0.0], np.cumsum(np.exp(gap))])
            sizes = [len(rows[i][0]) for i in chunk]
            names = np.concatenate([rows[i][0] for i in chunk])
            values = np.concatenate([rows[i][1] for i in chunk])
            of = np.repeat(np.arange(len(chunk)), sizes)
            score = np.bincount(of, w[names] * values, len(chunk))
            # P(y = k) = S(k-1) - S(k) with S(-1) = 1 and S(last) = 0.
            s = _sigmoid(score[:, None] - theta)
            upper = np.hstack([np.ones((len(chunk), 1)), s])
            lower = np.hstack([s, np.zeros((len(chunk), 1))])
            y = grade[chunk]
            at = np.arange(len(chunk))
            u, v = upper[at, y], lower[at, y]
            p = np.maximum(u - v, 1e-9)
            du, dv = u * (1 - u) / p, v * (1 - v) / p
            k = weight[chunk] / len(chunk)
            dscore = -(du - dv) * k  # of the negative log likelihood
            touched, back = np.unique(names, return_inverse=True)
            grad = np.bincount(back, dscore[of] * values) + penalty * w[touched]
            g2[touched] += grad * grad
            w[touched] -= rate * grad / np.sqrt(g2[touched])
            dtheta = np.zeros(GRADES - 1)
            for j in range(GRADES - 1):
                dtheta[j] = ((y == j + 1) * du * k).sum() - ((y == j) * dv * k).sum()
            steps = np.concatenate([[dtheta.sum()], [dtheta[j + 1 :].sum() * np.exp(gap[j]) for j in range(GRADES - 2)]])
            tg2 += steps * steps
            move = rate * steps / np.sqrt(tg2)
            base -= move[0]
            gap -= move[1:]
    return Model(w.astype(np.float32), base + np.concatenate([[0.0], np.cumsum(np.exp(gap))]))


def grade_of(quality: Column, toxic: Column) -> Column:
    """The grade of a rating; null where the quality is unknown."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def sampled(
    docs: DataFrame, labels: DataFrame, per_grade: int = 3000, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(id, grade, text) of a bounded sample, and (id, grade) of all rated documents.

    Of several ratings of a document the lowest counts. Of rows that repeat an id the
    text with the lowest hash counts.
    """
    rated = (
        labels.select(F.col("doc_id").alias("id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
        .filter(F.col("grade").isNotNull() & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("grade").alias("grade"))
    )
    # Only hashes that can be among the lowest are ranked: a fifth more than wanted and a
    # few hundred, so some thousand rows of a grade meet in a task, however many it has.
    totals = rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n"))  # a row per grade
    place = F.xxhash64("id") / F.lit(2.0**64) + F.lit(0.5)
    low = rated.join(F.broadcast(totals), "grade").filter(place <= F.lit(1.2 * per_grade + 200) / F.col("n"))
    first = Window.partitionBy("grade").orderBy(F.xxhash64("id"), "id")
    chosen = low.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_grade)
    # At most per_grade rows for each grade: small enough to send to every task.
    sample = docs.select(column(doc_id).alias("id"), column(text).alias("text")).join(
        F.broadcast(chosen.select("id", "grade")), "id"
    )
    # One row an id, so that the sample is bounded whatever repeats.
    sample = sample.groupBy("id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return sample, rated


def fit_sample(docs: DataFrame, labels: DataFrame, per_grade: int = 3000, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """Fit on a bounded sample, as `sampled` takes it.

    Texts become features in the tasks. The driver gets the number of texts by feature
    and grade, and of each text the features that tell something.
    """
    sample, rated = sampled(docs, labels, per_grade, doc_id, text)
    held = stage(sample.mapInArrow(_hashed, "id long, grade int, names array<int>, values array<double>"), "features")
    # Texts of each grade by feature: at most DIMENSIONS rows, whatever the texts.
    counts = [F.count_if(F.col("grade") == g).alias(f"grade{g}") for g in range(GRADES)]
    seen = np.zeros((DIMENSIONS, GRADES))
    found = held.select("grade", F.explode(F.array_distinct("names")).alias("name")).groupBy("name").agg(*counts)
    for batch in found.toArrow().to_batches():
        seen[batch.column(0).to_numpy()] = np.column_stack([batch.column(1 + g).to_numpy() for g in range(GRADES)])
    grades = held.agg(*counts).first()
    usual = _telling(seen, np.array(grades, float)) if sum(grades) else np.zeros(DIMENSIONS, bool)
    # Only the telling features of the sample's texts come to the driver.
    told = held.mapInArrow(_only(usual), held.schema).orderBy("id", "grade").toArrow()
    names, values = told.column("names").combine_chunks(), told.column("values").combine_chunks()
    rows = [(n.values.to_numpy(), v.values.to_numpy()) for n, v in zip(names, values)]
    prior = [0] * GRADES
    for row in rated.groupBy("grade").count().collect():  # a row per grade
        prior[row["grade"]] = row["count"]
    return fit_rows(rows, told.column("grade").to_pylist(), prior=prior)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of texts, each value still in its place."""
    for batch in batches:
        rows = [features(text.as_py()) for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column(0), pa.int64()),
                pa.array(batch.column(1), pa.int32()),
                pa.array([n for n, _ in rows], pa.list_(pa.int32())),
                pa.array([v for _, v in rows], pa.list_(pa.float64())),
            ],
            ["id", "grade", "names", "values"],
        )


def _only(usual: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the chosen features alone."""
    packed = np.packbits(usual)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.unpackbits(packed).astype(bool)
        for batch in batches:
            names, values = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [chosen[n] for n in names]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([np.array(n, np.int32)[k] for n, k in zip(names, keep)], pa.list_(pa.int32())),
                    pa.array([np.array(v)[k] for v, k in zip(values, keep)], pa.list_(pa.float64())),
                ],
                ["id", "grade", "names", "values"],
            )

    return run


def score(docs: DataFrame, model: Model | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """`docs` with expected_grade, tail_prob (of the top grade) and accepted.

    These replace columns of the same names.
    Null texts are scored as empty ones. Without a model nothing is known: the grade
    and the probability are null and every document is accepted.
    """

    @F.pandas_udf("expected_grade double, tail_prob double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            above = model.above(batch.tolist())
            yield pd.DataFrame({"expected_grade": above.sum(axis=1), "tail_prob": above[:, -1]})

    held = free_name(docs, "rating")
    nothing = F.lit(None).cast("double")
    unknown = F.struct(nothing.alias("expected_grade"), nothing.alias("tail_prob"))
    out = docs.withColumn(held, unknown if model is None else rate(column(text)))
    added = ("expected_grade", "tail_prob", "accepted")
    return out.select(
        *(column(c) for c in docs.columns if c.lower() not in added),
        F.col(f"{held}.expected_grade"),
        F.col(f"{held}.tail_prob"),
        F.coalesce(F.col(f"{held}.tail_prob") >= least, F.lit(True)).alias("accepted"),
    )
