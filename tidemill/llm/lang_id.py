"""Language identification in two steps: the family, then the language within it.

Texts are vectors of hashed byte trigrams (square roots of their shares, so every vector
has length one). A linear support vector machine per family, one against the rest, picks
the family. Within a family, one-versus-one machines separate its languages and the one
with most votes wins, ties going to the larger sum of margins. All weights together are
a small matrix, so a batch of texts is one matrix product.

Machines are fitted on a bounded sample: at most `per_language` texts of each of the
`most_languages` languages with most rows, taken by the lowest hash of id and text.
Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column, free_name

# Families of languages by code. A code not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "baltic": ("lt", "lv"),
}
UNKNOWN = "und"
DIMENSIONS = 1 << 13


def family_of(lang: str) -> str:
    for family, members in FAMILIES.items():
        if lang.lower().split("-")[0].split("_")[0] in members:
            return family
    return lang


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vectors(texts: list[str]) -> np.ndarray:
    """One row of unit length per text, from the byte trigrams of the whole text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        # Case and runs of digits and signs say little of a language.
        raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)
        kept = raw[(raw >= 97) & (raw <= 122) | (raw >= 128) | (raw == 32)].astype(np.uint32)
        if len(kept) < 3:
            continue
        code = kept[:-2] * 0x9E3779B1 + kept[1:-1] * 0x85EBCA6B + kept[2:] * 0xC2B2AE35
        counts = np.bincount((code ^ (code >> 15)) % DIMENSIONS, minlength=DIMENSIONS)
        out[i] = np.sqrt(counts / counts.sum())
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 120) -> np.ndarray:
    """Weights and intercept of a linear machine with squared hinge loss; y is -1 or 1.

    Both sides weigh the same whatever their numbers. Accelerated gradient steps.
    """
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, t = w.copy(), 1.0
    step = 1 / (2 * 2.0 + 2 * penalty)
    for _ in range(rounds):
        margin = y * (x @ ahead[:-1] + ahead[-1])
        pull = (-2 * share * y * np.maximum(0, 1 - margin)).astype(np.float32)
        grad = np.append(x.T @ pull + 2 * penalty * ahead[:-1], pull.sum())
        new = ahead - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Machines of both steps. `pairs` holds (family, first language, second language)."""

    families: tuple[str, ...]
    members: dict[str, tuple[str, ...]]
    pairs: tuple[tuple[str, str, str], ...]
    weights: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and a score between 0 and 1 for each row."""
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        f = len(self.families)
        family = np.argmax(margins[:, :f], axis=1)
        langs = np.empty(len(x), object)
        best = np.take_along_axis(margins[:, :f], family[:, None], 1)[:, 0]
        score = 1 / (1 + np.exp(-4 * best)) if f > 1 else np.ones(len(x))
        for i, name in enumerate(self.families):
            rows = np.flatnonzero(family == i)
            own = self.members[name]
            votes = np.zeros((len(rows), len(own)))
            sums = np.zeros((len(rows), len(own)))
            for j, (of, a, b) in enumerate(self.pairs):
                if of == name:
                    m = margins[rows, f + j]
                    for lang, sign in ((a, 1), (b, -1)):
                        votes[:, own.index(lang)] += m * sign > 0
                        sums[:, own.index(lang)] += m * sign
            pick = np.argmax(votes + 1e-3 * np.tanh(sums), axis=1)
            langs[rows] = np.array(own, object)[pick]
            if len(own) > 1:
                sure = np.take_along_axis(sums, pick[:, None], 1)[:, 0] / (len(own) - 1)
                score[rows] *= 1 / (1 + np.exp(-4 * sure))
        return langs, score


def fit(texts: list[str], langs: list[str]) -> Model | None:
    """Machines for the languages that occur; None if there is no text to learn from."""
    return fit_vectors(vectors(texts), langs)


def fit_vectors(x: np.ndarray, langs: list[str]) -> Model | None:
    """`fit` on the texts' vectors."""
    if not len(x):
        return None
    lang = np.array(langs, object)
    members: dict[str, tuple[str, ...]] = {}
    for name in sorted(set(langs)):
        members[family_of(name)] = (*members.get(family_of(name), ()), name)
    families = tuple(sorted(members))
    family = np.array([family_of(v) for v in langs], object)
    rows, pairs = [], []
    for name in families:
        rows.append(fit_machine(x, np.where(family == name, 1.0, -1.0)) if len(families) > 1 else np.zeros(DIMENSIONS + 1, np.float32))
    for name in families:
        own = members[name]
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                some = (lang == a) | (lang == b)
                rows.append(fit_machine(x[some], np.where(lang[some] == a, 1.0, -1.0)))
                pairs.append((name, a, b))
    return Model(families, members, tuple(pairs), np.stack(rows))


def sampled(
    docs: DataFrame,
    per_language: int = 1000,
    most_languages: int = 200,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """lang, order and text of a bounded sample of rows with a text with letters and a language.

    Of the languages with most rows, `most_languages` at most, each gives the rows of its
    `per_language` lowest hashes (order) of id and text. Repeated rows count once.
    """
    named = docs.select(column(text).alias("text"), column(lang).alias("lang"), F.xxhash64(column(doc_id), column(text)).alias("order"))
    usable = named.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    seen = usable.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("n"))
    seen = seen.orderBy(F.desc("n"), "lang").limit(most_languages)
    # Only hashes that can be among the lowest are ranked: half more than wanted, as numbers
    # are estimates, so a bounded number of rows of a language meet in a task.
    place = F.col("order") / F.lit(2.0**64) + F.lit(0.5)
    low = usable.join(F.broadcast(seen), "lang").filter(place <= F.lit(1.5 * per_language + 100) / F.col("n"))
    first = Window.partitionBy("lang").orderBy("order")
    ranked = low.select("lang", "order", "text").dropDuplicates(["lang", "order"]).withColumn("nth", F.row_number().over(first))
    return ranked.filter(F.col("nth") <= per_language).select("lang", "order", "text")


def fit_sample(docs: DataFrame, **options) -> Model | None:
    """Fit on the sample that `sampled` takes. Texts become features in the tasks."""
    sample = sampled(docs, **options)
    # At most DIMENSIONS features for each text of the sample, however long it is.
    rows = sample.mapInArrow(_hashed, "lang string, order long, names array<int>, shares array<float>").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("order", "ascending")])
    x = np.zeros((rows.num_rows, DIMENSIONS), np.float32)
    names, shares = rows["names"].combine_chunks(), rows["shares"].combine_chunks()
    for i in range(rows.num_rows):
        x[i, names[i].values.to_numpy()] = shares[i].values.to_numpy()
    return fit_vectors(x, rows["lang"].to_pylist())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [vectors([text.as_py()])[0] for text in batch.column(2)]
        names = [np.flatnonzero(row).astype(np.int32) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column(0), pa.string()),
                batch.column(1),
                pa.array(names, pa.list_(pa.int32())),
                pa.array([row[n] for row, n in zip(rows, names)], pa.list_(pa.float32())),
            ],
            ["lang", "order", "names", "shares"],
        )


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, which replace columns of those names.

    `und` and 0 for a null text, a text without letters, or where nothing was learned.
    """

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs = np.full(len(batch), UNKNOWN, object)
            score = np.zeros(len(batch))
            known = np.array([has_letter(t) for t in batch], bool)
            if model is not None:
                rows = np.flatnonzero(known)
                for i in range(0, len(rows), 256):
                    some = rows[i : i + 256]
                    langs[some], score[some] = model.predict(vectors([batch.iat[k] for k in some]))
            yield pd.DataFrame({"lang_pred": langs, "score": np.clip(score, 0, 1)})

    held = free_name(docs, "guess")
    others = [column(c) for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.withColumn(held, guess(column(text))).select(*others, f"{held}.lang_pred", f"{held}.score")
