"""Quality rules whose cutoffs carry an exact bound on false rejections.

Every rule compares a measure of a text with its limit; a document's severity is the
largest ratio of measure to limit. Labelled documents decide how severe is too severe:
a cutoff is certified for a stratum if an exact binomial test, corrected for the number
of strata and cutoffs tried, shows that it rejects at most a share `risk` of the good
documents there. Of the certified cutoffs the one that parts good from bad best is used.
A stratum with too few labels for any certificate loses no document to the rules.

Everything is built from DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import WORD_BREAK, column, let, stage

# Characters counted as symbols, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

WORD_SPACE = " \t\n\x0b\f\r"
SERIES_TERMS = 4000


@dataclass(frozen=True)
class Policy:
    """`limits`: what each measure may reach at severity 1. `cutoffs`: severities tried.

    `risk`: largest share of good documents that may be rejected in a stratum, which
    holds for all strata together with probability 1 - `doubt` over the labels.
    """

    limits: tuple[tuple[str, float], ...] = (
        ("symbol_share", 0.05),
        ("upper_share", 0.40),
        ("shout_share", 0.30),
        ("dup_line_share", 0.30),
        ("repeat_share", 0.30),
        ("long_word_mean", 14.0),
    )
    cutoffs: tuple[float, ...] = (0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0, 4.0)
    risk: float = 0.01
    doubt: float = 0.05


def _by_words(words: Column) -> Column:
    """Number of words, and of words inside 3-word windows that occur again.

    Each window becomes one number: hash bits above, position below. Sorting brings
    equal windows together in n log n steps. Neighbours with equal hash bits are then
    compared word by word, so no collision counts as a repeat.
    """

    def repeated(w: Column, n: Column, bits: Column) -> Column:
        def code(i):
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            high = F.call_function("shiftrightunsigned", h, bits + 1)
            return F.call_function("shiftleft", high, bits).bitwiseOR(i.cast("long"))

        def at(x):
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            return x.bitwiseAND(mask).cast("int")

        def same(x, y):
            bucket = F.call_function("shiftright", x.bitwiseXOR(y), bits) == 0
            words_equal = (
                (F.get(w, at(x)) == F.get(w, at(y)))
                & (F.get(w, at(x) + 1) == F.get(w, at(y) + 1))
                & (F.get(w, at(x) + 2) == F.get(w, at(y) + 2))
            )
            return F.when(bucket, words_equal).otherwise(False)

        def again(s):
            return F.filter(
                s,
                lambda x, j: F.when(j > 0, same(x, F.get(s, j - 1))).otherwise(False)
                | F.when(j < n - 3, same(x, F.get(s, j + 1))).otherwise(False),
            )

        def covered(places):
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
            return F.aggregate(
                places,
                start,
                lambda acc, i: F.struct(
                    i.alias("last"),
                    (acc["total"] + F.least(F.lit(3), i - acc["last"])).alias("total"),
                ),
                lambda acc: acc["total"],
            )

        codes = F.transform(F.sequence(F.lit(0), n - 3), code)
        places = let(F.sort_array(codes), again)
        return covered(F.sort_array(F.transform(places, at)))

    return let(
        words,
        lambda w: let(
            F.size(w),
            lambda n: F.struct(
                n.cast("long").alias("n_words"),
                F.when(n < 3, F.lit(0))
                .otherwise(let(F.length(F.bin(n)), lambda bits: repeated(w, n, bits)))
                .cast("long")
                .alias("n_repeat_words"),
            ),
        ),
    )


def measures(df: DataFrame, text: str = "text", name: str = "measures") -> DataFrame:
    """`df` and a struct `name` of counts over the whole text; null counts as empty."""
    body = F.coalesce(column(text), F.lit(""))
    words = F.array_remove(F.split(body, WORD_BREAK), "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, WORD_SPACE, "") != "")
    without = lambda chars: F.length(F.translate(body, chars, ""))
    return df.withColumn(
        name,
        let(
            _by_words(words),
            lambda by_words: F.struct(
                by_words["n_words"].alias("n_words"),
                without(WORD_SPACE).cast("long").alias("word_chars"),
                (F.length(body) - without(SYMBOLS)).cast("long").alias("n_symbols"),
                let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
                .cast("long")
                .alias("n_dup_lines"),
                by_words["n_repeat_words"].alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                (F.length(body) - F.length(F.regexp_replace(body, r"\p{Lu}+", "")))
                .cast("long")
                .alias("n_upper"),
                (F.length(body) - without("!")).cast("long").alias("n_shouts"),
            ),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (
        100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"]
    )


def severity(m: Column, policy: Policy) -> Column:
    """Largest ratio of a measure to its limit."""
    share = lambda a, b: F.when(m[b] > 0, m[a] / m[b]).otherwise(F.lit(0.0))
    value = {
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "shout_share": share("n_shouts", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "long_word_mean": share("word_chars", "n_words"),
    }
    return F.greatest(F.lit(0.0), *(value[k] / limit for k, limit in policy.limits))


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = (
        x * F.log(x)
        - x
        + 0.5 * F.log(2 * math.pi * x)
        + 1 / (12 * x)
        - 1 / (360 * F.pow(x, 3.0))
        + 1 / (1260 * F.pow(x, 5.0))
    )
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p); 1 where k is at least the mean.

    Summed downwards from k, where the terms fall off. What lies beyond the last term
    taken is replaced by a geometric bound, so the value never comes out too small.
    """
    top = (
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + k * math.log(p)
        + (n - k) * math.log1p(-p)
    )
    ratio = lambda i: i / (n - i + 1) * ((1 - p) / p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    terms = F.when(
        k >= 1, F.sequence(F.lit(0), F.least(k - 1, F.lit(SERIES_TERMS)).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(
        terms,
        start,
        lambda acc, i: F.struct(
            (acc["term"] * ratio(k - i)).alias("term"),
            (acc["total"] + acc["term"] * ratio(k - i)).alias("total"),
        ),
    )
    rest = F.when(k - 1 > SERIES_TERMS, series["term"] / (1 - ratio(k))).otherwise(F.lit(0.0))
    tail = F.exp(top) * (series["total"] + rest)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail))


def certified_cutoffs(labelled: DataFrame, policy: Policy) -> DataFrame:
    """One row per stratum with a certified cutoff: stratum, cutoff.

    `labelled` holds stratum, severity and quality (1 good, 0 bad; others are left out).
    Counts are added up before the shuffle, whatever a stratum's size.
    """
    tried = F.explode(F.array(*map(F.lit, policy.cutoffs))).alias("cutoff")
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    counts = [F.sum(good.cast("long")).alias("good"), F.sum(bad.cast("long")).alias("bad")]
    for i, t in enumerate(policy.cutoffs):
        over = F.col("severity") > t
        counts += [
            F.sum((good & over).cast("long")).alias(f"good_{i}"),
            F.sum((bad & over).cast("long")).alias(f"bad_{i}"),
        ]
    per_stratum = labelled.filter(good | bad).groupBy("stratum").agg(*counts)
    n_strata = per_stratum.agg(F.count("*").alias("strata"))
    pick = lambda kind: F.element_at(
        F.array(*(F.col(f"{kind}_{i}") for i in range(len(policy.cutoffs)))),
        F.array_position(F.array(*map(F.lit, policy.cutoffs)), F.col("cutoff")).cast("int"),
    )
    tests = (
        per_stratum.select("*", tried)
        .withColumns({"k": pick("good"), "caught": pick("bad")})
        .crossJoin(n_strata)  # one row
        .withColumn("p_value", at_most(F.col("k"), F.col("good"), policy.risk))
        .filter(F.col("p_value") * F.col("strata") * len(policy.cutoffs) <= policy.doubt)
    )
    gain = F.col("caught") / F.greatest(F.col("bad"), F.lit(1)) - F.col("k") / F.col("good")
    best = F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("best")
    return tests.groupBy("stratum").agg(best).select("stratum", F.col("best.cutoff").alias("cutoff"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    policy: Policy = Policy(),
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: doc_id, the columns `keep`, counts, base_failed, kept.

    A null text counts as empty and fails the base rule. A null stratum is a stratum of
    its own, a null or doubled id keeps its own row, null labels are left out, and a
    document with several labels counts by its lowest. Empty tables give no rows, or
    the base rule's verdict where only labels are missing.
    """
    own = [column(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    measured = measures(docs.select(column(doc_id).alias("id"), column(text).alias("text"), column(stratum).alias("stratum"), *own))
    m = F.col("measures")
    judged = stage(
        measured.select(
            "id",
            "stratum",
            *(f"keep_{i}" for i in range(len(keep))),
            "measures",
            severity(m, policy).alias("severity"),
            base_failed(m).alias("base_failed"),
        ),
        "rules",
    )
    grades = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality"))
        .filter(F.col("quality").isNotNull())
        .groupBy("id")
        .agg(F.min("quality").alias("quality"))
    )
    sound = judged.filter(~F.col("base_failed")).select("id", "stratum", "severity")
    cutoffs = stage(certified_cutoffs(sound.join(grades, "id"), policy), "cutoffs")
    limit = cutoffs.select(F.col("stratum").alias("of"), "cutoff")
    out = judged.join(limit, F.col("stratum").eqNullSafe(F.col("of")), "left")
    within = F.coalesce(F.col("severity") <= F.col("cutoff"), F.lit(True))
    return out.select(
        F.col("id").alias(doc_id),
        *(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)),
        *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed",
        (~F.col("base_failed") & within).alias("kept"),
        "severity",
        "cutoff",
    )
