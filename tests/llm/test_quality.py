"""Quality rules and the graded classifier."""

import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from tidemill.llm import quality_model, quality_rules


def counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.sub("[\x20\x09-\x0d]", "", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)
    )


def test_counts_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = [(-1, None), (-2, ""), (-3, "a b c"), (-4, "a b c a b c"), (-5, "x " * 9000), (-6, "a\n\na\n \na b\x0b\f"), (-7, "é ü é ü é ü ñ")]
    docs = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in docs.collect():
        want = counts(row["text"])
        have = got[row["doc_id"]]
        assert tuple(have[n] for n in names) == want, row["doc_id"]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert have["base_failed"] == failed and not (failed and have["kept"])


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (300, 1, 0.01), (1000, 3, 0.01), (5000, 40, 0.01), (20, 19, 0.99), (7, 7, 0.5)])
def test_binomial_bound(spark, n, k, p):
    got = spark.range(1).select(quality_rules.at_most(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("p")).first()["p"]
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
    assert got == pytest.approx(exact, rel=1e-9)


def test_cutoffs_are_certified_or_absent(spark):
    rows = [("en", 0.0, 1)] * 2000 + [("en", 2.6, 0)] * 50 + [("de", 0.0, 1)] * 100 + [("de", 9.0, 0)] * 50
    rows += [("en", 1.1, 1)] * 60 + [(None, 0.0, 1)] * 3000 + [(None, 0.8, 0)] * 9 + [("en", 9.0, None)]
    labelled = spark.createDataFrame(rows, "stratum string, severity double, quality int")
    got = {r["stratum"]: r["cutoff"] for r in quality_rules.certified_cutoffs(labelled, quality_rules.Policy()).collect()}
    assert got == {"en": 2.0, None: 0.75}  # 'de' has too few; below 1.1 'en' rejects too many


def test_rules_on_odd_rows(spark, odd_docs, odd_labels):
    got = quality_rules.judge(odd_docs, odd_labels, keep=("text", "length")).toPandas()
    assert len(got) == odd_docs.count()
    assert got[got["doc_id"].isin([3, 4, 6])]["n_words"].tolist() == [0, 0, 0]
    assert quality_rules.judge(odd_docs.limit(0), odd_labels).count() == 0
    assert quality_rules.judge(odd_docs, odd_labels.limit(0)).count() == odd_docs.count()


def test_classifier_on_ratings_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_model.fit_sample(docs, labels.filter("doc_id % 2 = 0"))
    held = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id")
    got = quality_model.score(held, model).select("quality", "toxic", "accepted", "expected_grade").toPandas()
    clean = got[(got["quality"] == 1) & (got["toxic"] == 0)]
    assert clean["accepted"].mean() > 0.98
    assert got[got["quality"] == 0]["accepted"].mean() < 0.05
    assert got[(got["quality"] == 1) & (got["toxic"] == 1)]["accepted"].mean() < 0.6
    assert clean["expected_grade"].mean() > got[got["quality"] == 0]["expected_grade"].mean() + 1


def test_classifier_thresholds_are_ordered():
    texts = ["### ### $$$"] * 30 + ["scum idiot words here"] * 30 + ["a clean text of words"] * 30
    model = quality_model.fit(texts, [0] * 30 + [1] * 30 + [2] * 30)
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    above = model.above([texts[0], texts[30], texts[60], None, ""])
    assert (above[:, 0] >= above[:, 1]).all()
    assert above[0].sum() < above[1].sum() < above[2].sum()


def test_classifier_takes_one_row_of_an_id(spark):
    seen = []
    rows = [(1, f"text {i}") for i in range(200)] + [(2, None), (2, None), (3, "own text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    for part in (docs, docs.orderBy("text").repartition(3)):
        sample, _ = quality_model.sampled(part, labels)
        found = sorted(map(tuple, sample.select("id", "grade", "text").collect()))
        seen.append(([t for _, _, t in found], [g for _, g, _ in found]))
        assert quality_model.fit_sample(part, labels) is not None
    (texts, grades), again = seen
    assert grades == [2, 0, 1] and texts[0].startswith("text ") and texts[1:] == [None, "own text"]
    assert again == (texts, grades)


def test_sample_is_that_of_the_lowest_hashes(spark):
    docs = spark.range(8000).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 50 > 0) as quality", "0 as toxic")
    hashed = docs.selectExpr("doc_id", "xxhash64(doc_id) as h", "if(doc_id % 50 > 0, 2, 0) as grade").collect()
    sample, _ = quality_model.sampled(docs, labels, per_grade=40)
    got = sample.collect()
    for grade in (0, 2):
        low = sorted((r["h"], r["doc_id"]) for r in hashed if r["grade"] == grade)[:40]
        assert sorted(r["id"] for r in got if r["grade"] == grade) == sorted(i for _, i in low)


def test_sample_is_fitted_as_its_texts_are(spark):
    """Features counted by Spark give the model that the texts themselves give."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    sample, rated = quality_model.sampled(docs, labels, per_grade=60)
    rows = sample.orderBy("id", "grade").collect()
    prior = [rated.filter(F.col("grade") == g).count() for g in range(quality_model.GRADES)]
    want = quality_model.fit([r["text"] for r in rows], [r["grade"] for r in rows], prior=prior)
    got = quality_model.fit_sample(docs, labels, per_grade=60)
    assert (got.weights == want.weights).all() and (got.thresholds == want.thresholds).all()
    assert (got.weights != 0).sum() > 10


def test_classifier_on_odd_rows(spark, odd_docs, odd_labels):
    model = quality_model.fit_sample(odd_docs, odd_labels)
    got = quality_model.score(odd_docs, model)
    assert got.count() == odd_docs.count()
    assert {"guess", "rating", "a.b", "accepted"} <= set(got.columns)
    assert quality_model.fit_sample(odd_docs, odd_labels.limit(0)) is None
    assert quality_model.score(odd_docs, None).filter("not accepted").count() == 0
    assert quality_model.score(odd_docs.limit(0), model).count() == 0
