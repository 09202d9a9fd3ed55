from pyspark.sql import functions as F

from tidemill.llm import lang_id, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op1_language(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").filter("held_out")
    right = held.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert right["a"] > 0.98 and 0 <= right["low"] and right["high"] <= 1
    assert got.count() == truth.count()


def test_families_come_first():
    texts = ["the cat and the dog ran"] * 9 + ["der Hund und die Katze"] * 9 + ["le chat et le chien"] * 9 + ["el gato y el perro"] * 9
    model = lang_id.fit(texts, ["en"] * 9 + ["de"] * 9 + ["fr"] * 9 + ["es"] * 9)
    assert model.families == ("germanic", "romance")
    assert model.pairs == (("germanic", "de", "en"), ("romance", "es", "fr"))
    langs, score = model.predict(lang_id.vectors(["the dog", "el perro"]))
    assert langs.tolist() == ["en", "es"] and (score > 0).all() and (score <= 1).all()


def test_one_language_and_unlisted_codes():
    model = lang_id.fit(["abc def"] * 3, ["xx"] * 3)
    assert model.predict(lang_id.vectors(["anything"]))[0].tolist() == ["xx"]
    assert lang_id.fit([], []) is None


def test_odd_rows(spark, odd_docs):
    model = lang_id.fit_sample(odd_docs)
    got = {r["doc_id"]: r for r in lang_id.predict(odd_docs, model).collect()}
    for name in (3, 4, 6, 8):
        assert (got[name]["lang_pred"], got[name]["score"]) == ("und", 0.0)
    assert got[7]["lang_pred"] in ("de", "en") and "guess" in odd_docs.columns
    assert lang_id.predict(odd_docs.limit(0), model).count() == 0
    assert lang_id.predict(odd_docs, None).filter("lang_pred <> 'und'").count() == 0


def test_sample_is_that_of_the_lowest_hashes(spark):
    """Whatever the partitions, with a hot language, repeated rows, and more languages than wanted."""
    rows = [(i, f"text {i % 900}", "en") for i in range(9000)] + [(5, "again", "en")] * 3000
    rows += [(i, f"Satz {i}", "de") for i in range(300)] + [(i, "mot", "fr") for i in range(20)] + [(1, "1 2", "en"), (2, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {}
    for r in docs.selectExpr("lang", "text", "xxhash64(doc_id, text) as h").distinct().collect():
        if lang_id.has_letter(r["text"]):
            want.setdefault(r["lang"], []).append((r["h"], r["text"]))
    for part in (docs, docs.orderBy("text").repartition(5)):
        got = lang_id.sampled(part, per_language=40, most_languages=2).collect()
        for name in ("en", "de"):
            assert sorted((r["order"], r["text"]) for r in got if r["lang"] == name) == sorted(want[name])[:40]
        assert {r["lang"] for r in got} == {"en", "de"}
    texts = sorted((r["lang"], r["order"], r["text"]) for r in got)
    plain = lang_id.fit([t for _, _, t in texts], [v for v, _, _ in texts])
    model = lang_id.fit_sample(docs, per_language=40, most_languages=2)
    assert (model.weights == plain.weights).all() and model.pairs == plain.pairs
