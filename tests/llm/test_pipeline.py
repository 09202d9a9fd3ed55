"""The stages of the corpus pipeline, each against plain Python on its own input."""

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_near_dups import brute
from tests.llm.test_quality import counts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, step) in enumerate(pipeline.STAGES):
        docs = pipeline.stage(step(spark, docs, SF), f"test{i}")
        out.append(docs)
    return [d.toPandas() for d in out]


def test_columns(stages):
    for rows in stages[1:-1]:
        assert tuple(rows.columns) == pipeline.COLUMNS


def test_classifier_keeps_clean_and_drops_junk(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(stages[0][["doc_id"]])
    kept = labels["doc_id"].isin(stages[1]["doc_id"])
    assert kept[(labels["quality"] == 1) & (labels["toxic"] == 0)].mean() > 0.97
    assert kept[labels["quality"] == 0].mean() < 0.1


def test_rules_drop_what_fails(stages):
    for row in stages[1].itertuples():
        n, _, _, _, repeated = counts(row.text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert not (failed and row.doc_id in set(stages[2]["doc_id"]))


def test_dedup_leaves_one_of_each_group(stages):
    want = brute(stages[2][["doc_id", "text"]].itertuples(index=False), 5)
    assert sorted(stages[3]["doc_id"]) == sorted({c for _, c in want.values()})


def test_mix_keeps_all_documents(stages):
    assert set(stages[4]["doc_id"]) == set(stages[3]["doc_id"])
    assert stages[4].groupby("doc_id").size().max() <= 2


def test_packing_holds_every_copy(stages):
    packed = stages[5]
    assert (packed["piece"] == 0).sum() == len(stages[4])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert packed["sequence_id"].nunique() <= packed["length"].sum() / 2048 * 1.01 + 1


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    folder = str(tmp_path)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, step in pipeline.STAGES:
            got = step(spark, docs, folder)
            n = got.count()
            assert n <= 3 * max(1, docs.count()) or name == "packing"
            if docs.isEmpty():
                assert n == 0


def test_repeated_rows_go_in_dedup(spark, odd_docs):
    got = sorted(pipeline.dedup(spark, odd_docs, "").toPandas()["doc_id"].fillna(-1))
    assert got == [-1, 1, 3, 4, 5, 6, 7, 8]


def test_dedup_goes_by_text_within_an_id(spark):
    """A copy goes, another text of the same id stays."""
    copy, own = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, copy), (2, copy), (2, own), (3, own + " end"), (4, own), (4, own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'a' source", "1L n_chars")
    got = pipeline.dedup(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, copy), (2, own)]


def test_mix_keeps_repeated_rows(spark, odd_docs):
    got = pipeline.mix(spark, odd_docs, "").toPandas()
    assert (got["doc_id"] == 2).sum() >= 2 and got["doc_id"].isna().sum() >= 1
