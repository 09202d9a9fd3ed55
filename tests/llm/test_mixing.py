import math

import pytest

from tidemill.llm import mixing


def totals(spark, sizes):
    return spark.createDataFrame(list(sizes.items()), "source string, total long")


def test_exponent_meets_the_repetition_limit(spark):
    t = totals(spark, {"big": 1000, "mid": 100, "small": 10})
    exponent, state = mixing.find_exponent(t, mixing.Target(repeats=5.0))
    assert state["repeats"] == pytest.approx(5.0, rel=1e-6)
    assert (1000 / 10) ** (1 - exponent) == pytest.approx(5.0, rel=1e-6)


def test_exponent_meets_the_entropy(spark):
    t = totals(spark, {"big": 1000, "mid": 100, "small": 10})
    exponent, state = mixing.find_exponent(t, mixing.Target(entropy=0.9))
    raised = [(s / 1110) ** exponent for s in (1000, 100, 10)]
    w = [r / sum(raised) for r in raised]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.9, abs=1e-6)
    assert mixing.find_exponent(t, mixing.Target(entropy=0.1))[0] == 1.0
    assert mixing.find_exponent(t, mixing.Target(entropy=2.0))[0] == 0.0


def test_every_document_once_and_small_sources_more(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i < 300 else "small") for i in range(340)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = mixing.Target(repeats=2.5, block=100)
    got = mixing.mix(docs, target).toPandas()
    size = {i: 1 + i % 7 for i in range(340)}
    assert set(got["doc_id"]) == set(range(340))
    big, small = got[got["source"] == "big"], got[got["source"] == "small"]
    assert len(big) == 300 and (big["pass"] == 0).all()
    drawn = small["tokens"].sum() / sum(size[i] for i in range(300, 340))
    assert 2.5 <= drawn < 2.6
    assert small.groupby("doc_id").size().between(2, 3).all()
    # Each pass is an order of its own, without gaps in its source.
    for _, own in got.groupby("source"):
        own = own.sort_values(["start"])
        assert (own["start"].to_numpy() == own["tokens"].cumsum().to_numpy() - own["tokens"].to_numpy()).all()
    first, second = (small[small["pass"] == p].sort_values("start")["doc_id"].tolist() for p in (0, 1))
    assert sorted(first) == sorted(second) and first != second
    # Blocks hold the sources by weight, and their places are numbered.
    weight = small["tokens"].sum() / got["tokens"].sum()
    blocks = got.groupby("block")
    assert len(blocks) == math.ceil(got["tokens"].sum() / 100) or len(blocks) >= got["tokens"].sum() // 100
    for number, block in blocks:
        assert sorted(block["position"]) == list(range(len(block)))
        if number < got["block"].max():
            share = block[block["source"] == "small"]["tokens"].sum()
            assert abs(share - 100 * weight) <= 14


def test_a_budget_draws_less(spark):
    docs = spark.createDataFrame([(i, "a b c d", "x") for i in range(100)], "doc_id long, text string, source string")
    assert mixing.mix(docs, mixing.Target(budget=200)).count() == 50


def test_odd_rows(spark, odd_docs):
    got = mixing.mix(odd_docs).toPandas()
    assert len(got) >= odd_docs.count() and set(got["doc_id"].dropna()) == set(range(1, 10))
    assert mixing.mix(odd_docs.limit(0)).count() == 0
    again = mixing.mix(odd_docs).toPandas()
    key = ["block", "position"]
    assert got.sort_values(key)["start"].tolist() == again.sort_values(key)["start"].tolist()


def test_halvings_in_one_pass_are_those_one_by_one(spark, monkeypatch):
    rows = [(f"s{i}", float(3**i)) for i in range(9)]
    totals = spark.createDataFrame(rows, "source string, total double")
    target = mixing.Target(repeats=4.0)
    together = mixing.find_exponent(totals, target)
    monkeypatch.setattr(mixing, "STEPS_AT_ONCE", 1)
    assert mixing.find_exponent(totals, target) == together
    assert 0 < together[0] < 1 and together[1]["repeats"] == pytest.approx(4.0, rel=1e-6)
