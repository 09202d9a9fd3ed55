import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import packing


def check_plan(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan_packing(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    for parts, times in plan:
        assert times > 0 and sum(parts) <= capacity
        np.add.at(used, list(parts), times)
    assert (used == counts).all()
    return sum(times for _, times in plan), len(plan)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=200))
def test_every_piece_is_used_once(lengths):
    sequences, _ = check_plan(lengths, 40)
    assert sequences >= -(-sum(lengths) // 40)
    assert sequences <= 1 + 2 * sum(lengths) // 40  # best fit leaves no two half-empty


def test_exact_complements_are_found():
    assert check_plan([30, 7, 2, 1] * 5, 40)[0] == 5  # a triple fills each gap
    assert check_plan([25, 10, 5] * 1000, 40) == (1000, 1)
    assert check_plan([20] * 9, 40)[0] == 5


def test_plan_does_not_grow_with_the_data():
    some = np.random.default_rng(0).integers(1, 2049, 20_000)
    few = check_plan(some, 2048)
    many = check_plan(np.repeat(some, 50), 2048)
    assert few[0] <= -(-int(some.sum()) // 2048) * 1.02
    assert many[1] < 4 * few[1]


def test_rows(spark, odd_docs):
    got = packing.pack(odd_docs, capacity=64).toPandas()
    assert len(got) >= odd_docs.count()
    for _, group in got.sort_values("offset").groupby("sequence_id"):
        assert group["length"].sum() <= 64
        assert (group["offset"].to_numpy() == group["length"].cumsum().to_numpy() - group["length"].to_numpy()).all()
    empty = got[got["doc_id"].isin([3, 4, 6])]
    assert empty["length"].tolist() == [1, 1, 1] and empty["piece"].tolist() == [0, 0, 0]
    assert (got[got["doc_id"] == 5].sort_values("piece")["length"].to_numpy()[:-1] == 64).all()


def test_no_rows(spark, odd_docs):
    assert packing.pack(odd_docs.limit(0)).count() == 0
