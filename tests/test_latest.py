"""One row per key."""

import pytest
from pyspark.sql import functions as F

from tests.plans import text_plan
from tidemill.operators.latest import choose_order_column, dedup_any, dedup_latest


def test_newest_row_wins_and_null_time_is_oldest(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02", "new"), (1, "2024-01-01", "old"), (1, None, "none"), (2, None, "only")],
        "id int, t string, v string",
    )
    got = {r["id"]: r["v"] for r in dedup_latest(df, ["id"], "t").collect()}
    assert got == {1: "new", 2: "only"}


def test_ties_are_settled_by_the_whole_row(spark):
    rows = [(1, "t", "b", {"k": 1}), (1, "t", "a", {"k": 2}), (1, "t", "a", {"k": 1})]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id int, t string, v string, m map<string,int>")
        row = dedup_latest(df.repartition(3), ["id"], "t").head()
        assert (row["v"], row["m"]) == ("a", {"k": 1})


def test_explicit_tie(spark):
    df = spark.createDataFrame([(1, "t", 1), (1, "t", 2)], "id int, t string, n int")
    assert dedup_latest(df, ["id"], "t", [F.col("n").desc()]).head()["n"] == 2


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id int, t string")
    assert dedup_latest(df, ["id"], "t").count() == 2


def test_any_row_is_repeatable(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z")], "id int, v string")
    got = {(r["id"], r["v"]) for r in dedup_any(df.repartition(2), ["id"]).collect()}
    assert got == {(1, "a"), (2, "z")}
    assert dedup_any(df.select("id"), ["id"]).count() == 2


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # Half of all rows share one key; each task may pass on one row of it.
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    newest = dedup_latest(df, ["k"], "t")
    plan = text_plan(newest)
    assert plan.count("WindowGroupLimit") == 2
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert newest.count() == 20_001
    assert newest.filter("k = 0").head()["t"] == 39_998


@pytest.mark.parametrize(
    "columns, by_column_order, wanted",
    [
        (["created_at", "id", "updated_at"], False, "updated_at"),
        (["created_at", "id", "updated_at"], True, "created_at"),
        (["ID", "Modified_At"], False, "Modified_At"),
        (["TIME", "Timestamp"], True, "TIME"),
        (["TIME", "Timestamp"], False, "Timestamp"),
        (["id", "name"], False, None),
        (["id", "name"], True, None),
    ],
)
def test_choose_order_column(columns, by_column_order, wanted):
    assert choose_order_column(columns, by_column_order=by_column_order) == wanted
