"""Data tests."""

import pytest

from tests.plans import text_plan
from tidemill.operators import quality


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "a", "SAI"), (1, "b", ""), (None, "c", None), (None, None, "SAI"), (2, "b", "x")]
    return spark.createDataFrame(data, "id int, kind string, cell string")


def failures(report):
    return {(r["test"], r["column"]): r["failures"] for r in report.collect()}


def test_each(df):
    assert failures(quality.not_null(df, ["id", "kind"])) == {
        ("not_null", "id"): 2,
        ("not_null", "kind"): 1,
    }
    assert failures(quality.unique(df, "id")) == {("unique", "id"): 1}
    assert failures(quality.accepted_values(df, "kind", ["a", "b"])) == {
        ("accepted_values", "kind"): 1
    }
    assert failures(quality.no_invalid_dates(df, ["cell"])) == {("no_invalid_dates", "*"): 2}
    assert quality.invalid_rows(df, ["kind", "cell"]).count() == 2
    assert quality.duplicate_values(df, "id").collect()[0]["n"] == 2
    assert [r["kind"] for r in quality.unexpected_values(df, "kind", ["a", "b"]).collect()] == ["c"]


def test_empty_table_passes(df):
    empty = df.limit(0)
    report = quality.dq_report(empty, ["id"], ["id"], {"kind": ["a"]}, ["cell"])
    assert set(failures(report).values()) == {0}
    assert quality.enforce(report) is report


def test_report_and_gate(df):
    report = quality.dq_report(df, ["id", "kind"], ["id"], {"kind": ["a", "b", "c"]}, ["cell"])
    assert len(failures(report)) == 5
    with pytest.raises(quality.QualityFailure, match=r"not_null\(id\): 2"):
        quality.enforce(report)
    with pytest.raises(ValueError):
        quality.dq_report(df)


def test_row_wise_tests_share_one_pass(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    plan = text_plan(quality.dq_report(stored, ["id", "kind"], date_cols=["cell"]))
    assert plan.count("FileScan") == 1
    narrow = text_plan(quality.unique(stored, "id"))
    assert "ReadSchema: struct<id:int>" in narrow


def test_avg_count(spark):
    row = quality.avg_count(spark.createDataFrame([(25,), (30,), (None,)], "age int"), "age").head()
    assert (row["avg_age"], row["n_rows"]) == (27.5, 3)
