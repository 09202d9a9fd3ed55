"""Tables of the session's own catalog, and a mart that is tested as it is built."""

import pytest
from pyspark.sql import functions as F

from tests.plans import text_plan
from tidemill.operators import certs, quality
from tidemill.plans import mart
from tidemill.registry import entries
from tidemill.sources import catalog, versions


@pytest.fixture
def namespace(spark, tmp_path):
    name = f"ns_{tmp_path.name}".replace("-", "_")
    catalog.create_namespace(spark, name, str(tmp_path))
    yield name
    spark.sql(f"DROP NAMESPACE {catalog.quoted(name)} CASCADE")


def test_a_table_from_nothing(spark, namespace):
    name = f"{namespace}.t"
    rows = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, `a.b` string")
    assert not catalog.table_exists(spark, name)
    catalog.create_like(rows, name, "parquet", {"kept": "yes"})
    assert catalog.table_exists(spark, name) and spark.table(name).count() == 0
    catalog.append_to(rows.select("`a.b`", "id"), name)  # by name, not by place
    catalog.append_to(rows, name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 1, 2, 2]
    catalog.set_properties(spark, name, catalog.METADATA_PROPERTIES)
    assert (catalog.METADATA_PROPERTIES | {"kept": "yes"}).items() <= catalog.get_properties(spark, name).items()
    assert catalog.tables_in(spark, namespace) == [name]
    assert name in [t.removeprefix("spark_catalog.") for t in catalog.list_tables(spark, "spark_catalog")]
    got = sorted(map(tuple, catalog.describe(spark, [name]).collect()))
    assert got == [(name, 1, "id", "bigint"), (name, 2, "a.b", "string")]
    with pytest.raises(Exception, match="(?i)exists"):
        catalog.create_like(rows, name, "parquet", {})


def test_replacing_columns_and_rows(spark, namespace):
    name = f"{namespace}.t"
    catalog.replace_table(spark.range(3), name, "parquet", {})
    catalog.replace_table(spark.range(2).select(F.lit("a").alias("x"), "id"), name, "parquet", {"k": "v"})
    assert spark.table(name).columns == ["x", "id"] and spark.table(name).count() == 2
    assert catalog.get_properties(spark, name)["k"] == "v"


def raw(spark, rows, id_type="bigint"):
    blank = {c: None for c in certs.DATE_COLUMNS}
    data = [(i, name, *(blank | cells).values()) for i, name, cells in rows]
    columns = ", ".join(f"{c} string" for c in certs.DATE_COLUMNS)
    return spark.createDataFrame(data, f"id {id_type}, cong_ty string, {columns}")


def test_a_failed_test_stops_the_switch(spark, tmp_path):
    base = str(tmp_path / "mart")
    good = mart.build_mart({"9001": raw(spark, [(1, "a", {"tcn_1": "1/2/2024"}), (2, "b", {"cnl_1": "Đình chỉ"})])})
    stored, report = mart.build_tested(good, base, strict=True)
    assert {r["failures"] for r in report.collect()} == {0} and stored.count() == 2
    bad = mart.build_mart({"9001": raw(spark, [(1, None, {"tcn_1": "?"}), (1, "b", {})]), "khac": raw(spark, [(3, "c", {})])})
    with pytest.raises(quality.QualityFailure) as failed:
        mart.build_tested(bad, base, strict=True)
    for said in ("not_null(cong_ty): 1", "unique(id): 1", "accepted_values(loai_chung_nhan): 1", "no_invalid_dates(*): 1"):
        assert said in str(failed.value)
    assert sorted(r["id"] for r in versions.current(spark, base).collect()) == [1, 2]
    assert len(list((tmp_path / "mart").glob("data-*"))) == 1  # what failed is gone
    _, report = mart.build_tested(bad, base, strict=True, enforced=False)
    whole = mart.mart_report(bad, strict=True)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, whole.collect()))
    assert versions.current(spark, base).count() == 3


def test_one_report_reads_the_rows_once(spark, tmp_path):
    rows = [(1, "a", 1.5), (1, "b", None), (None, "b", 1.5), (None, "z", 0.0), (2, None, -0.0)]
    spark.createDataFrame(rows, "id int, k string, v double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.dq_report(df, ["id", "k"], ["id", "v", "k"], {"k": ["a", "b"], "v": [1.5]})
    assert text_plan(report).count("FileScan") == 1
    got = {(r["test"], r["column"]): r["failures"] for r in report.collect()}
    assert got == {
        ("not_null", "id"): 2,
        ("not_null", "k"): 1,
        ("unique", "id"): 1,
        ("unique", "v"): 2,
        ("unique", "k"): 1,
        ("accepted_values", "k"): 1,
        ("accepted_values", "v"): 1,
    }
    empty = quality.dq_report(df.limit(0), ["id"], ["id"], {"k": ["a"]}).collect()
    assert [r["failures"] for r in empty] == [0, 0, 0]


def test_queries_leave_no_tables_behind(spark):
    before = catalog.list_tables(spark, "spark_catalog")
    for name in ("catalog_mart", "catalog_tables"):
        assert entries()[name].run(spark, "/root/testdata/sf0.001").count() > 0
    assert catalog.list_tables(spark, "spark_catalog") == before
