"""Tables known to a Spark catalog: list, create, merge, replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tidemill.operators.upsert import align_columns

# Keep two versions of the table's metadata, drop older ones on commit.
METADATA_PROPERTIES = {
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "2",
}
FORMAT_PROPERTIES = {"format-version": "2"} | METADATA_PROPERTIES

# Formats that Spark's own catalog keeps as folders of files.
PLAIN_FORMATS = ("parquet", "orc", "json", "csv")


def quoted(name: str) -> str:
    """A dotted name with every part in back-quotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(values: Mapping[str, str]) -> str:
    return ", ".join(f"{literal(k)}={literal(v)}" for k, v in values.items())


def parent(name: str) -> str:
    return name.rpartition(".")[0]


def under(root: str, namespace: str) -> str:
    """Full name of a listed namespace; some catalogs list it with its root already."""
    inner = root.partition(".")[2]
    for prefix in filter(None, (root, inner)):
        if namespace == prefix or namespace.startswith(prefix + "."):
            return root + namespace[len(prefix) :]
    return f"{root}.{namespace}"


def list_namespaces(spark: SparkSession, root: str) -> list[str]:
    rows = spark.sql(f"SHOW NAMESPACES IN {quoted(root)}").collect()
    return [under(root, row[0]) for row in rows]


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Full names of the tables in every namespace under `root`."""
    return [table for namespace in list_namespaces(spark, root) for table in tables_in(spark, namespace)]


def tables_in(spark: SparkSession, namespace: str) -> list[str]:
    """Full names of the tables in one namespace."""
    rows = spark.sql(f"SHOW TABLES IN {quoted(namespace)}").collect()
    return [f"{namespace}.{row['tableName']}" for row in rows if not row["isTemporary"]]


def describe(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table, position, column, data_type) of the tables' columns, as the catalog has them."""
    found = [
        (name, i, field.name, field.dataType.simpleString())
        for name in tables
        for i, field in enumerate(spark.table(quoted(name)).schema.fields, start=1)
    ]
    return spark.createDataFrame(found, "table string, position int, column string, data_type string")


def get_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it is there; tables go to `location`, if one is given."""
    place = "" if location is None else f" LOCATION {literal(location)}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(name)}{place}")


def create_like(
    df: DataFrame,
    name: str,
    using: str = "iceberg",
    table_properties: Mapping[str, str] = FORMAT_PROPERTIES,
) -> None:
    """Create an empty table with the columns of `df`, and its namespace."""
    spark = df.sparkSession
    if parent(name):
        create_namespace(spark, parent(name))
    writer = df.limit(0).writeTo(quoted(name)).using(using)
    for key, value in table_properties.items():
        writer = writer.tableProperty(key, value)
    writer.create()


def fit_columns(df: DataFrame, name: str) -> DataFrame:
    """`df` with the table's columns and types, and the table with the new columns of `df`.

    Columns that `df` lacks are NULL; columns that the table lacks are added to it.
    """
    spark = df.sparkSession
    target = spark.table(quoted(name))
    known = {c.lower() for c in target.columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"{quoted_part(f.name)} {_ddl(f)}" for f in new)
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({columns})")
        target = spark.table(quoted(name))
    return align_columns(target.limit(0), df)[1]


def _ddl(field: StructField) -> str:
    """A type as it is written in a statement, nested names quoted."""
    kind = StructType([StructField("c", field.dataType)]).toDDL()
    return kind.split(" ", 1)[1]


def quoted_part(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def set_properties(spark: SparkSession, name: str, values: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ({properties(values)})")


def merge_sql(target: str, source_view: str, keys: Sequence[str]) -> str:
    on = " AND ".join(f"t.{quoted_part(k)} = s.{quoted_part(k)}" for k in keys)
    return (
        f"MERGE INTO {quoted(target)} t USING {quoted(source_view)} s ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge_into(df: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Upsert into a table whose catalog supports row-level changes."""
    view = "merge_" + target.replace(".", "_")
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(merge_sql(target, view, keys))
    finally:
        df.sparkSession.catalog.dropTempView(view)


def append_to(df: DataFrame, name: str) -> None:
    """Add rows by column name, to a table of any catalog."""
    df.write.mode("append").saveAsTable(quoted(name))


def replace_table(
    df: DataFrame,
    name: str,
    using: str = "iceberg",
    table_properties: Mapping[str, str] = FORMAT_PROPERTIES,
) -> None:
    """Replace the table's contents and columns.

    A table format with commits does so in one. Spark's own catalog has none for plain
    file formats: there the table is dropped and written, and readers meanwhile fail.
    """
    if parent(name):
        create_namespace(df.sparkSession, parent(name))
    if using in PLAIN_FORMATS:
        df.write.mode("overwrite").format(using).saveAsTable(quoted(name))
        if table_properties:
            set_properties(df.sparkSession, name, table_properties)
        return
    writer = df.writeTo(quoted(name)).using(using)
    for key, value in table_properties.items():
        writer = writer.tableProperty(key, value)
    writer.createOrReplace()


def cert_sources(spark: SparkSession, namespace: str, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """Certificate kind -> table of that kind in `namespace`."""
    return {tag: spark.table(quoted(f"{namespace}.{table}")) for tag, table in tables.items()}


def cert_folders(spark: SparkSession, base: str, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """Certificate kind -> parquet folder of that kind under `base`."""
    return {tag: spark.read.parquet(f"{base}/{table}") for tag, table in tables.items()}
