"""Certificate queries. Orders stand in for certificates: each order gives a row of 27
cells, picked from fifteen spellings, most of them of its date."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidemill.operators import certs
from tidemill.plans.mart import build_mart, write_mart, write_mart_folder
from tidemill.registry import Entry, table
from tidemill.sources import catalog, scratch


# Texts that stay as they are. The third is a suspension in decomposed letters, which
# does not count as one.
_FIXED = (None, "   ", "\u0111i\u0300nh chi\u0309", "ĐÌNH CHỈ", "\t", "\u00a0", "1/2/024", "32/1/2024")
_DAY_SPELLINGS = (
    ("'Đình chỉ '", "dd/MM/yyyy", "%d/%m/%Y", ""),
    ("", "dd/MM/yy", "%d/%m/%y", ""),
    ("", "d/M/'00'yy", "%-d/%-m/00%y", ""),
    ("'cap '", "d/M/yyyy", "%-d/%-m/%Y", "' roi 06/04/2024'"),
    ("", "dd-MM-yyyy", "%d-%m-%Y", ""),
    ("'29/2/'", "yyyy", "%Y", ""),
    ("", "dd/MM/yyyy", "%d/%m/%Y", ""),
)
_SPELLINGS = len(_FIXED) + len(_DAY_SPELLINGS)


_SPELLED = "array(" + ", ".join(
    ["CAST(NULL AS STRING)" if t is None else f"'{t}'" for t in _FIXED]
    + [
        f"concat({before or chr(39) * 2}, date_format(o_orderdate, {pattern!r}), {after or chr(39) * 2})"
        for before, pattern, _, after in _DAY_SPELLINGS
    ]
) + ")"

_SPELLINGS_SQL = "[" + ", ".join(
    ["NULL" if t is None else "'" + t + "'" for t in _FIXED]
    + [
        " || ".join(filter(None, (before, f"strftime(o_orderdate, '{pattern}')", after)))
        for before, _, pattern, after in _DAY_SPELLINGS
    ]
) + "]"

_KINDS = tuple(certs.CERTIFICATE_TABLES)
_FOREIGN = "khac"
# Which spelling a cell gets: a hash of its row and place, the same in both engines.
_PICK = "(({id} * 2654435761 + {i} * 40503) % 1000003) % {n}"


def _pick(i: int) -> str:
    return _PICK.format(id="o_orderkey", i=i, n=_SPELLINGS)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All orders as fifteen raw tables, with number or text ids, and one of a foreign
    kind that repeats the ids of some customers."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", f"{_SPELLED} AS spelled")
    company = "CASE WHEN o_custkey % 50 <> 0 THEN concat('company ', o_custkey) END AS cong_ty"
    cells = [f"get(spelled, int({_pick(i)})) AS {source}" for i, source in enumerate(certs.DATE_COLUMNS)]

    def raw(rows: DataFrame, id_type: str) -> DataFrame:
        return rows.selectExpr(f"CAST(o_orderkey AS {id_type}) AS id", company, *cells)

    found = {
        kind: raw(orders.filter(f"o_orderkey % {len(_KINDS)} = {i}"), "string" if i % 2 else "bigint")
        for i, kind in enumerate(_KINDS)
    }
    return found | {_FOREIGN: raw(orders.filter("o_custkey % 97 = 0"), "bigint")}


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables as one."""
    return certs.coerce(raw_tables(spark, sf_dir))


_COERCED_SQL = (
    f"WITH kinds AS (SELECT *, [{', '.join(repr(k) for k in _KINDS)}][(o_orderkey % {len(_KINDS)}) + 1] "
    f"AS {certs.KIND} FROM orders UNION ALL SELECT *, '{_FOREIGN}' FROM orders WHERE o_custkey % 97 = 0), "
    f"spelled AS (SELECT *, {_SPELLINGS_SQL} AS s FROM kinds), "
    "cells AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, "
    f"CASE WHEN o_custkey % 50 <> 0 THEN 'company ' || o_custkey END AS cong_ty, {certs.KIND}, "
    + ", ".join(f"s[({_pick(i)}) + 1] AS {n}" for i, n in enumerate(certs.RAW_COLUMNS))
    + " FROM spelled)"
)
# Day, month and year of the first date, as texts; all empty if there is none.
_PARTS_SQL = (
    "regexp_extract({raw}, '(0?[1-9]|[12]\\d|3[01])/(0?[1-9]|1[0-2])/(\\d{{2,4}})', ['d', 'm', 'y'])"
)


def _parts_sql() -> str:
    picks = ", ".join(f"{_PARTS_SQL.format(raw=raw)} AS p{i}" for i, raw in enumerate(certs.RAW_COLUMNS))
    return f"{_COERCED_SQL}, parts AS (SELECT *, {picks} FROM cells)"


def _extracted_sql() -> str:
    picks = ", ".join(
        f"CASE WHEN p{i}.d = '' THEN '' ELSE concat_ws('/', p{i}.d, p{i}.m, p{i}.y) END AS {found}"
        for i, found in enumerate(certs.EXTRACTED_COLUMNS)
    )
    nulls = ", ".join(
        f"CASE WHEN {raw} IS NOT NULL THEN {found} END AS {found}"
        for raw, found in zip(certs.RAW_COLUMNS, certs.EXTRACTED_COLUMNS)
    )
    return f"{_parts_sql()}, texts AS (SELECT *, {picks} FROM parts), found AS (SELECT id, {nulls} FROM texts)"


def _formatted_sql() -> str:
    """Every date as numbers: the year below 100 is of this century, three digits are no
    year, and a day that no calendar has gives no date."""
    picks = []
    for i, (raw, out) in enumerate(zip(certs.RAW_COLUMNS, certs.FORMATTED_COLUMNS)):
        number = f"try_cast(p{i}.y AS INTEGER)"
        year = f"CASE WHEN length(p{i}.y) <> 3 THEN {number} + CASE WHEN {number} < 100 THEN 2000 ELSE 0 END END"
        day = f"try_cast(printf('%04d-%02d-%02d', {year}, try_cast(p{i}.m AS INTEGER), try_cast(p{i}.d AS INTEGER)) AS DATE)"
        suspended = "" if i == 0 else f"WHEN contains(lower({raw}), 'đình chỉ') THEN 'ĐÌNH CHỈ' "
        picks.append(
            f"CASE WHEN replace(coalesce({raw}, ''), ' ', '') = '' THEN '' {suspended}"
            f"WHEN p{i}.d = '' THEN 'SAI' ELSE strftime({day}, '%d-%m-%Y') END AS {out}"
        )
    return f"{_parts_sql()}, formatted AS (SELECT *, {', '.join(picks)} FROM parts)"


def _mart_sql() -> str:
    cells = ", ".join(
        f"{out} AS {short}" for out, short in zip(certs.FORMATTED_COLUMNS, certs.SHORT_NAMES)
    )

    def positions(otherwise: int) -> str:
        return ", ".join(
            f"CASE WHEN {out} = 'ĐÌNH CHỈ' THEN {i} ELSE {otherwise} END"
            for i, out in enumerate(certs.FORMATTED_COLUMNS, start=1)
        )

    return (
        f"{_formatted_sql()}, placed AS (SELECT id, cong_ty, {certs.KIND}, {cells}, "
        f"greatest({positions(0)}) AS last_dc_pos, least({positions(28)}) AS first_dc_pos "
        "FROM formatted), mart AS (SELECT *, last_dc_pos > 0 AS co_dinh_chi, "
        "CASE WHEN first_dc_pos < 28 THEN first_dc_pos END AS vi_tri_dinh_chi_dau_tien "
        "FROM placed)"
    )


MART_SQL = _mart_sql()


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as it is built from the raw tables, without the time of the run."""
    built = build_mart(raw_tables(spark, sf_dir), F.lit("2024-01-01").cast("timestamp"))
    return built.drop("dbt_updated_at")


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart stored and read back."""
    return write_mart_folder(mart(spark, sf_dir), scratch.scratch_path(spark, "mart"))


def _raw_catalog(spark: SparkSession, sf_dir: str) -> str:
    """The fifteen raw tables in a new namespace of the session's own catalog; its name."""
    place = scratch.scratch_path(spark, "namespace")
    namespace = "certs_" + place[-32:]
    catalog.create_namespace(spark, namespace, place)
    raw = raw_tables(spark, sf_dir)

    def store(kind: str) -> None:
        name = f"{namespace}.{certs.CERTIFICATE_TABLES[kind]}"
        if not catalog.table_exists(spark, name):
            catalog.create_like(raw[kind], name, "parquet", {})
        catalog.append_to(raw[kind], name)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(inheritable_thread_target(spark)(store), certs.CERTIFICATE_TABLES))
    return namespace


def _stored(spark: SparkSession, rows: DataFrame, namespace: str) -> DataFrame:
    """`rows` stored outside the namespace, which leaves the session's catalog."""
    kept, _ = scratch.stage(rows, "from-catalog")
    spark.sql(f"DROP NAMESPACE {catalog.quoted(namespace)} CASCADE")
    return kept


def catalog_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart from catalog tables to a catalog table, written twice, and read back."""
    namespace = _raw_catalog(spark, sf_dir)
    sources = catalog.cert_sources(spark, namespace, certs.CERTIFICATE_TABLES)
    built = build_mart(sources, F.lit("2024-01-01").cast("timestamp"))
    name = f"{namespace}.cert_status"
    for rows in (built.limit(3).drop("first_dc_pos"), built):
        write_mart(rows, name, "parquet")
    return _stored(spark, spark.table(catalog.quoted(name)).drop("dbt_updated_at"), namespace)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog says of the raw tables, and how many rows they hold."""
    namespace = _raw_catalog(spark, sf_dir)
    catalog.create_namespace(spark, namespace)  # it is there already
    names = catalog.tables_in(spark, namespace)
    for name in names:
        catalog.set_properties(spark, name, catalog.METADATA_PROPERTIES)
    kept = [n for n in names if catalog.METADATA_PROPERTIES.items() <= catalog.get_properties(spark, n).items()]
    local = F.substring_index("table", ".", -1).alias("table")
    described = catalog.describe(spark, kept).groupBy(local).agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.max(F.when(F.col("column") == "id", F.col("data_type"))).alias("id_type"),
    )
    counted = [
        spark.table(catalog.quoted(n)).agg(F.count(F.lit(1)).alias("n_rows"), F.count("cong_ty").alias("n_named")).withColumn(
            "of", F.lit(n.rpartition(".")[2])
        )
        for n in names
    ]
    rows = reduce(DataFrame.unionByName, counted)
    return _stored(spark, described.join(rows, F.col("table") == F.col("of")).drop("of"), namespace)


_KIND_TABLES = ", ".join(f"('{k}', '{t}', {i})" for i, (k, t) in enumerate(certs.CERTIFICATE_TABLES.items()))
_TABLES_SQL = (
    f"{_COERCED_SQL}, kind_tables(kind, name, i) AS (VALUES {_KIND_TABLES}) "
    f"SELECT name AS \"table\", {2 + len(certs.DATE_COLUMNS)} AS n_columns, "
    "CASE WHEN max(i) % 2 = 1 THEN 'string' ELSE 'bigint' END AS id_type, count(*) AS n_rows, count(cong_ty) AS n_named "
    f"FROM cells JOIN kind_tables ON kind = {certs.KIND} GROUP BY name"
)


def cert_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certificates(spark, sf_dir)


def cert_date_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = certs.extract_dates(certificates(spark, sf_dir))
    return found.select("id", *certs.EXTRACTED_COLUMNS)


def cert_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = certs.format_dates(certs.extract_dates(certificates(spark, sf_dir)))
    return formatted.select("id", *certs.FORMATTED_COLUMNS)


# Same-shaped tables of different key types: (id, label) by position.
_BRANCHES = {
    "region": {"r_regionkey": "id", "r_name": "label"},
    "nation": {"n_nationkey": "id", "n_name": "label"},
    "customer": {"c_custkey": "id", "c_name": "label"},
    "supplier": {"s_suppkey": "id", "s_name": "label"},
    "part": {"p_partkey": "id", "p_name": "label"},
    "orders": {"o_orderkey": "id", "o_orderpriority": "label"},
    "documents": {"doc_id": "id", "source": "label"},
    "pages": {"url": "id", "page_id": "label"},
}


def union_all_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certs.union_tagged(
        {
            name: certs.select_renamed(table(spark, sf_dir, name), mapping)
            for name, mapping in _BRANCHES.items()
        },
        name="kind",
    )


_UNION_SQL = " UNION ALL ".join(
    f"SELECT {', '.join(f'CAST({old} AS VARCHAR) AS {new}' for old, new in mapping.items())}, "
    f"'{name}' AS kind FROM {name}"
    for name, mapping in _BRANCHES.items()
)

ENTRIES = {
    "union_all_tagged": Entry(union_all_tagged, _UNION_SQL),
    "cert_date_extract": Entry(
        cert_date_extract,
        f"{_extracted_sql()} SELECT id, {', '.join(certs.EXTRACTED_COLUMNS)} FROM found",
    ),
    "cert_date_format": Entry(
        cert_date_format,
        f"{_formatted_sql()} SELECT id, {', '.join(certs.FORMATTED_COLUMNS)} FROM formatted",
    ),
    "cert_coerce": Entry(cert_coerce, f"{_COERCED_SQL} SELECT * FROM cells"),
    "cert_status_mart": Entry(stored_mart, f"{MART_SQL} SELECT * FROM mart"),
    "catalog_mart": Entry(catalog_mart, f"{MART_SQL} SELECT * FROM mart WHERE {certs.KIND} <> '{_FOREIGN}'"),
    "catalog_tables": Entry(catalog_tables, _TABLES_SQL),
}
