"""Certificate tables: unite, extract dates, format them, derive the status mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import dates
from tidemill.functions.names import fresh_name, quoted

# Source column -> name in the mart, in position order 1-27. Three of
# the source names do not follow the naming of their neighbours.
DATE_COLUMNS = {
    "ngay_cap": "ngay_cap",
    "giam_sat_lan_1": "gs1",
    "giam_sat_lan_2": "gs2",
    "tcn_1": "tcn1",
    "giam_sat_lan_1_tcn_1": "gs1_tcn1",
    "giam_sat_lan_2_tcn_1": "gs2_tcn1",
    "tcn_2": "tcn2",
    "giam_sat_lan_1_tcn_2": "gs1_tcn2",
    "giam_sat_lan_2_tcn_2": "gs2_tcn2",
    "cnl_1": "cnl1",
    "giam_sat_lan_1_cnl_1": "gs1_cnl1",
    "giam_sat_lan_2_cnl_1": "gs2_cnl1",
    "tcn1_cnl_1": "tcn1_cnl1",
    "giam_sat_lan_1_tcn1_cnl_1": "gs1_tcn1_cnl1",
    "giam_sat_lan_2_tcn1cnl_1": "gs2_tcn1_cnl1",
    "tcn2_cnl_1": "tcn2_cnl1",
    "giam_sat_lan_1_tcn2_cnl_1": "gs1_tcn2_cnl1",
    "giam_sat_lan_2_tcn2_cnl_1": "gs2_tcn2_cnl1",
    "cnl_2": "cnl2",
    "giam_sat_lan_1_cnl_2": "gs1_cnl2",
    "giam_sat_lan_2_cnl_2": "gs2_cnl2",
    "tcn1_cnl_2": "tcn1_cnl2",
    "giam_sat_lan_1_tcn1_cnl_2": "gs1_tcn1_cnl2",
    "giam_sat_lan_2_tcn1cnl_2": "gs2_tcn1_cnl2",
    "tcn2_cnl2": "tcn2_cnl2",
    "giam_sat_lan_1_tcn2_cnl_2": "gs1_tcn2_cnl2",
    "giam_sat_lan_2_tcn2_cnl_2": "gs2_tcn2_cnl2",
}

# Certificate kind -> source table.
CERTIFICATE_TABLES = {
    "13485": "tbl_13485",
    "14001": "tbl_14001",
    "22000": "tbl_22000",
    "22716": "tbl_22716",
    "27001": "tbl_27001",
    "45001": "tbl_45001",
    "5s": "tbl_5s",
    "9001": "tbl_9001",
    "gmp": "tbl_gmp",
    "haccp": "tbl_haccp",
    "qcvn": "tbl_qcvn",
    "san_pham": "tbl_san_pham",
    "11041_22017": "tbl_tcvn_11041_22017",
    "vietgahp": "tbl_vietgahp",
    "vietgap": "tbl_vietgap",
}

KIND = "loai_chung_nhan"
SHORT_NAMES = tuple(DATE_COLUMNS.values())
ISSUE_DATE = SHORT_NAMES[0]


def raw_name(short: str) -> str:
    return short if short == ISSUE_DATE else f"{short}_raw_col"


def extracted_name(short: str) -> str:
    return f"{short}_raw" if short == ISSUE_DATE else f"{short}_r"


def formatted_name(short: str) -> str:
    return f"format_{short}"


RAW_COLUMNS = tuple(map(raw_name, SHORT_NAMES))
EXTRACTED_COLUMNS = tuple(map(extracted_name, SHORT_NAMES))
FORMATTED_COLUMNS = tuple(map(formatted_name, SHORT_NAMES))


# Wide projections are written as expressions in one call: each column object costs
# several calls into the JVM, and fifteen tables of thirty columns some ten seconds.


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the columns named in `mapping`, in its order, under their new names."""
    return df.selectExpr(*[f"{quoted(old)} AS {quoted(new)}" for old, new in mapping.items()])


def with_tag(df: DataFrame, tag: str, name: str = KIND) -> DataFrame:
    return df.withColumn(name, F.lit(tag))


def union_tagged(branches: Mapping[str, DataFrame], name: str = KIND) -> DataFrame:
    """UNION ALL by position of same-shaped tables, each row tagged with its branch.

    A column that is a string in one branch and something else in another becomes a
    string in all of them. Left to itself, ANSI Spark would cast the strings to
    numbers and fail on the first one that is not. The tag is a literal per branch,
    so a reader who filters on it scans only the branches it asks for.
    """
    schemas = {tag: df.schema for tag, df in branches.items()}
    first = next(iter(schemas.values())).names
    width = len(first)
    for schema in schemas.values():
        if len(schema) != width:
            raise ValueError(f"expected {width} columns, got {schema.names}")
    kinds = [{s[i].dataType.simpleString() for s in schemas.values()} for i in range(width)]
    as_text = [len(k) > 1 and "string" in k for k in kinds]

    def aligned(tag: str, df: DataFrame) -> DataFrame:
        names = schemas[tag].names
        taken = [f"CAST({quoted(n)} AS STRING)" if text else quoted(n) for n, text in zip(names, as_text)]
        return df.selectExpr(*[f"{value} AS {quoted(n)}" for value, n in zip(taken, first)])

    return reduce(
        DataFrame.union, [with_tag(aligned(tag, df), tag, name) for tag, df in branches.items()]
    )


def certificate_branch(df: DataFrame) -> DataFrame:
    """One source table under the common names, its date cells as strings."""
    cells = [
        f"CAST({quoted(source)} AS STRING) AS {quoted(raw_name(short))}" for source, short in DATE_COLUMNS.items()
    ]
    return df.selectExpr("id", "cong_ty", *cells)


def coerce(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All certificate tables as one: id, company, kind, 27 raw date cells."""
    united = union_tagged({tag: certificate_branch(df) for tag, df in sources.items()})
    return united.select("id", "cong_ty", KIND, *RAW_COLUMNS)


def _raws() -> list[Column]:
    return [F.col(n) for n in RAW_COLUMNS]


def _spread(cells: str, names: Sequence[str]) -> list[str]:
    return [f"get({quoted(cells)}, {i}) AS {quoted(name)}" for i, name in enumerate(names)]


def _with_cells(df: DataFrame, cells: Column, names: Sequence[str]) -> DataFrame:
    held = fresh_name(df.columns, "_cells")
    return df.select("*", cells.alias(held)).selectExpr(*map(quoted, df.columns), *_spread(held, names))


def extract_dates(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the first date of each raw cell as text, NULL for a NULL cell."""
    return _with_cells(df, dates.extract_cells(_raws(), strict), EXTRACTED_COLUMNS)


def format_dates(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add each cell's formatted value. The issue date has no suspended state."""
    return _with_cells(df, dates.format_cells(_raws(), strict=strict), FORMATTED_COLUMNS)


def status_flags(last: Column, first: Column, cells: int = len(SHORT_NAMES)) -> list[Column]:
    """Whether any cell is suspended, and the first such position (NULL if none)."""
    return [
        (last > 0).alias("co_dinh_chi"),
        F.when(first <= cells, first).alias("vi_tri_dinh_chi_dau_tien"),
    ]


def mart_columns(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Narrow formatted rows to the mart: 35 columns, 34 if no run time is wanted.

    `first_dc_pos` keeps 28 where nothing is suspended; the nullable column beside
    it says the same with NULL.
    """
    cells = F.array(*[F.col(n) for n in FORMATTED_COLUMNS])
    return _mart(df.select("id", "cong_ty", KIND, cells.alias("_cells")), run_ts)


def _mart(df: DataFrame, run_ts: Column | None) -> DataFrame:
    cells = F.col("_cells")
    run = [] if run_ts is None else [run_ts.alias("dbt_updated_at")]
    placed = df.select(
        "*", dates.last_position(cells).alias("last_dc_pos"), dates.first_position(cells).alias("first_dc_pos"), *run
    ).selectExpr(
        "id",
        "cong_ty",
        KIND,
        *_spread("_cells", SHORT_NAMES),
        "last_dc_pos",
        "first_dc_pos",
        *["dbt_updated_at" for _ in run],
    )
    return placed.select("*", *status_flags(F.col("last_dc_pos"), F.col("first_dc_pos")))


def status_mart(df: DataFrame, run_ts: Column | None = None, strict: bool = False) -> DataFrame:
    """Extract, format and narrow in one pass from the coerced rows.

    Same rows as `mart_columns(format_dates(extract_dates(df)))`, but the cells stay
    together from the scan to the last projection instead of being spread out and
    gathered again between the steps.
    """
    cells = dates.format_cells(_raws(), strict=strict)
    return _mart(df.select("id", "cong_ty", KIND, cells.alias("_cells")), run_ts)
