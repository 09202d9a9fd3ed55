"""Cells: every outcome, one by one and in arrays."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates

# raw cell, extracted text, value, value with strict rules
CASES = [
    (None, None, "", ""),
    ("", "", "", ""),
    ("   ", "", "", ""),
    ("Đình chỉ 12/03/2023", "12/03/2023", "ĐÌNH CHỈ", "ĐÌNH CHỈ"),
    ("ĐÌNH CHỈ", "", "ĐÌNH CHỈ", "ĐÌNH CHỈ"),
    ("tạm đình chỉ", "", "ĐÌNH CHỈ", "ĐÌNH CHỈ"),
    ("05/03/2024", "05/03/2024", "05-03-2024", "05-03-2024"),
    ("5/3/24", "5/3/24", "05-03-2024", "05-03-2024"),
    ("5/03/24", "5/03/24", "05-03-2024", "05-03-2024"),
    ("15/3/24", "15/3/24", "15-03-2024", "15-03-2024"),
    ("5/3/0024", "5/3/0024", "05-03-2024", "05-03-2024"),
    ("5/3/0000", "5/3/0000", "05-03-2000", "05-03-2000"),
    ("31/12/99", "31/12/99", "31-12-2099", "31-12-2099"),
    ("cap 5/3/24 roi 06/04/2024", "5/3/24", "05-03-2024", "05-03-2024"),
    ("15-03-2024", "", "SAI", "SAI"),
    ("15/13/2024", "", "SAI", "SAI"),
    ("\t", "", "SAI", "SAI"),
    ("\u00a0", "", "SAI", "SAI"),
    (unicodedata.normalize("NFD", "đình chỉ"), "", "SAI", "SAI"),
    ("không rõ", "", "SAI", "SAI"),
    ("a/b", "", "SAI", "SAI"),
    ("31/2/2024", "31/2/2024", None, "SAI"),
    ("30/02/2024", "30/02/2024", None, "SAI"),
    ("31/4/24", "31/4/24", None, "SAI"),
    ("31/11/0024", "31/11/0024", None, "SAI"),
    ("29/2/2024", "29/2/2024", "29-02-2024", "29-02-2024"),
    ("29/2/24", "29/2/24", "29-02-2024", "29-02-2024"),
    ("29/2/0024", "29/2/0024", "29-02-2024", "29-02-2024"),
    ("29/2/23", "29/2/23", None, "SAI"),
    ("29/2/1900", "29/2/1900", None, "SAI"),
    ("29/2/2000", "29/2/2000", "29-02-2000", "29-02-2000"),
    ("1/2/024", "1/2/024", None, "SAI"),
    ("1/2/0124", "1/2/0124", "01-02-0124", "01-02-0124"),
]
# Cells whose extracted text depends on the strict rule.
TOUCHING = [
    ("32/1/2024", "2/1/2024", "02-01-2024"),
    ("1/2/20245", "1/2/2024", "01-02-2024"),
    ("00/1/2024", "", "SAI"),
]


@pytest.fixture(scope="module")
def cells(spark):
    raws = [(i, c[0]) for i, c in enumerate(CASES)]
    return spark.createDataFrame(raws, "i int, raw string").cache()


def column(df, value):
    return [r[0] for r in df.orderBy("i").select(value).collect()]


def test_extract(cells):
    assert column(cells, dates.extract_date(F.col("raw"))) == [c[1] for c in CASES]


@pytest.mark.parametrize("strict", [False, True])
def test_classify_one_cell(cells, strict):
    raw = F.col("raw")
    value = dates.classify_cell(raw, dates.extract_date(raw, strict), strict=strict)
    assert column(cells, value) == [c[3 if strict else 2] for c in CASES]


def gathered(cells):
    """All cells as columns of one row, behind a first that is not asked for a suspension."""
    raws = [r["raw"] for r in cells.orderBy("i").collect()]
    schema = ", ".join(f"c{i} string" for i in range(len(raws) + 1))
    return cells.sparkSession.createDataFrame([("", *raws)], schema)


@pytest.mark.parametrize("strict", [False, True])
def test_arrays_agree_with_single_cells(cells, strict):
    row = gathered(cells)
    raws = [F.col(c) for c in row.columns]
    picked = lambda array: [F.get(array, F.lit(i)) for i in range(1, len(raws))]
    formatted = row.select(*picked(dates.format_cells(raws, strict=strict))).head()
    assert list(formatted) == [c[3 if strict else 2] for c in CASES]
    if not strict:
        found = row.select(*picked(dates.extract_cells(raws))).head()
        assert list(found) == [c[1] for c in CASES]


def test_unchecked_cells_have_no_suspended_state(spark):
    texts = ["Đình chỉ 12/03/2023", "ĐÌNH CHỈ", "ĐÌNH CHỈ"]
    df = spark.createDataFrame([tuple(texts)], "a string, b string, c string")
    cells = [F.col(c) for c in "abc"]
    row = df.select(dates.format_cells(cells), dates.format_cells(cells, unchecked=0)).head()
    assert row[0] == ["12-03-2023", "ĐÌNH CHỈ", "ĐÌNH CHỈ"]
    assert row[1] == ["ĐÌNH CHỈ"] * 3


# Control characters, and everything that some engine takes for the end of a line.
BREAKS = [chr(c) for c in [*range(1, 32), 0x7F, 0x85, 0x2028, 0x2029]]


def test_control_characters_are_text(spark):
    """In any cell, the last one too, they are no blanks and end no search."""
    rows = [(i, f"  {c}", f"1/2/2024{c}", f"{c}Đình chỉ{c}") for i, c in enumerate([*BREAKS, "\r\n", "$1 \\"])]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string")
    for last in "abc":
        cells = [F.col(c) for c in (*sorted(set("abc") - {last}), last)]
        got = column(df, dates.format_cells(cells, unchecked=0))
        values = {"a": "SAI", "b": "01-02-2024", "c": "ĐÌNH CHỈ"}
        assert got == [[values[c] for c in (*sorted(set("abc") - {last}), last)]] * len(rows)


def test_arrays_agree_on_any_text(spark):
    draw = random.Random(11)
    parts = [*"0123/ -\n\r\x1f\u2028", "Đình chỉ", *(f"{d}/{m}/" for d in (1, 29, 31, "09") for m in (2, 11, "03")), "24", "1900"]
    some = lambda: "".join(draw.choices(parts, k=draw.randrange(6)))
    df = spark.createDataFrame([(some(), some(), some()) for _ in range(3000)], "a string, b string, c string")
    cells = [F.col(c) for c in "abc"]
    alone = [dates.classify_cell(c, dates.extract_date(c), check_suspended=i > 0) for i, c in enumerate(cells)]
    rows = df.select(dates.format_cells(cells), F.array(*alone)).collect()
    assert all(together == single for together, single in rows)
    assert len({v for together, _ in rows for v in together}) > 50


@pytest.mark.parametrize("raw, found, value", TOUCHING)
def test_search_is_not_anchored(spark, raw, found, value):
    df = spark.createDataFrame([(0, raw)], "i int, raw string")
    c = F.col("raw")
    loose = dates.extract_date(c)
    assert column(df, loose) == [found]
    assert column(df, dates.classify_cell(c, loose)) == [value]
    assert column(df, dates.extract_date(c, strict=True)) == [""]


def test_every_day_agrees_with_the_parser(spark):
    """All day/month pairs over leap and common years, in three spellings."""
    days = (
        spark.range(1, 32)
        .withColumnRenamed("id", "d")
        .join(spark.range(1, 13).withColumnRenamed("id", "m"))
        .join(spark.createDataFrame([(y,) for y in (1900, 1999, 2000, 2023, 2024)], "y int"))
    )
    text = F.concat_ws("/", "d", "m", "y")
    short = F.concat_ws("/", "d", "m", F.substring(F.col("y").cast("string"), 3, 2))
    zeros = F.concat_ws("/", "d", "m", F.concat(F.lit("00"), F.substring(F.col("y").cast("string"), 3, 2)))
    year20 = F.concat_ws("/", "d", "m", F.concat(F.lit("20"), F.substring(F.col("y").cast("string"), 3, 2)))

    def parsed(c):
        return F.date_format(F.try_to_date(c, "d/M/yyyy"), "dd-MM-yyyy")

    wrong = days.filter(
        ~dates.normalise_date(text).eqNullSafe(parsed(text))
        | ~dates.normalise_date(short).eqNullSafe(parsed(year20))
        | ~dates.normalise_date(zeros).eqNullSafe(parsed(year20))
    )
    assert wrong.count() == 0


def test_expand_year(spark):
    df = spark.createDataFrame([(0, "5/3/24"), (1, "05/03/0024"), (2, "5/3/024"), (3, "")], "i int, x string")
    assert column(df, dates.expand_year(F.col("x"))) == ["05/03/2024", "05/03/2024", None, ""]


def test_positions(spark):
    mark = dates.SUSPENDED
    data = [(0, ["", mark, None, mark]), (1, ["", "SAI", None, ""]), (2, [mark, "", "", ""])]
    df = spark.createDataFrame(data, "i int, c array<string>")
    assert column(df, dates.last_position(F.col("c"))) == [4, 0, 1]
    assert column(df, dates.first_position(F.col("c"))) == [2, 5, 1]
