"""Dates inside free-text certificate cells.

A cell is empty, says that the certificate is suspended, holds a day/month/year
date somewhere in its text, or is invalid. Everything here is a Spark column
expression. Dates are padded and checked as text: parsing them costs several times
more per cell, and each impossible date raises and catches an exception.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.binding import Step, bind

# The texts that readers of the mart compare against.
SUSPENDED = "ĐÌNH CHỈ"
INVALID = "SAI"
SUSPENDED_TEXT = "đình chỉ"

# Fixed value: day 1-31, month 1-12, two to four year digits, anywhere in the text.
DATE_PATTERN = r"(?:0?[1-9]|[12]\d|3[01])/(?:0?[1-9]|1[0-2])/\d{2,4}"
STRICT_DATE_PATTERN = r"(?<!\d)" + DATE_PATTERN + r"(?!\d)"

# Day-month pairs the pattern lets through that no year has.
_IMPOSSIBLE_DAYS = ("30-02", "31-02", "31-04", "31-06", "31-09", "31-11")


def extract_date(raw: Column, strict: bool = False) -> Column:
    """First date in the text: `''` when there is none, NULL for a NULL cell.

    The search is not anchored, so `32/1/2024` yields `2/1/2024`; `strict` refuses
    a date that touches further digits.
    """
    pattern = STRICT_DATE_PATTERN if strict else DATE_PATTERN
    return F.when(raw.contains("/"), F.regexp_extract(raw, pattern, 0)).when(
        raw.isNotNull(), ""
    )


def is_suspended(raw: Column) -> Column:
    """The cell mentions a suspension, in any letter case, in composed Unicode."""
    # The text has letters outside ASCII, so plain dates skip the case folding.
    return (F.octet_length(raw) > F.length(raw)) & F.lower(raw).contains(SUSPENDED_TEXT)


def is_blank(raw: Column) -> Column:
    """NULL or nothing but spaces. Tabs and no-break spaces are not blank."""
    return F.coalesce(F.trim(raw), F.lit("")) == ""


def _assemble(sign: str) -> Step:
    """Day, month and year texts to `dd?MM?yyyy`; a three-digit year to NULL.

    Two digits, and `00` before two digits, mean this century.
    """

    def step(parts: Column) -> Column:
        day, month, year = (F.get(parts, F.lit(i)) for i in range(3))
        century = F.concat(F.lit("20"), F.substring(year, -2, 2))
        width = F.octet_length(year)
        full = F.when(width == 2, century).when(
            width == 4, F.when(year.startswith("00"), century).otherwise(year)
        )
        return F.concat(F.lpad(day, 2, "0"), F.lit(sign), F.lpad(month, 2, "0"), F.lit(sign), full)

    return step


def _impossible(date: Column) -> Column:
    """A full date whose month does not have that day."""
    year = F.substring(date, 7, 4).cast("int")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return F.substring(date, 1, 5).isin(*_IMPOSSIBLE_DAYS) | (date.startswith("29-02") & ~leap)


def _existing(date: Column) -> Column:
    """The date, or NULL if there is no such day; most days are in every month."""
    return F.when((date < "29") | ~_impossible(date), date)


def expand_year(extracted: Column) -> Column:
    """Padded `dd/MM/yyyy` text of an extracted date; short years mean 20yy."""
    full = bind(F.split(extracted, "/"), _assemble("/"))
    return F.when(extracted == "", "").otherwise(full)


def normalise_date(extracted: Column) -> Column:
    """`dd-MM-yyyy` text of an extracted date; NULL if there is no such day."""
    date = bind(F.split(extracted, "/"), _assemble("-"), _existing)
    return F.when(extracted == "", "").otherwise(date)


def _outcome(extracted: Column, strict: bool) -> Column:
    """A cell that is neither blank nor suspended, from its date."""
    date = normalise_date(extracted)
    if strict:
        date = F.coalesce(date, F.lit(INVALID))
    return F.when(extracted == "", INVALID).otherwise(date)


def classify_cell(
    raw: Column, extracted: Column, check_suspended: bool | Column = True, strict: bool = False
) -> Column:
    """`''`, the suspended marker, a `dd-MM-yyyy` date, NULL or the invalid marker.

    NULL stands for a date that looks right but does not exist (`31/2/2024`);
    `strict` reports it as invalid instead. A suspension wins over a date in the
    same cell.
    """
    return (
        F.when(is_blank(raw), "")
        .when(F.lit(check_suspended) & is_suspended(raw), SUSPENDED)
        .otherwise(bind(extracted, lambda date: _outcome(date, strict)))
    )


def extract_cells(raws: Sequence[Column], strict: bool = False) -> Column:
    """`extract_date` of many cells as one array.

    One expression over the array, however many cells there are: 27 of them written out
    make a method too long for the JVM to compile, which costs twice as much.
    """
    return F.transform(F.array(*raws), lambda raw: extract_date(raw, strict))


def format_cells(raws: Sequence[Column], unchecked: int = 1, strict: bool = False) -> Column:
    """Extract and classify many raw cells as one array.

    Gives what `classify_cell` of each cell's first date gives. The first `unchecked`
    cells are not asked for a suspension.
    """
    return F.transform(
        F.array(*raws), lambda raw, i: classify_cell(raw, extract_date(raw, strict), i >= unchecked, strict)
    )


def last_position(cells: Column, value: str = SUSPENDED) -> Column:
    """One-based position of the last element equal to `value`; 0 if none is."""
    from_end = F.array_position(F.reverse(cells), F.lit(value))
    return F.when(from_end > 0, F.size(cells) + 1 - from_end).otherwise(0).cast("int")


def first_position(cells: Column, value: str = SUSPENDED) -> Column:
    """One-based position of the first element equal to `value`; size + 1 if none is."""
    at = F.array_position(cells, F.lit(value))
    return F.when(at > 0, at).otherwise(F.size(cells) + 1).cast("int")
