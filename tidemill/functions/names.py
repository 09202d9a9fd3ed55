"""Columns by their whole name, and names for helper columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its whole name: `a.b` is one column, not a field of `a`."""
    return F.col(quoted(name))


def fresh_name(columns: Iterable[str], stem: str) -> str:
    """A name that none of the columns has, compared without regard to case."""
    taken = {c.lower() for c in columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
