"""Evaluate a column once and use it several times inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


def through(values: Column, *steps: Step) -> Column:
    """Send every element of an array column through `steps`, in order.

    A step may use its argument as often as it likes: the element is a lambda
    variable, so the step before it runs once per element. Written over plain
    columns the same chain would be copied into every place that uses it, which is
    what makes wide projections overflow the generated method.
    """
    for step in steps:
        values = F.transform(values, step)
    return values


def bind(value: Column, *steps: Step) -> Column:
    """`through` for a single column."""
    return F.get(through(F.array(value), *steps), F.lit(0))
