"""Changes to a table as DataFrame work: upsert and append."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.names import col, fresh_name


class DuplicateKeys(ValueError):
    """The source holds a key more than once, so the result would be ambiguous."""


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise `DuplicateKeys` if a key repeats. NULL keys match nothing and may repeat."""
    has_key = reduce(and_, [col(k).isNotNull() for k in keys])
    # Counts are combined before the shuffle, so one hot key is one row per task.
    n = fresh_name(keys, "n")
    counted = source.filter(has_key).groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias(n))
    example = counted.filter(F.col(n) > 1).select(*map(col, keys)).head()
    if example is not None:
        raise DuplicateKeys(f"source repeats key {example.asDict()}")


def align_columns(
    target: DataFrame, source: DataFrame, on_new: str = "add", on_missing: str = "null"
) -> tuple[DataFrame, DataFrame]:
    """Give both sides the same columns, the target's first.

    New source columns are added to the target as NULL (`add`), left out (`ignore`)
    or refused (`fail`); columns the source lacks become NULL (`null`) or are refused
    (`fail`). Source values are cast to the target's types; a value that does not fit
    fails the job under ANSI rules instead of turning into NULL.
    """
    have = {c.lower(): c for c in source.columns}
    known = {c.lower() for c in target.columns}
    new = [c for c in source.columns if c.lower() not in known]
    missing = [c for c in target.columns if c.lower() not in have]
    if new and on_new == "fail":
        raise ValueError(f"source has new columns {new}")
    if missing and on_missing == "fail":
        raise ValueError(f"source lacks columns {missing}")
    added = new if on_new == "add" else []

    def of_source(field):
        name = have.get(field.name.lower())
        value = F.lit(None) if name is None else col(name)
        return value.cast(field.dataType).alias(field.name)

    wide_target = target.select(
        *map(col, target.columns), *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in added]
    )
    wide_source = source.select(
        *[of_source(f) for f in target.schema.fields], *map(col, added)
    )
    return wide_target, wide_source


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_than: str | None = None,
    check_source: bool = True,
    on_new: str = "add",
    on_missing: str = "null",
) -> DataFrame:
    """Replace target rows whose key is in the source; add source rows that match none.

    As MERGE does: the whole row is replaced, NULLs included; NULL keys match nothing;
    a key that repeats in the target stays repeated. With `newer_than` a target row is
    replaced only by a source row that is not older in that column. `on_new` and
    `on_missing` say what happens to columns only one side has (`align_columns`).

    The source is read up to three times: store it first (`scratch.stage`) unless it is
    a plain scan. Both joins keep the large side on the left, where Spark splits a hot key over
    several tasks and where a source under the broadcast threshold needs no shuffle of
    the target. The second pass reads only the target's keys and stops at those the
    source has.
    """
    if check_source:
        check_unique(source, keys)
    target, source = align_columns(target, source, on_new, on_missing)
    columns = target.columns
    # Key columns by the target's spelling; helper names that neither side has.
    spelled = {c.lower(): c for c in columns}
    keys = [spelled[k.lower()] for k in keys]
    match = fresh_name(columns, "_source")
    helpers = [fresh_name([*columns, match], f"_key{i}_") for i in range(len(keys))]
    marked = source.select(
        F.struct(*map(col, columns)).alias(match), *[col(k).alias(h) for k, h in zip(keys, helpers)]
    )
    on = reduce(and_, [col(k) == F.col(h) for k, h in zip(keys, helpers)])
    joined = target.join(marked, on, "left")
    replace = F.col(match).isNotNull()
    if newer_than is not None:
        time = spelled[newer_than.lower()]
        held, offered = col(time), F.col(match).getField(time)
        replace = replace & (held.isNull() | F.coalesce(offered >= held, F.lit(False)))
    kept = joined.select(
        *[F.when(replace, F.col(match).getField(c)).otherwise(col(c)).alias(c) for c in columns]
    )
    asked = source.select(*[col(k).alias(h) for k, h in zip(keys, helpers)])
    same = reduce(and_, [col(k) == F.col(h) for k, h in zip(keys, helpers)])
    held_keys = target.select(*map(col, keys)).join(asked, same, "left_semi").distinct()
    held_keys = held_keys.toDF(*helpers)
    inserted = source.join(held_keys, same, "left_anti").select(*map(col, columns))
    return kept.unionByName(inserted)


def append(target: DataFrame, df: DataFrame) -> DataFrame:
    """Add all rows. There is no key to compare, so a rerun adds them again."""
    return target.unionByName(df, allowMissingColumns=True)
