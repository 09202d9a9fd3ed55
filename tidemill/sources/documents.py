"""Read JSON documents and set broken ones apart.

Without a schema, documents are parsed once into variants and stored; their common
schema is then an aggregate over the stored variants, and the columns are taken out of
them. The files themselves are read a single time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemill.functions.names import fresh_name

CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Multi-line JSON: one object or one array of objects per file.

    Without `schema` Spark reads everything once to infer one and again for the rows.
    `keep_corrupt` makes sure that the text of broken documents has a column. Where
    every document is broken that is the only one.
    """
    reader = spark.read.option("multiLine", True)
    if schema is None:
        rows = reader.json(list(paths))
        if rows.columns == [CORRUPT]:
            # Spark refuses to read this column alone, and here it is the whole file.
            return spark.read.text(list(paths), wholetext=True).toDF(CORRUPT)
        return rows
    if keep_corrupt and CORRUPT not in schema.names:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return reader.schema(schema).json(list(paths))


# What a variant can hold; a longer document has to be read with a schema of its own.
VARIANT_BYTES = 128 * 1024 * 1024 - 1
_DOCUMENT = "_document"


class TooLong(ValueError):
    """A document has more bytes than a variant can hold."""


def parse_documents(spark: SparkSession, paths: Sequence[str], day: str | None = None) -> DataFrame:
    """A row per document, as a variant, and the text of broken ones.

    A file holds one object or one array of objects; blank files hold none. What does not
    parse, repeats a key or is no object is broken. `day` names a column for the day of
    each row's file.
    """
    texts = spark.read.text(list(paths), wholetext=True)
    texts = texts if day is None else with_day(texts, day)
    extra = [] if day is None else [F.col(day)]
    filled = F.trim(F.translate("value", "\t\r\n", "   ")) != ""
    parsed = texts.filter(filled).select(F.try_parse_json("value").alias("_parsed"), "value", *extra)
    failed = F.col("_parsed").isNull()
    # Settled before the elements are spread out, so that no row of them carries the text.
    told = parsed.select(
        "_parsed",
        F.when(failed, F.col("value")).alias("_text"),
        F.when(failed & (F.octet_length("value") > VARIANT_BYTES), F.lit(True)).alias("_long"),
        *extra,
    )
    # The elements of an array, or the whole document as one of its kind.
    each = F.coalesce(F.try_variant_get("_parsed", "$", "array<variant>"), F.array("_parsed"))
    rows = told.select(F.explode(each).alias(_DOCUMENT), "_text", "_long", *extra)
    whole = F.schema_of_variant(_DOCUMENT).startswith("OBJECT")
    broken = F.coalesce(F.col("_text"), F.to_json(_DOCUMENT), F.lit("null"))
    return rows.select(
        F.when(whole, F.col(_DOCUMENT)).alias(_DOCUMENT),
        F.when(F.coalesce(whole, F.lit(False)), None).otherwise(broken).alias(CORRUPT),
        "_long",
        *extra,
    )


def typed_documents(parsed: DataFrame) -> DataFrame:
    """Columns of stored documents: what `read_json` infers, without reading a file.

    Numbers with a fraction are doubles; a field of several kinds, or always null, is
    text. The text of broken documents keeps its column if there are any. Columns beside
    the document come last, under another name where a field has theirs.
    """
    schema, broken, long = parsed.agg(
        F.schema_of_variant_agg(_DOCUMENT), F.count(CORRUPT), F.count("_long")
    ).head()
    if long:
        raise TooLong(f"{long} documents have more than {VARIANT_BYTES} bytes")
    fields = StructType()
    if schema.startswith("OBJECT<"):
        parsed = parsed.withColumn(_DOCUMENT, F.try_variant_get(_DOCUMENT, "$", column_types(schema)))
        fields = parsed.schema[_DOCUMENT].dataType
    names = [n for n in fields.names if n != CORRUPT]  # that column is ours, as it is the reader's
    extra = [c for c in parsed.columns if c not in (_DOCUMENT, CORRUPT, "_long")]
    return parsed.select(
        *[F.col(_DOCUMENT).getField(n).alias(n) for n in names],
        *[F.col(CORRUPT)] * bool(broken),
        *[F.col(c).alias(fresh_name([*names, CORRUPT], c)) for c in extra],
    )


# Parts of a schema's text: a quoted name, a decimal type, or a word.
_SCHEMA_PART = re.compile(r"`(?:[^`]|``)*`|DECIMAL\(\d+,\s*\d+\)|\w+")
_TYPES = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}


def column_types(schema: str) -> str:
    """The schema of variants as the type of the columns they become."""

    def part(found: re.Match) -> str:
        word = found[0]
        if word.startswith("DECIMAL"):
            return word if word.rstrip(")").endswith((",0", ", 0")) else "DOUBLE"
        # A word before a colon is a field's name, whatever it says.
        named = schema[found.end() :].lstrip().startswith(":")
        if word.startswith("`"):
            return word
        return f"`{word}`" if named else _TYPES.get(word, word)

    return _SCHEMA_PART.sub(part, schema)


def with_day(df: DataFrame, name: str) -> DataFrame:
    """Add the day of each row's file, from the last folder that starts with a date."""
    day = F.regexp_extract(F.col("_metadata.file_path"), r"^.*/(\d{4}-\d{2}-\d{2})[^/]*/[^/]*$", 1)
    return df.withColumn(name, F.nullif(day, F.lit("")))


def folder_globs(folders: Sequence[str], suffix: str = ".json") -> list[str]:
    """Reader paths for the files right inside each folder."""
    special = str.maketrans({c: "\\" + c for c in "\\{}[]*?,"})
    return [f"{folder.translate(special)}/*{suffix}" for folder in folders]


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Remove the corrupt-text column. The broken row stays, with NULLs."""
    return df.drop(CORRUPT)


def split_corrupt(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows set aside): broken documents and rows without a key.

    A NULL key matches nothing, so loading such rows adds them again on every run.
    """
    aside = reduce(or_, [F.col(k).isNull() for k in keys], F.lit(False))
    if CORRUPT in df.columns:
        aside = aside | F.col(CORRUPT).isNotNull()
    return drop_corrupt(df.filter(~aside)), df.filter(aside)
