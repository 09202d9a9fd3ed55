"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. Stages handle null values and empty tables as the operators
that they call do, and carry no column but those of documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import mixing, near_dups, packing, quality_model, quality_rules
from tidemill.llm.common import stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a null text is scored as empty."""
    docs = docs.select(*COLUMNS)
    model = quality_model.fit_sample(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).filter("accepted").select(*COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null text has no words and goes."""
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"), keep=COLUMNS[1:])
    return judged.filter("kept").select(*COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, and of rows that repeat.

    Groups are linked by five-word shingles of similarity 0.8 or more. Documents
    without an id or without words belong to no group and stay.
    """
    docs = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    key = ["doc_id", "text_hash"]  # an id may have several texts, each with its own group
    groups = stage(near_dups.near_duplicates(docs, hash_as="text_hash").select(*key, "kept"), "groups")
    kept = docs.join(groups.filter("not kept").select(*key), key, "left_anti")
    repeated = groups.filter("kept and doc_id is not null").groupBy(*key).count().filter("count > 1")
    repeated = stage(repeated.select(*key), "repeated")
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    once = kept.join(repeated, key, "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, key, "left_anti").select(*COLUMNS).unionByName(once)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources draws them, each at least once.

    Rows that are alike in all columns are drawn one by one and written alike.
    """
    docs = docs.select(*COLUMNS)
    digest = F.xxhash64(*COLUMNS)
    drawn = mixing.mix(docs, digest=digest).select(F.col("doc_id").alias("d_id"), F.col("digest").alias("d_digest"))
    keyed = docs.withColumn("digest", digest).dropDuplicates(["doc_id", "digest"])
    same = [F.col("doc_id").eqNullSafe(F.col("d_id")), F.col("digest") == F.col("d_digest")]
    return keyed.join(drawn, reduce(lambda a, b: a & b, same)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of a document with its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("quality rules", rules),
    ("near-duplicates", dedup),
    ("source mix", mix),
    ("packing", pack),
]

# The classifier, the tokens and the packing cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"stage{i}")
    return docs
