"""A corpus pipeline: five stages, each over all rows that the one before it kept.

A row, not an id, is what a stage judges. Where ids are missing or repeated, each row gets a number in order of
``doc_id``, null ids last, then of its text, and stages work on that: of equal rows, with an id or without,
one stays after exact dedup; rows that share an id but not a text are judged apart, by the labels of
their id; a row without an id has no labels. Null texts count as empty. Other columns pass through; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.llm import bpe, decontaminate, exactdedup, quality, simhash
from bidlens.llm.common import stored, table
from bidlens.llm.queries import BYTE_BPE

KEY = "row_key_of_stage"


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``KEY`` of each row, in order of ``doc_id``: the id itself where ids are unique."""
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(KEY, F.col("doc_id").cast("long"))
    # The place in the input comes last, so that many equal rows can be sorted in many tasks.
    placed = docs.withColumn(KEY, F.monotonically_increasing_id()).orderBy(
        F.col("doc_id").asc_nulls_last(), F.sha2(F.coalesce("text", F.lit("")), 256), KEY)
    return stored(placed.withColumn(KEY, F.monotonically_increasing_id()), "numbered")


def _texts(rows: DataFrame) -> DataFrame:
    """What operators read of numbered rows, the number in place of the id."""
    return rows.select(F.col(KEY).alias("doc_id"), "text", "lang")


def _keep(rows: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """The numbered rows that are (or with ``left_anti`` are not) in ``found(doc_id)``, without their number."""
    return rows.join(found.select(F.col("doc_id").alias(KEY)), KEY, how).select(
        *[f"`{c}`" for c in rows.columns if c != KEY])


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the language model of trusted text rejects."""
    rows, labels = by_row(docs), table(spark, sf_dir, "labels")
    labels = rows.select("doc_id", KEY).join(labels.select("doc_id", "quality", "toxic"), "doc_id").select(
        F.col(KEY).alias("doc_id"), "quality", "toxic")
    return _keep(rows, quality.classify(_texts(rows), labels).where("NOT rejected"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row of each group of equal texts."""
    rows = by_row(docs)
    return _keep(rows, exactdedup.exact_groups(_texts(rows)).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row of each group of linked fingerprints."""
    rows = by_row(docs)
    return _keep(rows, simhash.near_groups(_texts(rows)).where("doc_id = component_id"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows with a passage of a benchmark item."""
    rows = by_row(docs)
    leaks = decontaminate.overlaps(_texts(rows), table(spark, sf_dir, "benchmark"))
    return _keep(rows, leaks.select("doc_id").distinct(), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of each row's token ids and of the text that they decode to."""
    return bpe.round_trip(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("bpe encoding", encode),
]

#: SQL cannot express perplexities, fingerprints or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
