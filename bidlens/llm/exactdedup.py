"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Copies are combined three times: inside each task before anything moves, then per (digest,
salt), then over the salts. The text is part of the key at each stage, so equal digests
of different texts never merge. The salt is the number of the input partition: copies that a
task has combined travel as one row, and those of a hot group meet first in ``SALTS``
places. What comes out is a small row per distinct text, which is stored. Documents find
theirs by digest; if any digest should turn out to have several texts, they find it by the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import id_and_text, stored

SALTS = 8
#: Fixed value: the white space that does not count.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """``digest, body, keep_id, group_size`` per distinct text of ``rows(doc_id, digest, body)``."""
    local = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    salted = local.groupBy("digest", "salt", "body").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "body").agg(
        F.min("least").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of each row, dropped ones too.

    Texts are equal when identical after each run of white space became one space; null
    counts as empty. ``keep_id`` is the smallest id of a group; null ids come last, and a group of
    only null ids has a null ``keep_id`` and is kept. Rows that repeat an id with its text are
    one document, so all of them have the same ``kept``. ``group_size`` counts rows. Other
    columns are not read; an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    found = distinct_texts(rows)
    groups = stored(found.select("digest", "keep_id", "group_size"), "exact-groups")
    clash = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    if clash.isEmpty():  # each digest stands for one text, as it was compared above
        placed = rows.select("doc_id", "digest").join(groups, "digest")
    else:
        placed = rows.join(found, ["digest", "body"])
    return placed.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))
