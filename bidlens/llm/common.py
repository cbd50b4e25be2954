"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.sources.workspace import work_dir

#: Characters of text that a task handles at once; texts are never cut.
SLICE_CHARS = 1 << 22
#: Entries of a worker's memory of words; it starts anew when full.
MEMO_WORDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``; a null text is empty."""
    return df.select(df[id_col].cast("long").alias("doc_id"),
                     F.coalesce(df[text_col], F.lit("")).alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends there."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``size`` bytes in all, so that memory stays bounded."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, min(n, int(n * size / max(1, batch.nbytes))))
        for start in range(0, n, step):
            yield batch.slice(start, step)
