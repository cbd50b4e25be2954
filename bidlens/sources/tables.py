"""Batch sources: stored tables, external stores and headerless CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.sources.schemas import IMPRESSION_MESSAGE
from bidlens.sources.payloads import to_impressions


def read_table(spark: SparkSession, source: str, format: str | None = None,
               **options: str) -> DataFrame:
    """A stored table.

    Without ``format``: a catalog table or view. With it: any data source, such
    as ``parquet``, ``jdbc`` or a key-value store's connector; ``source`` is its
    path, or the table name for sources that are not files. Filters and
    column lists are pushed down by the source.
    """
    if format is None:
        return spark.table(source)
    reader = spark.read.format(format).options(**options)
    if format == "jdbc":
        return reader.option("dbtable", source).load()
    if format in ("parquet", "orc", "csv", "json", "text", "binaryFile", "avro"):
        return reader.load(source)
    return reader.option("table", source).load()


def csv_ingest(spark: SparkSession, path: str,
               schema: T.StructType = IMPRESSION_MESSAGE) -> DataFrame:
    """Impressions from headerless CSV files with epoch milliseconds first.

    Files are split by size and parsed on the executors; a malformed line fails
    the job instead of passing as nulls.
    """
    raw = spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
    return to_impressions(raw)


def target_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast to a target table's schema, by name; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
