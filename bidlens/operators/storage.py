"""Table management, clustered appends and last-wins upserts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.functions import null_safe_join
from bidlens.operators.sizing import broadcast_within
from bidlens.sources.tables import target_columns
from bidlens.sources.workspace import drop_path, list_names, materialize, path_exists, scratch


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_column_table(spark: SparkSession, name: str, schema: T.StructType,
                        bucket_key: str | None = None, buckets: int | None = None,
                        partition_by: list[str] | None = None,
                        location: str | None = None) -> DataFrame:
    """Create an empty Parquet table and return it.

    A bucket key makes later joins and aggregations on it free of a shuffle; pick
    one without very frequent values, since a value lives in one bucket. Without a
    key, rows are stored as they come.
    ``location`` keeps the files outside the warehouse folder.
    """
    if buckets and not bucket_key:
        raise ValueError("buckets need a bucket_key; Spark has no buckets without a key")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    text = f"CREATE TABLE {name} ({columns}) USING parquet"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if bucket_key:
        text += f" CLUSTERED BY (`{bucket_key}`) INTO {buckets or 32} BUCKETS"
    if location:
        text += f" LOCATION '{location}'"
    spark.sql(text)
    return spark.table(name)


def store_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int,
                   location: str | None = None) -> DataFrame:
    """Store rows as a new table in buckets of all ``keys``, and return it.

    Tables with the same number of buckets of keys that are joined meet without a shuffle, and so do
    groups by these keys. Rows are dealt as the buckets are before they are written, so that a bucket is one sorted
    file, however many tasks there were. Choose keys without very frequent values: a value lives in one bucket.
    """
    writer = (df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys))
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to a catalog table, matching columns by name and casting to its types."""
    spark = df.sparkSession
    target_columns(df, spark.table(table).schema).write.insertInto(table)


def clustered(df: DataFrame, key: str, target: T.StructType | None = None) -> DataFrame:
    """Rows grouped and sorted by a key for writing, cast to the target's columns.

    The rebalance hint shuffles by key and lets adaptive execution split an
    oversized key over several tasks and merge small ones, so one hot key
    neither fills a single task nor a single file.
    """
    if target is not None:
        df = target_columns(df, target)
    return df.hint("rebalance", key).sortWithinPartitions(key)


def clustered_append(df: DataFrame, path: str, key: str,
                     target: T.StructType | None = None,
                     partition_by: list[str] | None = None) -> None:
    """Append clustered rows to a Parquet table; sorted files let scans skip row groups."""
    writer = clustered(df, key, target).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the greatest in ``order_cols``, compared in turn.

    Spark drops all but one row per key inside each task before the shuffle.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return (df.withColumn("__place", F.row_number().over(order))
              .where("__place = 1").drop("__place"))


def upsert_latest(target: DataFrame, updates: DataFrame, keys: list[str],
                  order_cols: list[str], touched: DataFrame | None = None) -> DataFrame:
    """The target after an upsert: per key the row with the greatest version.

    End ``order_cols`` with enough columns to make the order total, then the
    result does not depend on arrival order and repeating the upsert changes
    nothing. Target rows whose key is not updated pass through a plain anti
    join and are never sorted; only contested rows enter the ranking. The updated
    keys are stored and counted first, and broadcast if they are few, in which case
    the target is not shuffled. The target must hold one row per key already. A caller who
    has stored the distinct updated keys passes them as ``touched``; otherwise they
    are checkpointed and stay in the checkpoint folder.
    """
    updates = updates.select(*target.columns)
    if touched is None:
        touched = materialize(updates.select(*keys).distinct())
    touched = broadcast_within(touched)
    contested = null_safe_join(target, touched, keys, "left_semi")
    untouched = null_safe_join(target, touched, keys, "left_anti")
    winners = latest_per_key(contested.unionByName(updates), keys, order_cols)
    return untouched.unionByName(winners)


def upsert_partitioned(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                       order_cols: list[str], partition_by: str) -> None:
    """Upsert into a partitioned Parquet table, rewriting only touched partitions.

    The partition column must be a function of the key. Other partitions are
    pruned at run time and their files stay as they are. A missing table is created.
    The updated keys are stored for the time of the call only.
    """
    if not path_exists(spark, path):
        first = latest_per_key(updates, keys, order_cols)
        first.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
        return
    stored = spark.read.schema(updates.schema).parquet(path)
    updates = updates.select(*stored.columns)
    with scratch(spark, "upsert") as home:
        updates.select(*keys).distinct().write.parquet(f"{home}/keys")
        updates.select(partition_by).distinct().write.parquet(f"{home}/parts")
        parts = broadcast_within(spark.read.parquet(f"{home}/parts"))
        target = null_safe_join(stored, parts, [partition_by], "left_semi")
        merged = upsert_latest(target, updates, keys, order_cols,
                               spark.read.parquet(f"{home}/keys"))
        (merged.hint("rebalance", partition_by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))


def retain_window(spark: SparkSession, path: str, date_column: str, days: int,
                  today: date, dry_run: bool = False) -> list[str]:
    """Keep the ``days`` dates up to ``today`` of a date-partitioned table; returns what goes.

    Works on partition folders only: no data file is read. Dates after ``today`` are an error,
    as one wrong date must not decide what is old. ``dry_run`` only tells.
    """
    prefix = f"{date_column}="
    dates = [d[len(prefix):] for d in list_names(spark, path) if d.startswith(prefix)]
    dates = [d for d in dates if d != "__HIVE_DEFAULT_PARTITION__"]
    later = [d for d in dates if date.fromisoformat(d) > today]
    if later:
        raise ValueError(f"{date_column} has dates after {today}: {', '.join(later[:5])}")
    oldest_kept = today - timedelta(days=days - 1)
    gone = [d for d in dates if date.fromisoformat(d) < oldest_kept]
    for d in [] if dry_run else gone:
        drop_path(spark, f"{path}/{prefix}{d}")
    return gone
