"""Exact distinct counts that can be stored and merged: bitmaps over a dictionary of dense ids.

The dictionary only grows: a value keeps its id for ever, so bitmaps of any time can be merged. Ids are
given out per bucket of values, in parallel, and interleaved, so they are dense up to the unevenness of the buckets.
A partial row holds one key and one run of 32,768 ids, and the sums over the impressions whose cookie is in
that run: a hot key is spread over the runs, and one shuffle makes sums and bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidlens.sources.workspace import list_names

BUCKETS = 256
RUN, BITS = "id_run", "bits"
DICTIONARY = "value string, bucket int, place long, id long"


def dictionary(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """``value, bucket, place, id`` of all batches, or of those with a smaller number than ``before``."""
    found = [n for n in list_names(spark, path) if n.startswith("batch=")]
    mine = [f"{path}/{n}" for n in found if before is None or int(n.removeprefix("batch=")) < before]
    if not mine:
        return spark.createDataFrame([], DICTIONARY)
    return spark.read.schema(DICTIONARY).parquet(*mine)


def extend_dictionary(spark: SparkSession, path: str, values: DataFrame, column: str, batch: int,
                      buckets: int = BUCKETS) -> DataFrame:
    """Give ids to the values of ``column`` that have none, and return the dictionary with them.

    Batches are numbered upwards, and a batch that is run again replaces itself: it looks at smaller numbers only,
    and values of one bucket are numbered in their own order. ``buckets`` must stay the same; it is the
    number of tasks that number values. Null values have no id.
    """
    known = dictionary(spark, path, batch)
    new = values.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct().join(
        known.select("value"), "value", "left_anti").withColumn(
        "bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    place = (F.col("place") - 1) * buckets + F.col("bucket")
    if known.where((F.col("id") != place) | (F.col("bucket") >= buckets)).limit(1).collect():
        raise ValueError(f"the dictionary was begun with another number of buckets than {buckets}")
    used = known.groupBy("bucket").agg(F.max("place").alias("used"))
    order = Window.partitionBy("bucket").orderBy("value")
    placed = new.join(used, "bucket", "left").withColumn(
        "place", F.coalesce("used", F.lit(0)) + F.row_number().over(order))
    placed.select("value", "bucket", "place", place.alias("id")).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return dictionary(spark, path, batch + 1)


def exact_partials(df: DataFrame, ids: DataFrame, keys: list[str | Column], column: str = "cookie") -> DataFrame:
    """State per key and run of ids: first instant, sums of bids and rows, and the bitmap of the values seen.

    Rows whose value is null are in a run of their own, null, with an empty bitmap. A value without an id is an
    error: extend the dictionary first.
    """
    found = df.join(ids.select(F.col("value").alias("__value"), F.col("id").alias("__id")),
                    df[column].cast("string") == F.col("__value"), "left").drop("__value")
    missing = F.col(column).isNotNull() & F.col("__id").isNull()
    found = found.withColumn("__id", F.when(missing, F.raise_error(
        F.concat(F.lit("no id in the dictionary: "), F.col(column))).cast("long")).otherwise(F.col("__id")))
    return found.groupBy(*keys, F.bitmap_bucket_number("__id").alias(RUN)).agg(
        F.min("time_stamp").alias("first_seen"), F.sum("bid").alias("sum_bids"),
        F.count("bid").alias("n_bids"), F.count(F.lit(1)).alias("imps"),
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias(BITS))


def merge_exact(states: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Merge stored states to coarser keys; the result can be merged again."""
    return states.groupBy(*keys, RUN).agg(
        F.min("first_seen").alias("first_seen"), F.sum("sum_bids").alias("sum_bids"),
        F.sum("n_bids").alias("n_bids"), F.sum("imps").alias("imps"), F.bitmap_or_agg(BITS).alias(BITS))


def finish_exact(states: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Measures per key of states that have each key and run once: runs have no id in common, so counts add up."""
    return states.groupBy(*keys).agg(
        F.min("first_seen").alias("first_seen"),
        F.try_divide(F.sum("sum_bids").cast("double"), F.sum("n_bids").cast("double")).alias("avg_bid"),
        F.sum("imps").alias("imps"), F.sum(F.bitmap_count(BITS)).alias("uniques"))
