"""Session settings that the library's jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for a cluster. Shuffle partitions are left to adaptive execution,
# which coalesces them; a stateful stream fixes its own count, see
# ``streaming.continuous.state_partitions``.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the aggregate after the join then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sketches are small: keep many groups in memory before sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    # Spark checks the size; executors of a cluster can hold more than the default 10 MB.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


@contextmanager
def in_pool(spark: SparkSession, pool: str) -> Iterator[None]:
    """Jobs and streams started by this thread inside belong to a scheduler pool.

    With ``spark.scheduler.mode`` FAIR, pools share the executors evenly, so reports make
    progress beside a stream; jobs of one pool go in turn.
    """
    context, key = spark.sparkContext, "spark.scheduler.pool"
    before = context.getLocalProperty(key)
    context.setLocalProperty(key, pool)
    try:
        yield
    finally:
        context.setLocalProperty(key, before)


def build_session(app_name: str = "bidlens", master: str | None = None,
                  **overrides: str) -> SparkSession:
    """Session with the recommended settings; ``overrides`` use ``_`` for ``.``.

    ``master`` is for tests and local runs; on a cluster spark-submit sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
