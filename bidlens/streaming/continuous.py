"""Continuous queries over impression streams.

Windows are on event time and closed by a watermark, so a replay gives the same
answer however the rows were batched. All functions also accept a batch frame.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bidlens.functions import estimate, mean_of, sketch_of
from bidlens.operators.rollup import PUB_GEO, flat_window, merge_partials, partial_state, resolved, window_of
from bidlens.session import RECOMMENDED
from bidlens.sources.schemas import UNKNOWN_GEO


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Number of state partitions for queries started inside.

    A stateful query keeps the count of its first start for ever, so choose it
    for the load to come: about one to three per executor core. It is a setting of the session
    while the query starts; where reports share the session, build the stream in one of
    its own with ``stream_session``.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if count is not None:
        spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for streams, with its own settings and views in the same application.

    Its number of state partitions does not reach reports planned in ``spark``.
    """
    own = spark.newSession()
    for key, value in RECOMMENDED.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, spark.conf.get(key, value))
    if partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def cq_pub_geo(df: DataFrame, duration: str = "1 second", slide: str | None = None,
               watermark: str | None = None, unknown: str = UNKNOWN_GEO,
               by_timestamp: bool = False, uniques: str = "exact") -> DataFrame:
    """Per window, publisher and region: first instant, bids, impressions, uniques.

    ``by_timestamp`` also groups by the instant itself. ``uniques`` is ``exact``
    or ``hll``; the latter keeps one small sketch per group as state instead of
    one entry per cookie, and also returns the sketch as ``cookies``.

    ``watermark`` is how much later than the newest row a row may come; the
    default is one window. Exact uniques use two chained aggregations, since a stream cannot hold a
    distinct aggregate: by cookie first, then without it. State is bounded by the
    watermark; the first level spreads a hot publisher over its cookies.
    Output mode is append.
    """
    if uniques not in ("exact", "hll"):
        raise ValueError(f"unknown uniques: {uniques}")
    rows = resolved(df, unknown)
    if df.isStreaming:
        rows = rows.withWatermark("time_stamp", watermark or duration)
    keys = [window_of(duration, slide), *PUB_GEO]
    later = ["window", *PUB_GEO]
    if by_timestamp:
        # As a number, so that the window stays the only event-time column.
        micros = F.unix_micros("time_stamp") if dict(df.dtypes)["time_stamp"] == "timestamp" \
            else F.unix_micros(F.col("time_stamp").cast("timestamp"))
        keys.append(micros.alias("instant"))
        later.append("instant")
    if uniques == "hll":
        out = rows.groupBy(*keys).agg(
            F.min("time_stamp").alias("first_seen"), F.sum("bid").alias("sum_bids"),
            mean_of("bid").alias("avg_bid"), F.count(F.lit(1)).alias("imps"),
            sketch_of("cookie").alias("cookies"))
        out = out.withColumn("uniques", estimate("cookies"))
    else:
        per_cookie = rows.groupBy(*keys, "cookie").agg(
            F.min("time_stamp").alias("first_seen"), F.sum("bid").alias("sum_bids"),
            F.count("bid").alias("n_bids"), F.count(F.lit(1)).alias("n"))
        out = per_cookie.groupBy(*later).agg(
            F.min("first_seen").alias("first_seen"), F.sum("sum_bids").alias("sum_bids"),
            F.try_divide(F.sum("sum_bids").cast("double"),
                         F.sum("n_bids").cast("double")).alias("avg_bid"),
            F.sum("n").alias("imps"), F.count("cookie").alias("uniques"))
    out = flat_window(out)
    if by_timestamp:
        out = out.withColumn("instant", F.timestamp_micros("instant"))
    return out


def aggregate_rows(rolled: DataFrame) -> DataFrame:
    """Columns of the stored aggregate table from a rolled-up frame."""
    return rolled.select(F.col("first_seen").alias("time_stamp"), *PUB_GEO,
                         "avg_bid", "imps", "uniques")


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 partitions: int | None = None, partition_by: list[str] | None = None,
                 files_per_batch: int | None = None, name: str | None = None) -> StreamingQuery:
    """Append a stream's rows to a Parquet folder, exactly once.

    ``trigger`` is passed to ``DataStreamWriter.trigger``; by default all data
    present is processed and the query ends. An aggregate has few rows per batch
    but as many tasks as state partitions: ``files_per_batch`` gathers them into
    fewer files, at the price of a shuffle of just those rows.
    """
    if files_per_batch is not None:
        df = df.repartition(files_per_batch)
    writer = (df.writeStream.format("parquet").outputMode("append")
                .option("path", path).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    with state_partitions(df.sparkSession, partitions):
        return writer.start()


def continuous_query(spark: SparkSession, sql: str, path: str, checkpoint: str,
                     trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Run SQL text over registered streams; rows of closed windows go to ``path``.

    The text groups by ``window(...)`` where the result is windowed, and the
    stream should carry a watermark when it is registered.
    """
    result = spark.sql(sql)
    if not result.isStreaming:
        raise ValueError("the query reads no stream")
    return start_append(result, path, checkpoint, trigger, partitions)


def stream_count(stream: DataFrame, name: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Keep the number of rows seen so far in the one-row memory table ``name``."""
    counted = stream.groupBy().agg(F.count(F.lit(1)).alias("row_count"))
    with state_partitions(stream.sparkSession, 1):
        return (counted.writeStream.format("memory").queryName(name).outputMode("complete")
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())


def show_batches(df: DataFrame, rows: int = 20, mode: str = "append") -> StreamingQuery:
    """Print each micro-batch, for debugging."""
    return (df.writeStream.format("console").outputMode(mode)
            .option("numRows", rows).option("truncate", "false").start())


def print_rows(df: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Print each row where it is computed, into the executors' logs, for debugging."""
    return (df.writeStream.foreach(lambda row: print(row.asDict()))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window had closed, over the kept progress reports.

    Spark counts them after its partial aggregation, so late rows of one group and
    task count once.
    """
    return sum(op["numRowsDroppedByWatermark"]
               for report in query.recentProgress for op in report["stateOperators"])


def cq_sliding_panes(df: DataFrame, duration: str, slide: str, watermark: str | None = None,
                     unknown: str = UNKNOWN_GEO) -> DataFrame:
    """``cq_pub_geo`` with sketched uniques over sliding windows, made from panes of the slide's length.

    A row is aggregated once, into its pane; a window merges its panes, so that only one small state per pane
    and key is repeated, and not each row. ``duration`` must be a multiple of ``slide``.
    """
    lengths = df.sparkSession.sql(
        f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {duration}) AS a, "
        f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {slide}) AS b").first()
    if lengths.b <= 0 or lengths.a % lengths.b:
        raise ValueError(f"{duration} is no multiple of {slide}")
    rows = resolved(df, unknown)
    if df.isStreaming:
        rows = rows.withWatermark("time_stamp", watermark or slide)
    panes = partial_state(rows, [window_of(slide), *PUB_GEO])
    windows = merge_partials(panes, [F.window("window", duration, slide).alias("window"), *PUB_GEO])
    return flat_window(windows).select(
        "window_start", "window_end", *PUB_GEO, "first_seen", "sum_bids",
        F.try_divide(F.col("sum_bids").cast("double"), F.col("n_bids").cast("double")).alias("avg_bid"),
        "imps", "cookies", estimate("cookies").alias("uniques"))
