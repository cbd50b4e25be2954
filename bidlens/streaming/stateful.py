"""Windows whose late rows are kept, and exact uniques that are there before a window closes.

``windows_with_late_rows`` keeps state of its own, since built-in windows drop late rows unseen: one state per window and
bucket of the cookie holds the sums of all publishers and regions in it, so that the calls to the state store, which cost
far more than a row, grow with windows and buckets and not with the keys of the report. ``early_uniques`` is made of built-in stateful
operators alone. Both need the RocksDB state store, which ``session.RECOMMENDED`` and ``continuous.stream_session`` set.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from bidlens.operators.rollup import PUB_GEO, resolved
from bidlens.sources.schemas import UNKNOWN_GEO
from bidlens.sources.workspace import list_names
from bidlens.streaming.continuous import state_partitions

ON_TIME, LATE = "on time", "late"
BUCKETS = 16
#: Parts that a state may hold beyond twice those left by the last summing up.
SLACK = 1024


def _micros(spark: SparkSession, duration: str) -> int:
    found = spark.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {duration})").first()[0]
    if found <= 0:
        raise ValueError(f"a window needs a length: {duration}")
    return found


def _sum_type(df: DataFrame) -> str:
    """The type that a sum of bids has."""
    return df.select(F.sum("bid").alias("s")).schema["s"].dataType.simpleString()


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("cookie"), F.lit(buckets)).cast("int").alias("bucket")


def _summed(parts: Iterable[tuple]) -> list[tuple]:
    """``publisher, geo, first_seen, sum_bids, n_bids, imps`` once per publisher and region."""
    sums: dict[tuple, tuple] = {}
    for publisher, geo, first, bids, n_bids, imps in parts:
        key = publisher, geo
        if key in sums:
            other, held, n, rows = sums[key]
            first, n_bids, imps = min(first, other), n_bids + n, imps + rows
            bids = held if bids is None else bids if held is None else held + bids
        sums[key] = first, bids, n_bids, imps
    return [(*key, *values) for key, values in sums.items()]


class _Windows(StatefulProcessor):
    """Sums of a window until the watermark passes its end; rows that come after that are emitted as late.

    A row is late if the watermark of its micro-batch has reached the end of its window. A micro-batch appends its sums
    per publisher and region; once those are twice as many as after the last time, they are summed up, so that a state
    stays within a few times its publishers and regions however many micro-batches there are.
    """

    def __init__(self, width: int, sum_type: str):
        self.width, self.sum_type = width, sum_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "parts long, least long")
        self.parts = handle.getListState(
            "parts", f"publisher string, geo string, first_seen long, sum_bids {self.sum_type}, n_bids long, imps long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = -(-(key[0] + self.width) // 1000)
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield pd.DataFrame({
                    "kind": LATE, "window_start": key[0], "publisher": part["publisher"], "geo": part["geo"],
                    "instant": part["instant"], "sum_bids": part["bid"], "n_bids": part["bid"].notna().astype("int64"),
                    "imps": 1, "cookie": part["cookie"]})
            return
        new: list[tuple] = []
        for part in rows:
            there = part["bid"].notna().tolist()
            new = _summed([*new, *(
                (p, g, t, b if known else None, int(known), 1) for p, g, t, b, known in zip(
                    part["publisher"].tolist(), part["geo"].tolist(), part["instant"].tolist(),
                    part["bid"].tolist(), there))])
        before = self.held.get()
        if before is None:
            self.handle.registerTimer(end)
        held, least = before or (0, 0)
        if held + len(new) > 2 * least + SLACK:
            new = _summed([*self.parts.get(), *new])
            self.parts.put(new)
            held = least = len(new)
        else:
            self.parts.appendList(new)
            held += len(new)
        self.held.update((held, least))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sums = pd.DataFrame(_summed(self.parts.get()),
                            columns=["publisher", "geo", "instant", "sum_bids", "n_bids", "imps"])
        self.parts.clear()
        self.held.clear()
        yield sums.assign(kind=ON_TIME, window_start=key[0], cookie=None)[
            ["kind", "window_start", "publisher", "geo", "instant", "sum_bids", "n_bids", "imps", "cookie"]]

    def close(self) -> None:
        pass


def windows_with_late_rows(stream: DataFrame, duration: str = "1 second", watermark: str | None = None,
                           unknown: str = UNKNOWN_GEO, buckets: int = BUCKETS) -> DataFrame:
    """``kind, window_start, window_end, publisher, geo, time_stamp, sum_bids, n_bids, imps, cookie``.

    Rows of kind ``on time`` are the sums of one bucket of a closed window, with its first instant; sum over them with
    ``window_totals``. Rows of kind ``late`` are single impressions, with their own instant, bid and cookie, that came when
    the watermark had already passed their window's end. Every row of a known region and with an instant is in exactly
    one row, once its window has closed. Rows without an instant are dropped, as they belong to no window. Output mode
    is append; a late row never reopens a window.
    """
    width, kind = _micros(stream.sparkSession, duration), _sum_type(stream)
    rows = resolved(stream.where("time_stamp IS NOT NULL"), unknown).withWatermark("time_stamp", watermark or duration)
    at = F.unix_micros("time_stamp")
    # Plain numbers for window and instant, so that no row is dropped before the state sees it.
    keyed = rows.select(at.alias("instant"), (at - F.pmod(at, F.lit(width))).alias("window_start"), *PUB_GEO, "bid",
                        "cookie", _bucket(buckets))
    out = keyed.groupBy("window_start", "bucket").transformWithStateInPandas(
        _Windows(width, kind),
        f"kind string, window_start long, publisher string, geo string, instant long, sum_bids {kind}, "
        "n_bids long, imps long, cookie string", "Append", "EventTime")
    return out.select(
        "kind", F.timestamp_micros("window_start").alias("window_start"),
        F.timestamp_micros(F.col("window_start") + width).alias("window_end"), *PUB_GEO,
        F.timestamp_micros("instant").alias("time_stamp"), "sum_bids", "n_bids", "imps", "cookie")


def window_totals(rows: DataFrame) -> DataFrame:
    """Per kind, window, publisher and region the sums over what ``windows_with_late_rows`` stored."""
    return rows.groupBy("kind", "window_start", "window_end", *PUB_GEO).agg(
        F.min("time_stamp").alias("first_seen"), F.sum("sum_bids").alias("sum_bids"),
        F.sum("n_bids").cast("long").alias("n_bids"), F.sum("imps").cast("long").alias("imps"))


def early_uniques(stream: DataFrame, duration: str = "1 second", watermark: str | None = None,
                  unknown: str = UNKNOWN_GEO, buckets: int = BUCKETS) -> DataFrame:
    """Per window, publisher, region and bucket of cookies the sums so far, whenever they change.

    Cookies of one bucket are in no other, so the uniques of buckets add up. A null cookie counts as an impression
    only. The first row of a cookie is told by ``dropDuplicates``, whose state is one entry per cookie that is written once;
    the stream is read twice for it. Rows of windows that the watermark has passed are dropped (``windows_with_late_rows`` keeps them). Output
    mode is update; store with ``start_changes`` and read with ``latest_uniques``.
    """
    _micros(stream.sparkSession, duration)
    rows = resolved(stream.where("time_stamp IS NOT NULL"), unknown).withWatermark("time_stamp", watermark or duration)
    # The instant as a number, so that the window stays the only event-time column.
    rows = rows.select(F.window("time_stamp", duration).alias("window"), *PUB_GEO, _bucket(buckets), "cookie",
                       F.unix_micros("time_stamp").alias("instant"), "bid")
    keys = ["window", *PUB_GEO, "bucket"]
    firsts = rows.where("cookie IS NOT NULL").select(*keys, "cookie").dropDuplicates()
    both = (rows.select(*keys, "instant", "bid", F.lit(1).alias("imps"), F.lit(0).alias("uniques"))
            .unionByName(firsts.select(*keys, F.lit(0).alias("imps"), F.lit(1).alias("uniques")), True))
    out = both.groupBy(*keys).agg(
        F.min("instant").alias("instant"), F.sum("bid").alias("sum_bids"), F.count("bid").alias("n_bids"),
        F.sum("imps").alias("imps"), F.sum("uniques").alias("uniques"))
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *PUB_GEO, "bucket",
        F.timestamp_micros("instant").alias("first_seen"), "sum_bids", "n_bids", "imps", "uniques")


def start_changes(changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  partitions: int | None = None) -> StreamingQuery:
    """Store each micro-batch's changes in a folder of its own number; a batch that is run again replaces it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with state_partitions(changes.sparkSession, partitions):
        return (changes.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def _newest(changes: DataFrame) -> DataFrame:
    """The last change of each bucket; a change holds all that came before it, so the largest batch has it."""
    place = Window.partitionBy("window_start", *PUB_GEO, "bucket").orderBy(F.desc("batch"))
    return changes.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def latest_uniques(spark: SparkSession, path: str) -> DataFrame:
    """What is known now per window, publisher and region, open windows too: the newest change of each
    bucket, summed over buckets. The folder must hold a batch."""
    changes = spark.read.option("basePath", path).parquet(path)
    return _newest(changes).groupBy("window_start", "window_end", *PUB_GEO).agg(
        F.min("first_seen").alias("first_seen"), F.sum("sum_bids").alias("sum_bids"),
        F.try_divide(F.sum("sum_bids").cast("double"), F.sum("n_bids").cast("double")).alias("avg_bid"),
        F.sum("imps").cast("long").alias("imps"), F.sum("uniques").cast("long").alias("uniques"))


def compact_changes(spark: SparkSession, path: str, target: str) -> str:
    """The newest change of each bucket in ``target`` under the number of the last batch, so that ``latest_uniques`` reads
    each bucket once; the stream goes on in ``path`` from the next number. Returns the folder written."""
    last = max(int(n.removeprefix("batch=")) for n in list_names(spark, path) if n.startswith("batch="))
    out = f"{target}/batch={last}"
    newest = _newest(spark.read.option("basePath", path).parquet(path)).drop("batch")
    newest.write.mode("overwrite").parquet(out)
    return out
