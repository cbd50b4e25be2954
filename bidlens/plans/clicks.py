"""Click-stream reports per window, joined with the item table.

Both work on streams (append mode) and on stored clicks. A stream of clicks is
joined with the static item table batch by batch and needs no join state; a click may
come later than the newest one by ``watermark``, one window by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bidlens.functions import mean_of
from bidlens.operators.ranking import top_per_group
from bidlens.operators.rollup import flat_window, window_of

WINDOW = "60 seconds"
MIN_PRICE = 50


def _clock(clicks: DataFrame, delay: str) -> DataFrame:
    return clicks.withWatermark("cs_click_d", delay) if clicks.isStreaming else clicks


def click_items(clicks: DataFrame, item: DataFrame, duration: str = WINDOW,
                min_price: float = MIN_PRICE, watermark: str | None = None) -> DataFrame:
    """Clicks per window on items that cost more than ``min_price``.

    On stored clicks the counts are taken before the join, which then sees one row
    per window and item, whatever the share of a popular item.
    """
    costly = item.where(F.col("i_price") > min_price).select("i_id")
    window = window_of(duration, ts="cs_click_d")
    if clicks.isStreaming:
        rows = _clock(clicks, watermark or duration).join(costly, F.col("cs_i_id") == F.col("i_id"))
        return flat_window(rows.groupBy(window, "i_id").agg(F.count("i_id").alias("clicks")))
    counted = clicks.groupBy(window, "cs_i_id").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(costly, F.col("cs_i_id") == F.col("i_id"))
    return flat_window(joined.groupBy("window", "i_id").agg(F.sum("n").alias("clicks")))


def top_click_items(clicks: DataFrame, item: DataFrame, duration: str = WINDOW,
                    min_price: float = MIN_PRICE, k: int = 10) -> DataFrame:
    """The k most clicked costly items of every window (stored clicks only)."""
    counted = click_items(clicks, item, duration, min_price)
    return top_per_group(counted, "window_start", "i_id", F.sum("clicks"), "clicks", k)


def click_districts(clicks: DataFrame, duration: str = WINDOW,
                    watermark: str | None = None) -> DataFrame:
    """Average time spent per window and district."""
    rows = _clock(clicks, watermark or duration)
    return flat_window(rows.groupBy(window_of(duration, ts="cs_click_d"), "cs_c_d_id")
                           .agg(mean_of("cs_timespent").alias("avg_timespent")))


def click_reports(clicks: DataFrame, item: DataFrame, out: str, checkpoint: str,
                  min_price: float = MIN_PRICE, k: int = 10,
                  trigger: dict | None = None) -> StreamingQuery:
    """Both reports over each micro-batch, one folder per batch.

    The batch is the window here, as with a trigger of 60 seconds; a repeated
    batch overwrites its own folder.
    """
    def report(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            costly = item.where(F.col("i_price") > min_price).select("i_id")
            counted = batch.groupBy("cs_i_id").agg(F.count(F.lit(1)).alias("n"))
            items = (counted.join(costly, F.col("cs_i_id") == F.col("i_id"))
                            .groupBy("i_id").agg(F.sum("n").alias("clicks"))
                            .orderBy(F.desc("clicks"), "i_id").limit(k))
            items.write.mode("overwrite").parquet(f"{out}/items/batch_id={batch_id}")
            districts = batch.groupBy("cs_c_d_id").agg(
                mean_of("cs_timespent").alias("avg_timespent"))
            districts.write.mode("overwrite").parquet(f"{out}/districts/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (clicks.writeStream.foreachBatch(report).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
