"""Impression roll-ups by publisher and region, and their mergeable form.

Windows are on event time. A window without a slide is tumbling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.functions import estimate, mean_of, merged, sketch_of
from bidlens.sources.schemas import UNKNOWN_GEO

PUB_GEO = ("publisher", "geo")


def resolved(df: DataFrame, unknown: str = UNKNOWN_GEO) -> DataFrame:
    """Impressions whose region is known; rows without a region go too."""
    return df.where(F.col("geo") != F.lit(unknown))


def window_of(duration: str, slide: str | None = None, ts: str = "time_stamp") -> Column:
    return F.window(ts, duration, slide or duration)


def measures(uniques: str = "exact") -> list[Column]:
    """first instant, average bid, impressions and unique cookies of a group."""
    distinct = {
        "exact": lambda: F.count_distinct("cookie"),
        "hll": lambda: estimate(sketch_of("cookie")),
    }[uniques]()
    return [
        F.min("time_stamp").alias("first_seen"),
        mean_of("bid").alias("avg_bid"),
        F.count(F.lit(1)).alias("imps"),
        distinct.alias("uniques"),
    ]


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by its two bounds, in front."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def aggregate_table(impressions: DataFrame, duration: str,
                    unknown: str = UNKNOWN_GEO) -> DataFrame:
    """Rows of the stored aggregate: one per window, publisher and region.

    ``time_stamp`` is the first instant seen in the window.
    """
    rolled = (resolved(impressions, unknown)
              .groupBy(window_of(duration), *PUB_GEO).agg(*measures()))
    return rolled.select(F.col("first_seen").alias("time_stamp"), *PUB_GEO,
                         "avg_bid", "imps", "uniques")


def partial_state(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """State that can be stored and merged later: min, sum and number of bids, rows and a sketch."""
    return df.groupBy(*keys).agg(
        F.min("time_stamp").alias("first_seen"),
        F.sum("bid").alias("sum_bids"),
        F.count("bid").alias("n_bids"),
        F.count(F.lit(1)).alias("imps"),
        sketch_of("cookie").alias("cookies"))


def merge_partials(states: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Merge stored states to coarser keys; the result can be merged again."""
    return states.groupBy(*keys).agg(
        F.min("first_seen").alias("first_seen"),
        F.sum("sum_bids").alias("sum_bids"),
        F.sum("n_bids").alias("n_bids"),
        F.sum("imps").alias("imps"),
        merged("cookies").alias("cookies"))


def finish_partials(states: DataFrame) -> DataFrame:
    """Readable measures of a state: average bid and estimated uniques."""
    keys = [c for c in states.columns
            if c not in ("first_seen", "sum_bids", "n_bids", "imps", "cookies")]
    return states.select(
        *keys, "first_seen",
        F.try_divide(F.col("sum_bids").cast("double"),
                     F.col("n_bids").cast("double")).alias("avg_bid"),
        "imps", estimate("cookies").alias("uniques"))
