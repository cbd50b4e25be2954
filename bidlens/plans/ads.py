"""Named reports on impressions and on their stored aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.functions import estimate, merged
from bidlens.operators.ranking import top_k, top_per_group

TOP = 20


def count_by_geo(rows: DataFrame, k: int = TOP) -> DataFrame:
    """Regions with the most rows; for impressions or for the aggregate table."""
    return top_k(rows, "geo", F.count(F.lit(1)), "ad_count", k)


def bid_sum_by(impressions: DataFrame, key: str, k: int = TOP) -> DataFrame:
    """Regions or publishers with the largest sum of bids."""
    return top_k(impressions, key, F.sum("bid"), "sum_bid", k)


def impression_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def uniques_by_geo(aggregate: DataFrame, publisher: str = "publisher11",
                   k: int = TOP) -> DataFrame:
    """Sum of per-window uniques by region for one publisher.

    A person seen in several windows counts once in each; ``people_by_geo`` does not.
    """
    one = aggregate.where(F.col("publisher") == publisher)
    return top_k(one, "geo", F.sum("uniques"), "total_uniques", k)


def people_by_geo(states: DataFrame, publisher: str = "publisher11", k: int = TOP) -> DataFrame:
    """People by region for one publisher, from stored sketches that are merged."""
    one = states.where(F.col("publisher") == publisher)
    return top_k(one, "geo", estimate(merged("cookies")), "people", k)


def advertiser_uniques(impressions: DataFrame, advertiser: str) -> DataFrame:
    """Total distinct cookies that saw one advertiser, by region."""
    return (impressions.where(F.col("advertiser") == advertiser)
            .groupBy("geo").agg(F.count_distinct("cookie").alias("uniques")))


def impression_trend(impressions: DataFrame, unit: str = "day") -> DataFrame:
    """Impressions of each advertiser over time."""
    return (impressions.groupBy("advertiser", F.date_trunc(unit, "time_stamp").alias("period"))
            .agg(F.count(F.lit(1)).alias("imps")))


def top_ads_per_geo(impressions: DataFrame, k: int = 3) -> DataFrame:
    """The advertisers with the most distinct cookies in each region.

    The distinct count is split by cookie first, so a region or advertiser that
    holds much of the data is counted by many tasks.
    """
    return top_per_group(impressions, "geo", "advertiser", F.count_distinct("cookie"),
                         "uniques", k)
