"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, key: str, measure: Column, name: str, k: int = 20) -> DataFrame:
    """The k keys with the largest aggregate; ties go to the smaller key.

    Partial aggregation runs before the shuffle, and each task keeps only its
    own k rows before they are merged.
    """
    return (df.groupBy(key).agg(measure.alias(name))
              .orderBy(F.desc(name), F.asc(key)).limit(k))


def top_per_group(df: DataFrame, group: str, key: str, measure: Column, name: str,
                  k: int = 3, rank_name: str = "place") -> DataFrame:
    """The k best keys in every group, with their place.

    Rows are aggregated to (group, key) first. Spark then limits each group to k
    rows inside every task before the shuffle, so a group with very many keys
    does not pile up in one task.
    """
    totals = df.groupBy(group, key).agg(measure.alias(name))
    order = Window.partitionBy(group).orderBy(F.desc(name), F.asc(key))
    return totals.withColumn(rank_name, F.row_number().over(order)).where(F.col(rank_name) <= k)
