"""Broadcast only what has been measured, and never what Spark cannot measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def broadcast_within(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the frame holds at most ``max_rows`` narrow rows.

    Pass a stored or checkpointed frame, since the check reads it once more; it is
    a plain distributed count. A larger frame is returned without a hint, so the
    join shuffles and adaptive execution splits skewed keys.
    """
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


def never_broadcast(df: DataFrame) -> DataFrame:
    """Hint a sort-merge join for a side whose size Spark underestimates.

    A view that repeats rows (``explode``) counts as large as its input, and a compressed file as
    its bytes on disk. Spark would then collect the rows in the driver to broadcast them,
    however many they turn out to be.
    """
    return df.hint("merge")
