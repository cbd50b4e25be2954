"""Mergeable distinct counting with HyperLogLog sketches of 2^12 registers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions.expressions import as_col

SKETCH_BITS = 12


def sketch_of(c: Column | str) -> Column:
    """Aggregate: sketch of the distinct values, as binary."""
    return F.hll_sketch_agg(as_col(c), SKETCH_BITS)


def merged(c: Column | str) -> Column:
    """Aggregate: union of stored sketches."""
    return F.hll_union_agg(as_col(c))


def estimate(c: Column | str) -> Column:
    """Estimated number of distinct values in a sketch."""
    return F.hll_sketch_estimate(as_col(c))
