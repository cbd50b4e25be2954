"""Row predicates that compare two DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Join on equally named keys where null matches null; still a hash or merge join.

    The right side's keys are left out of the result, as are all its columns in a
    semi or anti join. Other column names must differ between the sides.
    """
    renamed = right.select(*[F.col(k).alias(f"__right_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b,
                       [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def not_in(left: DataFrame, left_key: Column, values: DataFrame, value_col: str) -> DataFrame:
    """Rows of ``left`` whose key is NOT IN the values, with SQL's null rules.

    Spark plans ``NOT IN`` as a null-aware anti join that always broadcasts the
    values, whatever their size. The same answer comes from a plain anti join,
    which can shuffle, plus two counts: one null among the values empties the
    result, and a null key passes only if there are no values at all.
    """
    counts = values.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(value_col).isNull(), 1)).alias("nulls"))
    no_nulls = counts.select(F.col("nulls") == 0).scalar()
    no_values = counts.select(F.col("n") == 0).scalar()
    known = values.where(F.col(value_col).isNotNull()).select(
        F.col(value_col).alias("__excluded"))
    return (left.where(no_nulls & (left_key.isNotNull() | no_values))
                .join(known, left_key == F.col("__excluded"), "left_anti"))
