"""Aggregates answered from a weighted sample, with an error bound.

With weight w = 1 / rate per sampled row, a total of y is estimated by sum(w y)
with variance sum(w (w - 1) y^2); a count is the total of ones, and an average is a
ratio of totals with linearised residuals. The relative error is z times the
standard deviation over the estimate. Rows kept for certain (w = 1) add no error.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.operators.sampling import STRATUM_ROWS, WEIGHT

KINDS = ("count", "sum", "avg")


class ErrorBoundExceeded(ValueError):
    """An estimate's relative error is above the limit the caller set."""


def z_score(confidence: float) -> float:
    return NormalDist().inv_cdf((1 + confidence) / 2)


def _moment(y: Column | None, power: int) -> Column:
    w = F.col(WEIGHT)
    spread = w * (w - 1)
    if power:
        spread = spread * (y if power == 1 else y * y)
    return F.coalesce(F.sum(spread), F.lit(0.0))


def _terms(name: str, kind: str, column: str | None) -> list[Column]:
    w = F.col(WEIGHT)
    if kind == "count" and column is None:
        return [F.coalesce(F.sum(w), F.lit(0.0)).alias(f"__{name}_total"),
                _moment(None, 0).alias(f"__{name}_var")]
    y = F.col(column).cast("double")
    if kind == "count":
        seen = F.col(column).isNotNull().cast("double")
        return [F.coalesce(F.sum(w * seen), F.lit(0.0)).alias(f"__{name}_total"),
                _moment(seen, 1).alias(f"__{name}_var")]
    if kind == "sum":
        return [F.sum(w * y).alias(f"__{name}_total"), _moment(y, 2).alias(f"__{name}_var")]
    seen = F.when(y.isNotNull(), 1.0)
    return [F.sum(w * y).alias(f"__{name}_total"), F.sum(w * seen).alias(f"__{name}_n"),
            _moment(seen, 1).alias(f"__{name}_s0"), _moment(y, 1).alias(f"__{name}_s1"),
            _moment(y, 2).alias(f"__{name}_s2")]


def _finish(name: str, kind: str) -> tuple[Column, Column]:
    """(estimate, variance) from the collected terms."""
    total = F.col(f"__{name}_total")
    if kind != "avg":
        return total, F.col(f"__{name}_var")
    n = F.col(f"__{name}_n")
    mean = F.try_divide(total, n)
    spread = (F.col(f"__{name}_s2") - 2 * mean * F.col(f"__{name}_s1")
              + mean * mean * F.col(f"__{name}_s0"))
    return mean, F.try_divide(F.greatest(spread, F.lit(0.0)), n * n)


def approx_aggregate(sample: DataFrame, group_by: list[str], aggs: dict[str, tuple],
                     error: float | None = None, confidence: float = 0.95,
                     on_violation: str = "raise", base: DataFrame | None = None) -> DataFrame:
    """Estimates per group, each with ``<name>_error``, and ``sample_rows``.

    ``aggs`` maps a name to ``("count",)``, ``("count", col)``, ``("sum", col)`` or
    ``("avg", col)``. Filters on base columns may be applied to the sample before.
    ``error`` limits the relative error of every group at the confidence level:

    * ``raise``: the action that reads a violating estimate fails. The check is
      part of the plan, so nothing is computed twice or collected.
    * ``exact``: one bounded probe looks for a violation; if there is one, the
      same aggregates are computed from ``base``, with error 0.
    * ``report``: estimates are returned as they are.

    A group absent from the sample is absent here; ``sample_rows`` shows how thin
    a group is.
    """
    if on_violation not in ("raise", "exact", "report"):
        raise ValueError(f"unknown on_violation: {on_violation}")
    if on_violation == "exact" and base is None:
        raise ValueError("on_violation='exact' needs the base table")
    for name, (kind, *_) in aggs.items():
        if kind not in KINDS:
            raise ValueError(f"unknown aggregate for {name}: {kind}")
    terms = [t for name, (kind, *col) in aggs.items()
             for t in _terms(name, kind, col[0] if col else None)]
    grouped = sample.groupBy(*group_by).agg(*terms, F.count(F.lit(1)).alias("sample_rows"))
    z = z_score(confidence)
    columns: list[Column] = []
    limits: list[Column] = []
    checks: list[Column] = []
    for name, (kind, *_) in aggs.items():
        value, variance = _finish(name, kind)
        bound = F.when(variance == 0, F.lit(0.0)).otherwise(
            F.try_divide(z * F.sqrt(variance), F.abs(value)))
        # A zero estimate with spread has no finite relative error.
        bound = F.when(value.isNotNull(), F.coalesce(bound, F.lit(float("inf"))))
        if error is not None:
            limits.append(F.col(f"{name}_error") > error)
            if on_violation == "raise":
                text = F.concat(F.lit(f"{ErrorBoundExceeded.__name__}: {name} has relative error "),
                                bound.cast("string"), F.lit(f" above {error} at {confidence}"))
                checks.append(F.when(bound > error, F.raise_error(text).cast("boolean")))
        columns += [value.alias(name), bound.alias(f"{name}_error")]
    for check in checks:  # a filter, so that no choice of columns drops it
        grouped = grouped.where(F.coalesce(check, F.lit(True)))
    result = grouped.select(*group_by, *columns, "sample_rows")
    if error is None or on_violation != "exact":
        return result
    violated = limits[0]
    for limit in limits[1:]:
        violated = violated | limit
    if not result.where(violated).limit(1).collect():
        return result
    return exact_aggregate(base, group_by, aggs)


def exact_aggregate(base: DataFrame, group_by: list[str], aggs: dict[str, tuple]) -> DataFrame:
    """The aggregates of ``approx_aggregate`` from all rows, with error 0."""
    exact = {"count": F.count, "sum": F.sum, "avg": F.avg}
    columns: list[Column] = []
    for name, (kind, *col) in aggs.items():
        value = exact[kind](F.col(col[0]) if col else F.lit(1)).cast("double")
        columns += [value.alias(name), F.lit(0.0).alias(f"{name}_error")]
    return base.groupBy(*group_by).agg(*columns, F.lit(None).cast("bigint").alias("sample_rows"))


def count_from_strata(counts: DataFrame, group_by: list[str]) -> DataFrame:
    """Exact count per group when the group columns are strata columns."""
    return counts.groupBy(*group_by).agg(F.sum(STRATUM_ROWS).alias("rows"))
