"""Errors of any smooth function of totals, such as a ratio, from replicates of a sample.

``approx`` has closed forms for counts, sums and averages. Other results, such as a share, a ratio of two sums
or a standard deviation, get theirs here: each replicate reweights the sampled rows at random, the
result is worked out from each replicate's totals, and their spread is the standard error. A row
of weight w counts w (1 + s sqrt(1 - 1/w)) in a replicate, s being 1 or -1, which has the variance w (w - 1) of
the sample itself; rows kept for certain (w = 1) count the same in all replicates and add no error.

The signs are bits of a hash of the row's key, so a replicate is the same whenever and wherever it is
computed, one hash serves all replicates, and all of them are sums of one aggregate: combined in
the tasks, then one row per group and task is shuffled.

A distinct count is no function of totals of rows, and no estimate of it from a sample of rows is free
of bias, so its error is not measured here; see ``uniques`` and ``sketches``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.operators.approx import ErrorBoundExceeded, z_score
from bidlens.operators.sampling import WEIGHT

#: Replicates; more than the bits of a digest are not to be had from one hash.
REPLICATES, MOST = 64, 128
#: Bits that one number takes from the digest.
WORD = 32


def _words(key: list[str], salt: str, replicates: int) -> list[Column]:
    """As many numbers of ``WORD`` bits as the replicates need, from a hash of the key; nulls and the
    borders of its columns count."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")), F.lit(":"), F.col(k).cast("string")),
                        F.lit("-")) for k in key]
    digest = F.md5(F.concat(F.lit(salt), *parts).cast("binary"))
    return [F.conv(F.substring(digest, 1 + at // 4, WORD // 4), 16, 10).cast("bigint")
            for at in range(0, replicates, WORD)]


def replicate_totals(sample: DataFrame, group_by: list[str], totals: dict[str, Column], key: list[str],
                     replicates: int = REPLICATES, salt: str = "replicate") -> DataFrame:
    """Per group the weighted ``totals``, for each the differences of its replicates to it as an array
    ``<name>_apart``, and ``sample_rows``. A null counts as 0."""
    if not 2 <= replicates <= MOST:
        raise ValueError(f"replicates must be 2 to {MOST}: {replicates}")
    if not key:
        raise ValueError("rows need a key, or all of one group would get the same signs")
    words = {f"__word{i}": w for i, w in enumerate(_words(key, salt, replicates))}
    w = F.col(WEIGHT)
    rows = sample.select(
        *group_by, w, *[F.coalesce(y.cast("double"), F.lit(0.0)).alias(f"__{t}") for t, y in totals.items()],
        F.sqrt(w * (w - 1)).alias("__spread"), *[c.alias(name) for name, c in words.items()])

    def sign(r: int) -> Column:
        bit = F.shiftright(F.col(f"__word{r // WORD}"), r % WORD).bitwiseAND(F.lit(1))
        return F.lit(1) - 2 * bit

    def of(name: str) -> list[Column]:
        apart = [F.sum(F.col(f"__{name}") * F.col("__spread") * sign(r)) for r in range(replicates)]
        return [F.coalesce(F.sum(F.col(f"__{name}") * w), F.lit(0.0)).alias(name),
                F.array(*[F.coalesce(a, F.lit(0.0)) for a in apart]).alias(f"{name}_apart")]

    return rows.groupBy(*group_by).agg(*[c for name in totals for c in of(name)],
                                       F.count(F.lit(1)).alias("sample_rows"))


def replicate_aggregate(sample: DataFrame, group_by: list[str], totals: dict[str, Column],
                        results: dict[str, Callable[[dict[str, Column]], Column]], key: list[str],
                        error: float | None = None, confidence: float = 0.95,
                        replicates: int = REPLICATES, salt: str = "replicate") -> DataFrame:
    """Results per group, each with its relative ``<name>_error``, and ``sample_rows``.

    ``totals`` names expressions over the sample's columns to be summed by weight; each of ``results`` makes a column of
    a dict of such totals, for instance ``lambda t: F.try_divide(t["won"], t["all"])``. A result that is null has a null
    error; one that is zero, or null in some replicate, has an infinite one if it varies. With ``error``, reading a group above this limit
    fails. An empty sample has no groups, and without ``group_by`` one row of totals of 0.
    """
    found = replicate_totals(sample, group_by, totals, key, replicates, salt)
    z, shown = z_score(confidence), []
    for name, result in results.items():
        value = result({t: F.col(t) for t in totals})
        # as a function of the replicate's number, so that the plan does not grow with their count
        squares = F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), lambda r: F.pow(
            result({t: F.col(t) + F.get(f"{t}_apart", r) for t in totals}) - value, F.lit(2.0)))
        variance = F.aggregate(squares, F.lit(0.0), lambda x, y: x + y) / replicates
        bound = F.when(variance == 0, 0.0).otherwise(F.try_divide(z * F.sqrt(variance), F.abs(value)))
        bound = F.when(value.isNotNull(), F.coalesce(bound, F.lit(float("inf"))))
        shown += [value.alias(name), bound.alias(f"{name}_error")]
    got = found.select(*group_by, *shown, "sample_rows")
    if error is not None:
        for name in results:
            bound = F.col(f"{name}_error")
            text = F.concat(F.lit(f"{ErrorBoundExceeded.__name__}: {name} has relative error "),
                            bound.cast("string"), F.lit(f" above {error} at {confidence}"))
            check = F.when(bound > error, F.raise_error(text).cast("boolean"))
            got = got.where(F.coalesce(check, F.lit(True)))
    return got
