"""Stratified samples that can be kept up to date.

Every row gets a repeatable number u in [0, 1) from its key. A stratum of N rows
has the rate t = min(1, max(fraction, min_rows / N)), and a row is kept when
u < t. Since t never rises while N grows, a sample is brought up to date by
dropping kept rows with u >= t and adding new rows with u < t; this gives the very
rows that sampling from scratch would give, in any order of arrival.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.functions import hash_unit, null_safe_join
from bidlens.operators.sizing import MAX_BROADCAST_ROWS, broadcast_within
from bidlens.sources.workspace import materialize

UNIT = "sample_u"
RATE = "sample_rate"
WEIGHT = "sample_weight"
STRATUM_ROWS = "stratum_rows"
SLICES = 4096  # parts of the sampled range in which floor_sample counts


@dataclass(frozen=True)
class SampleSpec:
    """Strata columns, target fraction, expected minimum per stratum, row key.

    Another ``seed`` gives another, independent sample. The key should be unique;
    rows with equal keys are kept or left together. ``portable`` draws by md5, which
    other engines can repeat, instead of the faster xxhash64.
    """

    qcs: tuple[str, ...]
    fraction: float
    min_rows: int
    key: tuple[str, ...]
    seed: str = ""
    portable: bool = False

    def __post_init__(self):
        if not 0 < self.fraction <= 1 or self.min_rows < 0 or not self.qcs or not self.key:
            raise ValueError(f"bad sample specification: {self}")

    def rate(self, stratum_rows: Column | str = STRATUM_ROWS) -> Column:
        n = F.col(stratum_rows) if isinstance(stratum_rows, str) else stratum_rows
        return F.least(F.lit(1.0), F.greatest(
            F.lit(float(self.fraction)), F.lit(float(self.min_rows)) / n.cast("double")))


def strata_counts(df: DataFrame, qcs: tuple[str, ...]) -> DataFrame:
    """Rows per stratum; reads only the strata columns."""
    return df.groupBy(*qcs).agg(F.count(F.lit(1)).alias(STRATUM_ROWS))


def add_counts(old: DataFrame, new: DataFrame, qcs: tuple[str, ...]) -> DataFrame:
    return (old.unionByName(new).groupBy(*qcs)
               .agg(F.sum(STRATUM_ROWS).alias(STRATUM_ROWS)))


def thin(units: DataFrame, counts: DataFrame, spec: SampleSpec,
         complete: bool = False) -> DataFrame:
    """Rows with u below their stratum's present rate, with rate and weight.

    Rows above the greatest rate of all go before the join, which is nearly all
    of them when every stratum is large and ``complete``. ``counts`` should be stored. A stratum that
    is not among them is kept whole, at rate 1; say ``complete`` if there can be none.
    """
    rates = counts.select(*spec.qcs, spec.rate().alias(RATE))
    if complete:
        units = units.where(F.col(UNIT) < rates.agg(F.max(RATE)).scalar())
    return (null_safe_join(units, rates, list(spec.qcs), "left")
            .withColumn(RATE, F.coalesce(RATE, F.lit(1.0))).where(F.col(UNIT) < F.col(RATE))
            .withColumn(WEIGHT, F.lit(1.0) / F.col(RATE)))


def with_unit(df: DataFrame, spec: SampleSpec) -> DataFrame:
    return df.withColumn(UNIT, hash_unit(list(spec.key), spec.seed, spec.portable))


def stratified_sample(df: DataFrame, spec: SampleSpec, counts: DataFrame | None = None,
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Sample of ``df`` with each row's u, rate and weight.

    Two passes: the strata are counted and stored, then joined back to the rows.
    The counts are broadcast only after a check of their number, in which case
    the rows are not shuffled at all. The minimum per stratum holds in
    expectation; see ``floor_sample`` for a hard one.
    """
    complete = counts is None
    counts = materialize(strata_counts(df, spec.qcs) if counts is None else counts)
    return thin(with_unit(df, spec), broadcast_within(counts, max_broadcast_rows), spec, complete)


def floor_sample(df: DataFrame, spec: SampleSpec,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Like ``stratified_sample``, but never fewer than ``min_rows`` per stratum.

    Each stratum yields its ceil(rate * N) rows with the smallest u. A histogram of
    u per stratum finds the slice in which the last wanted row lies: rows of lower
    slices are kept by a filter, and only that one slice, about a slice's
    share of the sample, is ranked. So no task ever sees a whole stratum.
    """
    counts = materialize(strata_counts(df, spec.qcs))
    return _least_rows(with_unit(df, spec), counts, spec, max_broadcast_rows)


def _least_rows(units: DataFrame, counts: DataFrame, spec: SampleSpec, max_broadcast_rows: int,
                whole: bool = True) -> DataFrame:
    """The ceil(rate * N) rows with the least u of each stratum of N rows. If ``units`` are not the ``whole`` table but lack rows
    with a large u, a stratum of which too few are there is an error that names it."""
    keys = list(spec.qcs)
    limits = broadcast_within(counts.select(
        *keys, STRATUM_ROWS, spec.rate().alias("__reach"),
        F.ceil(spec.rate() * F.col(STRATUM_ROWS)).cast("bigint").alias("__wanted")),
        max_broadcast_rows)
    # Slices cut [0, rate) finely; what lies beyond twice the rate shares one slice.
    piece = F.least(F.floor(F.col(UNIT) / F.col("__reach") * SLICES), F.lit(2 * SLICES))
    placed = null_safe_join(units, limits, keys).withColumn("__slice", piece)
    sizes = placed.groupBy(*keys, "__slice").agg(
        F.count(F.lit(1)).alias("__n"), F.first("__wanted").alias("__wanted"))
    upto = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cuts = (sizes.withColumn("__total", F.sum("__n").over(upto))
            .where((F.col("__total") >= F.col("__wanted"))
                   & (F.col("__total") - F.col("__n") < F.col("__wanted")))
            .select(*keys, F.col("__slice").alias("__cut"),
                    (F.col("__wanted") - F.col("__total") + F.col("__n")).alias("__left")))
    cuts = materialize(cuts)
    if not whole:
        lost = null_safe_join(limits.where("__wanted > 0"), cuts.select(*keys), keys, "left_anti").limit(1).collect()
        if lost:
            raise ValueError(f"too few rows of the stratum {[lost[0][k] for k in keys]}: sample it anew")
    near = null_safe_join(placed, broadcast_within(cuts, max_broadcast_rows), keys).where(
        F.col("__slice") <= F.col("__cut"))
    place = Window.partitionBy(*keys).orderBy(UNIT, *spec.key)
    edge = (near.where(F.col("__slice") == F.col("__cut"))
            .withColumn("__place", F.row_number().over(place))
            .where(F.col("__place") <= F.col("__left")).drop("__place"))
    kept = near.where(F.col("__slice") < F.col("__cut")).unionByName(edge)
    rate = F.col("__wanted").cast("double") / F.col(STRATUM_ROWS).cast("double")
    return (kept.withColumn(RATE, rate).withColumn(WEIGHT, F.lit(1.0) / F.col(RATE))
                .select(*units.columns, RATE, WEIGHT))


def sample_maintain(kept: DataFrame, counts: DataFrame, batch: DataFrame, spec: SampleSpec,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(sample, strata counts) after a batch of new base rows.

    ``kept`` may be any earlier sample of the same specification; its rates and
    weights are computed anew. Old base rows are not read again.
    """
    new_counts = materialize(add_counts(counts, strata_counts(batch, spec.qcs), spec.qcs))
    rows = kept.drop(RATE, WEIGHT).unionByName(with_unit(batch, spec))
    return thin(rows, broadcast_within(new_counts, max_broadcast_rows), spec,
                complete=True), new_counts


RESERVE, RESERVE_ROWS = 2.0, 60


def reserve_of(spec: SampleSpec) -> SampleSpec:
    """The wider sample from which ``floor_from_reserve`` takes a hard minimum.

    It expects twice the wanted rows of a stratum and ``RESERVE_ROWS`` more, so that fewer than wanted
    are there with a chance below one in a million.
    """
    return replace(spec, fraction=min(1.0, RESERVE * spec.fraction),
                   min_rows=int(RESERVE * spec.min_rows) + RESERVE_ROWS)


def floor_from_reserve(reserve: DataFrame, counts: DataFrame, spec: SampleSpec,
                       max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The rows of ``floor_sample``, from a sample of ``reserve_of(spec)`` that is kept up to date.

    The reserve holds all rows of a stratum below its rate, so the wanted rows with the least u are among them
    if it has that many. A stratum whose reserve is too small is an error that names it, never a smaller
    sample; it has to be sampled anew. ``counts`` should be stored, and the base is not read.
    """
    return _least_rows(reserve.drop(RATE, WEIGHT), counts, spec, max_broadcast_rows, whole=False)
