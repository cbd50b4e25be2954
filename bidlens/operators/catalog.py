"""Samples stored by the name of their base table, and a choice among them.

A query names the base table. The smallest stored sample whose strata cover its groups answers; where its error is above
the limit the next larger one is asked, and only then the base. Samples are drawn once, when they are added,
and never per query. Counts by strata columns come from the stored strata and have no error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidlens.operators.approx import (
    ErrorBoundExceeded, approx_aggregate, count_from_strata, exact_aggregate,
)
from bidlens.operators.sampling import STRATUM_ROWS, SampleSpec, strata_counts, thin, with_unit
from bidlens.operators.sizing import MAX_BROADCAST_ROWS, broadcast_within
from bidlens.sources.workspace import list_names, materialize

MANIFEST = ("name string, qcs array<string>, fraction double, min_rows int, `key` array<string>, seed string, "
            "portable boolean, base_rows long, sample_rows long, path string")
BY = "answered_by"


@dataclass(frozen=True)
class StoredSample:
    """One sample of a base table: its rows with weights, and its strata with their sizes."""

    name: str
    spec: SampleSpec
    base_rows: int
    sample_rows: int
    path: str

    @property
    def version(self) -> int:
        return int(self.path.rsplit("/", 1)[1])

    def rows(self, spark: SparkSession) -> DataFrame:
        return _read(spark, f"{self.path}/rows")

    def strata(self, spark: SparkSession) -> DataFrame:
        return _read(spark, f"{self.path}/strata")


_schemas: dict[str, StructType] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A stored part; a version never changes, so its schema is looked up once."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def add_sample(base: DataFrame, root: str, table: str, name: str, spec: SampleSpec,
               max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> StoredSample:
    """Draw a sample of ``base`` and enter it in the catalog below ``root``.

    It is a new version if the name is there already: the manifest is written last, so readers see the
    version before until the new one is whole.
    """
    spark, home = base.sparkSession, f"{root}/{table}/{name}"
    version = max((int(n) for n in list_names(spark, home) if n.isdigit()), default=0) + 1
    path = f"{home}/{version}"
    strata_counts(base, spec.qcs).hint("rebalance").write.parquet(f"{path}/strata")
    strata = spark.read.parquet(f"{path}/strata")
    thin(with_unit(base, spec), broadcast_within(strata, max_broadcast_rows), spec, complete=True).hint(
        "rebalance").write.parquet(f"{path}/rows")
    base_rows = strata.agg(F.sum(STRATUM_ROWS)).first()[0] or 0
    found = StoredSample(name, spec, base_rows, spark.read.parquet(f"{path}/rows").count(), path)
    spark.createDataFrame([(name, list(spec.qcs), spec.fraction, spec.min_rows, list(spec.key), spec.seed,
                            spec.portable, base_rows, found.sample_rows, path)], MANIFEST).write.json(f"{path}/manifest")
    return found


def samples_of(spark: SparkSession, root: str, table: str) -> list[StoredSample]:
    """The newest whole version of each sample of a table, the smallest first: one small row per sample."""
    if not list_names(spark, f"{root}/{table}"):
        return []
    newest: dict[str, StoredSample] = {}
    for m in spark.read.schema(MANIFEST).json(f"{root}/{table}/*/*/manifest").collect():
        spec = SampleSpec(tuple(m.qcs), m.fraction, m.min_rows, tuple(m.key), m.seed, m.portable)
        sample = StoredSample(m.name, spec, m.base_rows, m.sample_rows, m.path)
        if m.name not in newest or newest[m.name].version < sample.version:
            newest[m.name] = sample
    return sorted(newest.values(), key=lambda s: (s.sample_rows, s.name))


def _from_strata(spark, samples, needed: set[str], group_by, aggs, where) -> DataFrame | None:
    """Counts without error, if only rows are counted and a sample's strata tell the groups and the filter apart."""
    if any(tuple(spec) != ("count",) for spec in aggs.values()):
        return None
    for sample in samples:
        if needed <= set(sample.spec.qcs):
            strata = sample.strata(spark)
            counts = count_from_strata(strata if where is None else strata.where(where), group_by)
            return counts.select(*group_by, *(c for name in aggs for c in (
                F.coalesce("rows", F.lit(0)).cast("double").alias(name), F.lit(0.0).alias(f"{name}_error"))),
                F.lit(None).cast("bigint").alias("sample_rows"), F.lit(f"strata of {sample.name}").alias(BY))
    return None


def answer(spark: SparkSession, root: str, table: str, group_by: list[str], aggs: dict[str, tuple],
           error: float | None = None, confidence: float = 0.95, where: str | None = None,
           where_columns: tuple[str, ...] = (), base: DataFrame | None = None,
           on_violation: str = "raise", samples: list[StoredSample] | None = None) -> DataFrame:
    """Aggregates of a base table by its name, from its smallest stored sample that is good enough.

    The result is that of ``approx_aggregate`` and says in ``answered_by`` what it comes from. A sample covers the
    groups if all of ``group_by`` are strata columns; samples that don't cover them follow, smallest first, as the estimate
    holds for any groups but a rare one may be missing. ``where`` filters rows; name its columns in ``where_columns``
    where they are strata columns. ``samples`` saves reading the catalog, for who holds it. With an ``error`` the estimates of a sample are computed once and stored, one row per group, and the
    next larger sample is asked where one of them misses the limit. If all do: ``raise`` raises
    ``ErrorBoundExceeded``, ``exact`` computes from ``base``, ``report`` returns the last.
    """
    if on_violation not in ("raise", "exact", "report"):
        raise ValueError(f"unknown on_violation: {on_violation}")
    if on_violation == "exact" and base is None:
        raise ValueError("on_violation='exact' needs the base table")
    samples = samples_of(spark, root, table) if samples is None else samples
    if not samples and on_violation != "exact":
        raise LookupError(f"no sample of {table} below {root}")
    if where is None or where_columns:
        counted = _from_strata(spark, samples, {*group_by, *where_columns}, group_by, aggs, where)
        if counted is not None:
            return counted
    covering = [s for s in samples if set(group_by) <= set(s.spec.qcs)]
    tried, result = [], None
    for sample in covering + [s for s in samples if s not in covering]:
        rows = sample.rows(spark)
        result = approx_aggregate(rows if where is None else rows.where(where), group_by, aggs, error, confidence,
                                  "report").withColumn(BY, F.lit(sample.name))
        if error is None:
            return result
        result = materialize(result)
        worst = result.agg(F.max(F.greatest(*(F.col(f"{name}_error") for name in aggs), F.lit(0.0)))).first()[0]
        if worst is None or worst <= error:
            return result
        tried.append(f"{sample.name}: {worst:.3f}")
    if on_violation == "exact":
        return exact_aggregate(base if where is None else base.where(where), group_by, aggs).withColumn(BY, F.lit("base"))
    if on_violation == "raise":
        raise ErrorBoundExceeded(f"no sample of {table} is within {error} at {confidence}; " + ", ".join(tried))
    return result
