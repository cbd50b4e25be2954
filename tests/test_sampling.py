import pytest
from pyspark.sql import functions as F

from bidlens.operators import approx, sampling
from bidlens.operators.sampling import SampleSpec, sample_maintain, strata_counts
from conftest import rows


def make(spark, n=6000):
    """Half of the rows in one stratum, some in a null stratum, a few in tiny ones."""
    g = (F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))))
    return spark.range(n).select("id", g.alias("g"), (F.col("id") % 97).cast("double").alias("y"))


SPEC = SampleSpec(("g",), 0.05, 20, ("id",))


def test_rates_and_weights(spark):
    df = make(spark)
    sample = sampling.stratified_sample(df, SPEC)
    bad = sample.where((F.col("sample_u") >= F.col("sample_rate"))
                       | (F.abs(F.col("sample_weight") * F.col("sample_rate") - 1) > 1e-12))
    assert bad.count() == 0
    hot = sample.where("g = 'hot'").select("sample_rate").first()[0]
    assert hot == 0.05
    assert sample.where("g is null").count() > 0


@pytest.mark.parametrize("seed", ["a", "b", "c"])
@pytest.mark.parametrize("reverse", [False, True])
def test_maintained_equals_scratch(spark, seed, reverse):
    spec = SampleSpec(("g",), 0.05, 20, ("id",), seed)
    df = make(spark)
    bounds = [(0, 50), (50, 2500), (2500, 6000)]
    parts = [df.where((F.col("id") >= a) & (F.col("id") < b)) for a, b in bounds]
    if reverse:
        parts.reverse()
    counts = strata_counts(parts[0], spec.qcs)
    kept = sampling.stratified_sample(parts[0], spec, counts)
    for part in parts[1:]:
        kept, counts = sample_maintain(kept, counts, part, spec)
    assert rows(kept) == rows(sampling.stratified_sample(df, spec))
    assert rows(counts) == rows(strata_counts(df, spec.qcs))


def test_shuffled_strata_give_the_same_sample(spark):
    df = make(spark)
    assert rows(sampling.stratified_sample(df, SPEC, max_broadcast_rows=0)) == rows(
        sampling.stratified_sample(df, SPEC))


@pytest.mark.parametrize("spec", [
    SPEC, SampleSpec(("g",), 0.9, 1, ("id",)), SampleSpec(("g",), 0.001, 300, ("id",), "z"),
    SampleSpec(("g",), 1.0, 0, ("id",))])
def test_floor_sample_is_the_smallest_units(spark, spec):
    import math
    from collections import defaultdict

    df = make(spark)
    strata = defaultdict(list)
    for r in sampling.with_unit(df, spec).collect():
        strata[r.g].append((r.sample_u, r.id))
    want = []
    for g, units in strata.items():
        rate = min(1.0, max(spec.fraction, spec.min_rows / len(units)))
        want += [(i,) for _, i in sorted(units)[:math.ceil(rate * len(units))]]
    got = sampling.floor_sample(df, spec)
    assert rows(got, "id") == sorted(want, key=repr)
    total = got.agg(F.sum("sample_weight")).first()[0]
    assert abs(total - df.count()) < 1e-6 * df.count()


def test_bad_specifications_are_refused():
    for bad in (dict(qcs=()), dict(fraction=0), dict(fraction=1.5), dict(min_rows=-1),
                dict(key=())):
        with pytest.raises(ValueError):
            SampleSpec(**{**dict(qcs=("g",), fraction=0.1, min_rows=1, key=("id",)), **bad})


AGGS = {"n": ("count",), "total": ("sum", "y"), "mean": ("avg", "y")}


def test_certain_rows_have_no_error(spark):
    df = make(spark)
    whole = sampling.stratified_sample(df, SampleSpec(("g",), 1.0, 1, ("id",)))
    got = approx.approx_aggregate(whole, ["g"], AGGS, error=0.0)
    want = df.groupBy("g").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("total"),
                               F.avg("y").alias("mean"))
    for a, b in zip(rows(got, "g", "n", "total", "mean"), rows(want)):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-12)
    assert rows(got.agg(F.max("n_error"), F.max("total_error"), F.max("mean_error"))) == [
        (0.0, 0.0, 0.0)]


def test_violation_raises_when_read(spark):
    sample = sampling.stratified_sample(make(spark), SPEC)
    got = approx.approx_aggregate(sample, ["g"], {"n": ("count",)}, error=0.01)
    with pytest.raises(Exception, match="ErrorBoundExceeded: n has relative error"):
        got.orderBy(F.desc("n")).limit(3).collect()
    ok = approx.approx_aggregate(sample, [], {"n": ("count",)}, error=0.5)
    assert ok.first().n > 0


def test_violation_can_fall_back_or_be_reported(spark):
    df = make(spark)
    sample = sampling.stratified_sample(df, SPEC)
    exact = approx.approx_aggregate(sample, ["g"], AGGS, 0.01, on_violation="exact", base=df)
    assert exact.where("g = 'hot'").first().n == 3000.0
    kept = approx.approx_aggregate(sample, ["g"], AGGS, 5.0, on_violation="exact", base=df)
    assert kept.where("g = 'hot'").first().sample_rows is not None
    report = approx.approx_aggregate(sample, ["g"], AGGS, 0.01, on_violation="report")
    assert report.where("n_error > 0.01").count() > 0
    for kwargs in (dict(on_violation="exact"), dict(on_violation="guess")):
        with pytest.raises(ValueError):
            approx.approx_aggregate(sample, ["g"], AGGS, 0.1, **kwargs)


def test_nulls_do_not_count(spark):
    df = make(spark).withColumn("y", F.when(F.col("id") % 3 == 0, F.col("y")))
    whole = sampling.stratified_sample(df, SampleSpec(("g",), 1.0, 1, ("id",)))
    got = approx.approx_aggregate(whole, [], {"n": ("count", "y"), "mean": ("avg", "y"),
                                              "total": ("sum", "y")}).first()
    want = df.agg(F.count("y"), F.avg("y"), F.sum("y")).first()
    assert (got.n, got.mean, got.total) == pytest.approx(tuple(want), rel=1e-12)


def test_empty_sample(spark):
    sample = sampling.stratified_sample(make(spark), SPEC).where("g = 'none'")
    got = approx.approx_aggregate(sample, [], {"n": ("count",)}, error=0.1).first()
    assert got.n == 0 and got.sample_rows == 0
    assert approx.approx_aggregate(sample, ["g"], {"n": ("count",)}, error=0.1).count() == 0


def test_intervals_cover_the_truth(spark):
    df = make(spark).persist()
    truth = df.agg(F.sum("y"), F.count("*"), F.avg("y")).first()
    hits = [0, 0, 0]
    seeds = 40
    for seed in range(seeds):
        spec = SampleSpec(("g",), 0.05, 20, ("id",), f"seed{seed}")
        got = approx.approx_aggregate(sampling.stratified_sample(df, spec), [], AGGS).first()
        for i, (value, error) in enumerate([(got.total, got.total_error), (got.n, got.n_error),
                                            (got.mean, got.mean_error)]):
            hits[i] += abs(value - truth[i]) <= error * abs(value)
    df.unpersist()
    assert all(h >= 0.85 * seeds for h in hits), hits


def test_exact_counts_from_strata(spark):
    df = make(spark).withColumn("h", F.col("id") % 3)
    got = approx.count_from_strata(strata_counts(df, ("g", "h")), ["g"])
    assert rows(got) == rows(df.groupBy("g").count())


def test_strata_missing_from_counts_are_kept_whole(spark):
    spec = sampling.SampleSpec(("g",), 0.1, 0, ("id",))
    df = spark.range(400).selectExpr("id", "CASE WHEN id < 300 THEN 'a' END AS g")
    counts = sampling.strata_counts(df.where("g = 'a'"), spec.qcs)
    got = sampling.stratified_sample(df, spec, counts)
    assert got.where("g IS NULL").count() == 100 and got.where("g = 'a'").count() < 100


def test_violation_raises_whatever_is_read(spark):
    sample = spark.createDataFrame([("x", 1.0, 0.5), ("x", 9.0, 0.5)], "g string, v double, rate double")
    sample = sample.withColumnRenamed("rate", sampling.RATE).withColumn(sampling.WEIGHT, F.lit(2.0))
    limited = approx.approx_aggregate(sample, ["g"], {"n": ("count",)}, 0.0001)
    for read in (limited.count, limited.select("g").collect, limited.select("n_error").collect):
        with pytest.raises(Exception, match="ErrorBoundExceeded"):
            read()
