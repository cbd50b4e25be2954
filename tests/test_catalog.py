import pytest
from pyspark.sql import functions as F

from bidlens.operators import approx, catalog, sampling
from bidlens.operators.sampling import SampleSpec, floor_from_reserve, floor_sample, reserve_of
from bidlens.sources.workspace import drop_path, work_dir
from bidlens.streaming import ingest
from conftest import rows
from test_sampling import SPEC, make

SMALL, LARGE = SampleSpec(("g",), 0.05, 20, ("id",)), SampleSpec(("g",), 0.6, 100, ("id",))
OTHER = SampleSpec(("h",), 0.05, 20, ("id",))


@pytest.fixture(scope="module")
def stored(spark):
    root, df = work_dir(spark, "catalog"), make(spark).withColumn("h", F.col("id") % 3)
    for name, spec in (("large", LARGE), ("small", SMALL), ("other", OTHER)):
        catalog.add_sample(df, root, "t", name, spec)
    return root, df


def by(df):
    return {r[0] for r in df.select("answered_by").distinct().collect()}


def test_the_smallest_sample_that_holds_the_limit_answers(spark, stored):
    root, df = stored
    got = catalog.answer(spark, root, "t", ["g"], {"s": ("sum", "y")}, error=2.0)
    assert by(got) == {"small"}
    want = approx.approx_aggregate(sampling.stratified_sample(df, SMALL), ["g"], {"s": ("sum", "y")})
    assert {r.g: round(r.s, 6) for r in got.collect()} == {r.g: round(r.s, 6) for r in want.collect()}
    assert by(catalog.answer(spark, root, "t", ["g"], {"s": ("sum", "y")}, error=0.3)) == {"large"}
    assert by(catalog.answer(spark, root, "t", ["h"], {"s": ("sum", "y")}, error=0.5)) == {"other"}
    # no sample is stratified by this column: the smallest one is asked first all the same
    assert by(catalog.answer(spark, root, "t", [], {"s": ("sum", "y")}, error=0.5)) <= {"small", "other"}


def test_what_no_sample_can_answer(spark, stored):
    root, df = stored
    with pytest.raises(approx.ErrorBoundExceeded, match="small: .*large: "):
        catalog.answer(spark, root, "t", ["g"], {"s": ("sum", "y")}, error=1e-9)
    exact = catalog.answer(spark, root, "t", ["g"], {"s": ("sum", "y")}, error=1e-9, base=df, on_violation="exact")
    assert by(exact) == {"base"}
    assert rows(exact.select("g", "s")) == rows(df.groupBy("g").agg(F.sum("y").alias("s")))
    report = catalog.answer(spark, root, "t", ["g"], {"s": ("sum", "y")}, error=1e-9, on_violation="report")
    assert report.count() == df.select("g").distinct().count()
    with pytest.raises(LookupError):
        catalog.answer(spark, root, "unknown", [], {"n": ("count",)})


def test_counts_by_strata_have_no_error(spark, stored):
    root, df = stored
    got = catalog.answer(spark, root, "t", ["g"], {"n": ("count",)}, error=0.0)
    assert rows(got.select("g", "n", "n_error")) == rows(
        df.groupBy("g").agg(F.count("*").cast("double").alias("n"), F.lit(0.0)))
    one = catalog.answer(spark, root, "t", [], {"n": ("count",)}, where="g = 'hot'", where_columns=("g",))
    assert one.first().n == df.where("g = 'hot'").count()
    # a filter on another column is estimated
    some = catalog.answer(spark, root, "t", ["g"], {"n": ("count",)}, where="y < 50")
    assert by(some) == {"small"} and some.agg(F.sum("n")).first()[0] == pytest.approx(df.where("y < 50").count(), rel=0.2)


def test_a_new_version_counts_once_it_is_whole(spark):
    root, df = work_dir(spark, "catalog"), make(spark, 500)
    first = catalog.add_sample(df, root, "t", "s", SMALL)
    second = catalog.add_sample(make(spark, 900), root, "t", "s", SMALL)
    assert [s.base_rows for s in catalog.samples_of(spark, root, "t")] == [900]
    drop_path(spark, f"{second.path}/manifest")  # as if the writer had been lost
    assert catalog.samples_of(spark, root, "t") == [first]
    empty = catalog.add_sample(df.limit(0), root, "e", "s", SMALL)
    assert empty.sample_rows == 0
    assert catalog.answer(spark, root, "e", ["g"], {"s": ("sum", "y")}, error=0.1).count() == 0


@pytest.mark.parametrize("seed", ["a", "b", "c"])
def test_the_hard_minimum_is_kept_up_to_date(spark, folder, seed):
    spec, df = SampleSpec(("g",), 0.05, 20, ("id",), seed), make(spark)
    cuts = [0, 50, 2500, 2600, 6000]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        batch = df.where((F.col("id") >= a) & (F.col("id") < b))
        for _ in range(2 if n == 2 else 1):  # a batch may come again
            ingest.write_batch_with_sample(batch, n, folder, reserve_of(spec))
        so_far = df.where(F.col("id") < b)
        got = ingest.read_floor_sample(spark, folder, spec)
        want = floor_sample(so_far, spec)
        assert rows(got.select("id", "sample_rate")) == rows(want.select("id", "sample_rate"))
        least = so_far.groupBy("g").agg(F.least(F.lit(20), F.count("*")).alias("least"))
        held = {r.g: r["count"] for r in got.groupBy("g").count().collect()}
        assert all(held[r.g] >= r.least for r in least.collect())
    ingest.merge_batches(spark, folder, reserve_of(spec))
    assert rows(ingest.read_floor_sample(spark, folder, spec).select("id")) == rows(floor_sample(df, spec).select("id"))


def test_a_reserve_that_is_too_small_is_an_error(spark):
    df = make(spark)
    counts = sampling.strata_counts(df, SPEC.qcs)
    few = sampling.with_unit(df, SPEC).where("sample_u < 0.01")
    with pytest.raises(Exception, match="too few rows of the stratum"):
        floor_from_reserve(few, counts, SPEC).collect()
