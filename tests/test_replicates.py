import hashlib
import math

import pytest
from pyspark.sql import functions as F

from bidlens.operators import approx, sampling
from bidlens.operators.replicates import replicate_aggregate, replicate_totals
from bidlens.operators.sampling import SampleSpec

RATIO = {"share": lambda t: F.try_divide(t["part"], t["all"])}


def totals():
    return {"part": F.when(F.col("id") % 3 == 0, F.col("y")), "all": F.col("y")}


def make(spark, n=6000):
    g = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("cold"))
    return spark.range(n).select("id", g.alias("g"), (F.col("id") % 97).cast("double").alias("y"))


def test_replicates_are_those_of_plain_python(spark):
    sample = sampling.stratified_sample(make(spark), SampleSpec(("g",), 0.05, 20, ("id",)))
    n = 40
    got = {r.g: r for r in replicate_aggregate(sample, ["g"], totals(), RATIO, ["id"], replicates=n).collect()}
    groups = {}
    for r in sample.collect():
        digest = hashlib.md5(f"replicate{len(str(r.id))}:{r.id}".encode()).hexdigest()
        signs = [1 - 2 * ((int(digest[8 * (k // 32):8 * (k // 32) + 8], 16) >> k % 32) & 1) for k in range(n)]
        groups.setdefault(r.g, []).append((r.y if r.id % 3 == 0 else 0.0, r.y, r.sample_weight, signs))
    assert set(got) == set(groups)
    for g, rows in groups.items():
        def share(k=None):
            w = [w + (math.sqrt(w * (w - 1)) * s[k] if k is not None else 0) for _, _, w, s in rows]
            return sum(a * x for (a, *_), x in zip(rows, w)) / sum(b * x for (_, b, *_), x in zip(rows, w))

        error = 1.959963984540054 * math.sqrt(sum((share(k) - share()) ** 2 for k in range(n)) / n) / share()
        assert got[g].share == pytest.approx(share()) and got[g].share_error == pytest.approx(error)
        assert got[g].sample_rows == len(rows)


def test_intervals_cover_the_truth(spark):
    """Of the 95 % intervals of 60 samples, as many hold the true ratio as 60 draws allow."""
    seeds = 60
    df = make(spark).withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(seeds))))
    truth = make(spark).agg(F.sum(totals()["part"]) / F.sum("y")).first()[0]
    sample = sampling.stratified_sample(df, SampleSpec(("seed", "g"), 0.05, 20, ("id", "seed")))
    got = replicate_aggregate(sample, ["seed"], totals(), RATIO, ["id", "seed"]).collect()
    hits = sum(abs(r.share - truth) <= r.share_error * r.share for r in got)
    assert len(got) == seeds and hits >= 0.88 * seeds, hits


def test_a_total_has_about_the_error_of_the_closed_form(spark):
    sample = sampling.stratified_sample(make(spark), SampleSpec(("g",), 0.05, 20, ("id",)))
    got = replicate_aggregate(sample, [], {"all": F.col("y")}, {"all": lambda t: t["all"]}, ["id"], replicates=128)
    want = approx.approx_aggregate(sample, [], {"total": ("sum", "y")}).first()
    assert got.first()["all"] == pytest.approx(want.total)
    assert got.first()["all_error"] == pytest.approx(want.total_error, rel=0.3)


def test_certain_rows_limits_and_odd_samples(spark):
    df = make(spark, 200)
    whole = df.withColumn(sampling.WEIGHT, F.lit(1.0))
    got = replicate_aggregate(whole, ["g"], totals(), RATIO, ["id"], error=0.0).collect()
    assert len(got) == 3 and all(r.share_error == 0 for r in got)
    thin = df.withColumn(sampling.WEIGHT, F.lit(20.0))
    with pytest.raises(Exception, match="ErrorBoundExceeded: share"):
        replicate_aggregate(thin, ["g"], totals(), RATIO, ["id"], error=0.001).collect()
    none = replicate_aggregate(thin.where("false"), [], totals(), RATIO, ["id"], error=0.1).first()
    assert none.share is None and none.share_error is None and none.sample_rows == 0
    assert not replicate_aggregate(thin.where("false"), ["g"], totals(), RATIO, ["id"]).collect()
    for bad in ({"replicates": 1}, {"replicates": 129}):
        with pytest.raises(ValueError):
            replicate_totals(thin, [], totals(), ["id"], **bad)
    with pytest.raises(ValueError):
        replicate_totals(thin, [], totals(), [])
