from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bidlens.functions import (
    estimate, hash_unit, mean_of, merged, nation_code, not_in, null_safe_join, safe_ratio,
    sketch_of, supplier_key,
)
from bidlens.operators.sizing import broadcast_within
from bidlens.sources.workspace import checkpoint_root
from conftest import rows


@pytest.mark.parametrize("keys", [[1, 2, None], [1, 2], []])
@pytest.mark.parametrize("values", [[1, 3], [1, None], [], [None]])
def test_not_in_follows_sql(spark, keys, values):
    left = spark.createDataFrame([(k,) for k in keys], "k int")
    right = spark.createDataFrame([(v,) for v in values], "v int")
    want = spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT v FROM {r})", l=left, r=right)
    assert rows(not_in(left, left["k"], right, "v")) == rows(want)


def test_not_in_needs_no_broadcast(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = not_in(left, left["k"], right, "id")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "SortMergeJoin" in plan


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "p", "y"), (None, None, "z")],
                              "k int, g string, v string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 30)], "k int, g string, w int")
    assert rows(null_safe_join(a, b, ["k", "g"]), "v", "w") == [("x", 10), ("z", 30)]
    assert rows(null_safe_join(a, b, ["k", "g"], "left_anti"), "v") == [("y",)]
    assert null_safe_join(a, b, ["k", "g"]).columns == ["k", "g", "v", "w"]


def test_supplier_key_is_never_negative_nor_overflows(spark):
    df = spark.createDataFrame([(-3, 7), (2_000_000_000, 2_000_000_000), (4, 2500)],
                               "w int, i int")
    got = [r[0] for r in df.select(supplier_key("w", "i")).collect()]
    assert got == [(-3 * 7) % 10000, (2_000_000_000 ** 2) % 10000, 0]


def test_nation_code_and_ratio(spark):
    df = spark.createDataFrame([("AZ", 1, 0), ("b", 1, 4)], "s string, a int, b int")
    got = df.select(nation_code("s"), safe_ratio(F.col("a"), F.col("b")))
    assert rows(got) == [(65, None), (98, 0.25)]


def test_mean_of_decimals_is_one_division(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)],
                               "v decimal(18,2)")
    assert df.agg(mean_of("v")).first()[0] == 0.30 / 2
    assert df.where("v > 5").agg(mean_of("v")).first()[0] is None


@pytest.mark.parametrize("portable", [False, True])
def test_hash_unit_is_uniform_and_keeps_key_parts_apart(spark, portable):
    u = spark.range(20000).select(hash_unit(["id"], portable=portable).alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.001 and 0.999 < high < 1 and abs(mean - 0.5) < 0.01
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("", "c"), ("-", "c")],
                               "x string, y string")
    assert df.select(hash_unit(["x", "y"], portable=portable)).distinct().count() == 5
    one = spark.createDataFrame([("k",)], "x string")
    assert one.select(hash_unit(["x"], "", portable)).first() != one.select(
        hash_unit(["x"], "s", portable)).first()


def test_sketches_merge_to_the_whole(spark):
    df = spark.range(30000).select((F.col("id") % 5).alias("g"), (F.col("id") % 9001).alias("c"))
    whole = df.agg(estimate(sketch_of("c"))).first()[0]
    parts = df.groupBy("g").agg(sketch_of("c").alias("s")).agg(estimate(merged("s"))).first()[0]
    assert abs(whole - 9001) / 9001 < 0.06 and abs(parts - 9001) / 9001 < 0.06


def test_broadcast_only_within_the_bound(spark):
    small, big = spark.range(10), spark.range(11)

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_within(small, 10)) and not hinted(broadcast_within(big, 10))


class NoCheckpointDir:
    """A session that names no checkpoint folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_only_local_sessions_may_lack_a_checkpoint_folder():
    local = NoCheckpointDir("local[2]")
    assert checkpoint_root(local) == checkpoint_root(local)
    with pytest.raises(ValueError):
        checkpoint_root(NoCheckpointDir("yarn"))
