import os
import uuid

from fixtures.registry import bucketed_orders
from bidlens.operators import storage
from bidlens.plans import mixed
from bidlens.sources.workspace import work_dir
from conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_lines_meet_orders_without_a_shuffle(spark, data):
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        stored = plan_of(mixed.ch_query(bucketed_orders(data), 12, delivered_before="2001-01-01"))
        given = plan_of(mixed.ch_query(data.mixed(), 12, delivered_before="2001-01-01"))
        latest = plan_of(bucketed_orders(data).order_line.groupBy(*mixed.ORDER_KEY).count())
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in stored and "Exchange" not in stored.split("SortMergeJoin", 1)[1]
    assert "Exchange" in given.split("SortMergeJoin", 1)[1]
    assert "Exchange" not in latest


def test_stored_orders_are_not_broadcast(data):
    """Stored tables are compressed, so Spark takes them for smaller than their rows."""
    plan = plan_of(mixed.ch_query(bucketed_orders(data), 21, nation="NATION_1"))
    joins = [s for s in plan.split("\n") if "Join [" in s and ("ol_o_id#" in s or "o_orderkey#" in s)]
    assert len(joins) > 1 and all("SortMergeJoin" in s for s in joins)


def test_a_bucket_is_one_file_and_keeps_its_rows(spark):
    path, name = work_dir(spark, "bucketed"), f"b_{uuid.uuid4().hex}"
    df = spark.range(0, 1000, 1, 7).selectExpr("id % 50 AS a", "CASE WHEN id % 9 > 0 THEN id % 3 END AS b", "id AS c")
    got = storage.store_bucketed(df, name, ["a", "b"], 4, path)
    assert rows(got.select("a", "b", "c")) == rows(df)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 4
    storage.drop_table(spark, name)
    empty = storage.store_bucketed(df.limit(0), name, ["a"], 4, work_dir(spark, "bucketed"))
    assert empty.count() == 0
