from datetime import date

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.operators import storage
from bidlens.operators.ranking import top_k, top_per_group
from bidlens.operators.rollup import (
    finish_partials, measures, merge_partials, partial_state, resolved, window_of,
)
from bidlens.sources.tables import csv_ingest, read_table, target_columns
from conftest import rows


def versions(spark, values):
    return spark.createDataFrame(values, "k int, c string, v int, note string")


KEYS, ORDER = ["k", "c"], ["v", "note"]


def test_upsert_keeps_the_greatest_version(spark):
    target = versions(spark, [(1, "a", 1, "old"), (2, "a", 9, "old"), (3, None, 1, "old"),
                              (4, "z", 1, "kept")])
    updates = versions(spark, [(1, "a", 2, "new"), (1, "a", 3, "newer"), (2, "a", 8, "stale"),
                               (3, None, 2, "new"), (5, "b", None, "n"), (5, "b", 0, "first")])
    want = sorted([(1, "a", 3, "newer"), (2, "a", 9, "old"), (3, None, 2, "new"),
                   (4, "z", 1, "kept"), (5, "b", 0, "first")], key=repr)
    got = storage.upsert_latest(target, updates, KEYS, ORDER)
    assert rows(got) == want
    assert rows(storage.upsert_latest(got, updates, KEYS, ORDER)) == want
    some, others = updates.where("k < 3"), updates.where("k >= 3")
    step = storage.upsert_latest(target, others, KEYS, ORDER)
    assert rows(storage.upsert_latest(step, some, KEYS, ORDER)) == want


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 1000).alias("k"), F.col("id").alias("v"))
    latest = storage.latest_per_key(df, ["k"], ["v"])
    assert latest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(latest) == [(0, 999)]


def test_upsert_rewrites_touched_partitions_only(spark, folder):
    base = versions(spark, [(1, "a", 1, "x"), (11, "a", 1, "x"), (21, "a", 1, "x")])
    base = base.withColumn("p", (F.col("k") / 10).cast("int"))
    base.write.partitionBy("p").parquet(folder)
    local = folder.removeprefix("file:")
    before = {p: sorted(glob.glob(f"{local}/p={p}/*.parquet")) for p in (0, 1, 2)}
    updates = versions(spark, [(11, "a", 2, "y"), (31, "a", 1, "new")]).withColumn(
        "p", (F.col("k") / 10).cast("int"))
    root = os.path.dirname(local)
    others = sorted(os.listdir(root))
    storage.upsert_partitioned(spark, folder, updates, KEYS, ORDER, "p")
    assert sorted(os.listdir(root)) == others  # nothing is left behind
    got = spark.read.parquet(folder)
    assert rows(got, "k", "v", "note") == [(1, 1, "x"), (11, 2, "y"), (21, 1, "x"),
                                           (31, 1, "new")]
    after = {p: sorted(glob.glob(f"{local}/p={p}/*.parquet")) for p in (0, 1, 2)}
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1]


def test_clustered_rows_are_sorted_in_files_and_a_hot_key_is_split(spark, folder):
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"),
            F.md5(F.col("id").cast("string")).alias("v"))
        storage.clustered_append(df, folder, "k")
    finally:
        for k in confs:
            spark.conf.unset(k)
    stored = spark.read.parquet(folder)
    assert stored.count() == 200_000
    hot_files = stored.where("k = 0").select(F.input_file_name()).distinct().count()
    assert hot_files > 1
    for path in glob.glob(folder.removeprefix("file:") + "/*.parquet"):
        keys = [r.k for r in spark.read.parquet(path).select("k").collect()]
        assert keys == sorted(keys)


def test_target_schema_is_matched_by_name(spark):
    target = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rows(target_columns(df, target)) == [("2", 1)]
    with pytest.raises(Exception):
        target_columns(df.drop("b"), target)


def test_tables_can_be_created_filled_and_dropped(spark, folder):
    storage.create_database(spark, "default")
    storage.drop_table(spark, "people")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("n", T.StringType())])
    table = storage.create_column_table(spark, "people", schema, bucket_key="id", buckets=3,
                                        partition_by=["d"], location=folder)
    assert table.count() == 0
    day = dt.date(2024, 1, 1)
    storage.append_by_name(spark.createDataFrame([("x", 1, day), ("y", 2, day)],
                                                 "n string, id int, d date"), "people")
    assert rows(read_table(spark, "people"), "id", "d", "n") == [(1, day, "x"), (2, day, "y")]
    plan = spark.table("people").groupBy("id").count()._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    storage.drop_table(spark, "people")
    assert not spark.catalog.tableExists("people")


def test_retain_window_drops_old_days(spark, folder):
    days = ["2024-02-27", "2024-02-28", "2024-03-01", "2024-03-02"]
    spark.createDataFrame([(d, 1) for d in days], "day string, v int").withColumn(
        "day", F.to_date("day")).write.partitionBy("day").parquet(folder)
    today = date(2024, 3, 2)
    with pytest.raises(ValueError):
        storage.retain_window(spark, folder, "day", 3, date(2024, 3, 1))
    for dry in (True, False):
        assert storage.retain_window(spark, folder, "day", 3, today, dry) == [
            "2024-02-27", "2024-02-28"]
    assert spark.read.parquet(folder).count() == 2
    assert storage.retain_window(spark, folder, "day", 3, today) == []
    assert storage.retain_window(spark, folder + "-none", "day", 1, today) == []


def test_malformed_csv_fails(spark, folder):
    os.makedirs(folder.removeprefix("file:"))
    path = folder.removeprefix("file:") + "/a.csv"
    with open(path, "w") as f:
        f.write("1464194729027,p,a,w,NJ,0.5,c\nnot-a-number,p,a,w,NJ,0.5,c\n")
    with pytest.raises(Exception):
        csv_ingest(spark, path).collect()


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v int")
    assert [tuple(r) for r in top_k(df, "k", F.sum("v"), "s", 2).collect()] == [("c", 2), ("a", 1)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 1000).alias("g"), (F.col("id") % 100).alias("k"))
    best = top_per_group(df, "g", "k", F.count("*"), "n", 3)
    assert best._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(best, "k", "place") == [(0, 1), (1, 2), (2, 3)]


def test_partials_merge_in_any_grouping(spark, data):
    seen = resolved(data.impressions)
    keys = ["publisher", "geo"]
    whole = rows(finish_partials(partial_state(seen, keys)))
    assert whole == rows(seen.groupBy(*keys).agg(*measures()))
    split = [partial_state(seen.where(F.col("event_id") % 3 == i), keys) for i in range(3)]
    left = merge_partials(split[0].unionByName(split[1]), keys).unionByName(split[2])
    right = merge_partials(split[2].unionByName(split[1]), keys).unionByName(split[0])
    assert rows(finish_partials(merge_partials(left, keys))) == whole
    assert rows(finish_partials(merge_partials(right, keys))) == whole
    hourly = partial_state(seen, [window_of("1 hour"), *keys])
    assert rows(finish_partials(merge_partials(hourly, keys))) == whole


def test_buckets_need_a_key(spark):
    schema = spark.createDataFrame([], "id long").schema
    with pytest.raises(ValueError):
        storage.create_column_table(spark, "keyless", schema, buckets=3)
