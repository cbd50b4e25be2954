import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bidlens.operators.sampling import SampleSpec, stratified_sample
from bidlens.plans import clicks
from bidlens.sources import streams
from bidlens.sources.schemas import CLICK, IMPRESSION
from bidlens.sources.workspace import path_exists, work_dir
from bidlens.streaming import continuous, ingest
from bidlens.session import in_pool
from conftest import rows

T0 = dt.datetime(2024, 1, 1)
DDL = ("time_stamp timestamp, publisher string, advertiser string, website string, geo string, "
       "bid double, cookie string")


def impression(second, publisher="p1", geo="NJ", bid=1.0, cookie="c1"):
    return (T0 + dt.timedelta(seconds=second), publisher, "a1", "w1", geo, bid, cookie)


def land(spark, folder, number, values):
    """One file, later than those before it, as the file source orders by time."""
    path = f"{folder}/batch{number}"
    spark.createDataFrame(values, DDL).coalesce(1).write.parquet(path)
    local = path.removeprefix("file:")
    for name in os.listdir(local):
        os.utime(f"{local}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


def replay(spark, folder):
    return streams.replay_stream(spark, f"{folder}/*", IMPRESSION, files_per_trigger=1)


BATCHES = [
    [impression(0), impression(0.5, cookie="c2"), impression(0.9, cookie="c1", bid=2.0)],
    [impression(2), impression(2.1, geo="un"), impression(2.2, "p2", cookie=None)],
    [impression(5), impression(5.1)],
    [impression(0.2, cookie="late")],
    [impression(60)],
]


@pytest.fixture
def landed(spark, folder):
    for i, values in enumerate(BATCHES):
        land(spark, folder, i, values)
    return folder


def finished(spark, df):
    home = work_dir(spark, "test-stream")
    query = continuous.start_append(df, f"{home}/out", f"{home}/checkpoint", partitions=2)
    query.awaitTermination()
    return query, spark.read.parquet(f"{home}/out")


def at(second):
    return T0 + dt.timedelta(seconds=second)


def test_exact_uniques_over_batches_and_late_rows(spark, landed):
    query, out = finished(spark, continuous.cq_pub_geo(
        replay(spark, landed), "1 second", watermark="0 seconds"))
    got = rows(out, "window_start", "publisher", "geo", "avg_bid", "imps", "uniques")
    assert got == [(at(0), "p1", "NJ", 4.0 / 3, 3, 2), (at(2), "p1", "NJ", 1.0, 1, 1),
                   (at(2), "p2", "NJ", 1.0, 1, 0), (at(5), "p1", "NJ", 1.0, 2, 1)]
    assert continuous.late_rows(query) == 1


def test_a_watermark_delay_lets_late_rows_in(spark, landed):
    query, out = finished(spark, continuous.cq_pub_geo(
        replay(spark, landed), "1 second", watermark="10 seconds"))
    assert rows(out.where("publisher = 'p1'"), "window_start", "imps", "uniques") == [
        (at(0), 4, 3), (at(2), 1, 1), (at(5), 2, 1)]
    assert continuous.late_rows(query) == 0


def test_one_window_of_delay_by_default(spark, landed):
    query, out = finished(spark, continuous.cq_pub_geo(replay(spark, landed), "10 seconds"))
    assert continuous.late_rows(query) == 0
    assert rows(out, "window_start", "publisher", "imps", "uniques") == [
        (at(0), "p1", 7, 3), (at(0), "p2", 1, 0)]


def test_sliding_sketches_equal_batch(spark, landed):
    _, out = finished(spark, continuous.cq_pub_geo(
        replay(spark, landed), "2 seconds", "1 second", watermark="10 seconds", uniques="hll"))
    stored = spark.read.parquet(f"{landed}/*")
    batch = continuous.cq_pub_geo(stored, "2 seconds", "1 second", uniques="hll")
    shown = ["window_start", "window_end", "publisher", "geo", "sum_bids", "imps", "uniques"]
    assert rows(out, *shown) == rows(batch.where("window_end <= timestamp '2024-01-01 00:00:50'"),
                                     *shown)
    assert continuous.aggregate_rows(batch).columns == [
        "time_stamp", "publisher", "geo", "avg_bid", "imps", "uniques"]


def test_by_timestamp_splits_a_window(spark, landed):
    _, out = finished(spark, continuous.cq_pub_geo(
        replay(spark, landed), "1 second", watermark="0 seconds", by_timestamp=True))
    first = out.where(F.col("window_start") == F.lit(at(0)))
    assert rows(first, "instant", "imps") == [(at(0), 1), (at(0.5), 1), (at(0.9), 1)]


def test_unknown_kind_of_uniques(spark):
    with pytest.raises(ValueError):
        continuous.cq_pub_geo(spark.createDataFrame([], IMPRESSION), uniques="some")


def test_sql_over_a_registered_stream(spark, landed):
    streams.register_stream("ad_stream", replay(spark, landed).withWatermark("time_stamp", "1 hour"))
    assert spark.table("ad_stream").isStreaming
    home = work_dir(spark, "sql")
    continuous.continuous_query(
        spark, "SELECT publisher, bid FROM ad_stream WHERE geo <> 'un'", f"{home}/out",
        f"{home}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{home}/out").count() == 9
    with pytest.raises(ValueError):
        continuous.continuous_query(spark, "SELECT 1 AS x", f"{home}/o", f"{home}/c")
    with pytest.raises(ValueError):
        streams.register_stream("still", spark.range(1))


def test_counting_a_stream(spark, landed):
    continuous.stream_count(replay(spark, landed), "seen",
                            work_dir(spark, "count")).awaitTermination()
    assert spark.table("seen").first().row_count == 10


def test_append_resumes_where_it_stopped(spark, folder):
    home = work_dir(spark, "append")
    for i, values in enumerate(BATCHES):
        land(spark, folder, i, values)
        ingest.ingest_append(replay(spark, folder), f"{home}/t", f"{home}/c",
                             date_of="time_stamp").awaitTermination()
    stored = spark.read.parquet(f"{home}/t")
    assert stored.count() == 10 and rows(stored.select("day").distinct()) == [(T0.date(),)]


SPEC = SampleSpec(("geo",), 0.2, 3, ("cookie",))


def many(start, n):
    return [impression(i, geo="hot" if i % 2 else f"g{i % 10}", cookie=f"k{i}")
            for i in range(start, start + n)]


def test_sample_follows_its_base(spark, folder):
    home, root = work_dir(spark, "check"), work_dir(spark, "tables")
    for i in range(4):
        land(spark, folder, i, many(100 * i, 100))
        ingest.ingest_with_sample(replay(spark, folder), root, SPEC, home).awaitTermination()
        if i == 2:
            assert ingest.merge_batches(spark, root, SPEC) == 1
            assert ingest.merge_batches(spark, root, SPEC) == 1
            assert not path_exists(spark, f"{root}/base/batch_id=0")
        base = ingest.read_base(spark, root)
        assert base.count() == 100 * (i + 1)
        assert rows(ingest.read_sample(spark, root, SPEC)) == rows(stratified_sample(base, SPEC))
    assert ingest.merge_batches(spark, root, SPEC) == 2
    assert ingest.read_base(spark, root).count() == 400


def test_replaying_a_batch_changes_nothing(spark):
    root = work_dir(spark, "tables")
    batches = [spark.createDataFrame(many(100 * i, 100), DDL) for i in range(3)]
    for i in (0, 1, 1, 2, 2):
        ingest.write_batch_with_sample(batches[i], i, root, SPEC)
    base = ingest.read_base(spark, root)
    assert base.count() == 300
    assert rows(ingest.read_sample(spark, root, SPEC)) == rows(stratified_sample(base, SPEC))


def test_uncommitted_batch_is_not_seen(spark):
    root = work_dir(spark, "tables")
    ingest.write_batch_with_sample(spark.createDataFrame(many(0, 50), DDL), 0, root, SPEC)
    spark.createDataFrame(many(50, 50), DDL).write.parquet(f"{root}/base/batch_id=1")
    assert ingest.read_base(spark, root).count() == 50


def test_tables_of_another_checkpoint_are_refused(spark, landed):
    root = work_dir(spark, "tables")
    ingest.write_batch_with_sample(spark.createDataFrame(many(0, 10), DDL), 0, root, SPEC)
    with pytest.raises(ValueError):
        ingest.ingest_with_sample(replay(spark, landed), root, SPEC, work_dir(spark, "fresh"))


def test_kafka_options():
    got = streams.kafka_options("host:9092", "ads", "earliest", 5000, failOnDataLoss="false")
    assert got == {"kafka.bootstrap.servers": "host:9092", "subscribe": "ads",
                   "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5000",
                   "failOnDataLoss": "false"}
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("h", "t")
    with pytest.raises(ValueError):
        streams.kafka_options("h", "t", "middle")


def test_kafka_needs_its_package_only(spark):
    try:
        got = streams.read_impressions(spark, {"brokers": "h:1", "topics": "t"}, "kafka")
    except Exception as fault:
        assert "kafka" in str(fault).lower()
    else:
        assert got.schema == IMPRESSION


def test_print_rows(spark, landed):
    query = continuous.print_rows(replay(spark, landed).select("publisher"),
                                  work_dir(spark, "printed"))
    query.awaitTermination()
    assert query.exception() is None and sum(
        p["numInputRows"] for p in query.recentProgress) == 10


def test_few_files_per_batch(spark, landed):
    home = work_dir(spark, "files")
    rolled = continuous.cq_pub_geo(replay(spark, landed), "1 second", watermark="0 seconds",
                                   uniques="hll")
    continuous.start_append(rolled, f"{home}/out", f"{home}/c", partitions=4,
                            files_per_batch=1).awaitTermination()
    out = spark.read.parquet(f"{home}/out")
    files = out.select(F.input_file_name().alias("f"), "window_start").distinct()
    assert out.count() == 4 and files.select("f").distinct().count() <= 3


def click(second, item, district=1, spent=100):
    return (1, district, 7, item, spent, T0 + dt.timedelta(seconds=second))


def test_click_reports(spark, folder):
    values = [click(1, 5), click(2, 5, 2, 300), click(3, 6), click(4, 7, 1, 200), click(130, 9)]
    spark.createDataFrame(values, CLICK).coalesce(1).write.parquet(folder)
    item = spark.createDataFrame([(5, 60.0), (6, 40.0), (7, 51.0), (9, 99.0)],
                                 "i_id int, i_price double")
    stored = spark.read.schema(CLICK).parquet(folder)
    want = [(at(0), 5, 2), (at(0), 7, 1), (at(120), 9, 1)]
    assert rows(clicks.click_items(stored, item), "window_start", "i_id", "clicks") == want
    assert rows(clicks.top_click_items(stored, item, k=1), "i_id", "place") == [(5, 1), (9, 1)]
    stream = streams.replay_stream(spark, folder, CLICK)
    _, out = finished(spark, clicks.click_items(stream, item, watermark="0 seconds"))
    assert rows(out, "window_start", "i_id", "clicks") == want[:2]
    _, out = finished(spark, clicks.click_districts(stream, watermark="0 seconds"))
    assert rows(out, "cs_c_d_id", "avg_timespent") == [(1, 400 / 3), (2, 300.0)]
    home = work_dir(spark, "reports")
    clicks.click_reports(stream, item, f"{home}/out", f"{home}/c", k=2).awaitTermination()
    assert rows(spark.read.parquet(f"{home}/out/items"), "i_id", "clicks") == [(5, 2), (7, 1)]
    assert spark.read.parquet(f"{home}/out/districts").count() == 2


def test_a_stream_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = continuous.stream_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert own.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_pool_lasts_for_the_block(spark):
    with in_pool(spark, "streams"):
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "streams"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
