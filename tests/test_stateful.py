import datetime as dt
import re
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bidlens.operators import uniques
from bidlens.operators.rollup import resolved
from bidlens.sources import streams
from bidlens.sources.schemas import IMPRESSION
from bidlens.sources.workspace import work_dir
from bidlens.streaming import continuous, stateful
from conftest import rows
from test_streaming import BATCHES, DDL, T0, impression, land, replay

SECOND = dt.timedelta(seconds=1)


@pytest.fixture
def landed(spark, folder):
    for i, values in enumerate(BATCHES):
        land(spark, folder, i, values)
    return folder


def run_late(spark, folder, home, **options):
    out = stateful.windows_with_late_rows(replay(spark, folder), "1 second", "0 seconds", **options)
    continuous.start_append(out, f"{home}/out", f"{home}/checkpoint", partitions=2).awaitTermination()
    return spark.read.parquet(f"{home}/out")


@pytest.mark.parametrize("buckets", [1, 16])
def test_late_rows_are_kept_and_nothing_is_lost(spark, landed, buckets):
    got = run_late(spark, landed, work_dir(spark, "late"), buckets=buckets)
    late = got.where("kind = 'late'").select("window_start", "time_stamp", "cookie", "imps", "sum_bids")
    assert rows(late) == [(T0, T0 + 0.2 * SECOND, "late", 1, 1.0)]
    totals = stateful.window_totals(got.where("kind = 'on time'")).select(
        "window_start", "publisher", "first_seen", "sum_bids", "n_bids", "imps")
    # the window of second 60 is still open
    assert rows(totals) == [(T0, "p1", T0, 4.0, 3, 3), (T0 + 2 * SECOND, "p1", T0 + 2 * SECOND, 1.0, 1, 1),
                            (T0 + 2 * SECOND, "p2", T0 + 2.2 * SECOND, 1.0, 1, 1),
                            (T0 + 5 * SECOND, "p1", T0 + 5 * SECOND, 2.0, 2, 2)]


def test_late_rows_after_a_restart(spark, landed):
    home = work_dir(spark, "late")
    run_late(spark, landed, home)
    land(spark, landed, 10, [impression(59.5, cookie=None, bid=None), impression(60.5, cookie="x"), impression(5.5)])
    land(spark, landed, 11, [impression(90)])
    got = run_late(spark, landed, home)
    assert rows(got.where("kind = 'late'").select("time_stamp", "cookie", "sum_bids", "n_bids")) == sorted([
        (T0 + 0.2 * SECOND, "late", 1.0, 1), (T0 + 5.5 * SECOND, "c1", 1.0, 1), (T0 + 59.5 * SECOND, None, None, 0)],
        key=repr)
    assert got.agg(F.sum("imps")).first()[0] == 13 - 1  # all of a known region but the open window's row
    assert rows(stateful.window_totals(got).where("kind = 'on time' AND imps = 2").select("window_start")) == [
        (T0 + 5 * SECOND,), (T0 + 60 * SECOND,)]


def test_early_uniques_know_open_windows(spark, landed):
    home = work_dir(spark, "early")
    land(spark, landed, 5, [impression(60.2, cookie="c9"), impression(60.3, cookie="c9"), impression(60.4, cookie=None)])
    query = stateful.start_changes(stateful.early_uniques(replay(spark, landed), "1 second", "10 seconds", buckets=4),
                                   f"{home}/changes", f"{home}/checkpoint", partitions=2)
    query.awaitTermination()
    got = stateful.latest_uniques(spark, f"{home}/changes")
    shown = ["window_start", "publisher", "first_seen", "sum_bids", "imps", "uniques"]
    want = [(T0, "p1", T0, 5.0, 4, 3), (T0 + 2 * SECOND, "p1", T0 + 2 * SECOND, 1.0, 1, 1),
            (T0 + 2 * SECOND, "p2", T0 + 2.2 * SECOND, 1.0, 1, 0),
            (T0 + 5 * SECOND, "p1", T0 + 5 * SECOND, 2.0, 2, 1),
            (T0 + 60 * SECOND, "p1", T0 + 60 * SECOND, 4.0, 4, 2)]
    assert rows(got.select(*shown)) == want
    # a batch that is run again replaces its own folder
    again = spark.read.parquet(f"{home}/changes/batch=5")
    kept = again.collect()
    spark.createDataFrame(kept, again.schema).write.mode("overwrite").parquet(f"{home}/changes/batch=5")
    assert rows(stateful.latest_uniques(spark, f"{home}/changes").select(*shown)) == want
    stateful.compact_changes(spark, f"{home}/changes", f"{home}/compact")
    assert rows(stateful.latest_uniques(spark, f"{home}/compact").select(*shown)) == want


def test_early_uniques_are_built_in_operators(spark, landed):
    plan = stateful.early_uniques(replay(spark, landed), "1 second")._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "Deduplicate" in plan and "Aggregate" in plan


def test_a_state_is_a_window_and_a_bucket(spark, landed):
    """And not one per publisher and region, since a call to the state store costs far more than a row."""
    plan = stateful.windows_with_late_rows(replay(spark, landed), "1 second")._jdf.queryExecution().analyzed().toString()
    assert re.search(r"TransformWithStateInPySpark .*\)#\d+, 2, \[", plan)  # grouped by two columns


class _Memory:
    """Handle, value, list and timer of one state, in memory."""

    def __init__(self):
        self.value, self.rows, self.most, self.timers = None, [], 0, []

    def getValueState(self, name, schema):
        return SimpleNamespace(get=lambda: self.value, update=lambda v: setattr(self, "value", v),
                               clear=lambda: setattr(self, "value", None))

    def getListState(self, name, schema):
        return SimpleNamespace(get=lambda: iter(list(self.rows)), put=self.keep,
                               appendList=lambda rows: self.keep(self.rows + rows), clear=lambda: self.keep([]))

    def keep(self, rows):
        self.rows = list(rows)
        self.most = max(self.most, len(rows))

    def registerTimer(self, end):
        self.timers.append(end)


def test_a_state_does_not_grow_with_micro_batches():
    handle, at = _Memory(), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    windows = stateful._Windows(1_000_000, "decimal(28,2)")
    windows.init(handle)
    for n in range(500):
        part = pd.DataFrame({"instant": [500 - n] * 20, "publisher": [f"p{i % 10}" for i in range(20)], "geo": "g",
                             "bid": [None if i < 10 and n % 2 else Decimal("0.01") for i in range(20)], "cookie": "c"})
        assert not list(windows.handleInputRows((0, 3), iter([part]), at) or ())
    assert handle.timers == [1000] and handle.most <= stateful.SLACK + 30
    got = pd.concat(windows.handleExpiredTimer((0, 3), at, None))
    assert sorted(got[["publisher", "instant", "sum_bids", "n_bids", "imps", "kind"]].itertuples(index=False, name=None)) == [
        (f"p{i}", 1, Decimal("7.50"), 750, 1000, "on time") for i in range(10)]
    assert handle.value is None and not handle.rows


def test_windows_need_a_length(spark, landed):
    with pytest.raises(ValueError):
        stateful.windows_with_late_rows(replay(spark, landed), "0 seconds")


def test_panes_give_the_windows_of_rows(spark):
    values = [*sum(BATCHES, []), impression(0.1, "p3", cookie=None, bid=None), impression(1.99, cookie="c2")]
    df = spark.createDataFrame(values, DDL)
    panes = continuous.cq_sliding_panes(df, "3 seconds", "1 second")
    direct = continuous.cq_pub_geo(df, "3 seconds", "1 second", uniques="hll")
    shown = ["window_start", "window_end", "publisher", "geo", "first_seen", "sum_bids", "avg_bid", "imps", "uniques"]
    assert rows(panes.select(*shown)) == rows(direct.select(*shown))
    with pytest.raises(ValueError):
        continuous.cq_sliding_panes(df, "3 seconds", "2 seconds")


def test_panes_repeat_states_and_not_rows(spark):
    df = spark.createDataFrame(sum(BATCHES, []), DDL)
    plan = continuous.cq_sliding_panes(df, "4 seconds", "1 second")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.rsplit("Aggregate", 1)
    assert "Expand" in above and "Expand" not in below and above.count("Aggregate") == 1
    direct = continuous.cq_pub_geo(df, "4 seconds", "1 second", uniques="hll")
    assert "Expand" in direct._jdf.queryExecution().optimizedPlan().toString().rsplit("Aggregate", 1)[1]


def test_panes_as_a_stream(spark, landed):
    home = work_dir(spark, "panes")
    rolled = continuous.cq_sliding_panes(replay(spark, landed), "2 seconds", "1 second", "0 seconds").drop("cookies")
    continuous.start_append(rolled, f"{home}/out", f"{home}/checkpoint", partitions=2).awaitTermination()
    got = spark.read.parquet(f"{home}/out").where("publisher = 'p1'").select("window_start", "imps", "uniques")
    assert rows(got) == [(T0 - SECOND, 3, 2), (T0, 3, 2), (T0 + SECOND, 1, 1), (T0 + 2 * SECOND, 1, 1),
                         (T0 + 4 * SECOND, 2, 1), (T0 + 5 * SECOND, 2, 1)]


def brute(df, *keys):
    return rows(resolved(df).groupBy(*keys).agg(
        F.min("time_stamp"), F.sum("bid").cast("double") / F.count("bid"), F.count("*"), F.count_distinct("cookie")))


def test_bitmaps_merge_to_exact_uniques(spark, data):
    home, df = work_dir(spark, "ids"), data.impressions
    parts = [df.where(f"event_id % 3 = {i}") for i in range(3)]
    for n, part in enumerate(parts):
        ids = uniques.extend_dictionary(spark, f"{home}/ids", part, "cookie", n, buckets=8)
        uniques.exact_partials(resolved(part), ids, [F.date_trunc("hour", "time_stamp").alias("hour"), "geo", "publisher"]
                               ).write.parquet(f"{home}/hours/batch={n}")
    hours = spark.read.parquet(f"{home}/hours")
    by_geo = uniques.merge_exact(uniques.merge_exact(hours, ["geo", "publisher"]), ["geo"])
    assert rows(uniques.finish_exact(by_geo, ["geo"])) == brute(df, "geo")
    assert rows(uniques.finish_exact(uniques.merge_exact(by_geo, []), [])) == brute(df)


def test_ids_stay_and_are_dense(spark):
    path = work_dir(spark, "ids")
    one = spark.createDataFrame([(f"v{i % 400}",) for i in range(500)] + [(None,)], "cookie string")
    two = spark.createDataFrame([(f"v{i}",) for i in range(300, 900)], "cookie string")
    first = {r.value: r.id for r in uniques.extend_dictionary(spark, path, one, "cookie", 0, 4).collect()}
    second = {r.value: r.id for r in uniques.extend_dictionary(spark, path, two, "cookie", 1, 4).collect()}
    again = {r.value: r.id for r in uniques.extend_dictionary(spark, path, two, "cookie", 1, 4).collect()}
    assert len(first) == 400 and len(set(second.values())) == len(second) == 900 and again == second
    assert all(second[v] == i for v, i in first.items()) and max(second.values()) < 1.3 * 900
    with pytest.raises(ValueError):
        uniques.extend_dictionary(spark, path, two, "cookie", 2, 5)


def test_exact_partials_of_nulls_unknown_values_and_no_rows(spark):
    path = work_dir(spark, "ids")
    df = spark.createDataFrame([impression(0, cookie=None), impression(1), impression(1, bid=None)], DDL)
    ids = uniques.extend_dictionary(spark, path, df, "cookie", 0)
    done = uniques.finish_exact(uniques.exact_partials(df, ids, ["geo"]), ["geo"])
    assert rows(done) == [("NJ", T0, 1.0, 3, 1)]
    other = spark.createDataFrame([impression(0, cookie="unseen")], DDL)
    with pytest.raises(Exception, match="no id in the dictionary"):
        uniques.exact_partials(other, ids, ["geo"]).collect()
    assert uniques.exact_partials(df.limit(0), ids, ["geo"]).count() == 0
