"""The registered queries, over the given test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.operators import approx, catalog, replicates, rollup, sampling, snapshot, storage, uniques
from bidlens.plans import ads, clicks, mixed
from bidlens.sources import payloads, segments, streams, tables
from bidlens.sources.schemas import CLICK, IMPRESSION_MESSAGE
from bidlens.sources.workspace import work_dir
from bidlens.streaming import continuous, ingest, stateful
from fixtures.encode import as_messages, payloads as encoded, write_segments
from fixtures.oracle import (
    AGG, ad_oracles, aggregate_sample_oracle, ch_oracles, click_oracles, estimate_oracle, sample_oracle, share_oracle, stepped_oracle,
    window_oracle,
)
from fixtures.views import VIEWS, Data, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {**ad_oracles(), **ch_oracles(), **click_oracles()}

STATE_PARTITIONS = 8
NO_DELAY = "0 seconds"  # the given events are in order
BY_GEO = sampling.SampleSpec(("geo",), 0.03, 50, ("event_id",), portable=True)
BY_GEO_PUBLISHER = sampling.SampleSpec(("geo", "publisher"), 0.02, 50, ("event_id",),
                                       portable=True)
IMPRESSION_COLUMNS = ["time_stamp", "publisher", "advertiser", "website", "geo", "bid", "cookie"]
DAY = "1998-01-02"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, as the checks compare them."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def register(name: str, oracle: str | None = None):
    def keep(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(build(Data(spark, sf_dir)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return keep


# --- reports on impressions --------------------------------------------------

def _hourly(d: Data) -> DataFrame:
    return rollup.aggregate_table(d.impressions, "1 hour")


register("ad_1_count_by_geo")(lambda d: ads.count_by_geo(d.impressions))
register("ad_2_bid_by_geo")(lambda d: ads.bid_sum_by(d.impressions, "geo"))
register("ad_3_bid_by_publisher")(lambda d: ads.bid_sum_by(d.impressions, "publisher"))
register("ad_4_count")(lambda d: ads.impression_count(d.impressions))
register("ad_5_aggregate_by_geo")(lambda d: ads.count_by_geo(_hourly(d)))
register("ad_6_uniques_by_geo")(lambda d: ads.uniques_by_geo(_hourly(d)))
register("ad_7_advertiser_uniques")(
    lambda d: ads.advertiser_uniques(d.impressions, "advertiser11"))
register("ad_8_impression_trend")(lambda d: ads.impression_trend(d.impressions))
register("ad_9_top_ads_per_geo")(lambda d: ads.top_ads_per_geo(d.impressions))


@register("ad_6_people_by_geo")
def _people(d: Data) -> DataFrame:
    states = rollup.partial_state(rollup.resolved(d.impressions),
                                  [rollup.window_of("1 hour"), *rollup.PUB_GEO])
    return ads.people_by_geo(states)


@register("aggregate_table", with_views(
    "SELECT time_stamp, publisher, geo, avg_bid, imps, uniques FROM agg", "impressions",
    extra=AGG))
def _aggregate(d: Data) -> DataFrame:
    return _hourly(d)


@register("merge_partials", with_views(
    "SELECT geo, min(time_stamp) AS first_seen, cast(sum(bid) AS double) / count(*) AS avg_bid, "
    "count(*) AS imps, count(DISTINCT cookie) AS uniques FROM impressions "
    "WHERE geo <> 'un' GROUP BY geo", "impressions"))
def _merge(d: Data) -> DataFrame:
    rows = rollup.resolved(d.impressions)
    states = rollup.partial_state(rows, [rollup.window_of("1 hour"), *rollup.PUB_GEO])
    by_publisher = rollup.merge_partials(states, ["publisher", "geo"])
    return rollup.finish_partials(rollup.merge_partials(by_publisher, ["geo"]))


@register("cq_pub_geo", window_oracle("1 HOUR", "publisher, geo"))
def _cq(d: Data) -> DataFrame:
    return continuous.cq_pub_geo(d.impressions, "1 hour")


@register("cq_pub_geo_ts", window_oracle("1 HOUR", "publisher, geo", instant=True))
def _cq_ts(d: Data) -> DataFrame:
    return continuous.cq_pub_geo(d.impressions, "1 hour", by_timestamp=True)


@register("cq_pub_geo_hll", window_oracle("2 HOUR", "publisher, geo", slide="1 HOUR"))
def _cq_hll(d: Data) -> DataFrame:
    rolled = continuous.cq_pub_geo(d.impressions, "2 hours", "1 hour", uniques="hll")
    return rolled.drop("cookies")


# --- streams -----------------------------------------------------------------

def _event_stream(d: Data) -> DataFrame:
    """Impressions as a stream that replays the events in order of time, one file per trigger."""
    raw = streams.replay_stream(d.spark, d.event_files(), d["events"].schema, files_per_trigger=1)
    return _zoned(d.spark.sql(VIEWS["impressions"], events=raw))


def _zoned(df: DataFrame) -> DataFrame:
    return df.withColumn("time_stamp", F.col("time_stamp").cast("timestamp"))


def _finish(d: Data, query, path: str) -> DataFrame:
    query.awaitTermination()
    return d.spark.read.parquet(path)


def _streamed(d: Data, label: str, result: DataFrame) -> DataFrame:
    home = work_dir(d.spark, label)
    query = continuous.start_append(result, f"{home}/out", f"{home}/checkpoint",
                                    partitions=STATE_PARTITIONS)
    return _finish(d, query, f"{home}/out")


@register("cq_exact_uniques", window_oracle("1 HOUR", "publisher, geo", closed=True))
def _cq_stream(d: Data) -> DataFrame:
    return _streamed(d, "cq-exact", continuous.cq_pub_geo(
        _event_stream(d), "1 hour", watermark=NO_DELAY))


@register("cq_exact_uniques_ts", window_oracle("1 HOUR", "publisher, geo", closed=True,
                                               instant=True))
def _cq_stream_ts(d: Data) -> DataFrame:
    return _streamed(d, "cq-exact-ts", continuous.cq_pub_geo(
        _event_stream(d), "1 hour", watermark=NO_DELAY, by_timestamp=True))


@register("cq_stream_hll", window_oracle("2 HOUR", "publisher, geo", closed=True,
                                         slide="1 HOUR"))
def _cq_stream_hll(d: Data) -> DataFrame:
    rolled = continuous.cq_pub_geo(_event_stream(d), "2 hours", "1 hour", NO_DELAY,
                                   uniques="hll")
    return _streamed(d, "cq-hll", rolled.drop("cookies"))


@register("cq_sliding_panes", window_oracle("2 HOUR", "publisher, geo", slide="1 HOUR"))
def _cq_panes(d: Data) -> DataFrame:
    return continuous.cq_sliding_panes(d.impressions, "2 hours", "1 hour").drop("cookies")


@register("cq_stream_panes", window_oracle("2 HOUR", "publisher, geo", closed=True, slide="1 HOUR"))
def _cq_stream_panes(d: Data) -> DataFrame:
    rolled = continuous.cq_sliding_panes(_event_stream(d), "2 hours", "1 hour", NO_DELAY)
    return _streamed(d, "cq-panes", rolled.drop("cookies"))


@register("cq_exact_uniques_update", window_oracle("1 HOUR", "publisher, geo"))
def _cq_update(d: Data) -> DataFrame:
    own = Data(continuous.stream_session(d.spark, STATE_PARTITIONS), d.sf_dir)
    home = work_dir(own.spark, "cq-update")
    stateful.start_changes(stateful.early_uniques(_event_stream(own), "1 hour", NO_DELAY), f"{home}/changes",
                           f"{home}/checkpoint", partitions=STATE_PARTITIONS).awaitTermination()
    return stateful.latest_uniques(own.spark, f"{home}/changes")


# A tenth of the events comes two of the five deliveries too late.
DELIVERED = """least(4, cast(floor(5.0 * (event_id - first_id) / (last_id - first_id + 1)) AS int))"""
DELIVERED = f"CASE WHEN event_id % 10 = 0 AND {DELIVERED} < 3 THEN {DELIVERED} + 2 ELSE {DELIVERED} END"


@register("stream_late_rows", with_views(
    "SELECT kind, window_start, window_start + INTERVAL 1 HOUR AS window_end, publisher, geo, "
    "min(time_stamp) AS first_seen, cast(sum(bid) AS double) AS sum_bids, count(bid) AS n_bids, count(*) AS imps FROM j "
    "WHERE kind = 'late' OR window_start + INTERVAL 1 HOUR <= (SELECT max(time_stamp) FROM w) GROUP BY ALL",
    "impressions", extra=f"""w AS (
        SELECT *, time_bucket(INTERVAL 1 HOUR, time_stamp) AS window_start, {DELIVERED} AS delivery
        FROM impressions, (SELECT min(event_id) AS first_id, max(event_id) AS last_id FROM events) WHERE geo <> 'un'),
    m AS (SELECT delivery, date_trunc('milliseconds', max(max(time_stamp)) OVER (
              ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS reached FROM w GROUP BY delivery),
    j AS (SELECT w.*, CASE WHEN window_start + INTERVAL 1 HOUR <= reached THEN 'late' ELSE 'on time' END AS kind
          FROM w JOIN m USING (delivery))"""))
def _late_rows(d: Data) -> DataFrame:
    own = Data(continuous.stream_session(d.spark, STATE_PARTITIONS), d.sf_dir)
    home, rows = work_dir(own.spark, "late-rows"), _zoned(own.impressions)
    bounds = rows.agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    dealt = rows.crossJoin(F.broadcast(bounds)).withColumn("delivery", F.expr(DELIVERED)).drop("first_id", "last_id")
    for n in range(5):  # one delivery after another, each read by a stream that starts where the last one ended
        dealt.where(F.col("delivery") == n).drop("delivery").write.mode("append").parquet(f"{home}/landed")
        landed = streams.replay_stream(own.spark, f"{home}/landed", rows.schema)
        continuous.start_append(
            stateful.windows_with_late_rows(landed, "1 hour", NO_DELAY), f"{home}/out", f"{home}/checkpoint",
            partitions=STATE_PARTITIONS).awaitTermination()
    return stateful.window_totals(own.spark.read.parquet(f"{home}/out"))


LEVELS = "SELECT *, time_bucket(INTERVAL 1 DAY, time_stamp) AS day FROM impressions WHERE geo <> 'un'"


@register("merge_exact_partials", with_views(
    "SELECT CASE WHEN grouping(day) = 0 THEN 'day' WHEN grouping(geo) = 0 THEN 'geo' ELSE 'whole' END AS level, "
    "day, geo, min(time_stamp) AS first_seen, cast(sum(bid) AS double) / count(bid) AS avg_bid, count(*) AS imps, "
    "count(DISTINCT cookie) AS uniques FROM w GROUP BY GROUPING SETS ((day, geo), (geo), ())", "impressions",
    extra=f"w AS ({LEVELS})"))
def _merge_exact(d: Data) -> DataFrame:
    home, rows = work_dir(d.spark, "exact-partials"), rollup.resolved(_zoned(d.impressions))
    half = rows.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    for n, part in enumerate((rows.where(F.col("event_id") < half), rows.where(F.col("event_id") >= half))):
        ids = uniques.extend_dictionary(d.spark, f"{home}/ids", part, "cookie", n)
        uniques.exact_partials(part, ids, [rollup.window_of("1 hour"), *rollup.PUB_GEO]).write.mode(
            "overwrite").parquet(f"{home}/hours/batch={n}")
    hours = d.spark.read.parquet(f"{home}/hours")
    days = uniques.merge_exact(hours, [F.date_trunc("day", "window.start").alias("day"), "geo"])
    geos = uniques.merge_exact(days, ["geo"])
    whole, none = uniques.merge_exact(geos, []), F.lit(None)
    parts = [("day", uniques.finish_exact(days, ["day", "geo"])),
             ("geo", uniques.finish_exact(geos, [none.cast("timestamp").alias("day"), "geo"])),
             ("whole", uniques.finish_exact(whole, [none.cast("timestamp").alias("day"), none.cast("string").alias("geo")]))]
    out = [df.select(F.lit(level).alias("level"), *df.columns) for level, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("continuous_query", with_views(
    "SELECT window_start, publisher, geo, min(time_stamp) AS time_stamp, "
    "cast(sum(bid) AS double) / count(bid) AS avg_bid, count(*) AS imps FROM w "
    "WHERE geo <> 'un' GROUP BY window_start, publisher, geo "
    "HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(time_stamp) FROM impressions)",
    "impressions",
    extra="w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, time_stamp) AS window_start "
          "FROM impressions)"))
def _cq_sql(d: Data) -> DataFrame:
    name = f"impression_stream_{uuid.uuid4().hex}"
    streams.register_stream(name, _event_stream(d).withWatermark("time_stamp", NO_DELAY))
    home = work_dir(d.spark, "cq-sql")
    query = continuous.continuous_query(
        d.spark,
        f"""SELECT window.start AS window_start, publisher, geo, min(time_stamp) AS time_stamp,
                   cast(sum(bid) AS double) / count(bid) AS avg_bid, count(*) AS imps
            FROM {name} WHERE geo <> 'un'
            GROUP BY window(time_stamp, '1 hour'), publisher, geo""",
        f"{home}/out", f"{home}/checkpoint", partitions=STATE_PARTITIONS)
    return _finish(d, query, f"{home}/out")


@register("stream_count", with_views("SELECT count(*) AS row_count FROM impressions",
                                     "impressions"))
def _stream_count(d: Data) -> DataFrame:
    name = f"stream_count_{uuid.uuid4().hex}"
    continuous.stream_count(_event_stream(d), name,
                            f"{work_dir(d.spark, 'stream-count')}/checkpoint").awaitTermination()
    return d.spark.table(name)


IMPRESSION_ROWS = with_views(
    "SELECT time_stamp, publisher, advertiser, website, geo, cast(bid AS double) AS bid, cookie "
    "FROM impressions", "impressions")
MILLI_ROWS = IMPRESSION_ROWS.replace(
    "SELECT time_stamp,", "SELECT date_trunc('milliseconds', time_stamp)::timestamp "
    "AS time_stamp,")


@register("ingest_append", IMPRESSION_ROWS)
def _ingest(d: Data) -> DataFrame:
    home = work_dir(d.spark, "ingest")
    query = ingest.ingest_append(_event_stream(d).select(*IMPRESSION_COLUMNS), f"{home}/table",
                                 f"{home}/checkpoint", date_of="time_stamp")
    return _finish(d, query, f"{home}/table").drop("day")


def _staged(d: Data, files: int = 4) -> str:
    """Impressions as a stored table of several files, to be replayed in batches."""
    path = work_dir(d.spark, "staged")
    _zoned(d.impressions).repartition(files).write.parquet(path)
    return path


@register("replay_stream", IMPRESSION_ROWS)
def _replay(d: Data) -> DataFrame:
    path, home = _staged(d), work_dir(d.spark, "replay")
    schema = d.spark.read.parquet(path).schema
    rows = streams.replay_stream(d.spark, path, schema, files_per_trigger=1)
    query = ingest.ingest_append(rows.select(*IMPRESSION_COLUMNS), f"{home}/table",
                                 f"{home}/checkpoint")
    return _finish(d, query, f"{home}/table")


SAMPLE_SHOWN = ["event_id", "geo", "sample_rate", "sample_weight"]
SAMPLE_ROWS = ("SELECT event_id, geo, sample_rate, sample_weight FROM sample")


@register("ingest_with_sample", sample_oracle(SAMPLE_ROWS))
def _ingest_sample(d: Data) -> DataFrame:
    path, home = _staged(d), work_dir(d.spark, "with-sample")
    rows = streams.replay_stream(d.spark, path, d.spark.read.parquet(path).schema, 2)
    ingest.ingest_with_sample(rows, f"{home}/tables", BY_GEO,
                              f"{home}/checkpoint").awaitTermination()
    return ingest.read_sample(d.spark, f"{home}/tables", BY_GEO).select(*SAMPLE_SHOWN)


@register("ingest_with_sample_base", IMPRESSION_ROWS)
def _ingest_sample_base(d: Data) -> DataFrame:
    path, home = _staged(d), work_dir(d.spark, "with-sample")
    rows = streams.replay_stream(d.spark, path, d.spark.read.parquet(path).schema, 2)
    ingest.ingest_with_sample(rows, f"{home}/tables", BY_GEO_PUBLISHER,
                              f"{home}/checkpoint").awaitTermination()
    return ingest.read_base(d.spark, f"{home}/tables").select(*IMPRESSION_COLUMNS)


# --- sources -----------------------------------------------------------------

def _csv_files(d: Data) -> str:
    path = work_dir(d.spark, "csv")
    as_messages(d.impressions).repartition(8).write.csv(path)
    return path


@register("csv_ingest", MILLI_ROWS)
def _csv(d: Data) -> DataFrame:
    return tables.csv_ingest(d.spark, _csv_files(d))


@register("csv_stream_ingest", MILLI_ROWS)
def _csv_stream(d: Data) -> DataFrame:
    home = work_dir(d.spark, "csv-stream")
    query = ingest.ingest_append(streams.csv_stream(d.spark, _csv_files(d), 4), f"{home}/table",
                                 f"{home}/checkpoint")
    return _finish(d, query, f"{home}/table")


@register("decode_payloads", MILLI_ROWS)
def _decode(d: Data) -> DataFrame:
    good, _ = payloads.split_rejects(payloads.decode_payloads(
        encoded(d.impressions), "payload", IMPRESSION_MESSAGE))
    return payloads.to_impressions(good)


@register("decode_concatenated", MILLI_ROWS)
def _decode_many(d: Data) -> DataFrame:
    good, _ = payloads.split_rejects(payloads.decode_payloads(
        encoded(d.impressions, 100), "payload", IMPRESSION_MESSAGE, concatenated=True))
    return payloads.to_impressions(good)


@register("read_impressions_landed", MILLI_ROWS)
def _landed(d: Data) -> DataFrame:
    path, home = work_dir(d.spark, "landed"), work_dir(d.spark, "landed-out")
    encoded(d.impressions).write.parquet(path)
    rows = streams.read_impressions(d.spark, path, "landed", max_per_trigger=4)
    query = ingest.ingest_append(rows, f"{home}/table", f"{home}/checkpoint")
    return _finish(d, query, f"{home}/table")


@register("read_impressions_rejects", with_views(
    "SELECT geo, count(*) AS n, cast(0 AS bigint) AS rejected FROM impressions GROUP BY geo "
    "UNION ALL SELECT NULL, count(*), count(*) FROM impressions", "impressions"))
def _rejects(d: Data) -> DataFrame:
    """Every payload once as it is and once without its last byte, which none can do without."""
    path, home = work_dir(d.spark, "landed"), work_dir(d.spark, "landed-out")
    good = encoded(d.impressions)
    cut = good.select(F.expr("substring(payload, 1, length(payload) - 1)").alias("payload"))
    good.select("payload").unionByName(cut).write.parquet(path)
    rows = streams.read_impressions(d.spark, path, "landed", max_per_trigger=4, rejects="keep")
    query = ingest.ingest_append(rows, f"{home}/table", f"{home}/checkpoint")
    return _finish(d, query, f"{home}/table").groupBy("geo").agg(
        F.count(F.lit(1)).alias("n"), F.count("decode_error").alias("rejected"))


QUEUE_PARTITIONS = 4


def _queue(d: Data, per_segment: int) -> tuple[str, int]:
    """The impressions in indexed segments of a queue, and the records of its largest partition."""
    folder = work_dir(d.spark, "queue")
    write_segments(d.impressions, folder, QUEUE_PARTITIONS, per_segment)
    segments.index_segments(d.spark, folder, range_bytes=1 << 16)
    most = d.impressions.groupBy(F.pmod("event_id", F.lit(QUEUE_PARTITIONS))).count().agg(F.max("count")).first()[0]
    return folder, most or 0


@register("decode_segments_split", MILLI_ROWS)
def _split(d: Data) -> DataFrame:
    """A segment per queue partition, each read by several tasks."""
    folder, _ = _queue(d, 1 << 62)
    good, _ = payloads.split_rejects(segments.decode_segments(d.spark, folder, task_bytes=1 << 18))
    return payloads.to_impressions(good)


@register("read_queue_segments", MILLI_ROWS)
def _read_queue(d: Data) -> DataFrame:
    """Three segments a partition, taken in four or five batches that do not end where segments do."""
    size = d.impressions.count() // (3 * QUEUE_PARTITIONS) + 1
    folder, most = _queue(d, size)
    home = work_dir(d.spark, "queue-out")
    rows = streams.read_impressions(d.spark, {"path": folder, "progress": f"{home}/progress"}, "queue",
                                    max_per_trigger=most // 4 + 1)
    query = ingest.ingest_append(rows, f"{home}/table", f"{home}/checkpoint", {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return d.spark.read.parquet(f"{home}/table")


@register("read_table", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _read_table(d: Data) -> DataFrame:
    rows = tables.read_table(d.spark, f"{d.sf_dir}/events.parquet", "parquet")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- sinks -------------------------------------------------------------------

@register("create_column_table", IMPRESSION_ROWS)
def _column_table(d: Data) -> DataFrame:
    name = f"ad_impressions_{uuid.uuid4().hex}"
    rows = _zoned(d.impressions).select(*IMPRESSION_COLUMNS)
    storage.drop_table(d.spark, name)
    storage.create_column_table(d.spark, name, rows.schema, bucket_key="cookie", buckets=11,
                                location=work_dir(d.spark, "column-table"))
    storage.append_by_name(rows, name)
    return d.spark.table(name)


@register("clustered_append", IMPRESSION_ROWS)
def _clustered(d: Data) -> DataFrame:
    path = work_dir(d.spark, "clustered")
    rows = d.impressions.select(*IMPRESSION_COLUMNS)
    storage.clustered_append(rows, path, "time_stamp", target=rows.schema)
    return d.spark.read.parquet(path)


UPSERT_KEYS, UPSERT_ORDER = ["hour", "cookie"], ["time_stamp", "bid", "event_id"]
UPSERT_SHOWN = ["hour", "cookie", "time_stamp", "bid", "event_id"]
LATEST = with_views(
    "SELECT hour, cookie, time_stamp, cast(bid AS double) AS bid, event_id FROM ("
    "SELECT *, row_number() OVER (PARTITION BY hour, cookie "
    "ORDER BY time_stamp DESC, bid DESC, event_id DESC) AS place FROM ("
    "SELECT *, time_bucket(INTERVAL 1 HOUR, time_stamp) AS hour FROM impressions)) "
    "WHERE place = 1", "impressions")


def _keyed_halves(d: Data) -> tuple[DataFrame, DataFrame]:
    """A stored table from the first half of each hour, and updates from the second."""
    keyed = d.impressions.withColumn("hour", F.date_trunc("hour", "time_stamp")).select(
        *UPSERT_SHOWN)
    early = F.minute("time_stamp") < 30
    first = storage.latest_per_key(keyed.where(early), UPSERT_KEYS, UPSERT_ORDER)
    return first, keyed.where(~early)


@register("upsert_latest", LATEST)
def _upsert(d: Data) -> DataFrame:
    return storage.upsert_latest(*_keyed_halves(d), UPSERT_KEYS, UPSERT_ORDER)


@register("upsert_partitioned", LATEST)
def _upsert_stored(d: Data) -> DataFrame:
    path = work_dir(d.spark, "upsert")
    target, updates = (df.withColumn("day", F.to_date("hour")) for df in _keyed_halves(d))
    target.write.partitionBy("day").parquet(path)
    storage.upsert_partitioned(d.spark, path, updates, UPSERT_KEYS, UPSERT_ORDER, "day")
    return d.spark.read.parquet(path).drop("day")


@register("ingest_upsert", LATEST)
def _ingest_upsert(d: Data) -> DataFrame:
    path, home = _staged(d), work_dir(d.spark, "ingest-upsert")
    rows = streams.replay_stream(d.spark, path, d.spark.read.parquet(path).schema, 2)
    rows = (rows.withColumn("hour", F.date_trunc("hour", "time_stamp")).select(*UPSERT_SHOWN)
            .withColumn("day", F.to_date("hour")))
    ingest.ingest_upsert(rows, f"{home}/table", UPSERT_KEYS, UPSERT_ORDER, "day",
                         f"{home}/checkpoint").awaitTermination()
    return d.spark.read.parquet(f"{home}/table").drop("day")


@register("retain_window", with_views(
    "SELECT time_stamp, publisher, cookie FROM impressions WHERE cast(time_stamp AS date) > "
    "(SELECT max(cast(time_stamp AS date)) FROM impressions) - 7", "impressions"))
def _retain(d: Data) -> DataFrame:
    path = work_dir(d.spark, "retain")
    (d.impressions.select("time_stamp", "publisher", "cookie",
                          F.to_date("time_stamp").alias("day"))
     .write.partitionBy("day").parquet(path))
    today = d.impressions.agg(F.to_date(F.max("time_stamp"))).first()[0]
    storage.retain_window(d.spark, path, "day", 7, today)
    return d.spark.read.parquet(path).drop("day")


# --- samples and estimates ---------------------------------------------------

@register("stratified_sample", sample_oracle(SAMPLE_ROWS))
def _sample(d: Data) -> DataFrame:
    return sampling.stratified_sample(d.impressions, BY_GEO).select(*SAMPLE_SHOWN)


@register("stratified_sample_geo_publisher",
          sample_oracle(SAMPLE_ROWS, "geo, publisher", 0.02, 50))
def _sample_two(d: Data) -> DataFrame:
    return sampling.stratified_sample(d.impressions, BY_GEO_PUBLISHER).select(*SAMPLE_SHOWN)


@register("stratified_sample_floor", sample_oracle(
    "SELECT event_id, geo FROM (SELECT u.*, row_number() OVER (PARTITION BY u.geo "
    "ORDER BY sample_u, event_id) AS place, ceil(sample_rate * stratum_rows) AS wanted "
    "FROM units u JOIN rated USING (geo)) WHERE place <= wanted"))
def _floor(d: Data) -> DataFrame:
    return sampling.floor_sample(d.impressions, BY_GEO).select("event_id", "geo")


@register("sample_maintain", sample_oracle(SAMPLE_ROWS))
def _maintain(d: Data) -> DataFrame:
    split = "timestamp_ntz '2024-01-15'"
    old = d.impressions.where(f"time_stamp < {split}")
    new = d.impressions.where(f"time_stamp >= {split}")
    counts = sampling.strata_counts(old, BY_GEO.qcs)
    kept = sampling.stratified_sample(old, BY_GEO, counts)
    sample, _ = sampling.sample_maintain(kept, counts, new, BY_GEO)
    return sample.select(*SAMPLE_SHOWN)


def _estimate(sample: DataFrame, group: list[str], name: str, spec: tuple, error: float,
              where: str | None = None) -> DataFrame:
    if where:
        sample = sample.where(where)
    got = approx.approx_aggregate(sample, group, {name: spec}, error=error)
    got = got.select(*group, F.round(name, 6).alias(name),
                     F.round(f"{name}_error", 6).alias(f"{name}_error"), "sample_rows")
    return got.orderBy(F.desc(name), *group).limit(20) if group else got


def _estimated(entry: str, group: str | None, name: str, spec: tuple, error: float,
               where: str | None = None) -> None:
    y = "1" if len(spec) == 1 else f"{spec[1]}::double"
    text = sample_oracle(estimate_oracle(group or "", y, name, f"WHERE {where}" if where else ""))
    register(entry, text)(lambda d: _estimate(
        sampling.stratified_sample(d.impressions, BY_GEO), [group] if group else [], name, spec,
        error, where))


_estimated("aqp_count_by_geo", "geo", "ad_count", ("count",), 0.5)
_estimated("aqp_sum_by_geo", "geo", "sum_bid", ("sum", "bid"), 0.5)
_estimated("aqp_sum_by_pub", "publisher", "sum_bid", ("sum", "bid"), 0.9)
_estimated("aqp_count", None, "sample_cnt", ("count",), 0.1)
_estimated("aqp_sum_filtered", "geo", "sum_bid", ("sum", "bid"), 3.0,
           "publisher = 'publisher11'")


OF_AGGREGATE = sampling.SampleSpec(("geo",), 0.03, 50, ("micros", "publisher", "geo"),
                                   portable=True)


def _aggregate_sample(d: Data) -> DataFrame:
    micros = F.unix_micros(F.col("time_stamp").cast("timestamp"))
    return sampling.stratified_sample(_hourly(d).withColumn("micros", micros), OF_AGGREGATE)


@register("aqp_aggregate_count", aggregate_sample_oracle(estimate_oracle("geo", "1", "ad_count")))
def _aggregate_count(d: Data) -> DataFrame:
    return _estimate(_aggregate_sample(d), ["geo"], "ad_count", ("count",), 0.5)


@register("aqp_aggregate_uniques", aggregate_sample_oracle(estimate_oracle(
    "geo", "uniques", "total_uniques", "WHERE publisher = 'publisher11'")))
def _aggregate_uniques(d: Data) -> DataFrame:
    return _estimate(_aggregate_sample(d), ["geo"], "total_uniques", ("sum", "uniques"), 3.0,
                     "publisher = 'publisher11'")


@register("aqp_avg_by_geo", sample_oracle(
    "SELECT geo, round(sum(sample_weight * bid::double) / sum(sample_weight), 9) AS avg_bid, "
    "count(*) AS sample_rows FROM sample GROUP BY geo"))
def _avg(d: Data) -> DataFrame:
    sample = sampling.stratified_sample(d.impressions, BY_GEO)
    got = approx.approx_aggregate(sample, ["geo"], {"avg_bid": ("avg", "bid")}, error=0.5)
    return got.select("geo", F.round("avg_bid", 9).alias("avg_bid"), "sample_rows")


@register("aqp_share_by_geo", sample_oracle(share_oracle("publisher = 'publisher11'", 64)))
def _share(d: Data) -> DataFrame:
    totals = {"part": F.when(F.col("publisher") == "publisher11", F.col("bid")), "whole": F.col("bid")}
    got = replicates.replicate_aggregate(
        sampling.stratified_sample(d.impressions, BY_GEO), ["geo"], totals,
        {"share": lambda t: F.try_divide(t["part"], t["whole"])}, ["event_id"])
    shown = [F.round(c, 6).alias(c) for c in ("share", "share_error")]
    return got.where("share > 0").select("geo", *shown, "sample_rows")


@register("aqp_exact_fallback", with_views(
    "SELECT geo, count(*)::double AS ad_count, 0.0::double AS ad_count_error "
    "FROM impressions GROUP BY geo", "impressions"))
def _fallback(d: Data) -> DataFrame:
    sample = sampling.stratified_sample(d.impressions, BY_GEO)
    got = approx.approx_aggregate(sample, ["geo"], {"ad_count": ("count",)}, error=1e-6,
                                  on_violation="exact", base=d.impressions)
    return got.drop("sample_rows")


# Samples stored once per application and table, addressed by the name of the base. The limits are those that
# the original reports ask for.
GEO_STEPS = [("geo_3", 0.03, 50), ("geo_50", 0.5, 100)]
PUBLISHER_STEPS = [("publisher_3", 0.03, 50)]
_catalogs: dict[tuple[str, str], tuple[str, list]] = {}


def _catalog(d: Data) -> tuple[str, list]:
    key = (d.spark.sparkContext.applicationId, d.sf_dir)
    if key not in _catalogs:
        root = work_dir(d.spark, "catalog")
        for column, steps in (("geo", GEO_STEPS), ("publisher", PUBLISHER_STEPS)):
            for name, fraction, least in steps:
                catalog.add_sample(d.impressions, root, "impressions", name, sampling.SampleSpec(
                    (column,), fraction, least, ("event_id",), portable=True))
        _catalogs[key] = root, catalog.samples_of(d.spark, root, "impressions")
    return _catalogs[key]


def _by_name(entry: str, group: str | None, name: str, spec: tuple, limit: float, oracle: str) -> None:
    def build(d: Data) -> DataFrame:
        keys = [group] if group else []
        root, samples = _catalog(d)
        got = catalog.answer(d.spark, root, "impressions", keys, {name: spec}, limit,
                             base=d.impressions, on_violation="exact", samples=samples)
        got = got.select(*keys, F.round(name, 6).alias(name), F.round(f"{name}_error", 6).alias(f"{name}_error"),
                         "sample_rows", *(["answered_by"] if keys else []))
        return got.orderBy(F.desc(name), *keys).limit(20) if keys else got

    register(entry, oracle)(build)


_by_name("aqp_named_count_by_geo", "geo", "ad_count", ("count",), 0.1, with_views(
    "SELECT geo, count(*)::double AS ad_count, 0.0::double AS ad_count_error, NULL::bigint AS sample_rows, "
    "'strata of geo_3' AS answered_by FROM impressions GROUP BY geo ORDER BY ad_count DESC, geo LIMIT 20", "impressions"))
_by_name("aqp_named_sum_by_geo", "geo", "sum_bid", ("sum", "bid"), 0.1,
         stepped_oracle("geo", "bid::double", "sum_bid", 0.1, GEO_STEPS, "geo"))
_by_name("aqp_named_count", None, "sample_cnt", ("count",), 0.1, with_views(
    "SELECT count(*)::double AS sample_cnt, 0.0::double AS sample_cnt_error, NULL::bigint AS sample_rows "
    "FROM impressions", "impressions"))
_by_name("aqp_named_sum_by_pub", "publisher", "sum_bid", ("sum", "bid"), 0.5,
         stepped_oracle("publisher", "bid::double", "sum_bid", 0.5, PUBLISHER_STEPS, "publisher"))


@register("ingest_floor_sample", ORACLES["stratified_sample_floor"])
def _ingest_floor(d: Data) -> DataFrame:
    path, home = _staged(d), work_dir(d.spark, "floor-sample")
    rows = streams.replay_stream(d.spark, path, d.spark.read.parquet(path).schema, 1)
    ingest.ingest_with_sample(rows, f"{home}/tables", sampling.reserve_of(BY_GEO),
                              f"{home}/checkpoint").awaitTermination()
    return ingest.read_floor_sample(d.spark, f"{home}/tables", BY_GEO).select("event_id", "geo")


@register("aqp_count_from_strata", with_views(
    "SELECT geo, cast(count(*) AS bigint) AS rows FROM impressions GROUP BY geo", "impressions"))
def _strata(d: Data) -> DataFrame:
    counts = sampling.strata_counts(d.impressions, BY_GEO_PUBLISHER.qcs)
    return approx.count_from_strata(counts, ["geo"])


@register("sample_scan", sample_oracle(
    "SELECT geo, count(*) AS n FROM sample WHERE publisher = 'publisher11' GROUP BY geo"))
def _scan(d: Data) -> DataFrame:
    sample = sampling.stratified_sample(d.impressions, BY_GEO)
    return (sample.where("publisher = 'publisher11'").groupBy("geo")
            .agg(F.count(F.lit(1)).alias("n")))


@register("sample_count", sample_oracle("SELECT count(*) AS sample_cnt FROM sample"))
def _sample_count(d: Data) -> DataFrame:
    sample = sampling.stratified_sample(d.impressions, BY_GEO)
    return sample.agg(F.count(F.lit(1)).alias("sample_cnt"))


# --- mixed workload ----------------------------------------------------------

def _ch(entry: str, number: int, **literals) -> None:
    register(entry)(lambda d: mixed.ch_query(d.mixed(), number, **literals))


_ch("ch_01_pricing_summary", 1, delivered_after=DAY)
_ch("ch_02_lowest_stock_suppliers", 2, region_prefix="EUROP", item_suffix="t")
_ch("ch_03_undelivered_revenue", 3, entered_after=DAY)
_ch("ch_04_late_lines", 4)
_ch("ch_04_late_orders", 4, form="orders")
_ch("ch_05_regional_revenue", 5, region="EUROPE", entered_since=DAY)
_ch("ch_06_period_revenue", 6, since=DAY, before="2001-01-01", max_quantity=25)
_ch("ch_07_nation_pair_revenue", 7, first="NATION_7", second="NATION_15")
_ch("ch_08_market_share", 8, nation="NATION_15", region="EUROPE", item_suffix="t")
_ch("ch_09_product_profit", 9, item_suffix="lt")
_ch("ch_10_customer_revenue", 10, entered_since=DAY)
_ch("ch_11_important_stock", 11, nation="NATION_15")
_ch("ch_12_priority_lines", 12, delivered_before="2001-01-01")
_ch("ch_13_order_count_distribution", 13, carrier_above=4)
_ch("ch_14_promotion_share", 14, since=DAY)
_ch("ch_15_top_suppliers", 15, since=DAY)
_ch("ch_16_item_supplier_counts", 16)
_ch("ch_17_small_order_loss", 17, item_suffix="t")
_ch("ch_18_large_orders", 18, amount_above=400000)
_ch("ch_19_class_revenue", 19,
    classes=(("t", (1, 2, 3)), ("g", (1, 2, 4)), ("e", (1, 5, 3))))
_ch("ch_20_excess_suppliers", 20, nation="NATION_15", item_prefix="PR",
    delivered_after="2001-05-23 12:00:00")
_ch("ch_21_waiting_suppliers", 21, nation="NATION_15")


def _ch_checked(entry: str, number: int, **literals) -> None:
    """The same report with its filtered dimensions stored, counted and broadcast."""
    same = next(n for n in ORACLES if n.startswith(f"ch_{number:02d}_"))
    register(entry, ORACLES[same])(
        lambda d: mixed.ch_query(d.mixed(check_dimensions=True), number, **literals))


_ch_checked("ch_05_checked_dimensions", 5, region="EUROPE", entered_since=DAY)
_ch_checked("ch_21_checked_dimensions", 21, nation="NATION_15")


@register("ch_11_parameter_form")
def _ch11(d: Data) -> DataFrame:
    t = d.mixed()
    cut = mixed.stock_threshold(t, "NATION_15").first()[0]
    return mixed.important_stock(t, "NATION_15", threshold=cut)


register("ch_11_threshold")(lambda d: mixed.stock_threshold(d.mixed(), "NATION_15"))
register("ch_15_supplier_revenue")(lambda d: mixed.supplier_revenue(d.mixed(), DAY))


@register("ch_22_rich_without_orders")
def _ch22(d: Data) -> DataFrame:
    return mixed.rich_without_orders(d.mixed())


@register("ch_22_parameter_form")
def _ch22_parameter(d: Data) -> DataFrame:
    t = d.mixed()
    return mixed.rich_without_orders(t, balance_above=mixed.mean_balance(t).first()[0])


@register("ch_22_with_new_customers")
def _ch22_new(d: Data) -> DataFrame:
    """All given customers have orders; here each has a twin of another id who has none."""
    t = d.mixed()
    twins = t.customer.withColumn("c_id", F.col("c_id") + 100_000_000)
    t = mixed.MixedTables(**{n: getattr(t, n) for n in mixed.TABLE_NAMES} | {
        "customer": t.customer.unionByName(twins)})
    return mixed.rich_without_orders(t)


register("ch_22_mean_balance")(lambda d: mixed.mean_balance(d.mixed()))


# --- click stream ------------------------------------------------------------

register("clk_1_items")(
    lambda d: clicks.click_items(d["clicks"], d["ch_item"], "1 day", 950))
register("clk_1_top_items")(
    lambda d: clicks.top_click_items(d["clicks"], d["ch_item"], "1 day", 950))
register("clk_2_districts")(lambda d: clicks.click_districts(d["clicks"], "1 day"))


def _click_stream(d: Data, one_batch: bool = False) -> DataFrame:
    raw = (streams.replay_stream(d.spark, d.sf_dir, d["events"].schema, glob="events.parquet")
           if one_batch else
           streams.replay_stream(d.spark, d.event_files(), d["events"].schema, files_per_trigger=1))
    rows = d.spark.sql(VIEWS["clicks"], events=raw, part=d["part"])
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLICK.fields])


def _closed_clicks(text: str) -> str:
    return (f"SELECT * FROM ({text}) WHERE window_end <= "
            "(SELECT max(ts) FROM events)")


@register("clk_1_items_stream", _closed_clicks(ORACLES["clk_1_items"]))
def _clk1_stream(d: Data) -> DataFrame:
    return _streamed(d, "clk1", clicks.click_items(
        _click_stream(d), d["ch_item"], "1 day", 950, NO_DELAY))


@register("clk_2_districts_stream", _closed_clicks(ORACLES["clk_2_districts"]))
def _clk2_stream(d: Data) -> DataFrame:
    return _streamed(d, "clk2", clicks.click_districts(
        _click_stream(d), "1 day", NO_DELAY))


def _click_reports(d: Data, part: str) -> DataFrame:
    home = work_dir(d.spark, "click-reports")
    clicks.click_reports(_click_stream(d, one_batch=True), d["ch_item"], f"{home}/out", f"{home}/checkpoint",
                         min_price=950, k=10).awaitTermination()
    return d.spark.read.parquet(f"{home}/out/{part}").drop("batch_id")


@register("clk_1_reports_per_batch", with_views(
    "SELECT i_id, count(*) AS clicks FROM clicks JOIN ch_item ON i_id = cs_i_id "
    "WHERE i_price > 950 GROUP BY i_id ORDER BY clicks DESC, i_id LIMIT 10",
    "clicks", "ch_item"))
def _clk1_batch(d: Data) -> DataFrame:
    return _click_reports(d, "items")


@register("clk_2_reports_per_batch", with_views(
    "SELECT cs_c_d_id, cast(sum(cs_timespent) AS double) / count(*) AS avg_timespent "
    "FROM clicks GROUP BY cs_c_d_id", "clicks"))
def _clk2_batch(d: Data) -> DataFrame:
    return _click_reports(d, "districts")


# --- snapshots ---------------------------------------------------------------

SNAPSHOT_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


@register("snapshot_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", 'full' AS status, count(*) AS rows FROM {t}"
    for t in SNAPSHOT_TABLES if t != "customer"))
def _snapshot(d: Data) -> DataFrame:
    got = snapshot.snapshot_tables(
        d.spark, work_dir(d.spark, "snapshot"), include="[a-z]+", exclude="CUST.*",
        tables={t: d[t] for t in SNAPSHOT_TABLES})
    return got.select("table", "status", "rows")


def _incremental(d: Data) -> tuple[str, DataFrame]:
    """Snapshot of an earlier state of orders and nation, then of the present one."""
    target = work_dir(d.spark, "snapshot")
    earlier = d["orders"].where("o_orderstatus <> 'O'").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")))
    first = snapshot.snapshot_tables(
        d.spark, target, tables={"orders": earlier, "nation": d["nation"]},
        at=datetime(2024, 1, 1)).first().folder
    manifest = snapshot.snapshot_tables(
        d.spark, target, baseline=first,
        tables={"orders": d["orders"], "nation": d["nation"], "region": d["region"]},
        at=datetime(2024, 1, 2))
    return manifest.first().folder, manifest


@register("snapshot_incremental",
          "SELECT 'orders' AS \"table\", 'incremental' AS status, count(*) AS rows FROM orders "
          "WHERE o_orderstatus IN ('O', 'P') UNION ALL SELECT 'nation', 'unchanged', 0 "
          "UNION ALL SELECT 'region', 'full', count(*) FROM region")
def _snapshot_incremental(d: Data) -> DataFrame:
    return _incremental(d)[1].select("table", "status", "rows")


@register("snapshot_restore", "SELECT * FROM orders")
def _snapshot_restore(d: Data) -> DataFrame:
    folder, _ = _incremental(d)
    return snapshot.restore_table(d.spark, folder, "orders")


# Order lines and orders stored in the same buckets, once per application and table.
ORDER_BUCKETS = 8
_bucketed_tables: dict[tuple[str, str], dict[str, str]] = {}


def bucketed_orders(d: Data) -> mixed.MixedTables:
    key = (d.spark.sparkContext.applicationId, d.sf_dir)
    if key not in _bucketed_tables:
        names = {}
        for table, keys in (("order_line", mixed.ORDER_KEY.keys()), ("orders", mixed.ORDER_KEY.values())):
            names[table] = f"{table}_{uuid.uuid4().hex}"
            storage.store_bucketed(d[f"ch_{table}"], names[table], list(keys), ORDER_BUCKETS,
                                   work_dir(d.spark, f"bucketed-{table}"))
        _bucketed_tables[key] = names
    stored = {t: d.spark.table(n) for t, n in _bucketed_tables[key].items()}
    given = d.mixed()
    others = {t: getattr(given, t) for t in mixed.TABLE_NAMES if t not in stored}
    return mixed.MixedTables(**stored, **others, supplier_modulus=given.supplier_modulus)


register("ch_12_bucketed", ORACLES["ch_12_priority_lines"])(
    lambda d: mixed.ch_query(bucketed_orders(d), 12, delivered_before="2001-01-01"))
register("ch_21_bucketed", ORACLES["ch_21_waiting_suppliers"])(
    lambda d: mixed.ch_query(bucketed_orders(d), 21, nation="NATION_15"))
