import glob
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bidlens.sources import segments
from bidlens.sources.payloads import split_rejects
from bidlens.sources.schemas import IMPRESSION_MESSAGE
from conftest import rows
from fixtures.encode import as_messages, encode_record, write_segments

RECORD = (1464194729027, "publisher44", "advertiser11", "website233", "NJ", 0.857122, "cookie210")
READERS = segments._readers(IMPRESSION_MESSAGE)


def messages(data):
    return rows(as_messages(data.impressions))


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


def test_ranges_cover_a_file_wherever_reads_end(monkeypatch):
    records = [encode_record(i, "p" * (i % 70), "é", "w", "g", 0.5, "c") for i in range(300)]
    whole = b"".join(records)
    for read_bytes in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(segments, "READ_BYTES", read_bytes)
        found = list(segments.walk(pa.BufferReader(whole), READERS, 500))
        assert [f[4] for f in found] == [None] * len(found) and len(found) > 10
        at = first = 0
        for number, start, length, n, _ in found:
            assert (number, start) == (first, at)
            assert whole[start:start + length] == b"".join(records[first:first + n])
            at, first = start + length, first + n
        assert (at, first) == (len(whole), 300)


@pytest.mark.parametrize("tail", [b"\xff" * 12, encode_record(*RECORD)[:-1], b"\x00\x09"])
def test_bytes_after_a_fault_are_one_range(tail):
    good = encode_record(*RECORD) * 3
    *_, last = segments.walk(pa.BufferReader(good + tail), READERS, 10)
    assert last[:4] == (3, len(good), len(tail), 0) and last[4]
    assert list(segments.walk(pa.BufferReader(b""), READERS)) == []


def test_a_wrong_length_does_not_load_the_file(monkeypatch):
    monkeypatch.setattr(segments, "MAX_RECORD", 1000)
    monkeypatch.setattr(segments, "READ_BYTES", 100)
    size = b"\x00\x80\x80\x80\x80\x10"  # a text of half a gigabyte
    file = pa.BufferReader(size + b"x" * 100_000)
    (found,) = segments.walk(file, READERS)
    assert found[3] == 0 and file.tell() <= 1200


def test_one_file_is_read_by_many_tasks(spark, folder, data):
    assert write_segments(data.impressions, folder, 1, 1 << 62) == 1
    assert segments.index_segments(spark, folder, range_bytes=4096) == 1
    assert segments.index_segments(spark, folder, range_bytes=4096) == 0
    got = segments.decode_segments(spark, folder, task_bytes=8192)
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(t["count"] for t in tasks) < data.impressions.count() / 2
    assert rows(got.where("decode_error IS NULL"), *IMPRESSION_MESSAGE.names) == messages(data)


def test_a_segment_that_grew_is_indexed_again_and_faults_are_rows(spark, folder):
    path = folder.removeprefix("file:") + "/partition=0/000.seg"
    one = encode_record(*RECORD)
    put(path, one * 2 + one[:5])
    assert segments.index_segments(spark, folder) == 1
    good, bad = split_rejects(segments.decode_segments(spark, folder))
    assert good.count() == 2 and [r.start for r in bad.collect()] == [2 * len(one)]
    put(path, one * 4)
    assert segments.index_segments(spark, folder) == 1
    good, bad = split_rejects(segments.decode_segments(spark, folder))
    assert good.count() == 4 and bad.count() == 0
    put(path.replace("000", "004"), b"")
    segments.index_segments(spark, folder)
    assert segments.decode_segments(spark, folder).count() == 4


def run_queue(spark, folder, home, cap):
    """Rows per batch and partition of one run to the end; the sink keeps the batch's number."""
    stream = segments.queue_segments(spark, folder, f"{home}/progress", cap)

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{home}/out/b={number}")

    query = stream.writeStream.foreachBatch(keep).option(
        "checkpointLocation", f"{home}/checkpoint").trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(f"{home}/out")


def test_no_batch_takes_more_than_the_cap_and_a_restart_goes_on(spark, folder, data):
    queue, home, cap = f"{folder}/queue", f"{folder}/home", 90
    write_segments(data.impressions.where("event_id < 500"), queue, 3, 70)
    segments.index_segments(spark, queue, range_bytes=1000)
    first = run_queue(spark, queue, home, cap)
    assert first.select("partition", "offset").distinct().count() == first.count() == 500
    assert first.groupBy("batch", "partition").count().agg(F.max("count")).first()[0] == cap

    write_segments(data.impressions, queue, 3, 70)  # the same segments, and more of them
    segments.index_segments(spark, queue, range_bytes=1000)
    both = run_queue(spark, queue, home, cap)
    per = both.groupBy("batch", "partition").count()
    assert per.agg(F.max("count")).first()[0] <= cap
    total = data.impressions.count()
    assert both.select("partition", "offset").distinct().count() == both.count() == total
    decoded = segments.decode_payloads(both.select("payload"), "payload", IMPRESSION_MESSAGE)
    assert rows(decoded.drop("decode_error")) == messages(data)


def test_planning_a_batch_again_gives_the_same_parts(spark, folder, data):
    local = folder.removeprefix("file:")
    write_segments(data.impressions, f"{folder}/queue", 2, 100)
    segments.index_segments(spark, f"{folder}/queue", range_bytes=1000)

    def reader():
        return segments.QueueReader(f"{local}/queue", f"{local}/progress", 150, IMPRESSION_MESSAGE)

    def shown(parts):
        return [vars(p) for p in parts]

    one = reader()
    start, end = one.initialOffset(), one.latestOffset()
    assert start == {"0": 0, "1": 0} and end == {"0": 150, "1": 150} == one.latestOffset()
    parts = shown(one.partitions(start, end))
    assert len(parts) > 2 and sum(p["until"] - p["since"] for p in parts) == 300
    again = reader()  # as after a crash before the batch was done
    assert shown(again.partitions(start, end)) == parts
    assert again.latestOffset() == {"0": 300, "1": 300}
    offsets = [o for p in again.partitions({"0": 99, "1": 150}, {"0": 101, "1": 150})
               for b in again.read(p) for o in b.column("offset").to_pylist()]
    assert offsets == [99, 100]


def test_short_ranges_share_a_task(spark, folder, data, monkeypatch):
    local = folder.removeprefix("file:")
    write_segments(data.impressions.where("event_id < 300"), f"{folder}/queue", 1, 150)
    segments.index_segments(spark, f"{folder}/queue", range_bytes=500)

    def parts():
        reader = segments.QueueReader(f"{local}/queue", f"{local}/progress", None, IMPRESSION_MESSAGE)
        found = reader.partitions({"0": 10}, {"0": 290})
        return found, [o for p in found for b in reader.read(p) for o in b.column("offset").to_pylist()]

    found, offsets = parts()
    assert len(found) == 2 and offsets == list(range(10, 290))  # a task a segment
    monkeypatch.setattr(segments, "QUEUE_TASK_BYTES", 2500)
    found, offsets = parts()
    assert len(found) > 4 and offsets == list(range(10, 290))
    assert all(sum(r[1] for r in p.ranges) <= 2500 for p in found)


def test_segments_are_written_as_rows_come(spark, folder):
    """No writer holds a segment: bytes are in the file before all of its rows are there."""
    from fixtures.encode import landed_segments

    def batches():
        yield pd.DataFrame({"p": [1] * 3, "payload": [b"a" * (1 << 20)] * 3})
        seen.append(sum(os.path.getsize(f) for f in glob.glob(f"{local}/partition=1/*.seg")))
        yield pd.DataFrame({"p": [1, 1, 2], "payload": [b"b", b"c", b"d"]})

    local, seen = folder.removeprefix("file:"), []
    assert pd.concat(landed_segments(folder, 4)(batches()))["n"].sum() == 3
    assert seen[0] >= 2 << 20
    sizes = {f.removeprefix(local): os.path.getsize(f) for f in glob.glob(f"{local}/*/*.seg")}
    assert sizes == {f"/partition=1/{0:018d}.seg": (3 << 20) + 1, f"/partition=1/{4:018d}.seg": 1,
                     f"/partition=2/{0:018d}.seg": 1}


def test_progress_of_another_query_and_lost_records_are_errors(spark, folder, data):
    local = folder.removeprefix("file:")
    write_segments(data.impressions.where("event_id < 300"), f"{folder}/queue", 1, 100)
    segments.index_segments(spark, f"{folder}/queue")
    reader = segments.QueueReader(f"{local}/queue", f"{local}/progress", None, IMPRESSION_MESSAGE)
    reader.partitions({"0": 0}, reader.latestOffset())
    reader.latestOffset()
    with pytest.raises(ValueError, match="another query"):
        reader.initialOffset()
    with pytest.raises(ValueError, match="stands at"):
        reader.partitions({"0": 300}, {"0": 200})
    os.remove(f"{local}/queue/partition=0/{100:018d}.ranges")
    with pytest.raises(ValueError, match="missing"):
        reader.partitions({"0": 0}, {"0": 300})
    with pytest.raises(ValueError, match="at least 1"):
        segments.QueueSegments({"maxRecordsPerPartition": "0"}).streamReader(None)
