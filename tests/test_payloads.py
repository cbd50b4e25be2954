import os

import pytest
from pyspark.sql import types as T

from bidlens.sources.payloads import decode_payloads, has_avro, split_rejects, to_impressions
from bidlens.sources.schemas import IMPRESSION_MESSAGE, avro_record
from conftest import rows
from fixtures.encode import encode_record, payloads

GOOD = [(0, "p", "a", "w", "g", 0.5, "c"),
        (2 ** 63 - 1, "", "é中文", "x" * 300, "un", -1.25, "cookie1"),
        (-2 ** 63, "p", "a", "w", "g", float("inf"), "c"),
        (1464194729027, "publisher44", "advertiser11", "website233", "NJ", 0.857122, "cookie210")]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, payload binary")


def test_records_round_trip_with_other_columns(spark):
    df = frame(spark, [encode_record(*r) for r in GOOD])
    got = decode_payloads(df, "payload", IMPRESSION_MESSAGE)
    assert got.columns == ["id", *IMPRESSION_MESSAGE.names, "decode_error"]
    assert rows(got) == sorted([(i, *r, None) for i, r in enumerate(GOOD)], key=repr)


def test_bad_payloads_become_rejects(spark):
    whole = encode_record(*GOOD[3])
    bad = [None, b"", whole[:-1], whole + b"\x00", b"\xff" * 12, whole[:1] + b"\x09" + whole[2:]]
    good, rejected = split_rejects(decode_payloads(
        frame(spark, [whole, *bad]), "payload", IMPRESSION_MESSAGE))
    assert [r.id for r in good.collect()] == [0]
    assert [r.id for r in rejected.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]
    assert rejected.where("timestamp IS NOT NULL").count() == 0


def test_concatenated_keeps_what_precedes_a_fault(spark):
    records = [encode_record(*r) for r in GOOD]
    df = frame(spark, [b"".join(records), b"", records[0] + records[1][:5]])
    got = decode_payloads(df, "payload", IMPRESSION_MESSAGE, concatenated=True)
    good, rejected = split_rejects(got)
    assert sorted(r.id for r in good.collect()) == [0, 0, 0, 0, 2]
    assert [r.id for r in rejected.collect()] == [2]


def test_many_records_in_one_payload_are_emitted_in_batches(spark):
    df = frame(spark, [encode_record(*GOOD[3]) * 30_000])
    got = decode_payloads(df, "payload", IMPRESSION_MESSAGE, concatenated=True)
    assert got.count() == 30_000


def test_other_field_types(spark):
    schema = T.StructType([T.StructField("b", T.BooleanType()), T.StructField("f", T.FloatType()),
                           T.StructField("i", T.IntegerType()), T.StructField("r", T.BinaryType())])
    df = frame(spark, [b"\x01" + b"\x00\x00\x80?" + b"\x03" + b"\x04ab"])
    got = decode_payloads(df, "payload", schema, use_avro_package=False).first()
    assert (got.b, got.f, got.i, bytes(got.r)) == (True, 1.0, -2, b"ab")
    with pytest.raises(ValueError):
        avro_record(T.StructType([T.StructField("d", T.DateType())]))


def test_avro_package_is_detected(spark):
    assert has_avro(spark.range(1)) in (True, False)


def test_raw_segment_files(spark, folder, data):
    from bidlens.sources.streams import read_impressions

    local = folder.removeprefix("file:")
    os.makedirs(local)
    segments = [bytes(r.payload) for r in payloads(data.impressions, 400).collect()]
    for i, segment in enumerate(segments):
        with open(f"{local}/part{i}.bin", "wb") as f:
            f.write(segment)
    stream = read_impressions(spark, folder, "segments", max_per_trigger=1)
    query = stream.writeStream.format("memory").queryName("segments").option(
        "checkpointLocation", folder + "-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    want = to_impressions(split_rejects(decode_payloads(
        payloads(data.impressions), "payload", IMPRESSION_MESSAGE))[0])
    assert rows(spark.table("segments")) == rows(want)


def test_carried_nullable_ids_stay_exact(spark):
    ids = [2 ** 53 + 1, None, -2 ** 63]
    df = spark.createDataFrame([(i, encode_record(*GOOD[0])) for i in ids], "id long, payload binary")
    assert [r.id for r in decode_payloads(df, "payload", IMPRESSION_MESSAGE).collect()] == ids
