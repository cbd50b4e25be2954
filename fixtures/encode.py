"""Turn impressions into wire messages, to have something to decode."""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WRITE_BYTES = 1 << 20
TEXT_FIELDS = ("publisher", "advertiser", "website", "geo")


def as_messages(impressions: DataFrame, *others) -> DataFrame:
    """Impressions with the message's columns: epoch milliseconds and a double bid."""
    return impressions.select(
        *others,
        F.unix_millis(F.col("time_stamp").cast("timestamp")).alias("timestamp"),
        *TEXT_FIELDS, F.col("bid").cast("double").alias("bid"), "cookie")


def _varint(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _text(s: str) -> bytes:
    raw = s.encode()
    return _varint(len(raw)) + raw


def encode_record(timestamp, publisher, advertiser, website, geo, bid, cookie) -> bytes:
    return (_varint(int(timestamp)) + _text(publisher) + _text(advertiser) + _text(website)
            + _text(geo) + struct.pack("<d", bid) + _text(cookie))


def payloads(impressions: DataFrame, per_payload: int = 1) -> DataFrame:
    """A ``payload`` column with one record, or several back to back, per row."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = [encode_record(*row) for row in batch.itertuples(index=False, name=None)]
            yield pd.DataFrame({"payload": [
                b"".join(records[i:i + per_payload])
                for i in range(0, len(records), per_payload)]})

    return as_messages(impressions).mapInPandas(encode, "payload binary")


def landed_segments(folder: str, per_segment: int):
    """Write records, sorted by queue partition ``p``, to segments as they come; returns how many segments."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, at, number, end, written = None, None, 0, 0, 0
        try:
            for batch in batches:
                for p, payload in zip(batch["p"].tolist(), batch["payload"].tolist()):
                    if out is not None and (p != at or number == end):
                        out.close()
                        out = None
                    if p != at:
                        at, number = p, 0
                    if out is None:
                        fs.create_dir(f"{root}/partition={at}")
                        out = fs.open_output_stream(f"{root}/partition={at}/{number:018d}.seg", buffer_size=WRITE_BYTES)
                        end, written = number + per_segment, written + 1
                    out.write(payload)
                    number += 1
        finally:
            if out is not None:
                out.close()
        yield pd.DataFrame({"n": [written]})

    return write


def write_segments(impressions: DataFrame, folder: str, partitions: int, per_segment: int) -> int:
    """Impressions as a queue lands them: raw segments named by their first record; returns how many.

    ``event_id`` deals them to queue partitions and orders them there.
    """
    dealt = as_messages(impressions, F.pmod("event_id", F.lit(partitions)).cast("int").alias("p"), "event_id")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch.drop(columns=["p", "event_id"]).itertuples(index=False, name=None)
            yield batch[["p", "event_id"]].assign(payload=[encode_record(*row) for row in values])

    # Every task encodes; those that write, one per queue partition at most, hold no more than a buffer.
    records = (dealt.mapInPandas(encode, "p int, event_id bigint, payload binary")
               .repartition(partitions, "p").sortWithinPartitions("p", "event_id").select("p", "payload"))

    return records.mapInPandas(landed_segments(folder, per_segment), "n long").agg(F.sum("n")).first()[0]
