"""Decode Avro-binary payloads in a ``binary`` column to typed columns.

With the Avro package on the class path, single-record payloads go through
``from_avro`` in the JVM. Without it, and for payloads that hold many records
back to back, each partition is decoded in Arrow batches by a small reader for
flat records. Bad payloads are never dropped: they come out with the reason in
``decode_error`` and null fields.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bidlens.sources.schemas import avro_record

OUT_ROWS = 8192  # rows per emitted Arrow batch

# Ship these functions with the job, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _read_long(buf: bytes, pos: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = buf[pos]
        pos += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), pos
        shift += 7
        if shift > 63:
            raise ValueError("integer longer than 64 bits")


def _read_bytes(buf: bytes, pos: int) -> tuple[bytes, int]:
    size, pos = _read_long(buf, pos)
    end = pos + size
    if size < 0 or end > len(buf):
        raise ValueError("field runs past the end of the payload")
    return buf[pos:end], end


def _read_text(buf: bytes, pos: int) -> tuple[str, int]:
    raw, pos = _read_bytes(buf, pos)
    return raw.decode("utf-8"), pos


def _read_double(buf: bytes, pos: int) -> tuple[float, int]:
    return struct.unpack_from("<d", buf, pos)[0], pos + 8


def _read_float(buf: bytes, pos: int) -> tuple[float, int]:
    return struct.unpack_from("<f", buf, pos)[0], pos + 4


def _read_bool(buf: bytes, pos: int) -> tuple[bool, int]:
    if buf[pos] > 1:
        raise ValueError("boolean is neither 0 nor 1")
    return buf[pos] == 1, pos + 1


_READERS = {
    T.LongType: _read_long, T.IntegerType: _read_long, T.StringType: _read_text,
    T.BinaryType: _read_bytes, T.DoubleType: _read_double, T.FloatType: _read_float,
    T.BooleanType: _read_bool,
}


def has_avro(df: DataFrame) -> bool:
    """Whether the session can plan ``from_avro``."""
    from pyspark.sql.avro.functions import from_avro

    try:
        df.sparkSession.range(0).select(from_avro(F.lit(None).cast("binary"), '"long"')).schema
        return True
    except AnalysisException:
        return False


def decode_payloads(df: DataFrame, payload_col: str, schema: T.StructType,
                    concatenated: bool = False, use_avro_package: bool | None = None) -> DataFrame:
    """One output row per record: the schema's fields, then ``decode_error``.

    ``concatenated`` says that a payload holds any number of records. Records
    read before a fault are kept; the rest of that payload becomes one row with
    an error. Columns of ``df`` other than the payload are carried along.
    """
    if use_avro_package is None:
        use_avro_package = not concatenated and has_avro(df)
    others = [c for c in df.columns if c != payload_col]
    if use_avro_package and not concatenated:
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(F.col(payload_col), avro_record(schema), {"mode": "PERMISSIVE"})
        # A record of required fields is never empty, so all-null means unreadable.
        broken = F.coalesce(*[F.col(f"__record.{f.name}").cast("string")
                              for f in schema.fields]).isNull()
        return (df.withColumn("__record", record)
                  .select(*others, "__record.*",
                          F.when(broken, F.lit("unreadable payload")).alias("decode_error")))

    names = [f.name for f in schema.fields]
    readers = [_READERS[type(f.dataType)] for f in schema.fields]
    out_schema = T.StructType([df.schema[c] for c in others] + [
        T.StructField(f.name, f.dataType) for f in schema.fields
    ] + [T.StructField("decode_error", T.StringType())])
    out_names = out_schema.names
    blank = [None] * len(names)

    def records(payload) -> Iterator[tuple[list, str | None]]:
        if payload is None:
            yield blank, "null payload"
            return
        buf, pos = bytes(payload), 0
        if not buf and not concatenated:
            yield blank, "empty payload"
        while pos < len(buf):
            try:
                row = []
                for read in readers:
                    value, pos = read(buf, pos)
                    row.append(value)
                if not concatenated and pos != len(buf):
                    raise ValueError("bytes left after the record")
            except (IndexError, ValueError, struct.error) as fault:
                yield blank, f"{type(fault).__name__}: {fault}"
                return
            yield row, None
            if not concatenated:
                return

    arrow = to_arrow_schema(out_schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Carried columns are taken by row number and never leave Arrow."""
        for batch in batches:
            source, rows = [], []
            for i, payload in enumerate(batch.column(len(others))):
                for values, error in records(payload.as_py()):
                    source.append(i)
                    rows.append((*values, error))
                    if len(rows) >= OUT_ROWS:
                        yield out_batch(batch, source, rows)
                        source, rows = [], []
            if rows:
                yield out_batch(batch, source, rows)

    def out_batch(batch: pa.RecordBatch, source: list, rows: list) -> pa.RecordBatch:
        at = pa.array(source, pa.int64())
        carried = [batch.column(i).take(at) for i in range(len(others))]
        fields = [pa.array(c, arrow.field(len(others) + i).type) for i, c in enumerate(zip(*rows))]
        return pa.RecordBatch.from_arrays([*carried, *fields], out_names)

    return df.select(*others, payload_col).mapInArrow(decode, out_schema)


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, rejected rows)."""
    good = decoded.where(F.col("decode_error").isNull()).drop("decode_error")
    return good, decoded.where(F.col("decode_error").isNotNull())


def to_impressions(messages: DataFrame, *others: str) -> DataFrame:
    """Project decoded messages to impression rows: milliseconds become a timestamp."""
    return messages.select(
        F.timestamp_millis("timestamp").alias("time_stamp"),
        "publisher", "advertiser", "website", "geo", "bid", "cookie", *others)
