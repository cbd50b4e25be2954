"""Fixed schemas of the inputs."""

from __future__ import annotations

import json

from pyspark.sql import types as T

UNKNOWN_GEO = "un"  # marks an unresolved region in impression data

IMPRESSION = T.StructType([
    T.StructField("time_stamp", T.TimestampType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("advertiser", T.StringType()),
    T.StructField("website", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("cookie", T.StringType()),
])

# The message on the wire carries epoch milliseconds.
IMPRESSION_MESSAGE = T.StructType(
    [T.StructField("timestamp", T.LongType())] + IMPRESSION.fields[1:])

AGGREGATE = T.StructType([
    T.StructField("time_stamp", T.TimestampType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("avg_bid", T.DoubleType()),
    T.StructField("imps", T.LongType()),
    T.StructField("uniques", T.LongType()),
])

CLICK = T.StructType([
    T.StructField("cs_c_w_id", T.IntegerType()),
    T.StructField("cs_c_d_id", T.IntegerType()),
    T.StructField("cs_c_id", T.IntegerType()),
    T.StructField("cs_i_id", T.IntegerType()),
    T.StructField("cs_timespent", T.IntegerType()),
    T.StructField("cs_click_d", T.TimestampType()),
])

_AVRO_NAMES = {
    T.LongType: "long", T.IntegerType: "int", T.StringType: "string",
    T.DoubleType: "double", T.FloatType: "float", T.BooleanType: "boolean",
    T.BinaryType: "bytes",
}


def avro_record(schema: T.StructType, name: str = "Record") -> str:
    """Avro record schema, as JSON, for a flat Spark schema of required fields."""
    fields = []
    for field in schema.fields:
        try:
            fields.append({"name": field.name, "type": _AVRO_NAMES[type(field.dataType)]})
        except KeyError:
            raise ValueError(f"no flat Avro type for {field.simpleString()}") from None
    return json.dumps({"type": "record", "name": name, "fields": fields})
