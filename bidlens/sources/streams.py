"""Streaming sources: message queues, landed files and replayed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.sources.payloads import decode_payloads, split_rejects, to_impressions
from bidlens.sources.schemas import IMPRESSION, IMPRESSION_MESSAGE
from bidlens.sources.segments import queue_segments

OFFSETS = ("earliest", "latest")


def kafka_options(brokers: str, topics: str, starting: str = "latest",
                  max_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options of the Kafka source: where to start and how much to take per batch.

    ``max_per_trigger`` caps a whole micro-batch; a cap of r rows per second and
    partition corresponds to r * partitions * seconds per trigger.
    """
    if starting not in OFFSETS:
        raise ValueError(f"starting must be one of {OFFSETS}")
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topics,
               "startingOffsets": starting, **extra}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_impressions(spark: SparkSession, source: str | dict[str, str], format: str = "landed",
                     starting: str = "latest", max_per_trigger: int | None = None,
                     schema: T.StructType = IMPRESSION, concatenated: bool = False,
                     rejects: str = "fail") -> DataFrame:
    """A stream of impression rows.

    ``format``
      * ``kafka``: ``source`` holds the broker list under ``brokers`` and the
        topics under ``topics``. Keys are dropped, values decoded from Avro.
      * ``landed``: ``source`` is a folder of Parquet files with a binary
        ``payload`` column, as a queue's sink connector writes them.
      * ``segments``: ``source`` is a folder of raw files of records back to back.
      * ``queue``: ``source`` holds the folder of a queue's indexed segments under ``path`` and a folder
        for offsets under ``progress``; ``max_per_trigger`` is records per partition (see ``segments``).
      * ``parquet``, ``orc``, ``json``: files that already hold impression rows.
    ``rejects`` says what becomes of unreadable payloads: ``fail`` stops the stream at the first,
    ``keep`` returns a row with ``decode_error`` for each, and that column null for others, so
    that ``split_rejects`` can send them elsewhere, and ``drop`` leaves them out.
    """
    if rejects not in ("fail", "keep", "drop"):
        raise ValueError(f"rejects must be fail, keep or drop, not {rejects}")
    if format == "kafka":
        options = dict(source)
        raw = (spark.readStream.format("kafka")
               .options(**kafka_options(options.pop("brokers"), options.pop("topics"),
                                        starting, max_per_trigger, **options)).load())
        messages = raw.select(F.col("value").alias("payload"))
    elif format == "queue":
        messages = queue_segments(spark, source["path"], source["progress"], max_per_trigger).select("payload")
    else:
        reader = spark.readStream
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        if format == "landed":
            messages = reader.schema("payload binary").parquet(source)
        elif format == "segments":
            concatenated = True
            raw = reader.format("binaryFile").schema(
                "path string, modificationTime timestamp, length bigint, content binary"
            ).load(source)
            messages = raw.select(F.col("content").alias("payload"))
        else:
            return reader.format(format).schema(schema).load(source)
    decoded = decode_payloads(messages, "payload", IMPRESSION_MESSAGE, concatenated)
    if rejects == "keep":
        return to_impressions(decoded, "decode_error")
    good, _ = split_rejects(decoded)
    if rejects == "fail":
        text = F.concat(F.lit("unreadable payload: "), F.col("decode_error"))
        good = decoded.where(F.when(F.col("decode_error").isNotNull(), F.raise_error(text)
                                    .cast("boolean")).otherwise(F.lit(True)))
    return to_impressions(good)


def csv_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Impressions from CSV files as they land; a group of files is a micro-batch."""
    reader = spark.readStream.schema(IMPRESSION_MESSAGE).option("mode", "FAILFAST")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return to_impressions(reader.csv(path))


def replay_stream(spark: SparkSession, path: str, schema: T.StructType,
                  files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Replay a stored Parquet table as a stream, a group of files at a time."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def register_stream(name: str, stream: DataFrame) -> DataFrame:
    """Give a stream a name that SQL text and ``spark.table`` can use."""
    if not stream.isStreaming:
        raise ValueError(f"{name} is not a stream")
    stream.createOrReplaceTempView(name)
    return stream.sparkSession.table(name)
