"""Queue segments: raw files of records back to back, read by ranges of bytes.

Such a file has no marks between records, so it must be walked once from its start.
``index_segments`` does that, a task per file, and writes beside each segment which bytes hold which
records. From then on any number of tasks read parts of one file, and a stream can stop at a given record.

A queue's folder holds ``partition=<n>`` folders, whose segments are named after the number of
their first record (``000000000000001200.seg``). Offsets are record numbers, one per partition.
"""

from __future__ import annotations

import json
import math
import struct
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from bidlens.sources import payloads
from bidlens.sources.payloads import decode_payloads
from bidlens.sources.schemas import IMPRESSION_MESSAGE

SEGMENT, RANGES = ".seg", ".ranges"
#: A range ends with the record that fills it; a task reads ranges of about ``TASK_BYTES``.
RANGE_BYTES = 4 << 20
TASK_BYTES = 64 << 20
READ_BYTES = 1 << 20
#: A record longer than this is a fault, so that a wrong length does not load a whole file.
MAX_RECORD = 16 << 20
QUEUE_ROWS = 4096  # records per emitted Arrow batch
#: A task of the stream takes neighbouring ranges of a segment up to this size, so that short ranges do not make many tasks.
QUEUE_TASK_BYTES = 4 << 20
RANGE_DDL = ("path string, size bigint, first bigint, start bigint, length bigint, "
             "records bigint, error string")
RANGE_FIELDS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("first", pa.int64()),
                          ("start", pa.int64()), ("length", pa.int64()), ("records", pa.int64()),
                          ("error", pa.string())])

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _readers(schema: T.StructType) -> list[Callable]:
    return [payloads._READERS[type(f.dataType)] for f in schema.fields]


def _opened(path: str):
    fs, name = pafs.FileSystem.from_uri(path)
    return fs, fs.open_input_file(name)


def walk(file, readers: Sequence[Callable], range_bytes: int = RANGE_BYTES) -> Iterator[tuple]:
    """``first, start, length, records, error`` of each range of an open file.

    Memory follows the longest record, not the file. Bytes from the first fault on are one
    range without records.
    """
    buf, base, pos = b"", 0, 0  # ``base``: place of the buffer in the file
    first = start = records = 0
    error = None
    while True:
        try:
            at = pos
            for read in readers:
                _, at = read(buf, at)
        except (IndexError, ValueError, struct.error) as fault:
            more = file.read(READ_BYTES) if len(buf) - pos < MAX_RECORD else b""
            if more:  # the record may go on
                buf, base, pos = buf[pos:] + more, base + pos, 0
                continue
            if pos < len(buf):
                error = f"{type(fault).__name__}: {fault}"
            break
        pos, records = at, records + 1
        if base + pos - start >= range_bytes:
            yield first, start, base + pos - start, records, None
            first, start, records = first + records, base + pos, 0
    if records:
        yield first, start, base + pos - start, records, None
    if error is not None:
        yield first + records, base + pos, file.size() - base - pos, 0, error


def stored_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The indexed ranges of all segments below ``folder``."""
    return (spark.read.schema(RANGE_DDL).option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{RANGES}").parquet(folder))


def index_segments(spark: SparkSession, folder: str, schema: T.StructType = IMPRESSION_MESSAGE,
                   range_bytes: int = RANGE_BYTES) -> int:
    """Index segments below ``folder`` that have none or have grown; returns how many there were.

    Each task writes the ranges of a file in one piece beside it, so a task that is run again
    changes nothing.
    """
    readers = _readers(schema)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*{SEGMENT}").load(folder).select("path", F.col("length").alias("size")))
    done = stored_ranges(spark, folder).select("path", "size").distinct()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns)):
                fs, file = _opened(path)
                with file:
                    found = [(path, size, *r) for r in walk(file, readers, range_bytes)]
                columns = zip(*found) if found else [[]] * len(RANGE_FIELDS)
                rows = pa.table([pa.array(c, f.type) for c, f in zip(columns, RANGE_FIELDS)], RANGE_FIELDS)
                _, name = pafs.FileSystem.from_uri(path)
                pq.write_table(rows, name.removesuffix(SEGMENT) + RANGES, filesystem=fs)
                yield pa.RecordBatch.from_pydict({"path": [path]})

    return files.join(done, ["path", "size"], "left_anti").mapInArrow(index, "path string").count()


def split_segments(spark: SparkSession, folder: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``path, start, error, payload``: the bytes of each indexed range, spread evenly over tasks."""
    ranges = stored_ranges(spark, folder)
    size = ranges.agg(F.sum("length")).first()[0] or 0
    spread = ranges.select("path", "start", "error", "length").repartition(max(1, math.ceil(size / task_bytes)))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (path, start, error, length) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                payload = None
                if error is None:
                    _, file = _opened(path)
                    with file:
                        payload = file.read_at(length, start)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, 1) for c in batch.columns[:3]), pa.array([payload], pa.binary())],
                    ["path", "start", "error", "payload"])

    return spread.mapInArrow(fetch, "path string, start bigint, error string, payload binary")


def decode_segments(spark: SparkSession, folder: str, schema: T.StructType = IMPRESSION_MESSAGE,
                    task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of indexed segments, with ``path``, the ``start`` of their range and ``decode_error``.

    What follows a fault in a segment is one row with an error, as ``decode_payloads`` gives it.
    """
    found = decode_payloads(split_segments(spark, folder, task_bytes), "payload", schema, concatenated=True)
    reason = F.when(F.col("decode_error").isNotNull(), F.coalesce("error", "decode_error"))
    return found.withColumn("decode_error", reason).drop("error")


# --- as a stream ---------------------------------------------------------------

class QueueRange(InputPartition):
    """Records ``since`` to ``until`` of one queue partition, all in neighbouring ranges of a segment; of each range
    its ``start, length, first, records``."""

    def __init__(self, partition: int, path: str, ranges: list[tuple[int, int, int, int]], since: int, until: int):
        super().__init__(None)
        self.partition, self.path, self.ranges, self.since, self.until = partition, path, ranges, since, until


class QueueReader(DataSourceStreamReader):
    """Takes at most ``cap`` records of each queue partition per micro-batch.

    Spark asks a Python source for its latest offset without saying where the query stands. So the
    end of each batch is noted in the ``progress`` folder when the batch is planned: a batch that was
    planned is either done or run again with the same offsets before the next one is planned.

    Unreadable bytes at the end of a partition's last segment are an unfinished record, seen when the
    segment has grown and is indexed again; in front of a further segment they stop the query.
    """

    def __init__(self, folder: str, progress: str, cap: int | None, schema: T.StructType):
        self.folder, self.progress, self.cap, self.schema = folder.rstrip("/"), progress, cap, schema
        self.resumed = False

    # Only names are listed; ranges are read for the segments that a batch touches.
    def _segments(self, partition: str) -> list[tuple[int, str]]:
        """First record and name without ending of the indexed segments of a partition, in order."""
        fs, root = pafs.FileSystem.from_uri(self.folder)
        names = (i.path for i in fs.get_file_info(pafs.FileSelector(f"{root}/partition={partition}")))
        return sorted((int(n.rsplit("/", 1)[1].removesuffix(RANGES)), n.removesuffix(RANGES))
                      for n in names if n.endswith(RANGES))

    def _ranges(self, segment: tuple[int, str]) -> list[dict]:
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        rows = pq.read_table(segment[1] + RANGES, filesystem=fs, schema=RANGE_FIELDS).to_pylist()
        return [{**r, "first": r["first"] + segment[0]} for r in rows if r["error"] is None]

    def _partitions(self) -> list[str]:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        names = (i.base_name for i in fs.get_file_info(pafs.FileSelector(root)))
        return sorted((n.removeprefix("partition=") for n in names if n.startswith("partition=")), key=int)

    def _from(self, partition: str, since: int, until: int | None) -> Iterator[dict]:
        """The ranges that hold records from ``since`` on and before ``until``."""
        segments = self._segments(partition)
        expected = None
        for i, segment in enumerate(segments):
            if i + 1 < len(segments) and segments[i + 1][0] <= since:
                continue
            if until is not None and segment[0] >= until:
                return
            if expected is not None and segment[0] != expected:
                raise ValueError(f"records {expected} to {segment[0]} of partition {partition} are missing")
            expected = segment[0]
            for r in self._ranges(segment):
                expected = r["first"] + r["records"]
                if expected > since and (until is None or r["first"] < until):
                    yield r

    def _noted(self) -> dict:
        fs, root = pafs.FileSystem.from_uri(self.progress)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        for info in sorted(found, key=lambda i: i.base_name, reverse=True):
            try:
                with fs.open_input_file(info.path) as file:
                    return json.loads(file.read())
            except ValueError:  # written in part; the one before it holds
                continue
        return {}

    def _note(self, end: dict) -> None:
        fs, root = pafs.FileSystem.from_uri(self.progress)
        fs.create_dir(root)
        name = f"{root}/{sum(end.values()):020d}.json"
        with fs.open_output_stream(name) as file:
            file.write(json.dumps(end).encode())
        older = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.path < name)
        for path in older[:-1]:
            fs.delete_file(path)

    def initialOffset(self) -> dict:
        if self.resumed:
            raise ValueError(f"{self.progress} is of another query; give each checkpoint a folder of its own")
        return {p: s[0][0] for p in self._partitions() if (s := self._segments(p))}

    def latestOffset(self) -> dict:
        noted = self._noted()
        self.resumed = bool(noted)
        end = {}
        for p in self._partitions():
            segments = self._segments(p)
            if not segments:
                continue
            since = noted.get(p, segments[0][0])
            if since < segments[0][0]:
                raise ValueError(f"records of partition {p} from {since} on are gone")
            most = None if self.cap is None else since + self.cap
            end[p] = since
            for r in self._from(p, since, most):
                last = r["first"] + r["records"]
                end[p] = last if most is None else min(most, last)
        return {**noted, **end}

    @staticmethod
    def _packed(ranges: Iterable[dict]) -> Iterator[list[dict]]:
        """Neighbouring ranges of a segment, as many as a task takes."""
        part, size = [], 0
        for r in ranges:
            if part and size + r["length"] > QUEUE_TASK_BYTES:
                yield part
                part, size = [], 0
            part.append(r)
            size += r["length"]
        yield part

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        planned = []
        for p, until in end.items():
            since = start.get(p)
            if since is None:
                since = self._segments(p)[0][0]
            if until < since:
                raise ValueError(f"partition {p} stands at {since}, but {self.progress} says {until}")
            if since < until:
                for path, ranges in groupby(self._from(p, since, until), key=itemgetter("path")):
                    for part in self._packed(ranges):
                        last = part[-1]["first"] + part[-1]["records"]
                        planned.append(QueueRange(
                            int(p), path, [(r["start"], r["length"], r["first"], r["records"]) for r in part],
                            max(since, part[0]["first"]), min(until, last)))
        self._note(end)
        return planned

    def read(self, partition: QueueRange) -> Iterator[pa.RecordBatch]:
        _, file = _opened(partition.path)
        with file:
            for start, length, first, records in partition.ranges:
                yield from self._records(partition.partition, file.read_at(length, start), first,
                                         max(first, partition.since), min(first + records, partition.until))

    def _records(self, partition: int, buf: bytes, first: int, since: int, until: int) -> Iterator[pa.RecordBatch]:
        readers = _readers(self.schema)
        pos, number, offsets, records = 0, first, [], []
        while number < until:
            at = pos
            for read in readers:
                _, at = read(buf, at)
            if number >= since:
                offsets.append(number)
                records.append(buf[pos:at])
            pos, number = at, number + 1
            if len(records) >= QUEUE_ROWS or number == until:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition] * len(offsets), pa.int32()), pa.array(offsets, pa.int64()),
                     pa.array(records, pa.binary())], ["partition", "offset", "payload"])
                offsets, records = [], []

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class QueueSegments(DataSource):
    """``partition, offset, payload`` of the records in indexed segments of a queue."""

    @classmethod
    def name(cls) -> str:
        return "queue_segments"

    def schema(self) -> str:
        return "partition int, offset bigint, payload binary"

    def streamReader(self, schema: T.StructType) -> QueueReader:
        cap = self.options.get("maxRecordsPerPartition")
        if cap is not None and int(cap) < 1:
            raise ValueError("maxRecordsPerPartition must be at least 1")
        return QueueReader(self.options["path"], self.options["progress"], None if cap is None else int(cap),
                           T.StructType.fromJson(json.loads(self.options["record"])))


def queue_segments(spark: SparkSession, folder: str, progress: str, max_per_partition: int | None = None,
                   schema: T.StructType = IMPRESSION_MESSAGE) -> DataFrame:
    """A stream of ``partition, offset, payload`` over the indexed segments of a queue.

    Each micro-batch takes at most ``max_per_partition`` records from every partition; one with many
    records is read by many tasks. ``progress`` is a shared folder that goes with the query's checkpoint. Segments become
    visible when ``index_segments`` has indexed them, and one that was indexed must not grow unless it is the
    last of its partition. Use a ``processingTime`` trigger: an ``availableNow`` trigger asks a Python source
    for its end once, so it takes one batch of the cap and stops.
    """
    spark.dataSource.register(QueueSegments)
    reader = spark.readStream.format("queue_segments").option("progress", progress).option("record", schema.json())
    if max_per_partition is not None:
        reader = reader.option("maxRecordsPerPartition", max_per_partition)
    return reader.load(folder)
