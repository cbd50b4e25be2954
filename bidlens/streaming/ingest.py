"""Write streams to tables, alone or together with a maintained sample.

A batch callback may run twice for the same batch. Each batch therefore owns the
folders ``<part>/batch_id=<id>`` and overwrites them, and a commit marker is
written last; readers see committed batches only. Replaying a batch changes nothing.
``merge_batches`` folds old batches into larger files, so that neither a reader nor
the next batch has to list them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bidlens.operators.sampling import (
    UNIT, SampleSpec, add_counts, floor_from_reserve, reserve_of, strata_counts, thin, with_unit,
)
from bidlens.operators.sizing import MAX_BROADCAST_ROWS, broadcast_within
from bidlens.operators.storage import upsert_partitioned
from bidlens.sources.workspace import drop_path, list_names, path_exists, put_marker
from bidlens.streaming.continuous import start_append

BATCH = "batch_id"


def ingest_append(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  date_of: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table without a shuffle.

    ``date_of`` names a timestamp; rows are then put into ``day=<date>`` folders,
    which queries prune and ``storage.retain_window`` can drop.
    """
    if date_of is None:
        return start_append(stream, path, checkpoint, trigger)
    return start_append(stream.withColumn("day", F.to_date(date_of)), path, checkpoint,
                        trigger, partition_by=["day"])


def ingest_upsert(stream: DataFrame, path: str, keys: list[str], order_cols: list[str],
                  partition_by: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Upsert each micro-batch into a partitioned table, greatest version first.

    The order columns must make a total order; then an upsert may be repeated
    and batches may come in any order without changing the table.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            upsert_partitioned(batch.sparkSession, path, batch, keys, order_cols, partition_by)
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _slot(root: str, part: str, batch_id: int) -> str:
    return f"{root}/{part}/{BATCH}={batch_id}"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in list_names(spark, folder) if "=" in n)


def last_batch(spark: SparkSession, root: str) -> int:
    """Number of the last committed batch, or -1."""
    return max(_numbers(spark, f"{root}/commits"), default=-1)


def last_merged(spark: SparkSession, root: str) -> int:
    """Number of the last batch that ``merge_batches`` has folded in, or -1."""
    return max(_numbers(spark, f"{root}/merges"), default=-1)


def _totals(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Strata counts after a batch."""
    return spark.read.parquet(_slot(root, "totals", batch_id))


def write_batch_with_sample(batch: DataFrame, batch_id: int, root: str, spec: SampleSpec) -> None:
    """Store one micro-batch: base rows, running strata counts, sample rows, commit."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        batch.write.mode("overwrite").parquet(_slot(root, "base", batch_id))
        counts = strata_counts(batch, spec.qcs)
        if batch_id:
            counts = add_counts(_totals(spark, root, batch_id - 1), counts, spec.qcs)
        counts.write.mode("overwrite").parquet(_slot(root, "totals", batch_id))
        # Rates only fall later on, so these rows include all that stay.
        rates = broadcast_within(_totals(spark, root, batch_id))
        rows = thin(with_unit(batch, spec), rates, spec, complete=True).select(*batch.columns, UNIT)
        rows.write.mode("overwrite").parquet(_slot(root, "sample", batch_id))
        put_marker(spark, _slot(root, "commits", batch_id))
    finally:
        batch.unpersist()


def ingest_with_sample(stream: DataFrame, root: str, spec: SampleSpec, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Feed a base table and its stratified sample from one stream.

    The tables below ``root`` belong to one checkpoint, which numbers the batches;
    a fresh checkpoint would start again at zero and is refused.
    """
    spark = stream.sparkSession
    if last_batch(spark, root) >= 0 and not path_exists(spark, checkpoint):
        raise ValueError(f"{root} holds batches of another checkpoint than {checkpoint}")

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch_with_sample(batch, batch_id, root, spec)

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _batches(spark: SparkSession, root: str, part: str, after: int, upto: int) -> DataFrame:
    rows = spark.read.parquet(f"{root}/{part}")
    return rows.where((F.col(BATCH) > after) & (F.col(BATCH) <= upto)).drop(BATCH)


def _committed(spark: SparkSession, root: str, part: str, last: int) -> DataFrame:
    """Rows of the batches up to ``last``, which the caller looks up once."""
    merged = last_merged(spark, root)
    if last < 0:
        raise ValueError(f"no committed batch below {root}")
    rows = _batches(spark, root, part, merged, last)
    if merged >= 0:
        older = spark.read.parquet(f"{root}/{part}_merged")
        rows = older.where(F.col("upto") <= merged).drop("upto").unionByName(rows)
    return rows


def merge_batches(spark: SparkSession, root: str, spec: SampleSpec) -> int:
    """Fold committed batches into larger files; returns the last batch folded in.

    The newest batch stays as it is, since it may still be replayed. Rows merged
    before are not rewritten. Sample rows are thinned to the present rates on the way.
    Run it while no one reads: the folded batches' folders are removed.
    """
    last, merged = last_batch(spark, root), last_merged(spark, root)
    upto = last - 1
    if upto <= merged:
        return merged
    base = _batches(spark, root, "base", merged, upto)
    base.hint("rebalance").write.mode("overwrite").parquet(f"{root}/base_merged/upto={upto}")
    sample = _batches(spark, root, "sample", merged, upto)
    columns = sample.columns
    sample = thin(sample, broadcast_within(_totals(spark, root, last)), spec, complete=True).select(*columns)
    sample.hint("rebalance").write.mode("overwrite").parquet(f"{root}/sample_merged/upto={upto}")
    put_marker(spark, f"{root}/merges/upto={upto}")
    for part in ("base", "sample", "totals", "commits"):
        for number in _numbers(spark, f"{root}/{part}"):
            if number < upto or (number == upto and part in ("base", "sample")):
                drop_path(spark, _slot(root, part, number))
    return upto


def read_base(spark: SparkSession, root: str) -> DataFrame:
    """All committed base rows."""
    return _committed(spark, root, "base", last_batch(spark, root))


def read_sample(spark: SparkSession, root: str, spec: SampleSpec,
                max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The sample at the present rates, equal to sampling all base rows anew."""
    last = last_batch(spark, root)
    rows = _committed(spark, root, "sample", last)
    totals = broadcast_within(_totals(spark, root, last), max_broadcast_rows)
    return thin(rows, totals, spec, complete=True)


def read_floor_sample(spark: SparkSession, root: str, spec: SampleSpec) -> DataFrame:
    """The sample with a hard minimum, equal to ``floor_sample`` of all base rows, of a stream that was started with
    ``ingest_with_sample(..., reserve_of(spec), ...)``."""
    reserve = read_sample(spark, root, reserve_of(spec))
    return floor_from_reserve(reserve, _totals(spark, root, last_batch(spark, root)), spec)
