"""Filtered snapshots of tables, full or as the change against a baseline.

Layout of a snapshot folder:

* ``_INCOMPLETE``     marker, removed as the last step
* ``catalog/``        one row per column of the chosen tables
* ``manifest/``       one row per table: status, rows, and where its rows are
* ``data/<table>/``   all rows, or for an incremental snapshot the added rows
                      with a ``_copies`` count
* ``removed/<table>/``  hashes and counts of baseline rows that are gone

A snapshot with the marker is ignored as a baseline, and a full one is made.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.operators.sizing import broadcast_within
from bidlens.sources.workspace import drop_path, make_dir, path_exists, put_marker

CATALOG = "catalog"
INCOMPLETE = "_INCOMPLETE"
MANIFEST_DDL = "table string, status string, rows bigint, base_dir string"
COPIES_PER_ROW = 10_000
_HASHES = ("_h1", "_h2")


def chosen(names: list[str], include: str = ".*", exclude: str = "") -> list[str]:
    """Names that fully match ``include`` and not ``exclude``, ignoring case."""
    take, leave = re.compile(include, re.I), re.compile(exclude, re.I)
    return sorted(n for n in names if take.fullmatch(n) and not leave.fullmatch(n))


def _value_hash(value: Column, kind: T.DataType, seed: int) -> Column:
    """64 bits of a value that tell nulls and their places apart at every level; the order of
    a map's entries does not count."""
    if isinstance(kind, T.ArrayType):
        parts = [F.transform(value, lambda x: _value_hash(x, kind.elementType, seed))]
    elif isinstance(kind, T.MapType):
        parts = [F.array_sort(F.transform(F.map_entries(value), lambda e: F.xxhash64(
            _value_hash(e["key"], kind.keyType, seed), _value_hash(e["value"], kind.valueType, seed))))]
    elif isinstance(kind, T.StructType):
        parts = [_value_hash(value.getField(f.name), f.dataType, seed) for f in kind.fields]
    else:
        parts = [value]
    return F.xxhash64(F.lit(seed), value.isNull(), *parts)


def _row_hashes(df: DataFrame) -> list[Column]:
    """128 bits over all columns; a null differs from every value."""
    def of(seed: int) -> Column:
        parts: list[Column] = []
        for f in sorted(df.schema.fields, key=lambda f: f.name):
            value = F.col(f"`{f.name}`")
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
                parts.append(_value_hash(value, f.dataType, seed))
            else:
                parts += [value, value.isNull()]
        return F.xxhash64(F.lit(seed), *parts)

    return [of(seed).alias(name) for seed, name in enumerate(_HASHES, 1)]


def _hash_counts(df: DataFrame, copies: Column) -> DataFrame:
    return df.select(*_row_hashes(df.drop("_copies")), copies.cast("bigint").alias("n"))


def changes(current: DataFrame, base_counts: DataFrame) -> DataFrame:
    """Row hashes whose number of copies differs, with the signed difference.

    Only two longs per row are shuffled, pre-aggregated in each task, so a third
    of all rows being copies of one row costs nothing extra.
    """
    now = _hash_counts(current, F.lit(1))
    before = base_counts.select(*_HASHES, (-F.col("n")).alias("n"))
    return (now.unionByName(before).groupBy(*_HASHES)
               .agg(F.sum("n").alias("n")).where("n <> 0"))


def added_rows(current: DataFrame, changed: DataFrame) -> DataFrame:
    """The added rows, once each, with the number of added copies."""
    hashed = current.select("*", *_row_hashes(current))
    more = broadcast_within(changed.where("n > 0").withColumnRenamed("n", "_copies"))
    return (hashed.join(more, list(_HASHES)).dropDuplicates(list(_HASHES))
                  .select(*current.columns, "_copies"))


def removed_rows(changed: DataFrame) -> DataFrame:
    return changed.where("n < 0").select(*_HASHES, (-F.col("n")).alias("n"))


def expand_copies(df: DataFrame) -> DataFrame:
    """Repeat each row ``_copies`` times; very many copies are spread over tasks."""
    columns = [c for c in df.columns if c != "_copies"]
    chunks = F.ceil(F.col("_copies") / COPIES_PER_ROW).cast("bigint")
    spread = (df.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), chunks)).alias("_chunk"))
                .withColumn("_take", F.least(F.lit(COPIES_PER_ROW).cast("bigint"),
                                             F.col("_copies") - (F.col("_chunk") - 1) * COPIES_PER_ROW)))
    return (spread.hint("rebalance")
                  .select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))).alias("_i"))
                  .drop("_i"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).parquet(f"{folder}/manifest")


def is_complete(spark: SparkSession, folder: str) -> bool:
    return path_exists(spark, f"{folder}/manifest") and not path_exists(
        spark, f"{folder}/{INCOMPLETE}")


def _table_state(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Hash counts of a table as of a snapshot, following its baselines."""
    entry = _manifest(spark, folder).where(F.col("table") == table).first()
    empty = spark.createDataFrame([], "_h1 bigint, _h2 bigint, n bigint")
    if entry is None or entry.status == "empty":
        return empty
    if entry.status == "full":
        rows = spark.read.parquet(f"{folder}/data/{table}")
        return (_hash_counts(rows, F.lit(1)).groupBy(*_HASHES).agg(F.sum("n").alias("n")))
    state = _table_state(spark, entry.base_dir, table)
    added = spark.read.parquet(f"{folder}/data/{table}")
    state = state.unionByName(_hash_counts(added, F.col("_copies")))
    gone = spark.read.parquet(f"{folder}/removed/{table}")
    state = state.unionByName(gone.select(*_HASHES, (-F.col("n")).alias("n")))
    return state.groupBy(*_HASHES).agg(F.sum("n").alias("n")).where("n <> 0")


def _store_full(spark: SparkSession, folder: str, name: str, df: DataFrame) -> tuple:
    """Write all rows of a table; returns its manifest entry."""
    where = f"{folder}/data/{name}"
    df.write.parquet(where)
    rows = spark.read.schema(df.schema).parquet(where).count()
    if rows:
        return name, "full", rows, None
    drop_path(spark, where)
    return name, "empty", 0, None


def _store_changes(spark: SparkSession, folder: str, name: str, df: DataFrame,
                   baseline: str) -> tuple:
    """Write what a table gained and lost since the baseline; returns its manifest entry."""
    where, lost, work = (f"{folder}/{part}/{name}" for part in ("data", "removed", "changed"))
    changes(df, _table_state(spark, baseline, name)).write.parquet(work)
    changed = spark.read.parquet(work)
    added_rows(df, changed).write.parquet(where)
    removed_rows(changed).write.parquet(lost)
    added, removed = changed.agg(F.sum(F.when(F.col("n") > 0, F.col("n"))),
                                 F.sum(F.when(F.col("n") < 0, F.col("n")))).first()
    drop_path(spark, work)
    return name, "incremental" if added or removed else "unchanged", added or 0, baseline


def snapshot_tables(spark: SparkSession, target: str, include: str = ".*", exclude: str = "",
                    baseline: str | None = None, tables: dict[str, DataFrame] | None = None,
                    at: datetime | None = None, parallel: int = 4) -> DataFrame:
    """Write a snapshot below ``target`` and return its manifest.

    ``tables`` defaults to all tables and views of the current database. The
    folder is named after the time (UTC) and must not exist. With a complete
    ``baseline`` folder, only changed rows are stored; a table whose columns or types
    are not those of the baseline is stored in full. Statuses: ``full``,
    ``incremental``, ``unchanged``, ``empty``; tables of the baseline that are now
    gone are listed as ``missing``. ``parallel`` tables are written at a time, each
    by a Spark job of its own.
    """
    if not target:
        raise ValueError("no snapshot folder given")
    if re.compile(exclude, re.I).fullmatch(CATALOG):
        raise ValueError(f"the catalog cannot be excluded (exclude pattern: {exclude})")
    if tables is None:
        tables = {t.name: spark.table(t.name) for t in spark.catalog.listTables()}
    names = chosen(list(tables), include, exclude)
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y-%m-%d-%H-%M-%S")
    folder = f"{target.rstrip('/')}/{stamp}"
    make_dir(spark, folder)
    put_marker(spark, f"{folder}/{INCOMPLETE}")
    if baseline is not None and not is_complete(spark, baseline):
        baseline = None
    columns = [(n, i, f.name, f.dataType.simpleString(), f.nullable)
               for n in names for i, f in enumerate(tables[n].schema.fields)]
    spark.createDataFrame(
        columns, "table string, position int, column string, type string, nullable boolean",
    ).write.parquet(f"{folder}/{CATALOG}")

    known: dict[str, str] = {}
    shapes: dict[str, set] = {}
    if baseline is not None:
        known = {r.table: r.status for r in _manifest(spark, baseline).collect()}
        for r in spark.read.parquet(f"{baseline}/{CATALOG}").collect():
            shapes.setdefault(r.table, set()).add((r.position, r.column, r.type))

    def store(name: str) -> tuple:
        shape = {(i, c, t) for n, i, c, t, _ in columns if n == name}
        if known.get(name, "missing") in ("missing", "empty") or shapes.get(name) != shape:
            return _store_full(spark, folder, name, tables[name])
        return _store_changes(spark, folder, name, tables[name], baseline)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        entries = list(pool.map(store, names))
    for name in chosen([n for n in known if n not in tables and known[n] != "missing"],
                       include, exclude):
        entries.append((name, "missing", 0, None))
    spark.createDataFrame(entries, MANIFEST_DDL).write.parquet(f"{folder}/manifest")
    drop_path(spark, f"{folder}/{INCOMPLETE}")
    return _manifest(spark, folder).withColumn("folder", F.lit(folder))


def restore_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table as of a snapshot: the baseline, less removed rows, plus added ones."""
    if not is_complete(spark, folder):
        raise ValueError(f"incomplete snapshot: {folder}")
    return expand_copies(_restored(spark, folder, table))


def _restored(spark: SparkSession, folder: str, table: str) -> DataFrame:
    entry = _manifest(spark, folder).where(F.col("table") == table).first()
    if entry is None or entry.status == "missing":
        raise ValueError(f"{table} is not in {folder}")
    if entry.status == "empty":
        fields = (spark.read.parquet(f"{folder}/{CATALOG}").where(F.col("table") == table)
                       .orderBy("position").collect())
        ddl = ", ".join(f"`{f.column}` {f.type}" for f in fields)
        return spark.createDataFrame([], f"{ddl}, _copies bigint")
    rows = spark.read.parquet(f"{folder}/data/{table}")
    if entry.status == "full":
        return rows.withColumn("_copies", F.lit(1).cast("bigint"))
    before = _restored(spark, entry.base_dir, table)
    columns = rows.columns
    gone = broadcast_within(spark.read.parquet(f"{folder}/removed/{table}"))
    hashed = before.select(*columns, *_row_hashes(before.drop("_copies")))
    # Only rows that lost copies are grouped; the others pass and need no shuffle.
    kept = hashed.join(gone, list(_HASHES), "left_anti").select(*columns)
    fewer = hashed.join(gone, list(_HASHES)).groupBy(*_HASHES).agg(
        *[F.first(c).alias(c) for c in columns if c != "_copies"],
        (F.sum("_copies") - F.first("n")).alias("_copies"))
    return kept.unionByName(rows).unionByName(fewer.where("_copies > 0").select(*columns))
