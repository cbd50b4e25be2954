from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bidlens.operators import snapshot
from bidlens.sources.workspace import put_marker
from conftest import rows

DDL = "id int, name string, amount decimal(10,2)"


def table(spark, values):
    return spark.createDataFrame(values, DDL).withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def take(spark, target, day, tables, baseline=None, **options):
    manifest = snapshot.snapshot_tables(spark, target, tables=tables, baseline=baseline,
                                        at=datetime(2024, 1, day), **options)
    return manifest.first().folder, dict(rows(manifest, "table", "status")), manifest


A = [(1, "x", None), (1, "x", None), (2, None, None), (3, "", None)]
B = [(1, "x", None), (2, None, None), (2, None, None), (2, None, None), (4, "n", None)]
C = B + [(None, None, None)] * 3


def test_names_are_matched_in_full_and_without_case():
    names = ["Orders", "order_line", "customer", "stock"]
    assert snapshot.chosen(names) == sorted(names)
    assert snapshot.chosen(names, "ORDER.*") == ["Orders", "order_line"]
    assert snapshot.chosen(names, "order") == []
    assert snapshot.chosen(names, ".*", "s.*|order.*") == ["customer"]


def test_full_snapshot_restores_and_lists(spark, folder):
    tables = {"a": table(spark, A), "empty": table(spark, []), "skipped": table(spark, B)}
    where, statuses, manifest = take(spark, folder, 1, tables, exclude="skip.*")
    assert statuses == {"a": "full", "empty": "empty"}
    assert rows(manifest, "table", "rows") == [("a", 4), ("empty", 0)]
    assert rows(snapshot.restore_table(spark, where, "a")) == rows(tables["a"])
    assert rows(snapshot.restore_table(spark, where, "empty")) == []
    assert where.endswith("2024-01-01-00-00-00") and snapshot.is_complete(spark, where)
    catalog = spark.read.parquet(f"{where}/catalog")
    assert rows(catalog.where("table = 'a'"), "column", "type") == [
        ("amount", "decimal(10,2)"), ("id", "int"), ("name", "string")]
    with pytest.raises(ValueError):
        snapshot.restore_table(spark, where, "skipped")


def test_incremental_chain_restores_copies(spark, folder):
    one, _, _ = take(spark, folder, 1, {"t": table(spark, A), "gone": table(spark, B),
                                        "late": table(spark, [])})
    two, statuses, manifest = take(spark, folder, 2, {"t": table(spark, B),
                                                      "late": table(spark, A)}, one)
    assert statuses == {"t": "incremental", "gone": "missing", "late": "full"}
    assert rows(manifest.where("table = 't'"), "rows") == [(3,)]
    three, statuses, _ = take(spark, folder, 3, {"t": table(spark, C), "late": table(spark, A)},
                              two)
    assert statuses == {"t": "incremental", "late": "unchanged"}
    for where, values in ((one, A), (two, B), (three, C)):
        assert rows(snapshot.restore_table(spark, where, "t")) == rows(table(spark, values))
    assert rows(snapshot.restore_table(spark, three, "late")) == rows(table(spark, A))


def test_incomplete_baseline_means_full(spark, folder):
    one, _, _ = take(spark, folder, 1, {"t": table(spark, A)})
    put_marker(spark, f"{one}/{snapshot.INCOMPLETE}")
    _, statuses, _ = take(spark, folder, 2, {"t": table(spark, B)}, one)
    assert statuses == {"t": "full"}
    with pytest.raises(ValueError):
        snapshot.restore_table(spark, one, "t")


def test_bad_requests(spark, folder):
    for bad in ("catalog", "CATA.*", ".*"):
        with pytest.raises(ValueError):
            take(spark, folder, 1, {}, exclude=bad)
    with pytest.raises(ValueError):
        snapshot.snapshot_tables(spark, "")
    take(spark, folder, 1, {"t": table(spark, A)})
    with pytest.raises(FileExistsError):
        take(spark, folder, 1, {"t": table(spark, A)})


def test_catalog_tables_by_default(spark, folder):
    table(spark, A).createOrReplaceTempView("snap_view")
    got = snapshot.snapshot_tables(spark, folder, include="SNAP_.*")
    assert rows(got, "table", "rows") == [("snap_view", 4)]


def test_very_many_copies_are_spread(spark):
    df = spark.createDataFrame([("hot", 25_000), ("one", 1), ("edge", 10_000)],
                               "v string, _copies bigint")
    got = snapshot.expand_copies(df).groupBy("v").count()
    assert rows(got) == [("edge", 10_000), ("hot", 25_000), ("one", 1)]


def test_hashes_tell_columns_and_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", None), (None, None), ("", "")],
                               "x string, y string")
    hashed = df.select(*snapshot._row_hashes(df))
    assert hashed.distinct().count() == 5


NESTED = "id int, a array<int>, m map<string,array<int>>, s struct<x:int,y:string>"


def test_nested_changes_are_seen(spark, folder):
    old = spark.createDataFrame([(1, [1, None], {"k": [1], "l": None}, (1, None)),
                                 (2, [], None, None), (3, None, {}, (None, None))], NESTED)
    new = spark.createDataFrame([(1, [None, 1], {"l": None, "k": [1]}, (1, None)),
                                 (2, None, None, (None, None)), (3, None, {}, (None, None))], NESTED)
    one, _, _ = take(spark, folder, 1, {"t": old})
    same, statuses, _ = take(spark, folder, 2, {"t": old}, one)
    assert statuses == {"t": "unchanged"}
    two, statuses, manifest = take(spark, folder, 3, {"t": new}, same)
    assert statuses == {"t": "incremental"} and rows(manifest, "rows") == [(2,)]
    assert rows(snapshot.restore_table(spark, two, "t")) == rows(new)
    assert rows(snapshot.restore_table(spark, same, "t")) == rows(old)


def test_order_of_map_entries_does_not_count(spark, folder):
    one = spark.sql("SELECT map('a', 1, 'b', 2) AS m")
    where, _, _ = take(spark, folder, 1, {"t": one})
    _, statuses, _ = take(spark, folder, 2, {"t": spark.sql("SELECT map('b', 2, 'a', 1) AS m")}, where)
    assert statuses == {"t": "unchanged"}


@pytest.mark.parametrize("change", [
    lambda t: t.withColumn("more", F.lit(1)), lambda t: t.drop("name"),
    lambda t: t.withColumn("id", F.col("id").cast("string"))])
def test_changed_columns_are_stored_in_full(spark, folder, change):
    one, _, _ = take(spark, folder, 1, {"t": table(spark, A)})
    new = change(table(spark, B))
    two, statuses, _ = take(spark, folder, 2, {"t": new}, one)
    assert statuses == {"t": "full"}
    got = snapshot.restore_table(spark, two, "t")
    assert rows(got) == rows(new) and got.columns == new.columns
    three, statuses, _ = take(spark, folder, 3, {"t": new.limit(2)}, two)
    assert statuses == {"t": "incremental"}
    assert snapshot.restore_table(spark, three, "t").count() == 2
