"""The pipeline's stages on rows whose ids are missing or repeated, against plain versions."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from bidlens.llm import quality
from bidlens.sources.workspace import work_dir
from test_operators import SMALL, slow_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string"
PASSAGE = " ".join(f"word{i} of{i % 7}" for i in range(40))
ROWS = [(5, "a b"), (5, "a  b"), (5, "a b"), (None, "a b"), (5, "other"), (3, "other"), (None, "x y"), (None, "x\ny"),
        (None, "x y"), (None, None), (None, ""), (7, ""), (8, PASSAGE), (8, PASSAGE), (None, PASSAGE), (9, PASSAGE + " end"),
        (9, "quite another text of its own here"), (-1, "first by its id")] + [(1, "hot row")] * 40


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in ROWS], SCHEMA).repartition(5).withColumn("text_2", F.lit(1))


def shown(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_copies_go_by_row(spark, odd):
    got = p.drop_copies(spark, odd, SMALL)
    want = {}
    for i, t in in_order(ROWS):
        want.setdefault(normal(t), i)
    assert got.columns == odd.columns
    assert sorted(((normal(t), i) for i, t in shown(got)), key=repr) == sorted(want.items(), key=repr)


def test_near_copies_go_by_row(spark, odd):
    got = shown(p.drop_near_copies(spark, odd, SMALL))
    prints = [(i, slow_fingerprint(t or "")) for i, t in in_order(ROWS)]
    root = list(range(len(prints)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = [prints[k] for k in range(len(prints)) if find(k) == k]
    assert sorted(((i, slow_fingerprint(t or "")) for i, t in got), key=repr) == sorted(want, key=repr)


def test_leaks_go_by_row(spark, odd):
    home = work_dir(spark, "bench")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    got = p.drop_benchmark(spark, odd, home)
    assert shown(got) == sorted(((i, t) for i, t in ROWS if not (t or "").startswith(PASSAGE)), key=repr)


def test_quality_judges_rows_and_not_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bad = [r.doc_id for r in quality.classify(docs, labels).where("rejected").orderBy("doc_id").collect()][:2]
    low = docs.where(F.col("doc_id").isin(bad))
    unlabelled = labels.agg(F.max("doc_id")).first()[0] + 1
    more = low.withColumn("doc_id", F.lit(None).cast("long")).unionByName(
        low.withColumn("doc_id", F.lit(unlabelled)))  # without an id, and two texts with one id
    given = docs.unionByName(more).unionByName(docs.where("doc_id % 50 = 1"))
    got = shown(p.filter_quality(spark, given, SMALL))

    rows = spark.createDataFrame([(n, *r) for n, r in enumerate(given.collect())], f"n long, {SCHEMA}")
    apart = rows.join(labels.select("doc_id", "quality", "toxic"), "doc_id").select(F.col("n").alias("doc_id"), "quality", "toxic")
    kept = quality.classify(rows.select(F.col("n").alias("doc_id"), "text", "lang"), apart).where("NOT rejected")
    want = rows.join(kept.select(F.col("doc_id").alias("n")), "n", "left_semi")
    assert bad and got == shown(want)
    assert not {t for i, t in got if i is None} & {r.text for r in low.collect()}


def test_unique_ids_are_taken_as_they_are(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert p.by_row(docs).where(f"{p.KEY} <> doc_id").count() == 0


def test_numbers_follow_ids(spark, odd):
    numbered = p.by_row(odd).orderBy(p.KEY).collect()
    assert len({r[p.KEY] for r in numbered}) == len(ROWS)
    assert [r.doc_id for r in numbered] == [i for i, _ in in_order(ROWS)]


def test_empty_tables(spark):
    home = work_dir(spark, "empty")
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"),
                         ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{home}/{name}.parquet")
    assert p.run(spark, home).count() == 0
