"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask names the words of a window of ``SPAN`` that count; the others may differ. For any
``WINDOW`` words of which up to two are substituted, one of the two masks still hits somewhere. Seeds
of the benchmark are joined with those of every position of the documents; around a
hit, the words of item and document are compared along the diagonal, and a stretch of
``WINDOW`` words with at least ``SHARE`` of them alike is an overlap.

The benchmark's seeds are broadcast in blocks of at most ``BLOCK_BYTES``; each block goes
over all documents. Hits are few, one per document, item and diagonal; only they meet the text again.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import id_and_text

#: Words of a window that count, by mask. Found by search: no two substitutions in any 13 words
#: spoil every placing of both masks.
MASKS = ((0, 1, 3, 6, 7, 8), (0, 1, 2, 5, 6, 8))
SPAN = 9
WINDOW = 13
SHARE = 0.8
BLOCK_BYTES = 64 << 20
SEED_BYTES = 64


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters and digits, in lower case."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(hashes: Column) -> Column:
    """The seeds of all positions by the first mask, then of all positions by the next."""
    places = F.sequence(F.lit(0), F.size(hashes) - SPAN)

    def of(n: int) -> Column:
        return F.transform(places, lambda i: F.xxhash64(
            F.lit(n), *[F.get(hashes, i + at) for at in MASKS[n]]))

    return F.when(F.size(hashes) >= SPAN, F.concat(*map(of, range(len(MASKS)))))


def placed_seeds(rows: DataFrame, id_col: str) -> DataFrame:
    """``seed, place`` of each position of ``rows(id, hashes)``.

    The outer form of exploding spares a filter that would work out all seeds twice.
    """
    found = rows.select(id_col, (F.size("hashes") - SPAN + 1).alias("places"),
                        seeds(F.col("hashes")).alias("seeds"))
    found = found.select(id_col, "places", F.posexplode_outer("seeds").alias("n", "seed"))
    return found.select(id_col, "seed", (F.col("n") % F.col("places")).alias("place"))


def best_stretch(item: Column, doc: Column, shift: Column) -> Column:
    """The most words alike in any stretch of an item laid on a document."""
    width = F.least(F.lit(WINDOW), F.size(item))
    at = F.sequence(F.lit(0), F.size(item) - 1)

    def of(words: Column) -> Column:  # as a variable, ``doc`` is worked out once
        return F.transform(at, lambda j: F.coalesce(
            (F.when(j + shift >= 0, F.get(words, j + shift)) == F.get(item, j)).cast("int"), F.lit(0)))

    def best(alike: Column) -> Column:
        return F.array_max(F.transform(F.sequence(F.lit(0), F.size(alike) - width), lambda s: F.aggregate(
            F.slice(alike, s + 1, width), F.lit(0), lambda a, x: a + x)))

    return F.get(F.transform(F.transform(F.array(doc), of), best), F.lit(0))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_alike, n_window``: documents with a passage of a benchmark item.

    One row per pair: the most words alike in a stretch of ``n_window`` words, which is
    ``WINDOW`` or the whole item if that is shorter. Items of fewer than ``SPAN`` words are no
    evidence and match nothing; a null text is empty. Repeated rows give a pair once; rows with null
    ids have pairs with a null id. Other columns are not read; empty tables give no rows.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        word_hashes(F.coalesce("text", F.lit(""))).alias("hashes")).where(F.size("hashes") >= SPAN)
    size = items.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = max(1, math.ceil(size * len(MASKS) * SEED_BYTES / BLOCK_BYTES))
    tests = placed_seeds(items, "item_id").withColumnRenamed("place", "item_place")
    texts = id_and_text(docs, id_col, text_col)
    train = placed_seeds(texts.select("doc_id", word_hashes(F.col("text")).alias("hashes")), "doc_id")

    def block(n: int) -> DataFrame:
        part = tests.where(F.pmod("seed", F.lit(blocks)) == n)
        return train.join(F.broadcast(part), "seed").select(
            "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))

    hits = reduce(DataFrame.unionByName, map(block, range(blocks))).distinct()
    hits = hits.withColumnRenamed("doc_id", "hit_id")
    pairs = texts.join(hits, texts["doc_id"].eqNullSafe(hits["hit_id"])).join(
        items.withColumnRenamed("hashes", "item"), "item_id")
    compared = pairs.select(
        "doc_id", "item_id", F.least(F.lit(WINDOW), F.size("item")).alias("n_window"),
        best_stretch(F.col("item"), word_hashes(F.col("text")), F.col("shift")).alias("n_alike"))
    return compared.groupBy("doc_id", "item_id").agg(
        F.max("n_alike").alias("n_alike"), F.max("n_window").alias("n_window")).where(
        F.col("n_alike") >= F.ceil(F.col("n_window") * SHARE))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id has no overlap; those with a null id are kept only if no
    such row overlaps."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
