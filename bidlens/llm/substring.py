"""Substring deduplication by winnowed anchors.

Every ``WINDOW`` consecutive words have an anchor: the first smallest hash of the ``GRAM``-word
runs in them. Equal windows have equal anchors, so documents meet on anchors. An anchor
brings along the windows it stands for, which is how far a match can extend to the left and right
of it. Where documents meet, a window is a repeat if a smaller document had it; the runs of
such windows are the maximal repeats of at least ``WINDOW`` words.

Before anything moves, a task keeps only the first of its documents that have an anchor with the
same windows; for the others the answer is known. The inner anchors of a passage that a third of all
documents share thus travel once per task slice. Those near its edges stand for windows that reach into
each document's own words, so each document sends a row, all to the anchor's one task, which holds
their distinct windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import MEMO_WORDS, id_and_text, slices

WINDOW = 50
GRAM = 20
REACH = WINDOW - GRAM + 1
#: Odd multipliers of the rolling hashes; their inverses modulo 2**64 undo a shift.
BASE, GRAM_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > MEMO_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


HASHES = WordHashes()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of all runs of ``width`` values; equal runs have equal hashes wherever they are."""

    def __init__(self, base: int, width: int):
        self.base, self.inverse, self.width = base, pow(base, -1, 1 << 64), width
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if n > len(self.up):
            self.grow(2 * n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[:n])])
        mixed = (sums[self.width:] - sums[:-self.width]) * self.down[:n - self.width + 1]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(32))


_window, _gram = Rolling(BASE, WINDOW), Rolling(GRAM_BASE, GRAM)


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows; where the runs of windows with one anchor start; those anchors."""
    values = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    windows, grams = _window(values), _gram(values)
    at = np.arange(len(windows)) + np.lib.stride_tricks.sliding_window_view(
        grams, REACH).argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return windows, first, grams[at[first]]


def _occurrences(batches):
    """Rows ``doc_id, key, start, size, anchor, windows, known`` of each anchor of each document.

    ``known``: a smaller document of the slice has the same anchor and windows, so that all of
    them are repeats; such a row needs no windows and goes anywhere.
    """
    for batch in slices(batches):
        ids = batch.column(0)
        order = np.argsort(ids.fill_null(np.iinfo(np.int64).max).to_numpy(), kind="stable")
        seen: dict[tuple, object] = {}
        out = {k: [] for k in ("doc_id", "key", "start", "size", "anchor", "windows", "known")}
        texts, ids, keys = batch.column(1), ids.to_pylist(), batch.column(2).to_pylist()
        for i in order.tolist():
            words = texts[i].as_py().encode().split()
            if len(words) < WINDOW:
                continue
            windows, first, anchor = anchors(words)
            last, raw = np.append(first[1:], len(windows)), windows.tobytes()
            doc = ids[i]
            for s, e, a in zip(first.tolist(), last.tolist(), anchor.view(np.int64).tolist()):
                part = raw[8 * s:8 * e]
                before = seen.setdefault((a, part), doc)
                known = before is not None and before != doc
                out["doc_id"].append(doc)
                out["key"].append(keys[i])
                out["start"].append(s)
                out["size"].append(e - s)
                out["anchor"].append(a if not known else a ^ (hash((doc, s)) | 1))
                out["windows"].append(None if known else part)
                out["known"].append(known)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["doc_id"], pa.int64()), pa.array(out["key"], pa.int64()),
             pa.array(out["start"], pa.int32()), pa.array(out["size"], pa.int32()), pa.array(out["anchor"], pa.int64()),
             pa.array(out["windows"], pa.binary()), pa.array(out["known"], pa.bool_())], list(out))


def _judge(batches):
    """Rows ``doc_id, key, start, repeats`` from rows by anchor and id: bit k of ``repeats`` is set
    if window ``start + k`` also starts in a smaller document."""
    current, seen = None, {}
    for batch in batches:
        doc, key, start, size = (batch.column(i).to_pylist() for i in range(4))
        anchor, known = batch.column(4).to_numpy(), batch.column(6).to_pylist()
        windows = batch.column(5)
        # an anchor that only one row has needs no look at its windows
        after = np.concatenate([anchor[1:] == anchor[:-1], [True]])
        before = np.concatenate([[current is None or anchor[0] == current], anchor[1:] == anchor[:-1]])
        out = ([], [], [], [])
        for i in np.flatnonzero(after | before | np.array(known)).tolist():
            if known[i]:
                bits = (1 << size[i]) - 1
            else:
                if anchor[i] != current:
                    current, seen = anchor[i], {}
                bits, me = 0, doc[i]
                for k, w in enumerate(np.frombuffer(windows[i].as_buffer(), np.int64).tolist()):
                    owner = seen.setdefault(w, me)
                    if owner is not None and owner != me:
                        bits |= 1 << k
            if bits:
                for x, y in zip(out, (doc[i], key[i], start[i], bits)):
                    x.append(y)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
            ["doc_id", "key", "start", "repeats"])


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, key, start, repeats`` of ``docs(doc_id, text, key)``: which windows repeat a smaller document's.
    ``key``: a digest of the text, since places hold for one text only and ids may be null or repeat."""
    rows = docs.mapInArrow(_occurrences, "doc_id long, key long, start int, size int, anchor long, "
                                         "windows binary, known boolean")
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", F.col("doc_id").asc_nulls_last())
    return dealt.mapInArrow(_judge, "doc_id long, key long, start int, repeats long")


def kept_words(words: list[bytes], found: list[dict]) -> list[bytes]:
    """The words that no repeated window covers."""
    edge = np.zeros(len(words) + WINDOW + 1, np.int64)
    for r in found:
        bits, at = r["repeats"], r["start"]
        while bits:
            if bits & 1 and at + WINDOW <= len(words):
                edge[at] += 1
                edge[at + WINDOW] -= 1
            bits >>= 1
            at += 1
    covered = np.cumsum(edge)[:len(words)] > 0
    return [w for w, c in zip(words, covered.tolist()) if not c]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of each row; ``kept`` is the text of the words that stay.

    Words are runs without ASCII white space. A word goes if a window of ``WINDOW`` words that covers
    it also starts in a document with a smaller id. A null id is larger than all others and no
    id is smaller than its own, so rows that repeat an id don't remove each other's words, and each
    loses only the repeats of its own text. A
    null text has no words. Other columns are not read; an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    found = repeats(rows).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "repeats")).alias("found")).withColumnsRenamed(
        {"doc_id": "at_id", "key": "at_key"})
    joined = rows.join(found, (rows["key"] == found["at_key"])
                       & rows["doc_id"].eqNullSafe(found["at_id"]), "left").select(
        "doc_id", "text", "found")

    def run(batches):
        for batch in slices(batches):
            n, removed, kept = [], [], []
            for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                stay = kept_words(words, parts) if parts else words
                n.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
