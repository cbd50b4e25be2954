"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both encode the same text, and their tokens tile the same bytes. Per batch, ``pandas.merge_asof`` by
document finds for each token start the other side's token that covers it; both directions together are all
overlaps. Overlaps that end at the same byte close a group. All pairs of a group are links. How many
documents hold a pair of ids is counted over the corpus: tasks send one row per distinct pair of a unit of
documents, and each unit gets the counts of its pairs back.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm import bpe, dealing
from bidlens.llm.common import id_and_text, slices, stored

#: Bytes of text whose distinct pairs are sent as one unit, and that are aligned at once.
UNIT_BYTES, STEP_BYTES = 12 << 20, 1 << 20
#: Pairs of a group beyond which its distinct ids are paired with their counts, and not each token.
LARGE_GROUP = 4096
ID_BITS = 20
FOUND = ("kind int, unit string, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, pairs binary, links binary, codes array<long>, docs array<long>")


class Pieces:
    """A sentencepiece vocabulary: the ids of texts and the bytes that each id stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _labels(n: int) -> list[str]:
    """Decimal ids with each of the marks that may follow one."""
    return [f"{i}{mark}" for i in range(n) for mark in (",", "|", ";", "")]


class Side:
    """One side's tokens of several documents: document, first and last byte, id."""

    def __init__(self, ids: list[np.ndarray], sizes: np.ndarray):
        self.ids = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        self.n = np.array([len(x) for x in ids], np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.n)
        self.end = np.cumsum(sizes[self.ids])
        self.start = self.end - sizes[self.ids]

    def frame(self, side: str) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "doc": self.doc, side: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens of ``a`` and of ``b`` with a byte in common."""
    left, right = a.frame("a"), b.frame("b")
    one, other = pd.merge_asof(left, right, on="start", by="doc"), pd.merge_asof(right, left, on="start", by="doc")
    x, y = other["a"].to_numpy(), other["b"].to_numpy()
    new = b.start[y] > a.start[x]  # tokens that start together are in both directions
    return np.concatenate([one["a"].to_numpy(), x[new]]), np.concatenate([one["b"].to_numpy(), y[new]])


def _group_numbers(side: Side, closers: np.ndarray) -> np.ndarray:
    closes = np.zeros(len(side.ids), np.int64)
    closes[closers] = 1
    return np.cumsum(closes) - closes


def _pairs(a: Side, b: Side, of_a: np.ndarray, of_b: np.ndarray, groups: int):
    """Of each link its document, ids and how often it stands for: ``doc, code, n``."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    small = n_a * n_b <= LARGE_GROUP
    # each token of a with each of its group's tokens of b
    mine = np.flatnonzero(small[of_a])
    times = n_b[of_a[mine]]
    left = np.repeat(mine, times)
    step = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
    right = at_b[of_a[left]] + step
    doc, code, n = [a.doc[left]], [(a.ids[left] << ID_BITS) | b.ids[right]], [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(~small).tolist():
        x, x_n = np.unique(a.ids[at_a[g]:at_a[g] + n_a[g]], return_counts=True)
        y, y_n = np.unique(b.ids[at_b[g]:at_b[g] + n_b[g]], return_counts=True)
        code.append(((x << ID_BITS)[:, None] | y[None, :]).ravel())
        n.append((x_n[:, None] * y_n[None, :]).ravel())
        doc.append(np.full(len(x) * len(y), a.doc[at_a[g]]))
    return np.concatenate(doc), np.concatenate(code), np.concatenate(n), n_a, n_b


def align(texts: list[str], a_vocabulary: str, b_vocabulary: str) -> list[tuple]:
    """Per text ``(n_a, n_b, n_groups, n_links, groups, codes, links)``: the groups in decimal ids, and
    its distinct pairs of ids, as ``a << ID_BITS | b``, with the number of links of each."""
    first, second = bpe.encoder(a_vocabulary), pieces(b_vocabulary)
    if max(len(first.sizes), len(second.bytes)) > 1 << ID_BITS:
        raise ValueError("vocabularies of over a million ids can't be paired")
    spaced = [" " + t for t in texts]
    a_ids, b_ids = first.encode(spaced, reserved=False), second.encode(texts)
    get, none, sizes = second.bytes.__getitem__, np.zeros(0, np.int64), np.array(first.sizes, np.int64)
    for i, (t, s) in enumerate(zip(texts, spaced)):
        raw = s.encode()
        # a's encoder only takes a text apart, so that the sum of sizes shows whether all of it is there
        if not t or sizes[a_ids[i]].sum() != len(raw) or b"".join(map(get, b_ids[i])) != raw:
            a_ids[i], b_ids[i] = none, none
    a = Side(a_ids, sizes)
    b = Side([np.asarray(x, np.int64) for x in b_ids], np.array([len(x) for x in second.bytes], np.int64))
    x, y = overlaps(a, b)
    closing = a.end[x] == b.end[y]
    of_a, of_b = _group_numbers(a, x[closing]), _group_numbers(b, y[closing])
    groups = int(closing.sum())
    doc, code, n, n_a, n_b = _pairs(a, b, of_a, of_b, groups)
    # distinct pairs of each document
    order = np.lexsort((code, doc))
    doc, code, n = doc[order], code[order], n[order]
    edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])]))[:len(doc)]
    links = np.add.reduceat(n, edge) if len(edge) else n
    doc, code = doc[edge], code[edge]
    # the tokens in the order of the groups' text, each with the mark that follows it
    place_a = np.arange(len(a.ids)) + (np.cumsum(n_b) - n_b)[of_a]
    place_b = np.arange(len(b.ids)) + np.cumsum(n_a)[of_b]
    last_a = np.append(of_a[1:] != of_a[:-1], True)[:len(of_a)]
    last_b = np.append(of_b[1:] != of_b[:-1], True)[:len(of_b)]
    end_b = np.append(b.doc[1:] != b.doc[:-1], True)[:len(of_b)]
    marked = np.empty(len(a.ids) + len(b.ids), np.int64)
    marked[place_a] = a.ids * 4 + last_a
    marked[place_b] = b.ids * 4 + np.where(end_b, 3, np.where(last_b, 2, 0))
    label = labels(max(len(first.sizes), len(second.bytes))).__getitem__
    marked, cut = marked.tolist(), np.cumsum([0, *(a.n + b.n)]).tolist()
    pairs_to = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    group_doc = a.doc[np.cumsum(n_a) - 1] if groups else none
    n_groups = np.bincount(group_doc, minlength=len(texts))
    n_links = np.bincount(group_doc, n_a * n_b, len(texts)) if groups else n_groups
    return [(int(a.n[i]), int(b.n[i]), int(n_groups[i]), int(n_links[i]),
             "".join(map(label, marked[cut[i]:cut[i + 1]])), code[pairs_to[i]:pairs_to[i + 1]],
             links[pairs_to[i]:pairs_to[i + 1]]) for i in range(len(texts))]


@lru_cache(maxsize=2)
def labels(n: int) -> list[str]:
    return _labels(n)


def _unit_rows(rows: list[tuple]) -> pa.RecordBatch:
    """One row of kind 0 per document, and one of kind 1 with the distinct pairs of all of them."""
    unit = uuid.uuid4().hex
    codes, which = np.unique(np.concatenate([np.zeros(0, np.int64), *(r[6] for r in rows)]), return_inverse=True)
    cut = np.cumsum([0, *(len(r[6]) for r in rows)])
    docs = [[r[k] for r in rows] + [None] for k in range(6)]
    packed = [dealing.pack_sorted(which[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array([0] * len(rows) + [1], pa.int32()), pa.array([unit] * (len(rows) + 1)),
        *(pa.array(x, pa.int64()) for x in docs[:5]), pa.array(docs[5], pa.string()),
        pa.array([*packed, None], pa.binary()), pa.array([*(r[7] for r in rows), None], pa.binary()),
        pa.array([None] * len(rows) + [codes], pa.list_(pa.int64())),
        pa.array([None] * len(rows) + [np.bincount(which, minlength=len(codes))], pa.list_(pa.int64()))],
        [c.split()[0] for c in FOUND.split(", ")])


def aligned(docs: DataFrame, a_vocabulary: str, b_vocabulary: str) -> DataFrame:
    """The alignment of each document and the distinct pairs of each unit of documents, as one table."""

    def run(batches):
        rows, size = [], 0
        for batch in slices(batches, STEP_BYTES):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, (n_a, n_b, n_groups, n_links, groups, codes, links) in zip(
                    ids, align(texts, a_vocabulary, b_vocabulary)):
                digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
                rows.append((doc, n_a, n_b, n_groups, n_links, digest, codes, dealing.pack(links)))
            size += batch.nbytes
            if size >= UNIT_BYTES:
                yield _unit_rows(rows)
                rows, size = [], 0
        if rows:
            yield _unit_rows(rows)

    return docs.mapInArrow(run, FOUND)


def _scores(left: pa.Table, right: pa.Table) -> pa.Table:
    """``n_best`` and ``count_sum`` of a unit's documents from the counts of its pairs."""
    order = np.argsort(right.column("at").to_numpy(), kind="stable")
    count, best = right.column("n").to_numpy()[order], right.column("best").to_numpy()[order]
    n_best, sums = [], []
    for pairs, links in zip(left.column("pairs"), left.column("links")):
        at, n = dealing.unpack_sorted(pairs.as_buffer()), dealing.unpack(links.as_buffer()).astype(np.int64)
        n_best.append(int(n[best[at]].sum()))
        sums.append(int((n * count[at]).sum()))
    keep = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return keep.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
        "count_sum", pa.array(sums, pa.int64())).append_column("groups_sha256", left.column("groups_sha256"))


def pair_counts(found: DataFrame) -> DataFrame:
    """``code, a, n, best`` of each pair of ids: in how many documents it is linked, and whether no other
    pair of its first id is in more."""
    pairs = found.where("kind = 1").selectExpr("inline(arrays_zip(codes, docs))").groupBy("codes").agg(
        F.sum("docs").alias("n")).select(
        F.col("codes").alias("code"), F.shiftright("codes", ID_BITS).alias("a"), "n")
    pairs = stored(pairs, "pairs")
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))
    return pairs.join(most, "a").select("code", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_vocabulary: str, b_vocabulary: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row.

    Both sides encode a space and the text, without special tokens. Texts that are null, empty, or whose
    tokens of a side do not join to these bytes, have no tokens: all numbers are 0 and the digest is ''.
    Groups are cut where tokens of both sides end, and all pairs of a group are links. ``count_sum`` sums over the
    links in how many rows of the table their pair of ids is linked; ``n_best`` is the number of links whose pair is
    in as many as any pair of its first id. Repeated rows count each, null ids stay, other columns are not read; an empty
    table gives no rows.
    """
    found = stored(aligned(id_and_text(docs, id_col, text_col), a_vocabulary, b_vocabulary), "aligned")
    counts = pair_counts(found).drop("a")
    spots = found.where("kind = 1").select("unit", F.posexplode("codes").alias("at", "code"))
    scored = spots.join(counts, "code").select("unit", "at", "n", "best")
    left = found.where("kind = 0").drop("kind", "codes", "docs").withColumnRenamed("unit", "of_unit")
    return left.groupBy("of_unit").cogroup(scored.groupBy("unit")).applyInArrow(
        _scores, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                 "count_sum long, groups_sha256 string")
