"""SimHash near-duplicates by a self-join of binary tries.

Two fingerprints within ``BUDGET`` differing bits agree on at least two of six
blocks of their bits. For each choice of two blocks, fingerprints that agree there are a bucket,
and its members are a binary trie over all bits. The join goes down pairs of nodes together,
adds up the bits in which their paths differ and prunes a pair beyond the budget. A pair is also
dropped when all leaves below it are known to be linked already, so that a bucket of copies
costs little more than its size. A bucket gives one row per linked member, to its smallest
one; components over these rows are found by alternating stars.

Only distinct fingerprints take part, so a group of exact copies is one leaf.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import id_and_text, slices, stored
from bidlens.llm.components import components

WORDS = 4
SEED = 42
BUDGET = 4
#: First bit and width of the six blocks; any ``BUDGET`` bits leave two of them untouched.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Node pairs that the join holds at once.
CHUNK = 1 << 17


def fingerprint(text: str) -> int:
    """64 bits, unsigned: a bit is 1 if over half of the shingles' hashes have it.

    Words are runs without ASCII white space, A-Z in lower case. Fewer than ``WORDS`` words
    are one shingle; no words give 0.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - WORDS + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:n - 1]]).tolist()
    stops = (ends[WORDS - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of each row; ``fp`` is the fingerprint as a signed long."""

    def run(batches):
        for batch in slices(batches):
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Labels of leaves: the first leaf of what they are known to be linked with."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self.changes = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            if (x == y).all():
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label[:] = jumped
        self.changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])

    def settled(self, pairs: np.ndarray) -> np.ndarray:
        """Whether all leaves of both nodes have one label."""
        a0, a1, b0, b1 = pairs[:4]
        c = self.changes
        return (c[a0] == c[a1 - 1]) & (c[b0] == c[b1 - 1]) & (self.label[a0] == self.label[b0])


def trie_links(fps: np.ndarray, buckets: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For each leaf the first leaf of its bucket that it is linked with, over any number of links.

    ``fps`` (unsigned) are distinct and sorted within each bucket, ``buckets`` has the limits of the
    buckets. A node is a range of leaves; a row of the frontier is a pair of nodes with
    their differing bits so far. A node paired with itself stands for its inner pairs.
    """
    forest = Forest(len(fps))
    same = np.ones(len(fps), bool)
    same[buckets[:-1]] = False
    near = np.flatnonzero(same[1:] & (np.bitwise_count(fps[1:] ^ fps[:-1]) <= budget))
    forest.link(near, near + 1)
    first, last = buckets[:-1], buckets[1:]
    wide = last - first > 1
    first, last = first[wide], last[wide]
    stack = [(0, np.stack([first, last, first, last, np.zeros_like(first)]))]
    while stack:
        bit, pairs = stack.pop()
        pairs = pairs[:, ~forest.settled(pairs)]
        if pairs.shape[1] > CHUNK:
            stack += [(bit, pairs[:, CHUNK:]), (bit, pairs[:, :CHUNK])]
            continue
        a0, a1, b0, b1, _ = pairs
        ends = (a1 - a0 == 1) & (b1 - b0 == 1)
        if ends.any():  # two leaves: the rest of their bits at once
            x, y = a0[ends], b0[ends]
            linked = np.bitwise_count(fps[x] ^ fps[y]) <= budget
            forest.link(x[linked], y[linked])
            pairs = pairs[:, ~ends]
        if not pairs.shape[1]:
            continue
        a0, a1, b0, b1, bits = pairs
        am, bm = split(fps, a0, a1, bit), split(fps, b0, b1, bit)
        inner = (a0 == b0) & (a1 == b1)
        children = np.concatenate([
            np.stack([a0, am, b0, bm, bits]), np.stack([am, a1, bm, b1, bits]),
            np.stack([a0, am, bm, b1, bits + 1]),
            np.stack([am, a1, b0, bm, bits + 1])[:, ~inner]], axis=1)
        c0, c1, d0, d1, bits = children
        alive = (c0 < c1) & (d0 < d1) & (bits <= budget)
        alive &= ~((c0 == d0) & (c1 == d1) & (c1 - c0 == 1))
        stack.append((bit + 1, children[:, alive]))
    return forest.label


def split(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where in each range of sorted leaves, alike in all earlier bits, the given bit becomes 1."""
    mask = np.uint64(1 << (63 - bit))
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = (fps[np.where(open_, mid, 0)] & mask) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def bucket_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links between the smallest ids of distinct fingerprints, a star per linked group
    of a bucket."""
    keys = []
    for n, chosen in enumerate(combinations(BLOCKS, 2)):
        key = F.lit(n)
        for at, width in chosen:
            part = F.shiftrightunsigned("fp", 64 - at - width).bitwiseAND(F.lit((1 << width) - 1))
            key = key * F.lit(1 << width).cast("long") + part
        keys.append(key)
    # the unsigned order of fingerprints is the signed one with the first bit turned
    order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    rows = fps.select("fp", "node", order.alias("by"), F.explode(F.array(*keys)).alias("key"))

    def run(batches):
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if left is not None:
                table = pa.concat_tables([left, table])
            key = table.column("key").to_numpy()
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            left = table.slice(cut)
            if cut:
                yield found(table.slice(0, cut))
        if left is not None and left.num_rows:
            yield found(left)

    def found(table):
        key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        label = trie_links(fp, np.append(starts, len(fp)))
        child = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[child]), pa.array(node[label[child]])], ["a", "b"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "by").select("key", "fp", "node")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row.

    Fingerprints link at ``BUDGET`` or fewer differing bits; ``component_id`` is the smallest id
    reachable over links, itself included. A null text is empty, and an empty one has the
    fingerprint zero, linked like any other. Rows with a null id take part in nothing but get the
    component of their fingerprint. Other columns are not read; an empty table gives no rows.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    roots = components(bucket_links(distinct.where("node IS NOT NULL")))
    named = distinct.join(roots, "node", "left").select(
        "fp", F.coalesce("root", "node").alias("component_id"))
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
