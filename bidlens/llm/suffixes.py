"""Suffix-array deduplication of byte strings by two-stage sorting.

Strings of ``WIDTH`` bytes start at nearly every byte. Each has an anchor, the smallest hash of the
``GRAM``-byte runs in it, and equal strings have equal anchors. Shards of documents ask which anchors occur
more than once, and send the stretches of text that such anchors stand for. Each part of the anchors sorts
the suffixes of its stretches in two stages: those smaller than their successors are sorted directly, the
others are induced by a scan over the buckets of first bytes. Where neighbours share a prefix of ``WIDTH``
bytes, the strings that start in documents above the smallest are repeats.

A stretch that several documents of a shard have is sent once. The strings of an anchor with ``HOT`` occurrences
or more are dealt one by one by their own hash, so that the edges of a passage that very many documents share
do not meet in one part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm import dealing
from bidlens.llm.dealing import mixed
from bidlens.llm.common import id_and_text, slices
from bidlens.llm.substring import Rolling

WIDTH, GRAM = 50, 20
HOT = 10_000
#: Bytes of text in a shard and, if all of it repeats, in a part; string starts that a pass handles at once.
SHARD_BYTES, PART_BYTES, STEP = 4 << 20, 4 << 20, 1 << 19
POSITION = np.uint64((1 << 20) - 1)
NO_ID = np.iinfo(np.int64).max
UNITS = "shard long, part long, bytes binary, starts binary, owners binary"
MARKS = "shard long, part long, marks binary"

_gram = Rolling(0xC2B2AE3D27D4EB4F, GRAM)


def types(x: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors."""
    if not len(x):
        return np.zeros(0, bool)
    ends = np.flatnonzero(np.append(x[1:] != x[:-1], True))  # of the runs of equal bytes
    return np.repeat(np.append(x[ends[:-1]] < x[ends[:-1] + 1], False), np.diff(ends, prepend=-1))


def _words(padded: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    return np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,))


def sorted_directly(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``width`` bytes or a few more."""
    key = words[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    tied = np.concatenate([[False], key[1:] == key[:-1]])[:len(at)]
    for step in range(8, width, 8):
        member = tied.copy()
        member[:-1] |= tied[1:]
        m = np.flatnonzero(member)
        if not len(m):
            break
        after, key = tied[m], words[at[m] + step].astype(np.uint64)
        differs = np.flatnonzero(after[1:] & (key[1:] != key[:-1])) + 1
        if len(differs):
            group = np.cumsum(~after) - 1
            open_ = np.zeros(group[-1] + 1, bool)
            open_[group[differs]] = True
            mine = open_[group]
            order = np.lexsort((key[mine], group[mine]))
            at[m[mine]], key[mine] = at[m[mine]][order], key[mine][order]
        tied = np.zeros(len(at), bool)
        tied[m[1:]] = after[1:] & (key[1:] == key[:-1])
    return at


def suffix_order(x: np.ndarray, wanted: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The places that ``wanted`` marks, in the order of their suffixes' first ``width`` bytes.

    Besides the wanted suffixes only those are placed that the induction of a wanted one starts from.
    """
    n = len(x)
    padded = np.concatenate([x, np.zeros(width + 16, np.uint8)])
    of = np.int32 if n < 1 << 31 else np.int64
    words, smaller, index = _words(padded), types(x), np.zeros(0, of)
    # wanted, or reached from a wanted one by larger suffixes only: some wanted since the last smaller one
    stretch = np.cumsum(np.concatenate([[0], smaller[:-1]]), dtype=of) if n else index
    begin = np.flatnonzero(np.concatenate([[True], smaller[:-1]]))[:n]
    sums = np.cumsum(wanted, dtype=of)
    needed = sums > np.concatenate([np.zeros(1, of), sums])[begin][stretch] if n else wanted
    del stretch, sums
    direct = sorted_directly(words, np.flatnonzero(needed & smaller).astype(of), width)
    edges = np.searchsorted(x[direct], np.arange(257))
    # of each bucket: what earlier buckets induced into it
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and needed[n - 1]:
        induced[x[n - 1]].append(np.array([n - 1], of))  # larger than the empty suffix after it
    out = []
    for c in range(256):
        level = np.concatenate(induced[c]) if induced[c] else index
        bucket = []
        while len(level):
            bucket.append(level)
            level = level[level > 0] - 1
            level = level[(x[level] == c) & needed[level]]
        bucket.append(direct[edges[c]:edges[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        out.append(bucket)
        earlier = bucket[bucket > 0] - 1
        first = x[earlier]
        stay = (first > c) & needed[earlier]
        earlier, first = earlier[stay], first[stay]
        order = np.argsort(first, kind="stable")
        earlier, first = earlier[order], first[order]
        cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))[:len(first)]
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(first)).tolist()):
            induced[first[a]].append(earlier[a:b])
    found = np.concatenate(out) if out else index
    return found[wanted[found]]


def equal_prefix(x: np.ndarray, order: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which suffixes of ``order`` share at least ``width`` bytes with the one before."""
    words = _words(np.concatenate([x, np.zeros(width + 16, np.uint8)]))
    alike = np.arange(1, len(order))
    for step in [*range(0, width - 7, 8), width - 8]:
        alike = alike[words[order[alike] + step] == words[order[alike - 1] + step]]
    out = np.zeros(len(order), bool)
    out[alike] = True
    return out


def repeated(x: np.ndarray, wanted: np.ndarray, owner: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Of each wanted place, in the order of places, whether a smaller owner has its string."""
    order = suffix_order(x, wanted, width)
    if not len(order):
        return np.zeros(0, bool)
    index = np.cumsum(wanted, dtype=order.dtype) - 1
    mine = owner[index[order]]
    first = np.flatnonzero(~equal_prefix(x, order, width))
    least = np.repeat(np.minimum.reduceat(mine, first), np.diff(np.append(first, len(mine))))
    out = np.zeros(len(order), bool)
    out[index[order]] = mine > least
    return out


class Shard:
    """The texts of a shard one after another, by id, and the runs of strings with one anchor."""

    def __init__(self, table: pa.Table):
        rows = sorted(zip((NO_ID if i is None else i for i in table.column("doc_id").to_pylist()),
                          table.column("text").to_pylist(), table.column("copies").to_pylist()))
        parts = [t.encode() for _, t, _ in rows]
        self.ids, self.copies = [r[0] for r in rows], [r[2] for r in rows]
        self.raw = b"".join(parts)
        self.x = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum([len(p) for p in parts])
        self.begins = self.ends - [len(p) for p in parts]
        found = [self._runs(a) for a in range(0, len(self.x), STEP)]
        if found:
            self.start, self.size, self.key = (np.concatenate(part) for part in zip(*found))
        else:
            self.start, self.size, self.key = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))

    def _runs(self, a: int):
        """First place, number of strings and anchor of the runs that start in one step of the text."""
        values = self.x[a:a + STEP + WIDTH - 1].astype(np.uint64) + np.uint64(1)
        if len(values) < WIDTH:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = _gram(values)
        least = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
        reach, have = WIDTH - GRAM + 1, 1
        while 2 * have <= reach:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < reach:
            least = np.minimum(least[:have - reach], least[reach - have:])
        at = (least & POSITION).astype(np.int64)
        place = np.arange(a, a + len(at))
        doc = np.searchsorted(self.ends, place, "right")
        inside = place + WIDTH <= self.ends[doc]
        edge = np.ones(len(at), bool)
        edge[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(at)))
        first, size = first[inside[first]], size[inside[first]]
        # an anchor is a least hash, so only a hash of it is spread evenly over the parts
        return first + a, size, mixed(grams[at[first]])

    def units(self, shared: np.ndarray, hot: np.ndarray, bits: int):
        """What is sent: ``part, bytes, strings, owner`` of distinct stretches, and for each run with a
        shared anchor ``(place, strings, unit or units, whether an earlier document has it)``."""
        short = dealing.shortened(self.key, bits)
        mine = dealing.Members(shared)(short)
        is_hot = np.zeros(len(short), bool)
        is_hot[dealing.Members(hot)(short)] = True
        part = (short >> np.uint64(dealing.SENT_BITS)).astype(np.int64)
        doc = np.searchsorted(self.ends, self.start, "right")
        raw, ids, shift = self.raw, self.ids, 64 - bits
        seen: dict[tuple, tuple] = {}
        single: dict[bytes, int] = {}
        units, runs = [], []
        for s, n, p, h, d in zip(self.start[mine].tolist(), self.size[mine].tolist(), part[mine].tolist(),
                                 is_hot[mine].tolist(), doc[mine].tolist()):
            text, owner = raw[s:s + n + WIDTH - 1], ids[d]
            known = seen.get((p, text))
            if known is not None:
                runs.append((s, n, known[0], known[1] != owner))
                continue
            if not h:
                unit = len(units)
                units.append((p, text, n, owner))
            else:
                unit = []
                for i in range(n):
                    string = text[i:i + WIDTH]
                    u = single.get(string)
                    if u is None:
                        u = single[string] = len(units)
                        units.append((xxhash.xxh64_intdigest(string) >> shift, string, 1, owner))
                    unit.append(u)
            seen[p, text] = (unit, owner)
            runs.append((s, n, unit, False))
        return units, runs


def _question(bits: int):
    def ask(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(dealing.shortened(Shard(table).key, bits), return_counts=True)
        return dealing.asks(table.column("shard")[0].as_py(), keys, counts, bits)
    return ask


def _shared(table: pa.Table) -> pa.Table:
    keys = np.concatenate([dealing.unpack_sorted(k.as_buffer()) for k in table.column("keys")])
    counts = np.concatenate([dealing.unpack(c.as_buffer()) for c in table.column("counts")]).astype(np.int64)
    keys, which = np.unique(keys, return_inverse=True)
    total = np.bincount(which, counts)
    return dealing.answers(table, keys[total > 1]).append_column(
        "hot", dealing.answers(table, keys[total >= HOT]).column("keys"))


def _units_of(shard: Shard, answer: pa.Table, bits: int):
    hot = answer.select(["part", "hot"]).rename_columns(["part", "keys"])
    return shard.units(dealing.answered(answer), dealing.answered(hot), bits)


def _by_part(units: list[tuple]) -> dict[int, list[int]]:
    parts: dict[int, list[int]] = {}
    for i, unit in enumerate(units):
        parts.setdefault(unit[0], []).append(i)
    return parts


def _send(bits: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {k: [] for k in ("shard", "part", "bytes", "starts", "owners")}
        if left.num_rows and right.num_rows:
            units, _ = _units_of(Shard(left), right, bits)
            for part, which in _by_part(units).items():
                out["shard"].append(left.column("shard")[0].as_py())
                out["part"].append(part)
                out["bytes"].append(b"".join(units[i][1] for i in which))
                out["starts"].append(np.array([units[i][2] for i in which], np.int32).tobytes())
                out["owners"].append(np.array([units[i][3] for i in which], np.int64).tobytes())
        return pa.table([pa.array(out["shard"], pa.int64()), pa.array(out["part"], pa.int64()),
                         *(pa.array(out[k], pa.binary()) for k in ("bytes", "starts", "owners"))], list(out))
    return send


def _judge(table: pa.Table) -> pa.Table:
    x = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    starts = [np.frombuffer(s, np.int32) for s in table.column("starts").to_pylist()]
    owners = [np.frombuffer(o, np.int64) for o in table.column("owners").to_pylist()]
    size = np.concatenate(starts).astype(np.int64)
    ends = np.cumsum(size + WIDTH - 1)
    edge = np.zeros(len(x) + 1, np.int8)
    edge[ends - size - WIDTH + 1] += 1
    edge[ends - WIDTH + 1] -= 1
    wanted = np.cumsum(edge[:-1], dtype=np.int8) > 0
    marks = repeated(x, wanted, np.repeat(np.concatenate(owners), size))
    cut = np.cumsum([0, *(int(s.sum()) for s in starts)])
    return pa.table({"shard": table.column("shard"), "part": table.column("part"), "marks": pa.array(
        [np.packbits(marks[a:b]).tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary())})


def _cut(bits: int):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        """``right`` holds answers (without marks) and marks (without keys) of the shard."""
        if not left.num_rows:
            return _result([], [], [], [], [])
        shard = Shard(left)
        x = shard.x
        repeat = np.zeros(len(x), bool)
        if right.num_rows:
            is_mark = right.column("marks").is_valid()
            answer, marked = right.filter(is_mark.to_numpy() == False), right.filter(is_mark)  # noqa: E712
            units, runs = _units_of(shard, answer, bits)
            of = dict(zip(marked.column("part").to_pylist(), marked.column("marks").to_pylist()))
            found: list = [None] * len(units)
            for part, which in _by_part(units).items():
                size = [units[i][2] for i in which]
                flags = np.unpackbits(np.frombuffer(of[part], np.uint8), count=sum(size)).astype(bool)
                end = np.cumsum(size).tolist()
                for i, n, e in zip(which, size, end):
                    found[i] = flags[e - n:e]
            for s, n, unit, earlier in runs:
                if earlier:
                    repeat[s:s + n] = True
                elif isinstance(unit, int):
                    repeat[s:s + n] = found[unit]
                else:
                    owner = shard.ids[int(np.searchsorted(shard.ends, s, "right"))]
                    repeat[s:s + n] = [found[u][0] or units[u][3] != owner for u in unit]
        sums = np.concatenate([np.zeros(WIDTH, np.int64), np.cumsum(repeat)])
        gone = sums[WIDTH:] > sums[:-WIDTH]
        ids, n_bytes, removed, spans, kept = [], [], [], [], []
        for i, copies, a, b in zip(shard.ids, shard.copies, shard.begins.tolist(), shard.ends.tolist()):
            out = gone[a:b]
            row = (None if i == NO_ID else i, b - a, int(out.sum()),
                   int((out[1:] & ~out[:-1]).sum() + (out[:1]).sum()), x[a:b][~out].tobytes())
            for _ in range(copies):
                for column, value in zip((ids, n_bytes, removed, spans, kept), row):
                    column.append(value)
        return _result(ids, n_bytes, removed, spans, kept)
    return cut


def _result(ids, n_bytes, removed, spans, kept) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                     "kept": pa.array(kept, pa.binary())})


def _combined(batches):
    for batch in slices(batches):
        seen: dict[tuple, int] = {}
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.int64()), pa.array([k[1] for k in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], ["doc_id", "text", "copies"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of each row; ``kept`` is binary, since a cut may
    fall inside a character.

    A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a document with a smaller id,
    judged on the whole input. A null id is larger than all others (it counts as the largest long); rows that repeat
    an id, or have none, do not remove each other's bytes. A null text is empty. Other columns are not read; an
    empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    size = dealing.text_bytes(rows)
    shards, bits = 1 + size // SHARD_BYTES, dealing.part_bits(size, PART_BYTES)
    rows = rows.mapInArrow(_combined, "doc_id long, text string, copies long").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("long"))
    asked = rows.groupBy("shard").applyInArrow(_question(bits), dealing.ASK)
    answer = asked.groupBy("part").applyInArrow(_shared, dealing.ANSWER + ", hot binary")
    sent = rows.groupBy("shard").cogroup(answer.groupBy("shard")).applyInArrow(_send(bits), UNITS)
    marks = sent.groupBy("part").applyInArrow(_judge, MARKS)
    both = answer.withColumn("marks", F.lit(None).cast("binary")).unionByName(marks, allowMissingColumns=True)
    return rows.groupBy("shard").cogroup(both.groupBy("shard")).applyInArrow(
        _cut(bits), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
