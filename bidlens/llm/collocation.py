"""Phrase collocation mining: frequent word n-grams by Misra-Gries summaries, then exact counts.

Each shard of documents counts the hashes of its 1- to 4-grams and deals them to hash parts. A
part merges what the shards send into one Misra-Gries summary. Its capacity exceeds the part's mass
divided by the threshold, so the summary undercounts by less than the threshold and every frequent
n-gram is still in it. Those whose counter plus that error may reach the threshold go back to the shards
that have them, and these count them in their text, by their words, for an exact sum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidlens.llm import dealing
from bidlens.llm.common import slices, stored
from bidlens.llm.dealing import mixed

MIN_COUNT, TOP, LONGEST = 30, 2000, 4
#: Percent of a phrase's occurrences within one longer phrase from which on it is dropped.
WITHIN = 80
SCALE = 2_000_000
#: Bytes of text in a shard, and n-gram occurrences in a part; either takes about 40 bytes of memory each.
SHARD_BYTES, PART_MASS = 4 << 20, 4_000_000
#: Counters of a summary for each count of the threshold: an error of a fourth of it at most.
CAPACITY = 4
BASE = 0x9E3779B97F4A7C15
LOWER_SPLIT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\x0d",
                              b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
RUN_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hash_words(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges of ``x``, by sums over runs of about ``RUN_BYTES``."""
    out, a = np.empty(len(starts), np.uint64), 0
    up = down = np.zeros(0, np.uint64)
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + RUN_BYTES)))
        lo, hi = int(starts[a]), int(ends[b - 1])
        if hi - lo >= len(up):
            up, down = _powers(BASE, hi - lo + 1), _powers(pow(BASE, -1, 1 << 64), hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((x[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        out[a:b] = (sums[ends[a:b] - lo] - sums[starts[a:b] - lo]) * down[starts[a:b] - lo]
        a = b
    return mixed(out)


class Shard:
    """The words of some texts: where they are in ``x``, their piece, language, weight and hash."""

    def __init__(self, texts: list[str], langs: list[str], weights: list[int]):
        parts = [t.encode().translate(LOWER_SPLIT) for t in texts]
        self.raw = b"\n".join(parts)
        x = np.frombuffer(self.raw, np.uint8)
        inner = np.zeros(len(x) + 2, np.int8)
        inner[1:-1] = (x != 32) & (x != 10)
        edge = np.diff(inner)
        of = np.int32 if len(x) < 1 << 31 else np.int64
        self.x, self.starts, self.ends = x, np.flatnonzero(edge == 1).astype(of), np.flatnonzero(edge == -1).astype(of)
        del inner, edge
        self.piece = np.cumsum(x == 10, dtype=np.int32)[self.starts]
        self.names = sorted(set(langs))
        code = {name: i for i, name in enumerate(self.names)}
        begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
        doc = np.searchsorted(begins, self.starts, "right") - 1
        self.lang = np.array([code[name] for name in langs], np.int32)[doc]
        self.weight = np.array(weights, np.int64)[doc]
        self.plain = not (self.weight > 1).any()
        self.hash = hash_words(x, self.starts, self.ends)
        seeds = hash_words(*self._joined(self.names))
        self.seed = seeds[self.lang]

    @staticmethod
    def _joined(names: list[str]):
        ends = np.cumsum([len(n.encode()) + 1 for n in names])
        return (np.frombuffer("\n".join([*names, ""]).encode(), np.uint8),
                np.concatenate([[0], ends[:-1]]), ends)

    def grams(self):
        """``size, keys, at`` for 1- to ``LONGEST``-grams: hashes, and the numbers of their first words."""
        key, at = mixed(self.hash ^ self.seed), np.arange(len(self.hash), dtype=self.starts.dtype)
        for size in range(1, LONGEST + 1):
            if size > 1:
                inside = at < len(self.piece) - size + 1
                at, key = at[inside], key[inside]
                ok = self.piece[at] == self.piece[at + size - 1]
                at, key = at[ok], key[ok]
                key = mixed(key * np.uint64(BASE) + self.hash[at + size - 1])
            yield size, key, at


def _columns(table: pa.Table):
    return (table.column("text").to_pylist(), table.column("lang").to_pylist(),
            table.column("weight").to_pylist())


def _question(bits: int):
    def ask(table: pa.Table) -> pa.Table:
        shard = Shard(*_columns(table))
        found = [(dealing.shortened(key, bits), None if shard.plain else at) for _, key, at in shard.grams()]
        keys = np.concatenate([k for k, _ in found])
        if shard.plain:
            del found
            keys, counts = np.unique(keys, return_counts=True)
        else:
            order = np.argsort(keys)
            keys, weight = keys[order], shard.weight[np.concatenate([a for _, a in found])][order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[:len(keys)]
            keys, counts = keys[first], np.add.reduceat(weight, first)
        return dealing.asks(table.column("shard")[0].as_py(), keys, counts, bits)
    return ask


def merge_summaries(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Summaries, one after another, as one of ``capacity`` counters; by how much it was lowered."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[:len(keys)]
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    if len(keys) <= capacity:
        return keys, counts, 0
    less = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    stay = counts > less
    return keys[stay], counts[stay] - less, less


def summarise(lists, mass: int, min_count: int) -> np.ndarray:
    """The sorted keys that may occur ``min_count`` times, from ``(keys, counts)`` of mass ``mass``.

    Each lowering by ``d`` takes ``d`` from more than ``capacity`` counters, so all of them together are
    less than ``mass / capacity``.
    """
    capacity = CAPACITY * mass // min_count + 1
    keys, counts, error, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, []
    size = 0
    for k, c in lists:
        waiting.append((k, c))
        size += len(k)
        if size > capacity:
            keys, counts, less = merge_summaries(
                np.concatenate([keys, *(k for k, _ in waiting)]),
                np.concatenate([counts, *(c for _, c in waiting)]), capacity)
            error, waiting, size = error + less, [], 0
    keys, counts, less = merge_summaries(np.concatenate([keys, *(k for k, _ in waiting)]),
                                         np.concatenate([counts, *(c for _, c in waiting)]), capacity)
    return keys[counts + error + less >= min_count]


def _summary(min_count: int):
    def judge(table: pa.Table) -> pa.Table:
        counts = [dealing.unpack(c.as_buffer()).astype(np.int64) for c in table.column("counts")]
        keys = (dealing.unpack_sorted(k.as_buffer()) for k in table.column("keys"))
        wanted = summarise(zip(keys, counts), int(sum(map(np.sum, counts))), min_count)
        return dealing.answers(table, wanted)
    return judge


def _same_bytes(x: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the ``n`` bytes at ``a`` and at ``b`` are equal."""
    out, i, total = np.ones(len(a), bool), 0, np.cumsum(n)
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + RUN_BYTES)))
        m = n[i:j]
        begin = np.cumsum(m) - m
        step = np.arange(int(m.sum())) - np.repeat(begin, m)
        differ = x[np.repeat(a[i:j], m) + step] != x[np.repeat(b[i:j], m) + step]
        out[i:j] = np.add.reduceat(differ, begin) == 0
        i = j
    return out


def _exact(bits: int):
    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[tuple[int, int, bytes], int] = {}
        if not left.num_rows:
            return _counted(out, [])
        shard = Shard(*_columns(left))
        for code, n in enumerate(np.bincount(shard.lang, shard.weight, len(shard.names)).tolist()):
            out[code, 0, b""] = int(n)
        wanted = dealing.Members(dealing.answered(right))
        raw, starts, ends = shard.raw, shard.starts, shard.ends

        def phrase(at: int, size: int) -> bytes:
            text = raw[starts[at]:ends[at + size - 1]]
            return b" ".join(text.split(b" ")) if b"  " not in text else b" ".join(
                w for w in text.split(b" ") if w)

        for size, keys, at in shard.grams():
            stay = wanted(dealing.shortened(keys, bits))
            keys, at = keys[stay], at[stay]
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[:len(keys)]
            of = np.repeat(at[first], np.diff(np.append(first, len(keys))))
            n = ends[at + size - 1] - starts[at]
            same = (n == ends[of + size - 1] - starts[of]) & (shard.lang[at] == shard.lang[of])
            same[same] = _same_bytes(shard.x, starts[at[same]], starts[of[same]], n[same])
            weight = shard.weight[at]
            sums = np.add.reduceat(np.where(same, weight, 0), first) if len(first) else weight
            for i, total in zip(at[first].tolist(), sums.tolist()):
                k = (int(shard.lang[i]), size, phrase(i, size))
                out[k] = out.get(k, 0) + total
            for i in np.flatnonzero(~same).tolist():  # other blanks between the words, or an equal hash
                k = (int(shard.lang[at[i]]), size, phrase(int(at[i]), size))
                out[k] = out.get(k, 0) + int(weight[i])
        return _counted(out, shard.names)
    return count


def _counted(out: dict, names: list[str]) -> pa.Table:
    return pa.table({"lang": pa.array([names[k[0]] for k in out], pa.string()),
                     "size": pa.array([k[1] for k in out], pa.int32()),
                     "phrase": pa.array([k[2].decode() for k in out], pa.string()),
                     "n": pa.array(list(out.values()), pa.int64())})


def _combined(batches):
    """Equal texts of a slice as one row with their number, so that no group of copies is heavy."""
    for batch in slices(batches):
        seen: dict[tuple, int] = {}
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], ["lang", "text", "weight"])


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, size, phrase, n`` of all phrases of 1 to 4 words that occur ``min_count`` times in a
    language; size 0 holds each language's number of words."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    size = dealing.text_bytes(rows)
    shards, bits = 1 + size // SHARD_BYTES, dealing.part_bits(size / 2, PART_MASS)
    rows = rows.mapInArrow(_combined, "lang string, text string, weight long").withColumn(
        "shard", F.pmod(F.xxhash64("text", "lang"), F.lit(shards)).cast("long"))
    asked = rows.groupBy("shard").applyInArrow(_question(bits), dealing.ASK)
    wanted = asked.groupBy("part").applyInArrow(_summary(min_count), dealing.ANSWER)
    counted = rows.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(
        _exact(bits), "lang string, size int, phrase string, n long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where(
        f"size = 0 OR n >= {int(min_count)}")


def _inner(counts: DataFrame) -> DataFrame:
    """Per phrase the most occurrences of a longer phrase that holds it."""
    words = F.split("phrase", " ")
    spots = [(i, n) for n in range(2, LONGEST) for i in range(LONGEST - n + 1)]
    spots = F.array(*(F.when(F.col("size") >= i + n, F.array_join(F.slice(words, i + 1, n), " "))
                      for i, n in spots))
    longer = counts.where("size > 2").select("lang", "n", "phrase", F.explode(spots).alias("inner"))
    return longer.where("inner <> phrase").groupBy("lang", F.col("inner").alias("phrase")).agg(
        F.max("n").alias("longer"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to 4 words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut that scores lowest
    (the earliest of several), ``n`` the language's words and ``score`` is ``SCALE * a / (l + r)``, rounded down.
    Texts are lower-cased (A-Z) and cut at ``[.,;:!?]`` and line ends; phrases stay within the pieces. A phrase goes
    if ``WITHIN`` percent of its occurrences or more lie in one longer phrase. A null text is
    empty, a null language is ``und``; equal rows count each. Ties go to the higher count, then to the smaller phrase in
    bytes. Other columns are not read; tables without a frequent phrase give no rows.
    """
    counts = stored(phrase_counts(docs, min_count), "phrases")
    wide = "decimal(20,0)"
    found = counts.where("size > 1").withColumnRenamed("n", "a").join(
        _inner(counts), ["lang", "phrase"], "left").where(
        f"longer IS NULL OR cast(longer AS {wide}) * 100 < cast(a AS {wide}) * {WITHIN}").drop("longer")
    cuts = found.select("lang", "phrase", "size", "a", F.expr("explode(sequence(1, size - 1)) AS k"))
    parts = cuts.selectExpr(
        "lang", "phrase", "a", "k", "inline(array(struct(true, substring_index(phrase, ' ', k)), "
        "struct(false, substring_index(phrase, ' ', k - size)))) AS (first, part)")
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), "n")
    scored = parts.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("n"))).alias("l"), F.max(F.when(~F.col("first"), F.col("n"))).alias("r"))
    scored = scored.withColumn("score", F.expr(
        f"cast(a AS {wide}) * {SCALE} div (cast(l AS {wide}) + cast(r AS {wide}))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
