"""Line deduplication by a tree of log templates.

A line goes down a tree of fixed depth: by its number of tokens, then by its first ``LEADING``
tokens; tokens with a digit are variable and read ``<*>``. In a leaf, a token that stays rare at its
place is a variable field too. What remains is the line's template, if at least
``CONSTANT`` of its tokens are constant, or else the line itself. Templates that occur in
``min_docs`` documents or more are dropped from all of them.

Counts of leaves are summed in each task first, so only lines of leaves that can hold a
recurring template go on, and of those each distinct line once per leaf.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import id_and_text, slices, stored

LEADING = 3
MIN_TOKENS = 2
MIN_DOCS = 10
CONSTANT = 0.5
FIELD = "<*>"
_DIGIT = re.compile(r"\d")


def parse(line: str) -> tuple[str, str] | None:
    """The leaf of a line and the line with variable tokens replaced; nothing for a short line."""
    tokens = line.split()
    if len(tokens) < MIN_TOKENS:
        return None
    if _DIGIT.search(line):
        tokens = [FIELD if _DIGIT.search(t) else t for t in tokens]
    return f"{len(tokens)} {' '.join(tokens[:LEADING])}", " ".join(tokens)


def lines_of(text: str) -> set[tuple[str, str]]:
    return {p for p in map(parse, set(text.split("\n"))) if p}


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _leaves(batches):
    """Per slice: how many of its documents have each leaf."""
    for batch in slices(batches):
        counts = Counter(leaf for text in batch.column(1).to_pylist()
                         for leaf in {x for x, _ in lines_of(text)})
        yield pa.RecordBatch.from_arrays(
            [pa.array([_hash(x) for x in counts], pa.int64()), pa.array(counts.values(), pa.int64())],
            ["leaf", "n"])


def _lines(batches):
    for batch in slices(batches):
        out = [(doc, _hash(leaf), masked) for doc, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist()) for leaf, masked in lines_of(text)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
            ["doc_id", "leaf", "line"])


def templates_of(lines: list[str], counts: list[int], min_docs: int = MIN_DOCS) -> list[str]:
    """The template of each distinct line of a leaf; ``counts``: in how many documents each is."""
    split = [x.split(" ") for x in lines]
    support = [Counter() for _ in split[0]]
    for tokens, n in zip(split, counts):
        for place, token in zip(support, tokens):
            place[token] += n
    out = []
    for line, tokens in zip(lines, split):
        form = [t if place[t] >= min_docs else FIELD for place, t in zip(support, tokens)]
        constant = sum(t != FIELD for t in form)
        out.append(" ".join(form) if constant >= CONSTANT * len(form) else line)
    return out


def _templates(batches, min_docs: int = MIN_DOCS):
    """``line, template`` for each line of rows by leaf."""
    leaf, lines, counts = None, [], []

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.string()), pa.array(templates_of(lines, counts, min_docs), pa.string())],
            ["line", "template"])

    for batch in batches:
        for x, line, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if x != leaf or lines and lines[0].count(" ") != line.count(" "):
                if lines:
                    yield done()
                leaf, lines, counts = x, [], []
            lines.append(line)
            counts.append(n)
    if lines:
        yield done()


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, line, template``: the lines of each document, variable tokens replaced, whose template
    occurs in ``min_docs`` different ids or more."""
    leaves = docs.mapInArrow(_leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    busy = stored(leaves.where(F.col("n") >= min_docs).select("leaf"), "leaves")
    lines = stored(docs.mapInArrow(_lines, "doc_id long, leaf long, line string")
                   .join(busy, "leaf", "left_semi"), "lines")
    distinct = lines.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"))
    named = stored(distinct.repartition("leaf").sortWithinPartitions("leaf", "line")
                   .mapInArrow(partial(_templates, min_docs=min_docs), "line string, template string"), "line-templates")
    found = lines.select("doc_id", "line").join(named, "line")
    often = found.select("template", "doc_id").distinct().groupBy("template").agg(
        F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("template")
    return found.join(often, "template", "left_semi").select("doc_id", "line", "template")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` of each row; ``kept`` is the text of the lines that stay.

    Lines end at a newline; those of fewer than ``MIN_TOKENS`` tokens always stay. A null text is one
    empty line. Rows that repeat an id count as one document, and so do all null ids. Other
    columns are not read; an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    found = recurring_lines(rows, min_docs).groupBy("doc_id").agg(
        F.collect_set("line").alias("found")).withColumnRenamed("doc_id", "at_id")
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["at_id"]), "left").select(
        "doc_id", "text", "found")

    def run(batches):
        for batch in slices(batches):
            n, dropped, kept = [], [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines, drop = text.split("\n"), set(drop or ())
                stay = [x for x in lines if (parse(x) or ("", None))[1] not in drop] if drop else lines
                n.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append("\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept string")
