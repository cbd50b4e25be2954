"""Chat formatting by token-level assembly.

Each turn's role and text are encoded by themselves; the marks between them are reserved ids
beyond the vocabulary, so no content can produce one. The loss mask comes from prefix sums of
the segments' lengths, as spans of tokens. In the formatted text a backslash after its first
character breaks every control string in content, and a backslash is doubled, which can be
undone exactly.

A turn reads ``<s>role[INST]text</s>``; a turn under the loss has ``[/INST]`` for ``[INST]``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidlens.llm.bpe import encoder
from bidlens.llm.common import slices

#: The control strings, which are reserved ids from the vocabulary's size on.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, CLOSE, BODY, LOSS_BODY = MARKS[0], MARKS[1], MARKS[2], MARKS[3]
_BREAK = re.compile(r"\\|[<\[](?=" + "|".join(re.escape(m[1:]) for m in MARKS) + ")")
_UNDO = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """The text with no control string in it: ``</s>`` becomes ``<`` + backslash + ``/s>``."""
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """What was given to ``escape``: two backslashes become one, a single one goes."""
    return _UNDO.sub(r"\1", text)


def chat_format(turns: DataFrame, vocabulary: str, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, ids, loss_spans, formatted`` of each conversation.

    ``turns`` has ``conv_id, turn, role, text``; rows go by ``turn``, a null one first, then by role
    and text; repeated rows are turns of their own. A null role or text is empty. Rows with a
    null ``conv_id`` are one conversation. Other columns are not read; no rows give none.
    ``loss_spans`` are token ranges ``first`` to before ``last``, in order, one per turn of
    ``loss_role``. A conversation is one row of the result, so it is put together in one task.
    """

    def segments(batches):
        bpe = encoder(vocabulary)
        mark = {m: np.array([len(bpe.token_bytes) + i], np.int32) for i, m in enumerate(MARKS)}
        for batch in slices(batches):
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            escaped = [[escape(x) for x in column] for column in (roles, texts)]
            heads, bodies = (bpe.encode(x, reserved=False) for x in escaped)
            ids, first, last, pieces = [], [], [], []
            for role, head, body, shown, text in zip(roles, heads, bodies, *escaped):
                between = LOSS_BODY if role == loss_role else BODY
                ids.append(np.concatenate([mark[OPEN], head, mark[between], body, mark[CLOSE]]))
                first.append(len(head) + 2)
                last.append(len(head) + 2 + len(body))
                pieces.append(OPEN + shown + between + text + CLOSE)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate(ids), pa.int32())),
                 pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(pieces, pa.string())],
                ["conv_id", "turn", "role", "text", "ids", "first", "last", "piece"])

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    parts = rows.mapInArrow(segments, "conv_id long, turn long, role string, text string, "
                                      "ids array<int>, first int, last int, piece string")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select(
        "conv_id", F.row_number().over(order).alias("at"), "ids", "piece",
        (F.col("role") == loss_role).alias("loss"), "first", "last",
        F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)).alias("offset"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "at", "ids", "piece", "loss", (F.col("offset") + F.col("first")).alias("first"),
        (F.col("offset") + F.col("last")).alias("last")))).alias("parts"))
    return whole.select(
        "conv_id", F.size("parts").cast("long").alias("n_turns"),
        F.flatten("parts.ids").alias("ids"),
        F.transform(F.filter("parts", lambda p: p["loss"]),
                    lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"))
                    ).alias("loss_spans"),
        F.array_join("parts.piece", "").alias("formatted"))


def read_back(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of what a formatted conversation says, read from its ids and spans alone."""
    import hashlib

    def run(batches):
        bpe = encoder(vocabulary)
        size = len(bpe.token_bytes)

        def said(ids) -> str:
            return unescape(bpe.decode(ids))

        for batch in batches:
            out = {k: [] for k in ("n", "turns", "chars", "loss")}
            for ids, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                ids = ids.values.to_numpy(zero_copy_only=False)
                marks = np.flatnonzero(ids >= size)
                turns = hashlib.sha256()
                for a, b, c in zip(marks[0::3], marks[1::3], marks[2::3]):
                    turns.update(f"{said(ids[a + 1:b])}\n{said(ids[b + 1:c])}\n".encode())
                loss = [said(ids[s["first"]:s["last"]]) for s in spans]
                out["n"].append(len(marks) // 3)
                out["turns"].append(turns.hexdigest())
                out["chars"].append(sum(map(len, loss)))
                out["loss"].append(hashlib.sha256("".join(loss).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["turns"], pa.string()),
                 pa.array(out["chars"], pa.int64()), pa.array(out["loss"], pa.string()), batch.column(3)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "ids", "loss_spans",
                            F.length("formatted").cast("long").alias("formatted_chars")).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
