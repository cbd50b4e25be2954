"""Token counts with overlap resynchronisation for huge documents.

A document longer than ``CHUNK`` characters is encoded in overlapping chunks with offsets. A chunk
starts at a token boundary of the one before it, and takes over where ``AGREE`` tokens on end have the same
ids and offsets in both. Such a boundary is stable: a sequence of tokens is what byte-pair merges make of a
piece exactly if each two neighbours are what they make of the two alone, and every pair of neighbours of
the spliced sequence stands in one chunk. So neither white space nor any other mark in the text is needed. If the overlap holds
no such place, it is widened, at last to all that the chunk before has not yet counted. Memory and time follow the chunk.

Other documents are a single chunk, counted by runs without white space: the vocabulary never joins text
across white space and its normalisation looks at no context beyond it, so each run is encoded once
and remembered.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from bidlens.llm.common import MEMO_WORDS, id_and_text, slices

CHUNK = 16_384
OVERLAP = 256
#: Tokens on end that two chunks must have in common where they are spliced. One proves the merges; more
#: leave room for normalisation and splitting, which look at neighbouring characters.
AGREE = 4
#: Fixed value: white space at which texts may be cut.
SPACES = " \t\n\x0b\x0c\r"
#: Runs of more bytes are counted, but not remembered.
LONG_RUN = 256


class Counter:
    """Counts the tokens of whole texts with a vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[bytes, int] = {}

    def tokens(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """``begin, end, id`` of each token of a chunk, with places in the document."""
        found = self.library.encode(text[start:end], add_special_tokens=False)
        return [(start + a, start + b, i) for (a, b), i in zip(found.offsets, found.ids)]

    def huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text, chunk by chunk; at a splice the next chunk takes over."""
        total, end = 0, min(chunk, len(text))
        here = self.tokens(text, 0, end)  # not yet counted
        begin = 0  # where this chunk, or what is left of it, starts
        while end < len(text):
            until, back = min(len(text), end + chunk), overlap
            if not text[end - back:end].strip(SPACES):  # white space all along, which nothing joins across
                total += len(here)
                here, begin, end = self.tokens(text, end, until), end, until
                continue
            while True:
                at = boundary(here, end - back)
                start = here[at][0] if at else begin
                after = self.tokens(text, start, until)
                place = splice(here, at, after)
                if place is not None or not at:
                    break
                back *= 4
            if place is None:  # no stable boundary: this stretch is encoded in one piece
                here, end = after, until
                continue
            total += place[0]
            here, end = after[place[1]:], until
            begin = here[0][0]
        return total + len(here)

    def count(self, texts: list[str]) -> list[int]:
        split = [t.encode().split() if len(t) <= CHUNK else None for t in texts]
        memo = self.memo
        words = set().union(*(w for w in split if w is not None))
        new = list(words.difference(memo))
        if len(memo) + len(new) > 2 * MEMO_WORDS:
            memo.clear()
            new = list(words)
        found = self.library.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        memo.update((w, len(e)) for w, e in zip(new, found))
        get = memo.__getitem__
        counts = [self.huge(t) if words is None else sum(map(get, words))
                  for t, words in zip(texts, split)]
        for word in new:
            if len(word) > LONG_RUN:
                del memo[word]
        return counts


def boundary(tokens: list[tuple], before: int) -> int:
    """The last token that begins at or before a place, and at the end of its neighbour; 0 if there is none.

    A character that is several tokens has no boundary inside.
    """
    at = bisect_right(tokens, before, key=lambda t: t[0]) - 1
    while at > 0 and tokens[at - 1][1] > tokens[at][0]:
        at -= 1
    return max(at, 0)


def splice(here: list[tuple], at: int, after: list[tuple]) -> tuple[int, int] | None:
    """The first tokens, of ``here`` from ``at`` on and of ``after``, from which ``AGREE`` are alike in both."""
    places = {t: j for j, t in reversed(list(enumerate(after)))}
    for i in range(max(at, 1), len(here) - AGREE + 1):
        j = places.get(here[i])
        if (j is not None and here[i - 1][1] <= here[i][0] and (j == 0 or after[j - 1][1] <= after[j][0])
                and here[i:i + AGREE] == after[j:j + AGREE]):
            return i, j
    return None


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row.

    One row per input row, repeated rows and null ids included. A null or empty text has
    0 bytes and 0 tokens. Other columns are not read.
    """

    def run(batches):
        tokens = counter(vocabulary)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            counts = tokens.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
