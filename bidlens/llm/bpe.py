"""BPE encoding and decoding by a prefix-sharing trie.

The distinct words of a slice of text are the paths of a trie. The walk goes through it
depth first and keeps, for each byte of the path, the last token of that prefix's
encoding; a prefix that words share is encoded once. The last token of a prefix is
the one suffix token that may follow the last token of what stands before it. Two tokens
may follow each other if merging their joined bytes gives just these two; that is
remembered per pair. Sorted words are the depth-first order of the trie, so the walk needs
only the path of one word in memory, however many words there are.

Texts are split by the vocabulary's own pattern, reserved strings first. Every text is
handled whole in one row; nothing is shuffled.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import MEMO_WORDS, id_and_text, slices

#: Fixed value: the pattern that splits text before the merges of byte-level vocabularies;
#: L, N and S stand for letters, digits and white space.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
#: Blocks in which every Unicode version of the last years has the same letters, digits and
#: spaces; a text with others is split by the tokenizers library's own splitter.
SETTLED = re.compile("[^\x00-ɏͰ-ͷΑ-ΡΣ-ҁ‐-⁞"
                     "₠-₿←-⏿ぁ-ゖァ-ヺ一-龥가-힣]")
PAIR = 1 << 20


@lru_cache(maxsize=1)
def word_finder():
    """``findall`` of the splitting pattern for settled texts."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "S": []}
    for c in map(chr, range(0x10000)):
        if not SETTLED.search(c):
            if regex.match(r"\s", c):
                kinds["S"].append(c)
            elif (kind := unicodedata.category(c)[0]) in "LN":
                kinds[kind].append(c)
    classes = {k: "".join(map(re.escape, v)) for k, v in kinds.items()}
    return re.compile("".join(
        classes[c] if c in classes else c for c in WORDS)).findall


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable, else the next free from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encoder and decoder of a byte-level BPE vocabulary in the tokenizers library's format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        as_bytes = lambda t: bytes(alphabet[c] for c in t)
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.reserved = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"reserved token with options: {token['content']}")
            self.reserved[token["content"]] = token["id"]
        if spec["normalizer"] or not spec["pre_tokenizer"].get("use_regex"):
            raise ValueError("only plain byte-level vocabularies can be read")
        size = max([*self.ids.values(), *self.reserved.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for t, i in [*self.ids.items(), *((t.encode(), i) for t, i in self.reserved.items())]:
            self.token_bytes[i] = t
        self.sizes = list(map(len, self.token_bytes))
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = as_bytes(a), as_bytes(b)
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.parts = {new: pair for pair, (_, new) in self.merges.items()}
        self.spines: tuple[dict, dict] = ({}, {})
        self.begun = sorted({t[:i] for t in self.ids for i in range(len(t) + 1)})
        self.states = {t: i for i, t in enumerate(self.begun)}  # 0: the empty one
        self.ends: list[list | None] = [None] * len(self.begun)
        self.steps: dict[int, int] = {}
        self.follows: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.split_words = word_finder()
        self.splitter = None
        self.at_reserved = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.reserved, key=len, reverse=True))) + ")"
        ) if self.reserved else None

    def merged(self, text: bytes) -> list[int]:
        """Plain merging by rank, for single tokens only."""
        ids = [self.ids[text[i:i + 1]] for i in range(len(text))]
        while len(ids) > 1:
            found = [(*self.merges[p], i) for i, p in enumerate(zip(ids, ids[1:]))
                     if p in self.merges]
            if not found:
                break
            rank, new, _ = min(found)
            pair_at, i, out = {i for r, _, i in found if r == rank}, 0, []
            while i < len(ids):
                if i in pair_at:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token at its first (0) or last (1) byte, each with the rank at which
        it ceases to be by merging into the next larger part."""
        found = self.spines[side].get(token)
        if found is None:
            found, x, until = [], token, float("inf")
            while True:
                found.append((x, until))
                if x not in self.parts:
                    break
                until = self.merges[self.parts[x]][0]
                x = self.parts[x][side]
            self.spines[side][token] = found
        return found

    def may_follow(self, key: int) -> bool:
        """Whether no merge joins the two tokens' parts before the tokens are complete.

        Of merges of the same rank the left one comes first.
        """
        before, token = divmod(key, PAIR)
        if not before:
            return self.merged(self.token_bytes[token]) == [token]
        merges = self.merges
        for x, x_until in self.spine(before - 1, 1):
            for y, y_until in self.spine(token, 0):
                joined = merges.get((x, y))
                if joined is not None and joined[0] < x_until and joined[0] <= y_until:
                    return False
        return True

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte: the longest end of the path that begins a token."""
        path = self.begun[state] + bytes([byte])
        while path not in self.states:
            path = path[1:]
        self.steps[state << 8 | byte] = new = self.states[path]
        if self.ends[new] is None:
            self.ends[new] = [(len(path) - i, self.ids[path[i:]]) for i in range(len(path))
                              if path[i:] in self.ids]
        return new

    def walk(self, words: list[bytes]) -> Iterator[list[int]]:
        """The ids of each of the sorted words, from one depth-first walk through their trie."""
        follows, sizes, steps, ends = self.follows, self.sizes, self.steps.get, self.ends
        last, states, path = [0], [0], b""  # of each prefix: (last token + 1) * PAIR, state
        for word in words:
            n, depth, shared = len(word), 0, min(len(word), len(path))
            if word[:shared] == path[:shared]:
                depth = shared
            else:
                while word[depth] == path[depth]:
                    depth += 1
            del last[depth + 1:], states[depth + 1:]
            state, end = states[-1], depth
            for byte in word[depth:]:
                end += 1
                found = steps(state << 8 | byte)
                state = self.step(state, byte) if found is None else found
                for size, token in ends[state]:
                    key = last[end - size] + token
                    ok = follows.get(key)
                    if ok is None:
                        ok = follows[key] = self.may_follow(key)
                    if ok:
                        break
                else:
                    raise ValueError(f"no encoding of {word[:end]!r}")
                last.append((token + 1) * PAIR)
                states.append(state)
            path, ids, end = word, [], n
            while end:
                token = last[end] // PAIR - 1
                ids.append(token)
                end -= sizes[token]
            ids.reverse()
            yield ids

    def split(self, text: str) -> list[str]:
        """Words of a text; a reserved string is a word of its own."""
        if self.at_reserved is not None and any(r in text for r in self.reserved):
            return [w for i, part in enumerate(self.at_reserved.split(text))
                    for w in ([part] if i % 2 else self.split_plain(part))]
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if text.isascii() or not SETTLED.search(text):
            return self.split_words(text)
        if self.splitter is None:
            from tokenizers.pre_tokenizers import ByteLevel
            self.splitter = ByteLevel(add_prefix_space=False, trim_offsets=False)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def learn(self, words: set[str]) -> None:
        new = sorted(w.encode() for w in words.difference(self.reserved))
        for word, ids in zip(new, self.walk(new)):
            self.memo[word.decode()] = array("i", ids).tobytes()
        for content in words.intersection(self.reserved):
            self.memo[content] = array("i", [self.reserved[content]]).tobytes()

    def encode(self, texts: list[str], reserved: bool = True) -> list[np.ndarray]:
        """Ids of each text; reserved strings in a text become reserved ids if ``reserved``."""
        split = [self.split(t) if reserved else self.split_plain(t) for t in texts]
        words = set().union(*split)
        missing = words.difference(self.memo)
        if len(self.memo) + len(missing) > MEMO_WORDS:
            missing = words
            self.memo.clear()
        self.learn(missing)
        get = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        get = self.token_bytes.__getitem__
        return b"".join(map(get, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process and vocabulary."""
    return TrieEncoder(path)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` of each row: the ids of the whole text and the text they decode to.

    One row per input row, repeated rows and null ids included. A null or empty text has no
    ids and decodes to the empty text. Other columns of the input are not read.
    """

    def run(batches):
        bpe = encoder(vocabulary)
        for batch in slices(batches):
            ids = bpe.encode(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate(ids), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat),
                 pa.array([bpe.decode(x) for x in ids], pa.string())],
                ["doc_id", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the ids and of the decoded text of each document."""
    out = encode_decode(docs, vocabulary)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
