"""Phrases, repeated bytes and aligned tokens against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bidlens.llm import alignment, collocation, dealing, suffixes
from bidlens.llm.bpe import byte_alphabet
from bidlens.llm.queries import BYTE_BPE, ORACLES, PIECES, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, keys binary"
WORDS = "new york big city runs on New York time, New York! the  the\tthe cat and the".split(" ")
DAY = " ".join(f"w{i}" for i in range(40))
ODD = [None, "", " \t\n", "a", "日本語 テキスト\U00010348 é", "x" * 3000, DAY, DAY, "tail " + DAY + " end", "the the the the the",
       "<|endoftext|> </s> a▁b", "\x00 \x85b", "ab" * 400, "xab" * 300, "z" * 120 + DAY + "z" * 60]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, repeated rows and ids, null ids, clashing columns."""
    rng = random.Random(4)
    rows = [(i, t, "en", "p", 1, None) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choices(WORDS, k=60)), rng.choice(["en", None, "de"]), None, None, None)
             for i in range(30)]
    rows += [rows[7], rows[20], (None, DAY, None, None, None, None), (None, DAY, None, None, None, None),
             (None, "other " + DAY * 2, "en", None, None, None), (6, "same id " + DAY, "en", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def found(df, *key):
    return sorted((tuple(r) for r in df.select(*key).collect()), key=repr)


def slow_collocations(rows, least, top):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", (text or "").encode().lower().decode()):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        scored = []
        for p, a in often.items():
            if any(100 * b >= 80 * a for q, b in often.items() if len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,top", [(2, 40), (5, 2000), (400, 10)])
def test_collocations_are_those_of_brute_force(odd, least, top, monkeypatch):
    monkeypatch.setattr(collocation, "SHARD_BYTES", 3000)
    rows = [(r.text, r.lang) for r in odd.select("text", "lang").collect()]
    got = collocation.collocations(odd, least, top)
    assert found(got, *got.columns) == slow_collocations(rows, least, top)


def test_collocations_of_an_empty_table(odd):
    assert collocation.collocations(odd.limit(0)).count() == 0


def test_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(1)
    for capacity in (1, 4):
        lists = []
        for _ in range(40):
            keys, counts = np.unique(np.concatenate([rng.integers(0, 100_000, 3000), rng.integers(0, 40, 200)]),
                                     return_counts=True)
            lists.append((keys, counts))
        total = Counter()
        for k, c in lists:
            total.update(dict(zip(k.tolist(), c.tolist())))
        saved, collocation.CAPACITY = collocation.CAPACITY, capacity
        try:
            kept = set(collocation.summarise(iter(lists), sum(total.values()), 100).tolist())
        finally:
            collocation.CAPACITY = saved
        assert {k for k, n in total.items() if n >= 100} <= kept
        assert len(kept) < len(total) / 10


def test_packed_numbers():
    values = np.array([0, 5, 5, 70000, (1 << 32) - 1])
    assert dealing.unpack_sorted(dealing.pack_sorted(values)).tolist() == values.tolist()
    assert dealing.unpack(dealing.pack(values)).tolist() == values.tolist()
    keys = np.unique(np.random.default_rng(2).integers(0, 2**63, 1000).astype(np.uint64) << np.uint64(1))
    short = np.unique(dealing.shortened(keys, 5))
    table = dealing.asks(3, short, np.ones(len(short), np.int64), 5)
    assert dealing.answered(table).tolist() == short.tolist()
    assert dealing.Members(short[::3])(short).tolist() == list(range(0, len(short), 3))


def slow_bytes(rows):
    first = {}
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - 49):
            w = t[p:p + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, _), (order, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < order:
                gone[p:p + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, bytearray(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [2, 5, 10_000])
def test_repeated_bytes_are_those_of_brute_force(odd, docs, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 4000)
    monkeypatch.setattr(suffixes, "HOT", hot)
    for df in (odd, docs) if hot == 5 else (odd,):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = suffixes.dedup_bytes(df)
        assert sorted(((i, n, r, s, bytearray(k)) for i, n, r, s, k in got.collect()), key=repr) == slow_bytes(rows)
    assert suffixes.dedup_bytes(odd.limit(0)).count() == 0


def test_two_stage_sorting_is_the_order_of_suffixes():
    rng = random.Random(1)
    for _ in range(200):
        width, letters = rng.choice([8, 9, 50]), rng.choice([b"ab", b"abc", bytes(range(256)), b"a"])
        base = bytes(rng.choices(letters, k=rng.randrange(1, 300)))
        text = base + base[rng.randrange(len(base)):] + base
        wanted = np.array([rng.random() < 0.6 for _ in text])
        order = suffixes.suffix_order(np.frombuffer(text, np.uint8), wanted, width).tolist()
        assert sorted(order) == np.flatnonzero(wanted).tolist()
        prefixes = [text[i:i + width] for i in order]
        assert prefixes == sorted(prefixes)


def slow_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    first, alphabet = Tokenizer.from_file(BYTE_BPE), byte_alphabet()
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    done, held = [], Counter()
    for i, t in rows:
        e = first.encode(" " + (t or ""), add_special_tokens=False)
        a = [(k, bytes(alphabet[c] for c in s)) for k, s in zip(e.ids, e.tokens)]
        b = [(k, piece(k)) for k in second.encode(t or "")]
        raw, groups = (" " + (t or "")).encode(), []
        if not t or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            done.append((i, [], [], [], Counter()))
            continue
        x, y = list(a), list(b)
        while x:
            left, right = [x.pop(0)], [y.pop(0)]
            sizes = [len(left[0][1]), len(right[0][1])]
            while sizes[0] != sizes[1]:
                side = 0 if sizes[0] < sizes[1] else 1
                (left, right)[side].append((x, y)[side].pop(0))
                sizes[side] += len((left, right)[side][-1][1])
            groups.append(([k for k, _ in left], [k for k, _ in right]))
        links = Counter((p, q) for left, right in groups for p in left for q in right)
        held.update(set(links))
        done.append((i, a, b, groups, links))
    best = {}
    for (p, _), n in held.items():
        best[p] = max(best.get(p, 0), n)
    return sorted(((i, len(a), len(b), len(g), sum(k.values()), sum(n for p, n in k.items() if held[p] == best[p[0]]),
                    sum(n * held[p] for p, n in k.items()), hashlib.sha256(";".join(
                        ",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if a else "")
                   for i, a, b, g, k in done), key=repr)


@pytest.mark.parametrize("large,unit", [(4096, 1 << 20), (3, 1000)])
def test_alignment_is_that_of_brute_force(odd, docs, large, unit, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    monkeypatch.setattr(alignment, "UNIT_BYTES", unit)
    for df in (odd, docs):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = alignment.align_documents(df, BYTE_BPE, PIECES)
        assert found(got, *got.columns) == slow_alignment(rows)
    assert alignment.align_documents(odd.limit(0), BYTE_BPE, PIECES).count() == 0


def test_the_queries_return_the_columns_of_their_contracts(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = found(QUERIES["op12_suffix_array"](spark, SMALL), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in slow_bytes(rows)), key=repr)
    assert found(QUERIES["op13_alignment"](spark, SMALL), "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                 "groups_sha256") == slow_alignment(rows)
    assert "op11_collocations" in ORACLES
