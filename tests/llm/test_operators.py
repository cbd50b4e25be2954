"""Every operator against the library it must agree with or a brute-force version."""

import hashlib
import html
import random
import re
import time

import duckdb
import numpy as np
import pytest

from bidlens.llm import (
    bpe, chat, decontaminate, exactdedup, htmltext, linededup, quality, simhash, substring, tokencount,
)
from bidlens.llm.components import components
from bidlens.llm.queries import BYTE_BPE, ORACLES, QUERIES, WORD_BPE

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, keep_id long, words string"
DAY = " ".join(f"w{i}" for i in range(80))
ODD = [None, "", " \t\n", "a", "don't  stop now क़\U00010348 ꟑ", "日本語 123<|endoftext|>x",
       "x" * 5000, DAY, DAY, "tail " + DAY + " end", "\x1c a\x85b", "</s>[INST] \\ <\\/s>"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, a repeated row, a null id, clashing columns."""
    rows = [(i, t, "en", "s", 7, "w") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[8], (None, DAY, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def found(df, *key):
    return sorted((tuple(r) for r in df.select(*key).collect()), key=repr)


def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_bpe_is_the_librarys(spark, odd, docs):
    library = tokenizer(BYTE_BPE)
    for df in (odd, docs):
        got = {(r.doc_id, r.decoded): r.ids for r in bpe.encode_decode(df, BYTE_BPE).collect()}
        for i, t in texts(df):
            want = library.encode(t, add_special_tokens=False).ids
            assert got[i, library.decode(want, skip_special_tokens=False)] == want
    rng, encoder = random.Random(5), bpe.TrieEncoder(BYTE_BPE)
    for _ in range(300):
        t = "".join(rng.choice("abcdeinrst  '1é") for _ in range(80))
        assert encoder.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_token_counts_are_the_librarys(odd, docs):
    library = tokenizer(WORD_BPE)
    for df in (odd, docs):
        got = found(tokencount.token_counts(df, WORD_BPE), "doc_id", "n_bytes", "n_tokens", "over_limit")
        want = [(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 2048)
                for i, t in texts(df)]
        assert got == sorted(want, key=repr)


@pytest.mark.parametrize("text", [DAY * 20, "x" * 3000 + " y" + "z1" * 2000, "q" * 999, "é \n" * 700])
def test_huge_documents_are_spliced_right(text):
    counter = tokencount.Counter(WORD_BPE)
    want = len(counter.library.encode(text, add_special_tokens=False).ids)
    assert counter.huge(text, 100, 10) == counter.huge(text, 400, 40) == want


@pytest.mark.parametrize("text", [
    "\u4e2d\u6587\u8bcd\u5178\u6d4b\u8bd5\u7684\u662f" * 300, "x" * 5000, "ab" * 2500 + "'s" * 900, "''s" * 1500, "e\u0301" * 1500,
    "<|endoftext|>" * 300, "\U0001f600\U0001f3fd" * 900, "7" * 3000, "Zm9vYmFyYmF6" * 400, " " * 3000, "a b c d e" + " " * 3000 + "f\n" * 900, "a" + "\u0301" * 2000])
def test_splices_need_no_white_space(text):
    counter = tokencount.Counter(WORD_BPE)
    want = len(counter.library.encode(text, add_special_tokens=False).ids)
    assert [counter.huge(text, c, o) for c, o in ((97, 7), (300, 20), (1024, 64))] == [want] * 3


def test_random_texts_are_spliced_right():
    counter, draw = tokencount.Counter(WORD_BPE), random.Random(5)
    for alphabet in ("ab", "aeinrst'", "the'sS \n", "\u4e2d\u6587\u7684", "a1-.'", "\u00e9e\u0301 \uac00\u1100\u1161"):
        for _ in range(30):
            text = "".join(draw.choices(alphabet, k=draw.randint(200, 1500)))
            want = len(counter.library.encode(text, add_special_tokens=False).ids)
            assert counter.huge(text, 120, 12) == want


def test_time_without_white_space_is_linear():
    counter, draw = tokencount.Counter(WORD_BPE), random.Random(7)
    text = "".join(draw.choices("\u4e2d\u6587\u8bcd\u5178\u6d4b\u8bd5\u7684\u662fabcdefgh", k=2_000_000))
    began = time.perf_counter()
    want = len(counter.library.encode(text, add_special_tokens=False).ids)
    whole = time.perf_counter() - began
    began = time.perf_counter()
    assert counter.count([text]) == [want] and not counter.memo
    assert time.perf_counter() - began < 3 * whole


def test_long_runs_are_not_remembered():
    counter = tokencount.Counter(WORD_BPE)
    counter.count(["w" * 300 + " short", "w" * 300])
    assert list(counter.memo) == [b"short"]


def brute_components(fps):
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j]).count("1") <= 4:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fps))]


def slow_fingerprint(text):
    import xxhash

    words = [w for w in re.split("[\x20\x09-\x0d]+", text.encode().lower().decode()) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(odd, docs):
    for df in (odd.where("doc_id IS NOT NULL"), docs):
        rows = sorted(set(texts(df)))
        fps = [slow_fingerprint(t) for _, t in rows]
        want = sorted((rows[i][0], f"{fps[i]:016x}", rows[c][0]) for i, c in enumerate(brute_components(fps)))
        got = found(simhash.near_groups(df).distinct(), "doc_id", "fingerprint", "component_id")
        assert got == sorted(want, key=repr)


def test_trie_join_of_close_and_random_fingerprints():
    rng = np.random.default_rng(3)
    fps = set()
    for base in rng.integers(0, 2**63, 6).tolist():
        for _ in range(25):
            x = base
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    got = simhash.trie_links(np.array(fps, np.uint64), np.array([0, len(fps)]))
    assert got.tolist() == brute_components(fps)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (1, 0)]
    got = dict(found(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}}


def test_exact_groups_by_sql_and_with_odd_rows(spark, odd):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exactdedup.exact_groups(odd).collect()}
    assert {(7, 7, 4, True), (8, 7, 4, False), (None, 7, 4, False), (0, 0, 2, True), (1, 0, 2, False)} <= got
    assert exactdedup.exact_groups(odd).count() == odd.count()


def test_exact_groups_when_digests_clash(spark, odd, monkeypatch):
    want = found(exactdedup.exact_groups(odd), "doc_id", "keep_id", "group_size", "kept")
    monkeypatch.setattr(exactdedup.F, "sha2", lambda c, n: exactdedup.F.lit("same"))
    assert found(exactdedup.exact_groups(odd), "doc_id", "keep_id", "group_size", "kept") == want


def test_overlaps_are_those_of_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    words = lambda t: [w for w in re.split(r"[^\w]+|_", t.lower()) if w]
    planted = bench.first().text.split()
    planted[2], planted[9] = "other", "words"
    more = spark.createDataFrame([(10**6, "so " + " ".join(planted) + " on", None), (10**6 + 1, None, None),
                                  (None, " ".join(planted), None)], "doc_id long, text string, item_id long")
    df = docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    items = [(r.item_id, words(r.text)) for r in bench.collect()]
    want = set()
    for i, t in texts(df):
        d = words(t)
        for item, w in items:
            n = min(13, len(w))
            for shift in range(1 - len(w), len(d)):
                alike = [0 <= j + shift < len(d) and d[j + shift] == x for j, x in enumerate(w)]
                if sum(alike) >= 11 and max(sum(alike[s:s + n]) for s in range(len(w) - n + 1)) >= 0.8 * n:
                    want.add((i, item))
    got = found(decontaminate.overlaps(df, bench), "doc_id", "item_id")
    assert got == sorted(want, key=repr) and (10**6, bench.first().item_id) in want
    clean = {r.doc_id for r in decontaminate.clean_documents(df, bench).collect()}
    assert clean == {i for i, _ in texts(df)} - {i for i, _ in want}


def brute_substrings(rows):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = t.encode().split()
        covered = [False] * len(w)
        for s in range(len(w) - 49):
            owner = first.setdefault(tuple(w[s:s + 50]), i)
            if owner != i:
                covered[s:s + 50] = [True] * 50
        out.append((i, len(w), sum(covered), b" ".join(x for x, c in zip(w, covered) if not c).decode()))
    return sorted(out, key=repr)


def test_substrings_are_those_of_brute_force(odd, docs):
    for df in (odd, docs):
        got = found(substring.dedup_substrings(df), "doc_id", "n_words", "n_removed", "kept")
        assert got == brute_substrings(texts(df))


def test_rows_without_an_id_lose_only_their_own_repeats(spark):
    own = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, DAY), (None, own("a", 30) + " " + DAY), (None, own("b", 200)), (None, None),
            (5, own("c", 10) + " " + DAY + " " + own("d", 90)), (5, own("e", 150)), (5, own("e", 150))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(substring.dedup_substrings(df), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute_substrings([(i, t or "") for i, t in rows])
    assert (None, 200, 0, own("b", 200)) in got and (None, 110, 80, own("a", 30)) in got


PAGE = """<html><head><title>x</title></head><body><header>H</header><nav><a>m {n}</a></nav>
<div class="cookie-notice">c</div><div id=wrap><main><h1>T{n} &amp; t</h1><p>a <b>b</b>&nbsp;c<p>d{n}
<form>f</form><div class="comments">zz</div></main><aside>s</aside></div>
<script>if (a<b) "</p>"</script><footer>f</footer></body>"""


def test_main_text(spark):
    rows = [(n, "http://A.example/x", PAGE.replace("{n}", str(n)), 1) for n in range(5)]
    rows += [(9, None, None, 1), (10, "odd", "", 1), (11, "http://b.example", "plain &lt; text", 1), rows[0]]
    got = found(htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, slot int")),
                "page_id", "text")
    page = "T{0} & t\n\na b c\n\nd{0}"
    assert got == sorted([*((n, page.format(n)) for n in (0, 0, 1, 2, 3, 4)), (9, ""), (10, ""),
                          (11, "plain < text")], key=repr)


def main_texts(spark, pages):
    rows = [(n, f"http://h.example/{n}", page) for n, page in enumerate(pages)]
    return [t for _, t in found(htmltext.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text")]


def test_title_and_lead_outside_the_body_div_stay(spark):
    page = ("<html><body><article><h1>T{n}</h1><p>Lead {n}</p><div class=body>" + "<p>long {n} text</p>" * 9
            + "</div></article></body></html>")
    got = main_texts(spark, [page.replace("{n}", str(n)) for n in range(5)])
    assert got == ["\n\n".join([f"T{n}", f"Lead {n}", *[f"long {n} text"] * 9]) for n in range(5)]


def test_template_text_goes_and_odd_pages_do_no_harm(spark):
    page = ("<html><head><meta a=b><body class=has-sidebar><div class=x1>All rights</div><article class='post-{n} "
            "comments-open no-comments'><p>story {n}</div></article></body></html>")
    got = main_texts(spark, [page.replace("{n}", str(n)) for n in range(8)] + [None, ""])
    assert got == [*(f"story {n}" for n in range(8))] + ["", ""]


def test_pages_that_are_all_alike_keep_their_text(spark):
    assert main_texts(spark, ["<body><article><p>same</article>"] * 4) == ["same"] * 4


def test_main_text_of_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for page, text in zip(pages.collect(), htmltext.main_text(pages).collect()):
        inside = re.search("<article>(.*)</article>", page.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", inside)
        assert text.text.split() == html.unescape(plain).split()


def test_lines_that_recur_are_dropped(spark):
    rows = [(i, f"Copyright 20{i} by owner{i} Ltd , all rights\nonly here {chr(97 + i)} {i}x end of it\nok", "x")
            for i in range(10, 22)] + [(1, None, "x"), (2, "", "x"), (3, "ok", "x")]
    got = found(linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, line string")),
                "doc_id", "n_lines", "n_dropped", "kept")
    assert [r[2] for r in got if r[0] >= 10] == [1] * 12 and (1, 1, 0, "") in got
    assert all(r[3] == f"only here {chr(97 + r[0])} {r[0]}x end of it\nok" for r in got if r[0] >= 10)


def test_short_lines_and_few_documents(spark):
    rows = [(i, f"And ornd.\nbuy a big {w} today here\n{w}my own {w}{w} lines") for i, w in enumerate("abcd")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(linededup.dedup_lines(df, min_docs=4), "doc_id", "n_lines", "n_dropped")
    assert got == [(i, 3, 2) for i in range(4)]
    assert linededup.dedup_lines(df).where("n_dropped > 0").count() == 0


def test_a_template_needs_enough_documents(spark):
    one = spark.createDataFrame([(1, "\n".join(f"row number {i} of one list" for i in range(50)))],
                                "doc_id long, text string")
    assert linededup.dedup_lines(one).first().n_dropped == 0


def brute_logp(train, text):
    """Interpolated modified Kneser-Ney over character trigrams, written out plainly."""
    from collections import Counter, defaultdict

    def grams(t):
        u = ["\0", "\0", *t]
        return [tuple(u[i:i + 3]) for i in range(len(t))]

    c3 = Counter(g for t in train for g in grams(t))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)
    tables = []
    for c in (c1, c2, c3):
        n = Counter(c.values())
        y = n[1] / max(1, n[1] + 2 * n[2])
        d = [0] + [max(0.05, min(k, k - (k + 1) * y * n[k + 1] / max(1, n[k]))) for k in (1, 2, 3)]
        ctx = defaultdict(list)
        for g, v in c.items():
            ctx[g[:-1]].append(v)
        tables.append((c, d, ctx))
    total = 0.0
    for g in grams(text):
        p = 1 / (len(c1) + 1)
        for k, (c, d, ctx) in enumerate(tables):
            q = g[2 - k:]
            if ctx.get(q[:-1]):
                v = ctx[q[:-1]]
                p = (c[q] - d[min(c[q], 3)]) / sum(v) + sum(d[min(x, 3)] for x in v) / sum(v) * p
        total -= float(np.log(p))
    return total / len(text)


def test_perplexity_is_kneser_neys(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["the ", "of ", "and ", "ing ", "x"]) for _ in range(40)), "en", 1)
            for i in range(30)]
    odd = [(100, "THE!! OF", "en", 1), (101, None, "en", 1), (102, "", "en", 1), (103, "text", "zz", 1),
           (104, "the of", None, 1), (None, "and ing", "en", 1)]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string, shard int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(25, 0, 0), (26, 1, 1), (27, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    train = [t for i, t, _, _ in rows if i < 20]
    for i, t, lang, _ in [*rows, *odd]:
        if t and lang == "en":
            assert got[i].log_perplexity == pytest.approx(brute_logp(train, t), abs=1e-9)
        else:
            assert got[i].log_perplexity is None and not got[i].rejected
    assert got[100].rejected and len(got) == len(rows) + len(odd)


def test_quality_on_held_out_labels(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    got = {(r.quality, r.rejected): r["count"] for r in out.groupBy("quality", "rejected").count().collect()}
    assert got.get((1, True), 0) <= 0.06 * (got.get((1, True), 0) + got[1, False])
    assert got[0, True] >= 0.5 * (got[0, True] + got.get((0, False), 0))


def test_few_trusted_documents_set_no_limit_below_other_clean_text(spark):
    rng, words = random.Random(4), ["the", "of", "and", "ing", "lake", "stone", "river", "moon", "query", "jazz"]

    def text():
        return " ".join("".join(rng.sample(words, 2)) for _ in range(rng.randint(8, 60)))

    trusted = {"one": 1, "three": 3, "copies": 12, "some": 20}
    rows, labels = [], []
    for lang, n in trusted.items():
        same = text()
        for k in range(n + 60):
            rows.append((len(rows), same if lang == "copies" and k < n else text(), lang))
            labels += [(rows[-1][0], 1, 0)] if k < n else []
        rows.append((-len(rows), "#@! QXZ ||| %%% " * 5, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {r.lang for r in out if r.max_log_perplexity is not None} == {"some"}
    assert all(r.log_perplexity is not None for r in out)
    for lang in trusted:
        assert sum(r.rejected for r in out if r.lang == lang and r.doc_id >= 0) <= 3
    assert [r.rejected for r in out if r.lang == "some" and r.doc_id < 0] == [True]


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\/s>", "[[INST]", "<<s>", "a\\\\</s>\\", "", None, "<|endoftext|>"]
    rows = [(1, n, "assistant" if n % 2 else "user", t) for n, t in enumerate(nasty)]
    rows += [(2, None, None, "x"), (2, 1, "assistant", "y"), (2, 1, "assistant", "y"), (None, 0, "user", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat.chat_format(turns, BYTE_BPE)
    got = {r.conv_id: r for r in chat.read_back(whole, BYTE_BPE).collect()}
    said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows[:9])
    loss = "".join(r[3] or "" for r in rows[:9] if r[2] == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[2].n_turns == 3 and got[2].loss_chars == 2 and got[None].n_turns == 1
    for t in nasty:
        assert not any(m in chat.escape(t or "") for m in chat.MARKS)
        assert chat.unescape(chat.escape(t or "")) == (t or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = QUERIES[name](spark, SMALL)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert found(got, *got.columns) == sorted(want, key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(docs, BYTE_BPE).count() == 0
    assert simhash.near_groups(docs).count() == 0
    assert tokencount.token_counts(docs, WORD_BPE).count() == 0
    assert exactdedup.exact_groups(docs).count() == 0
    assert substring.dedup_substrings(docs).count() == 0
    assert linededup.dedup_lines(docs).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(docs, bench).count() == 0
    assert quality.classify(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    assert htmltext.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_format(turns, BYTE_BPE).count() == 0


def test_pipeline_keeps_what_its_operators_say(spark):
    import corpus_pipeline as p

    got = {r.doc_id for r in p.run(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bad = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
           .where("rejected").collect()}
    left = [(i, t) for i, t in sorted(texts(docs)) if i not in bad]
    seen, unique = set(), []
    for i, t in left:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in seen:
            seen.add(key)
            unique.append((i, t))
    label = brute_components([slow_fingerprint(t) for _, t in unique])
    near = {unique[i][0] for i, c in enumerate(label) if i == c}
    leaks = {r.doc_id for r in decontaminate.overlaps(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert got == near - leaks and p.ORACLE_SQL is None and [n for n, _ in p.STAGES]
