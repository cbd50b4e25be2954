"""Main text of web pages by template deduction per host.

The tokens of a page are its blocks of text, each at its path of tags and classes (digits in a
class read ``#``). Per host, a block that the same path has on ``SUPPORT`` of the pages with text, and on
``MIN_PAGES`` or more, is the template's. A path whose blocks are all the template's is part
of the template; every other path is a slot, and the text of all slots is extracted, however little
it is. A host on which nothing varies has no template, and nothing is removed.

A word list (``OTHER_TAGS``, ``OTHER_NAMES``) decides before that what is never article: menus, adverts and the
like whose text differs from page to page. Of equivalence classes of occurrence vectors only the one of
blocks on (nearly) every page is formed.

Blocks are summed in each task first as pairs of hashes; pages are joined with one row per host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import slices, stored

#: Elements, and words in class, id or role, that are not the article.
OTHER_TAGS = frozenset("nav header footer aside form script style noscript template head iframe svg "
                       "button select textarea menu dialog object canvas".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion menu nav navbar "
    "navigation header footer sidebar breadcrumb breadcrumbs cookie cookies consent notice notices "
    "banner newsletter subscribe signup login popup modal share social related comment comments "
    "respond widget toolbar copyright complementary contentinfo search".split())
#: Elements inside a line of text, and those without an end.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe")
#: What an opening tag ends if it is still open.
ENDS = {t: {t} for t in ("p", "li", "option", "tr")} | {
    "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}
BLOCKS_END_P = frozenset("article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header "
                         "hr main nav ol p pre section table ul".split())
#: Elements that do not end an open head.
IN_HEAD = frozenset("title meta link base style script noscript template head html".split())
#: A template's block is on this share of a host's pages with text, and on as many pages at least.
SUPPORT, MIN_PAGES = 0.8, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
_DIGITS = re.compile(r"\d+")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def is_other(name: str) -> bool:
    """Whether a whole class, id or role says menu, advert etc.: all its words do, numbers aside."""
    words = [w for w in re.split(r"[_/.-]+", name) if w and not w.isdigit()]
    return bool(words) and OTHER_NAMES.issuperset(words)


def scan(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """Events of a page: ``("open", path, other, "")`` for a structural element, ``("text", path,
    other, text)``, ``("break", path, other, "")`` at the edge of a block. ``other``: inside
    what is not the article."""
    stack: list[tuple[str, str, bool]] = [("", "", False)]
    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            yield "text", stack[-1][1], stack[-1][2], html.unescape(text)
            continue
        if m["tag"] is None:
            continue
        tag, attrs = m["tag"].lower(), m["attrs"]
        if tag in INLINE:
            if tag == "br":
                yield "text", stack[-1][1], stack[-1][2], " "
            continue
        if m["end"]:
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
            yield "break", stack[-1][1], stack[-1][2], ""
            continue
        ends = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS_END_P else set())
        if ends and stack[-1][0] in ends:
            stack.pop()
        if tag not in IN_HEAD and any(s[0] == "head" for s in stack):
            while stack.pop()[0] != "head":
                pass
        names = sorted({n for k, *v in _NAMES.findall(attrs)
                        for n in "".join(v).lower().split()}) if attrs else []
        _, path, other = stack[-1]
        inside = any(s[0] == "article" for s in stack) if tag == "header" else False
        other = other or (tag in OTHER_TAGS and not inside) or (
            tag not in ("html", "body") and any(map(is_other, names)))
        path = f"{path}/{tag}" + "".join("." + _DIGITS.sub("#", n.replace("/", "-")) for n in names)
        yield "open", path, other, ""
        yield "break", path, other, ""
        if tag not in VOID:
            stack.append((tag, path, other))


def blocks(page: str) -> Iterator[tuple[str, str]]:
    """Path and text of each block outside what is not the article, in page order."""
    part: list[str] = []
    at = ""
    for kind, path, other, text in scan(page):
        if kind == "text" and not other:
            part.append(text)
            at = path
        elif kind == "break":
            if block := " ".join("".join(part).split()):
                yield at, block
            part = []
    if block := " ".join("".join(part).split()):
        yield at, block


def _hash(*parts: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _counts(batches):
    """Per slice, ``place, text, host, path, pages, texts``: for each path of a host how many pages have
    it and how many blocks they have there (``text`` is null; the path '*' stands for the
    page), and for each block at a path how many pages have it (``host`` and ``path`` are null)."""
    for batch in slices(batches):
        paths: dict[tuple[str, str], list[int]] = {}
        counts: Counter = Counter()
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set(blocks(page))
            for path in {p for p, _ in found} | ({"*"} if found else set()):
                paths.setdefault((host, path), [_hash(host, path), 0, 0])[1] += 1
            for path, text in found:
                row = paths[host, path]
                row[2] += 1
                counts[row[0], _hash(text)] += 1
        none = [None] * len(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*(v[0] for v in paths.values()), *(k[0] for k in counts)], pa.int64()),
             pa.array([*([None] * len(paths)), *(k[1] for k in counts)], pa.int64()),
             pa.array([*(h for h, _ in paths), *none], pa.string()),
             pa.array([*(p for _, p in paths), *none], pa.string()),
             pa.array([*(v[1] for v in paths.values()), *counts.values()], pa.int64()),
             pa.array([*(v[2] for v in paths.values()), *none], pa.int64())],
            ["place", "text", "host", "path", "pages", "texts"])


def templates(pages: DataFrame) -> DataFrame:
    """``host, template`` of ``pages(host, html)``: the paths that hold only text of the template."""
    counts = pages.mapInArrow(
        _counts, "place long, text long, host string, path string, pages long, texts long").groupBy(
        "place", "text", "host", "path").agg(*(F.sum(c).alias(c) for c in ("pages", "texts")))
    # text on fewer pages is no template's
    counts = stored(counts.where(F.col("text").isNull() | (F.col("pages") >= MIN_PAGES)), "page-counts")
    paths = counts.where("text IS NULL")
    whole = paths.where("path = '*'").select("host", F.col("pages").alias("all_pages"))
    paths = paths.where("path <> '*'").join(whole, "host").select("place", "host", "path", "texts", "all_pages")
    fixed = counts.where("text IS NOT NULL").select("place", F.col("pages").alias("on")).join(
        paths.select("place", "all_pages"), "place").where(
        F.col("on") >= SUPPORT * F.col("all_pages")).groupBy("place").agg(F.sum("on").alias("fixed"))
    all_fixed = F.coalesce("fixed", F.lit(0)) == F.col("texts")
    found = paths.join(fixed, "place", "left").groupBy("host").agg(
        F.collect_list(F.when(all_fixed, F.col("path"))).alias("template"),
        F.max((~all_fixed).cast("int")).alias("varies"))
    return found.where("varies = 1 AND size(template) > 0").select("host", "template")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of each row of ``pages(page_id, url, html)``.

    Blocks of the article are joined by a blank line; a page without any has an empty text, as has a
    null one. Pages with a null or odd url are the host ''. Repeated rows give repeated
    results; other columns are not read; an empty table gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    # stored, its size is known, and Spark broadcasts it only if it is small
    found = stored(templates(rows.select("host", "html")), "templates")
    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "template")

    def run(batches):
        for batch in slices(batches):
            texts = ["\n\n".join(t for path, t in blocks(page) if path not in template)
                     for page, template in zip(batch.column(2).to_pylist(),
                                               (frozenset(x or ()) for x in batch.column(3).to_pylist()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    return joined.mapInArrow(run, "page_id long, url string, text string")
