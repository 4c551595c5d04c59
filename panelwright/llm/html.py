"""Main text of HTML pages by the maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score above zero and tags below, by
weights learned from labelled pages; one linear scan finds the contiguous run of the
highest score.  Elements that never hold the article (menus, forms, scripts,
adverts, comments and so on, by name, role or class) are taken out before the scan.  A
class tells so as a whole word, or as a compound of such words and words of layout
(``ad-slot``, ``site-footer``), not by a part of it (``with-sidebar``, ``related-work``);
and no other element than menus, footers, asides, scripts and readers' remarks goes if
it holds the mark of an article or most of the page's words.  The run is then widened to whole blocks, or to all
elements marking an article that it covers words of.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.tables import rest

LABELLED = 2000  # pages the weights are fitted on, at most (as the mean of the draw)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*+>?|(?P<text>[^<]++|<)", re.S
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)

# fixed values: element names
RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NEVER = RAW | {"head", "title", "nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "object", "dialog", "menu", "audio", "video", "math"}
BESIDE = RAW | {"head", "nav", "footer", "aside", "select", "menu", "dialog"}  # whatever they hold
MARKS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# fixed values: words of class, id and role that tell of something beside the article
ASIDE = set(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup "
    "promo promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "teaser toolbar widget".split()
)
# fixed values: words of layout that may stand beside those in a compound name
LAYOUT = set(
    "area article articles bar block blocks bottom box btn button buttons col column container content count entry feed field footer form group header "
    "icon icons inner item items label left link links list main media middle outer page panel post posts right row section site slot "
    "thread title top unit wrap wrapper zone".split()
)
OUTER = {"header", "alert"}  # tell of it only outside an article
REMARKS = {"comment", "comments", "reply", "replies", "ad", "advert", "advertisement", "sponsored", "promo", "related", "teaser"}


def _tells(names: str, of: set[str]) -> bool:
    """Whether one of the names is a word of the set, or a compound of such words and words of layout."""
    for name in names.split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if any(x in of for x in words) and all(x in of or x in ASIDE or x in LAYOUT for x in words):
            return True
    return False


def _is_aside(name: str, more: str, inside_article: bool) -> bool:
    if name in NEVER or (name == "header" and not inside_article):
        return True
    if name in ("html", "body") or not more:
        return False
    for m in ATTRIBUTE.finditer(more):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value.lower())):
            return True
        if key == "id" and (name in HEADINGS or (inside_article and value.lower() not in REMARKS)):
            continue  # names a part of the text
        if key in ("class", "id", "role"):
            if _tells(value, REMARKS if name in MARKS else ASIDE) or (name not in MARKS and not inside_article and _tells(value, OUTER)):
                return True
    return False


def tokens(page: str) -> list[tuple[str, str, bool]]:
    """(tag name or empty, text or attributes, is an end tag); comments are gone, raw texts come as they are."""
    out, at, size = [], 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        if not m:
            out.append(("", page[at], False))
            at += 1
            continue
        at = m.end()
        if m["text"] is not None:
            out.append(("", m["text"], False))
        elif m["name"] is not None:
            name = m["name"].lower()
            out.append((name, m["more"], bool(m["end"])))
            if name in RAW and not m["end"]:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = close.start() if close else size
    return out


def kept_tokens(found: list[tuple[str, str, bool]]) -> list[tuple[str, str, bool]]:
    """Tokens without the elements that hold something beside the article.

    Such an element ends with its end tag; without one, before the next block tag.
    """
    opened: dict[str, list[int]] = {}
    closes: dict[int, int] = {}
    for i, (name, _, end) in enumerate(found):
        if not name or name in VOID:
            continue
        if end:
            if opened.get(name):
                closes[opened[name].pop()] = i
        else:
            opened.setdefault(name, []).append(i)
    # words and marks before each token
    words, begun, raw = [0], [0], 0
    for i, (name, text, end) in enumerate(found):
        raw = raw + (-1 if end else 1) if name in RAW else raw
        words.append(words[-1] + (0 if name or raw > 0 else len(text.split())))
        begun.append(begun[-1] + (name in MARKS and not end))

    def holds_the_text(i: int) -> bool:
        name, more, _ = found[i]
        told = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(more)]
        if name in BESIDE or i not in closes or any(key in ("hidden", "aria-hidden", "style") or _tells(value, REMARKS) for key, value in told):
            return False
        return begun[closes[i]] > begun[i + 1] or 2 * (words[closes[i]] - words[i]) > words[-1]

    out, i, marks = [], 0, 0
    while i < len(found):
        name, more, end = found[i]
        if name in MARKS:
            marks += -1 if end else 1
        if name and not end and name not in VOID and _is_aside(name, more, marks > (name in MARKS)) and not holds_the_text(i):
            marks -= name in MARKS
            out.append(("hr", "", False))  # blocks on both sides stay apart
            if i in closes:
                i = closes[i]
            elif name in RAW:
                i = len(found)
            else:
                while i + 1 < len(found) and found[i + 1][0] not in BLOCKS:
                    i += 1
        else:
            out.append(found[i])
        i += 1
    return out


def marked(found: list[tuple[str, str, bool]]) -> list[tuple[int, int]]:
    """Token ranges of the outermost elements that mark an article."""
    out, depth, start = [], 0, 0
    for i, (name, _, end) in enumerate(found):
        if name not in MARKS:
            continue
        if not end:
            start = i if depth == 0 else start
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                out.append((start, i + 1))
    if depth:
        out.append((start, len(found)))
    return out


def best_run(found: list[tuple[str, str, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """The contiguous run of tokens with the highest score, by one scan; empty if no token scores above zero."""
    word, other = weights["word"], weights["other"]
    best, at, score, start = 0.0, (0, 0), 0.0, 0
    for i, (name, text, _) in enumerate(found):
        if score <= 0:
            score, start = 0.0, i
        score += weights.get(name, other) if name else word * len(text.split())
        if score > best:
            best, at = score, (start, i + 1)
    return at


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text: blocks in page order, one to a line, white space within a block as one space."""
    found = kept_tokens(tokens(page))
    first, end = best_run(found, weights)
    if first == end:
        return ""
    # the marked elements that the run covers words of
    covered = [(a, b) for a, b in marked(found) if any(not n and t.strip() for n, t, _ in found[max(first, a) : min(end, b)])]
    if not covered:
        while first > 0 and found[first - 1][0] not in BLOCKS:
            first -= 1
        while end < len(found) and found[end][0] not in BLOCKS:
            end += 1
        covered = [(first, end)]
    blocks, parts = [], []
    for name, text, _ in [t for a, b in covered for t in [*found[a:b], ("hr", "", False)]]:
        if not name:
            parts.append(text)
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            line = " ".join(unescape("".join(parts)).split())
            if line:
                blocks.append(line)
            parts = []
    return "\n".join(blocks)


def _label(page: str) -> tuple[Counter, Counter]:
    """Words and tags inside and outside of the element that marks the article; nothing for pages without one."""
    found = tokens(page)
    ranges = marked(found)
    inside, outside = Counter(), Counter()
    if ranges:
        at = 0
        for i, (name, text, _) in enumerate(found):
            while at < len(ranges) and ranges[at][1] <= i:
                at += 1
            side = inside if at < len(ranges) and ranges[at][0] < i < ranges[at][1] - 1 else outside
            side[name if name in BLOCKS | NEVER | VOID | {"a", "b", "i", "em", "strong", "span"} else "other" if name else "word"] += 1 if name else len(text.split())
    return inside, outside


def fit(pages: DataFrame, html_col: str = "html", labelled: int = LABELLED) -> dict[str, float]:
    """Weights: log odds of a word or tag inside against outside of the marked article.

    They are fitted on the pages whose hash falls into a share that makes ``labelled``
    pages at most on average, wherever they lie.  Words are held above zero, tags below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for all_, one in zip(total, _label(page)):
                    all_.update(one)
        names = sorted({*total[0], *total[1]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([total[0][x] for x in names], pa.int64()), pa.array([total[1][x] for x in names], pa.int64())], names=["name", "inside", "outside"]
        )

    share = min(1.0, labelled / max(1, pages.count()))
    drawn = F.pmod(F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in pages.columns])), F.lit(1 << 30)) < int(share * (1 << 30))
    some = pages.where(drawn).select(F.col(f"`{html_col}`").alias("html")).where("html rlike '(?i)<(article|main)[ >/]'")
    sums = some.mapInArrow(run, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    rows = sums.collect()
    all_in, all_out = sum(r.inside for r in rows), sum(r.outside for r in rows)
    odds = {r.name: math.log((r.inside + 0.5) / (all_in + 1)) - math.log((r.outside + 0.5) / (all_out + 1)) for r in rows}
    weights = {name: min(-0.1, x) for name, x in odds.items() if name != "word"}
    return {"other": -1.0} | weights | {"word": max(0.1, odds.get("word", 0.5))}


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html", out: str = "text") -> DataFrame:
    """All other columns and the main text of each page; empty where there is none, and for a null page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [extract(page or "", weights) for page in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    columns = [c for c in pages.columns if c not in (html_col, out)]
    named = pages.select(rest(pages, html_col, out).alias("row"), F.col(f"`{html_col}`").alias("html"))
    done = named.mapInArrow(run, f"row {named.schema['row'].dataType.simpleString()}, text string")
    return done.select(*[F.col(f"row.`{c}`") for c in columns], F.col("text").alias(out))
