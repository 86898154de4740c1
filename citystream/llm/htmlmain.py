"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags
negative; a linear scan finds the contiguous run of text blocks with the
highest sum, and that run is the content region.  The weights are learned
from labelled pages: pages with an ``article`` or ``main`` element (or
itemprop articleBody) say which words and tags lie inside the content.  A
tag's weight is the smoothed log ratio of its frequency inside and outside,
at most 0.  A word weighs ``WORD`` plus the weights of where it stands: the block
element it stands in, the boilerplate elements of HTML around it, the words of
their class, id and role values.  Each weighs the log odds of words there to be
content, at most 0, at least ``LOW``; so a word in a menu scores negative.
Elements and names that no labelled page shows have the weights ``PRIOR``,
which count as ``PSEUDO`` words seen.  Counts are summed over all labelled pages
in Spark.  The labelled element itself is no feature, so pages without it are
read alike.

The region is widened to the smallest element that holds all of it, unless
that is the page itself, so short paragraphs at its ends are not lost; runs of
negative words inside (menus, notices, adverts, forms, reader comments) leave.
Character references are decoded, white space inside a block becomes one blank,
blocks are joined in page order by an empty line.

Defined results: null, empty or textless pages give an empty text; without any
labelled page the weights are ``DEFAULT_TAG`` for every tag; broken markup
(unclosed or stray tags, cut-off pages) never fails; very long pages are read
whole; repeated rows are extracted alike, ties take the first region.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.common import read, small_batches

WORD, DEFAULT_TAG = 1.0, -3.25
#: Weights of boilerplate elements and names (``marked``) that were not learned, the
#: words that these count for in learning, and the least weight.
PRIOR, MARKED, PSEUDO, LOW = -3.0, -6.0, 20, -8.0
#: Open elements at most; deeper ones count as their parent's, as in browsers.
DEPTH = 512

# Element names of HTML by what they mean here.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "math", "canvas",
       "textarea", "title", "select", "audio", "video", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr", "!doctype"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd",
          "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
          "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
BOILER = {"nav", "aside", "footer", "form", "head", "menu", "button", "dialog", "fieldset"}
CONTENT = {"article", "main"}
#: Words of class, id and role values that mark boilerplate elements.
BOILER_NAMES = {
    "ad", "ads", "adbox", "adsense", "advert", "adverts", "advertisement", "advertising",
    "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "sidenav", "side", "menu",
    "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent",
    "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations",
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "footer",
    "header", "masthead", "topbar", "toolbar", "search", "searchform", "widget", "widgets",
    "pagination", "pager", "contentinfo", "complementary", "alert", "alertdialog", "skip",
}
#: Content names that win over the list above (``article-header`` is content).
CONTENT_NAMES = {"article", "post", "entry", "story", "main", "content", "body", "text", "title"}
#: Opening one of these ends an open paragraph or list item of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|>|.*\Z)|<!\[CDATA\[.*?\]\]>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z!][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|([^<]+)|(<)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ARTICLE = re.compile(r"itemprop\s*=\s*[\"']?articleBody", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _is_boiler(tag: str, attrs: str, in_content: bool) -> bool:
    if tag in BOILER:
        return True
    if tag == "header":
        return not in_content
    if attrs and tag not in ("html", "body", "article", "main"):
        for m in _NAMES.finditer(attrs):
            for name in (m.group(1) or m.group(2) or m.group(3) or "").split():
                parts = {p.lower() for p in _PART.findall(name)}
                if parts & BOILER_NAMES and (name.lower() in BOILER_NAMES
                                             or not parts & CONTENT_NAMES
                                             or parts & {"comment", "comments", "ad", "ads",
                                                         "sidebar", "related", "share"}):
                    return True
    return "hidden" in attrs and re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs) is not None


class Block:
    """A text block: its words' text, the tags since the block before it, the
    open elements (numbers) around it, what those mean, and the features of
    its place."""
    __slots__ = ("parts", "tags", "path", "boiler", "inside", "place")

    def __init__(self, tags, path, boiler, inside, place):
        self.parts, self.tags, self.path = [], tags, path
        self.boiler, self.inside, self.place = boiler, inside, place

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _features(tag: str, attrs: str, boiler: bool, own: bool) -> tuple[str, ...]:
    """What an element says about the words in it; ``own``: it is boilerplate
    itself, ``boiler``: it is or stands in boilerplate."""
    out = []
    if own and (tag in BOILER or tag == "header"):
        out.append(f"in:{tag}")
    elif own:
        out.append("marked")
    for m in _NAMES.finditer(attrs) if attrs and tag not in CONTENT else ():
        for name in (m.group(1) or m.group(2) or m.group(3) or "").split():
            out += [f"name:{p.lower()}" for p in _PART.findall(name)]
    return tuple(out)


def _place(stack: list[tuple]) -> tuple[str, ...]:
    """Features of a text: its nearest block element's tag and all around it."""
    near = next((x[0] for x in reversed(stack) if x[0] in BLOCKS), "")
    own = (f"at:{near}",) if near and near not in CONTENT | {"body", "html"} else ()
    return own + (stack[-1][4] if stack else ())


def word_weight(b: "Block", weights: dict[str, float]) -> float:
    """Score of one word of a block."""
    total = sum(weights.get(f, PRIOR if f[:3] == "in:" else MARKED if f == "marked" else 0.0)
                for f in set(b.place))
    return WORD + max(LOW, min(0.0, total))


def blocks(page: str) -> list[Block]:
    """All text blocks of a page in page order."""
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, number, boilerplate, content, features)
    number, at, n = 0, 0, len(page)
    tags: list[str] = []
    now: Block | None = None
    while at < n:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            at = n
            break
        at = m.end()
        closing, tag, attrs, text, lone = m.group(1, 2, 3, 4, 5)
        if tag is not None:
            tag = tag.lower()
            if not closing and tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else n
                tags.append(tag)
                continue
            if tag == "br":
                if now is not None:
                    now.parts.append(" ")
                tags.append(tag)
                continue
            if tag in VOID:
                if tag == "hr":
                    now = None
                tags.append(tag)
                continue
            if tag in BLOCKS:
                now = None
                # A block element ends an open paragraph.
                if (not closing or tag != "p") and any(s[0] == "p" for s in stack):
                    while stack and any(s[0] == "p" for s in stack):
                        stack.pop()
            tags.append("/" + tag if closing else tag)
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                    if stack[i][0] in ("article", "main", "body") and tag not in ("body", "html"):
                        break
                continue
            shut = CLOSES.get(tag)
            if shut and stack and stack[-1][0] in shut:
                stack.pop()
            up_boiler, up_content = (stack[-1][2], stack[-1][3]) if stack else (False, False)
            content = up_content or tag in CONTENT or bool(attrs and _ARTICLE.search(attrs))
            number += 1
            if len(stack) >= DEPTH:
                continue
            if tag in ("html", "body") and any(s[0] == tag for s in stack):
                continue
            mine = _is_boiler(tag, attrs or "", up_content)
            stack.append((tag, number, up_boiler or mine, content,
                          (stack[-1][4] if stack else ()) + _features(tag, attrs or "", up_boiler, mine)))
        elif text is not None or lone:
            raw = text or lone
            if now is None and raw.isspace():
                continue
            if now is None:
                boiler, inside = (stack[-1][2], stack[-1][3]) if stack else (False, False)
                now = Block(tags, tuple(s[1] for s in stack if s[0] not in ("html", "body")),
                            boiler, inside, _place(stack))
                tags = []
                out.append(now)
            elif (stack[-1][2] if stack else False) != now.boiler:
                if raw.strip():  # an inline boilerplate element inside a block
                    side = Block(tags, now.path, stack[-1][2] if stack else False, now.inside,
                                 _place(stack))
                    side.parts.append(html.unescape(raw))
                    out.append(side)
                    now = Block([], now.path, now.boiler, now.inside, now.place)
                    out.append(now)
                    tags = []
                continue
            now.parts.append(html.unescape(raw))
    return [b for b in out if b.text()]


def count_tags(pages: list[str]) -> dict[str, list[int]]:
    """Tag or feature -> [inside content, outside] over the labelled pages of a
    batch, features by words; ``#word`` and ``#page`` count words and pages."""
    total: dict[str, list[int]] = {"#page": [0, 0], "#word": [0, 0]}
    for page in pages:
        found = blocks(page)
        if not any(b.inside for b in found):
            continue
        total["#page"][0] += 1
        for b in found:
            side = 0 if b.inside and not b.boiler else 1
            words = len(b.text().split())
            total["#word"][side] += words
            for f in set(b.place):
                total.setdefault(f, [0, 0])[side] += words
            for t in b.tags:
                if t.lstrip("/") in BLOCKS or t.lstrip("/") in ("a", "b", "i", "span", "em",
                                                                 "strong", "br", "img", "input"):
                    total.setdefault(t.lstrip("/"), [0, 0])[side] += 1
    return total


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log ratio of each tag's rate inside and outside the content, and log odds
    of words in each place to be content; at most 0."""
    import math
    if counts.get("#page", (0, 0))[0] == 0:
        return {}
    places = {k: v for k, v in counts.items() if ":" in k or k == "marked"}
    rows = {k: v for k, v in counts.items() if k[0] != "#" and k not in places}
    inside = sum(v[0] for v in rows.values()) + len(rows) + 1
    outside = sum(v[1] for v in rows.values()) + len(rows) + 1
    out = {k: min(0.0, math.log((v[0] + 1) / inside) - math.log((v[1] + 1) / outside))
           for k, v in rows.items()}
    for k, v in places.items():
        known = PSEUDO if k[:3] == "in:" or k == "marked" else 0
        out[k] = max(LOW, min(0.0, math.log((v[0] + 0.5) / (v[1] + known + 0.5))))
    return out


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    texts = [b.text() for b in found]
    score = [word_weight(b, weights) for b in found]
    best, best_at, run, start = 0.0, None, 0.0, 0
    for i, b in enumerate(found):
        worth = score[i] * len(texts[i].split())
        cost = sum(weights.get(t.lstrip("/"), DEFAULT_TAG if not weights else 0.0) for t in b.tags)
        # Tags before a region do not count against it: extend the run over
        # them, or begin behind them, whichever is worth more.
        if i and run + cost >= 0:
            run += cost + worth
        else:
            run, start = worth, i
        if run > best:
            best, best_at = run, (start, i)
    if best_at is None:
        return ""
    lo, hi = best_at
    path = found[lo].path
    for b, own in zip(found[lo:hi + 1], score[lo:hi + 1]):
        if own > 0:
            same = 0
            for x, y in zip(path, b.path):
                if x != y:
                    break
                same += 1
            path = path[:same]
    if hi == lo:
        path = path[:-1] if path else path
    if path:
        keep = [i for i, b in enumerate(found) if b.path[:len(path)] == path]
    else:
        keep = range(lo, hi + 1)
    return "\n\n".join(texts[i] for i in keep if score[i] > 0)


# ---- Spark ------------------------------------------------------------------

def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[int]] = {}
    for b in batches:
        for k, v in count_tags([p or "" for p in b.column(0).to_pylist()]).items():
            have = total.setdefault(k, [0, 0])
            have[0] += v[0]
            have[1] += v[1]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()),
         pa.array([v[1] for v in total.values()], pa.int64())], ["tag", "inside", "outside"])


def learn_weights(pages: DataFrame, page: str = "html") -> dict[str, float]:
    """Tag weights from all labelled pages: tasks send one row a tag name."""
    small_batches(pages.sparkSession)
    rows = (pages.select(F.col(page).cast("string"))
            .mapInArrow(_counter, "tag string, inside long, outside long")
            .groupBy("tag").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect())
    return weights_from({r["tag"]: (r["i"], r["o"]) for r in rows})


def _extractor(weights: dict[str, float], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([main_text(p, weights) for p in b.column(at).to_pylist()],
                                      pa.string())], [*b.schema.names, "main_text"])
    return run


def extract(pages: DataFrame, weights: dict[str, float], page: str = "html") -> DataFrame:
    """``pages`` plus ``main_text`` (a column of that name is replaced)."""
    small_batches(pages.sparkSession)
    pages = pages.drop("main_text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInArrow(_extractor(weights, pages.columns.index(page)),
                            f"{fields}, `main_text` string")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("string"))
    return (extract(pages, learn_weights(pages))
            .select("page_id", "url", F.col("main_text").alias("text"),
                    F.length("main_text").cast("long").alias("n_chars")))
