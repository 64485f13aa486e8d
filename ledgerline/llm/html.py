"""Main text of HTML pages by the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the weights are learned from (about; chosen by a hash of the id).
FIT_PAGES = 5_000
#: The quantile of the longest stretches outside the content of these pages that a tag outside has to outweigh,
#: the words it outweighs at least and at most, and the cost at most of a tag that is used inside more often
#: than outside (that of an unsupervised tagger), so that it doesn't cost a paragraph at the content's ends.
QUANTILE, LEAST, MOST, PUBLISHED = 0.95, 20.0, 1000.0, 3.25

# HTML elements by their role
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title", "textarea", "math")
BOILERPLATE = ("nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "header")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
                  "track", "wbr"))
BLOCK = frozenset(("address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details",
                   "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
                   "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
                   "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
NOTICE = (r"ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?|cookies?|consent|"
          r"notices?|alert|popup|modal|overlay|comments?|disqus|replies|responses|footer|masthead|header|share|social|"
          r"related|recommended|newsletter|subscribe|signup|login|paywall|widget|toolbar|pagination|pager")
PARTS = (r"site|global|container|wrapper|wrap|box|block|list|section|area|inner|slot|unit|bar|items?|links?|form|"
         r"buttons?|[0-9]+")
#: A whole class or id: notice words and words for a part of a page alone (cookie-banner, nav-list, but not
#: nav-open, no-comments or entry-header).
NOTICE_NAME = re.compile(rf"(?:(?:{PARTS})[_-]+)*(?:{NOTICE})(?:[_-]+(?:{NOTICE}|{PARTS}))*", re.I)
#: What also heads an article, and what holds other articles than the page's own.
HEADING_NAME = re.compile(rf"(?:(?:{PARTS})[_-]+)*(?:header|masthead)(?:[_-]+(?:{PARTS}))*", re.I)
OTHERS_NAME = re.compile(r"(?:comment|disqus|repl|response|related|recommended)", re.I)
OTHERS = ("nav", "footer", "aside")
ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert)\b", re.I)
MAIN = ("article", "main")

# A quote begins a value only after an equals sign, as browsers read it: elsewhere it is part of a name or of an
# unquoted value, and the tag ends at the next > .
ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?"
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[\s/]++|{ATTRIBUTE})*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?<![\w-])(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, value): text with its raw characters, or a start or end tag with its attributes."""
    out, at = [], 0
    while True:
        m = TOKEN.search(page, at)
        if not m:
            break
        if m.start() > at:
            out.append(("text", "", page[at:m.start()]))
        at = m.end()
        if m["name"]:
            name = m["name"].lower()
            out.append(("end" if m["end"] else "start", name, m["attrs"] or ""))
            if not m["end"] and name in RAW and not (m["attrs"] or "").rstrip().endswith("/"):
                close = re.compile(rf"</{name}\b", re.I).search(page, at)
                if close:  # what stands inside is no content: not even its tags are read
                    at = close.start()
    if at < len(page):
        out.append(("text", "", page[at:]))
    return out


def names(attrs: str) -> list[str]:
    """The classes and the id of a tag."""
    return [x for found in NAMES.findall(attrs) for x in next(filter(None, found), "").split()]


def is_boilerplate(name: str, attrs: str, in_main: bool) -> bool:
    if name in RAW or name in BOILERPLATE and not (name == "header" and in_main):
        return True
    if name in MAIN or name in ("body", "html") or not attrs:
        return False
    return bool(ROLES.search(attrs)) or any(NOTICE_NAME.fullmatch(x) and not (in_main and HEADING_NAME.fullmatch(x))
                                            for x in names(attrs))


def dropped(toks: list[tuple[str, str, str]]) -> tuple[list[bool], tuple[int, int] | None]:
    """For each token, whether it lies in an element that never is content; and where the ``article`` (else
    ``main``) of the most words begins and ends. An element without its end tag ends at the next end tag of
    an element that was open before it. An element around an ``article`` or ``main`` is kept; comments, related
    pages and the like only around the article of the most words. On a page without either, a form or an
    element named like a notice is kept if it holds most of the page's words: then it is the page's frame."""
    out = [False] * len(toks)
    ends: dict[str, list[int]] = {}
    close: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    marks, words = [], [0]
    for i, (kind, name, value) in enumerate(toks):
        raw = i and toks[i - 1][0] == "start" and toks[i - 1][1] in RAW
        words.append(words[-1] + (len(value.split()) if kind == "text" and not raw else 0))
        if kind == "end":
            ends.setdefault(name, []).append(i)
            if opened.get(name):
                close[opened[name].pop()] = i + 1
        elif kind == "start":
            opened.setdefault(name, []).append(i)
            if name in MAIN:
                marks.append(i)
    first = max((i for i in marks if toks[i][1] == "article"), default=None,
                key=lambda i: words[close.get(i, len(toks))] - words[i])
    if first is None and marks:
        first = max(marks, key=lambda i: words[close.get(i, len(toks))] - words[i])
    main = 0
    i = 0
    open_names: Counter = Counter()
    while i < len(toks):
        kind, name, attrs = toks[i]
        if kind == "start" and name not in VOID:
            if is_boilerplate(name, attrs, main > 0):
                j = close.get(i)
                if j is None:  # never closed
                    after = ((ends[n], bisect(ends[n], i)) for n, k in open_names.items() if k > 0 and n in ends)
                    j = min((e[k] for e, k in after if k < len(e)), default=len(toks))
                if name in RAW:
                    keep = False
                elif name in OTHERS or any(OTHERS_NAME.match(x) for x in names(attrs)):
                    keep = first is not None and i < first < j
                else:
                    at = bisect(marks, i)
                    keep = at < len(marks) and marks[at] < j or not marks and 2 * (words[j] - words[i]) > words[-1]
                if not keep:
                    out[i:j] = [True] * (j - i)
                    i = j
                    continue
            open_names[name] += 1
            main += name in MAIN
        elif kind == "end" and open_names[name] > 0:
            open_names[name] -= 1
            main -= name in MAIN
        i += 1
    return out, None if first is None or out[first] else (first, close.get(first, len(toks)))


class Weights:
    """A word scores 1. A tag scores minus ``reach`` times the share of its uses outside the content at twice
    its log-odds, so a tag that never stands inside costs more than the words of nearly any stretch outside,
    and one that mostly stands inside next to nothing (at most ``PUBLISHED``). Unknown tags, and all tags where
    no page was labelled, score ``default``."""

    def __init__(self, inside: dict[str, float], outside: dict[str, float], reach: float, default: float = -1.0):
        self.default = default
        self.tag = {}
        for t in {*inside, *outside}:
            i, o = inside.get(t, 0), outside.get(t, 0)
            share = (o + 0.01) / (o + i + 1)
            cost = min(reach, MOST) * share ** 2 / (share ** 2 + (1 - share) ** 2)
            self.tag[t] = -(min(cost, PUBLISHED) if share <= 0.5 else cost)

    def __call__(self, name: str) -> float:
        return self.tag.get(name, self.default)


#: Without labelled pages: published weights of an unsupervised tagger (a word 1, a tag -3.25).
UNTRAINED = Weights({}, {}, 0.0, default=-PUBLISHED)


def observe(page: str | None) -> tuple[Counter, Counter, int]:
    """Tags inside and outside the content of a labelled page, and the longest stretch of words outside.
    A page is labelled if it marks its content by one ``article`` or ``main`` element."""
    inside, outside = Counter(), Counter()
    toks = tokens(page or "")
    name = next((n for n in MAIN if sum(k == "start" and x == n for k, x, _ in toks) == 1), None)
    if name is None:
        return inside, outside, 0
    drop, main, words, longest = dropped(toks)[0], False, 0, 0
    for (kind, tag, value), off in zip(toks, drop, strict=True):
        if off:
            continue
        if kind == "text":
            words += 0 if main else len(value.split())
        elif tag == name:
            main = kind == "start"
            longest, words = max(longest, words), 0
        else:
            (inside if main else outside)[tag] += 1
    return inside, outside, max(longest, words)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES) -> Weights:
    """Tag weights from about ``fit_pages`` labelled pages (all, if fewer). Each page counts once for a tag, by
    the share of the page's uses that are outside, and once for the quantile of stretches: no page sets a weight."""
    n = pages.count()
    if not n:
        return UNTRAINED
    spread = F.pmod(F.xxhash64(F.lit(3), F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, outside, stretches = Counter(), Counter(), Counter()  # pages; millionths of pages; pages by longest stretch
        for b in batches:
            for page in b.column(0).to_pylist():
                i, o, r = observe(page)
                for t in {*i, *o}:
                    of[t] += 1_000_000
                    outside[t] += round(1_000_000 * o[t] / (i[t] + o[t]))
                if i or o:
                    stretches[min(r, int(MOST))] += 1
        names = sorted(of)
        yield pa.record_batch([pa.array([*names, *[""] * len(stretches)], pa.string()),
                               pa.array([*[0] * len(names), *stretches], pa.int64()),
                               pa.array([*(of[t] - outside[t] for t in names), *stretches.values()], pa.int64()),
                               pa.array([*(outside[t] for t in names), *[0] * len(stretches)], pa.int64())],
                              names=["tag", "stretch", "inside", "outside"])

    seen = pages.where(spread < fit_pages / n).select(F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, "tag string, stretch long, inside long, outside long") \
        .groupBy("tag", "stretch").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    rows = seen.orderBy(F.col("tag") != "", F.desc(F.col("i") + F.col("o")), "tag", "stretch") \
        .limit(int(MOST) + 1001).collect()  # all stretches, at most MOST + 1, and the tags that occur at all often
    inside, outside = ({r["tag"]: r[k] / 1e6 for r in rows if r["tag"]} for k in ("i", "o"))
    if not sum(inside.values()):
        return UNTRAINED
    stretches = sorted((r["stretch"], r["i"]) for r in rows if not r["tag"])
    below = int(QUANTILE * (sum(k for _, k in stretches) - 1))  # rounded down: never the longest of several
    reach = next(r for r, k in zip((r for r, _ in stretches), accumulate(k for _, k in stretches)) if k > below)
    return Weights(inside, outside, reach=LEAST + reach)


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best-scoring contiguous region, joined by a line feed; '' if there are no words.

    Words score positive and tags negative; one linear scan finds the region with the largest sum (the
    one that ends first, and the shortest, of equals). Inside the article that a page marks tags cost nothing, so that
    the scan doesn't cut it. Elements that never are content count as one tag and give no text. References are
    decoded; white space inside a block is one space.
    """
    toks = tokens(page or "")
    drop, marked = dropped(toks)
    marked = marked or (0, 0)
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    was_off = False
    for i, (kind, name, value) in enumerate(toks):
        inside = marked[0] < i < marked[1] - 1
        if drop[i]:
            score = 0.0 if was_off or inside else -1.0
        else:
            score = len(value.split()) if kind == "text" else 0.0 if inside else weights(name)
        was_off = drop[i]
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i + 1)
    blocks: list[list[str]] = [[]]
    for i in range(*span):
        kind, name, value = toks[i]
        if drop[i]:
            blocks.append([])
        elif kind == "text":
            blocks[-1].append(value)
        elif name in BLOCK:
            blocks.append([])
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row, from whole pages.

    Null and empty pages, and pages without words, have an empty text; repeated rows give repeated rows;
    an empty table gives no rows. Only the three columns are read.
    """
    w = weights or learn(pages, id_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(p, w) for p in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()),
                                   pa.array([len(t) for t in text], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
