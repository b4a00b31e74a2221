"""Main text of web pages by minimum-cut labelling.

A page is read into blocks: runs of text between the starts and ends of
block-level elements.  A linear classifier gives each block its log odds of
being content; the two log costs become capacities from the source and to the
sink.  Neighbours in reading order, by the part of their paths that they share,
and neighbours under one container are joined by smoothness capacities.  The
minimum cut, found by maximum flow, is the cheapest labelling; the source's
side is the text.

The classifier sees length, sentences, link share, kind of element and
position, and what the names of the elements around a block say.  Names are
evidence, not verdicts: a listed word counts for little beside a word for
content (``legal-text``) and for nothing behind ``with`` or ``no``
(``post-with-sidebar``); and an element that holds most of a page's words is
not boilerplate by its name.  The weights are fitted by logistic regression on
blocks of at most ``train_pages`` pages (those of least hash of page_id that have
an ``article`` or ``main`` element, which gives the labels; at most
``train_blocks`` blocks), drawn towards ``PRIOR``, the weights used without such
pages.  What the labels come from is no feature; it is added as evidence of its
own when a page is labelled.

Defined cases: null or empty html, and pages without content, give an empty
text.  Unclosed elements, comments, quotes, scripts and tags end where the
next structure or the page ends; an open head ends at the first text or
element that can't be in it.  Formulas are text, their annotations are not.
Character references are decoded once.  Elements may be nested to any depth: a
block points to its element, an element to its parent.
Nothing is capped: a very long page is one row's work.  Repeated rows are
answered each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import slices

_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th
thead tr ul""".split())
_VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("script style noscript template iframe object svg annotation annotation-xml head title textarea select button canvas audio video noframes".split())
# What a head may hold: all of it is void or raw.
_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
_RAW = frozenset("script style textarea title iframe noscript noframes template".split())
_ASIDE = frozenset("nav footer aside form header menu dialog".split())
_HOME = frozenset("article main".split())
# An open element of the second kind ends where one of the first kind starts.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BOUND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

# Words in names that tell boilerplate whatever stands beside them, and those that don't.
_BAD = frozenset("""ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
popup modal overlay newsletter subscribe subscription signup menu nav navbar navigation breadcrumb breadcrumbs masthead toolbar topbar
footer foot related recommended recommendations comment comments respond reply replies disqus pagination pager searchbox contentinfo""".split())
_WEAK = frozenset("""sidebar side aside widget widgets header copyright legal social share sharing discussion form search login skip
complementary notice notices alert""".split())
_GOOD = frozenset("article content main post entry story body text".split())
_NOT = frozenset("no has with without hide not is".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOP = re.compile(r"[.!?。！？](?:\s|$)")
_CLOSING = re.compile(r"(?i)copyright|all rights reserved|©")


def _hint(tag: str, attributes: str) -> tuple[bool, int, int, bool]:
    """What an element's name, classes, id and role say: content; boilerplate, for
    certain words and for doubtful ones; and whether it is hidden."""
    if tag in ("html", "body"):
        return False, 0, 0, False
    good, bad, weak = tag in _HOME, int(tag in _ASIDE), 0
    found: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes) if len(attributes) > 1 else ():
        found.setdefault(key.lower(), value)  # of an attribute given twice, the first counts
    hidden = "hidden" in found or "true" in found.get("aria-hidden", "").lower()
    for value in (found[x] for x in ("class", "id", "role") if x in found):
        for name in value.strip("\"'").split():
            parts = [x.lower() for x in _WORD.findall(name)]
            cut = next((i for i, x in enumerate(parts) if x in _NOT), len(parts))
            parts = parts[:cut]
            says_good = not _GOOD.isdisjoint(parts)
            good = good or says_good
            if not _BAD.isdisjoint(parts):
                bad = 1
            elif not _WEAK.isdisjoint(parts) and not says_good:
                weak = 1
    return good and not bad, bad, weak, hidden


class Element:
    __slots__ = ("tag", "parent", "good", "bad", "weak", "home", "link", "skip", "words", "depth")

    def __init__(self, tag, parent, good=False, bad=0, weak=0, home=False, link=False, skip=False):
        self.tag, self.parent, self.good, self.bad, self.weak = tag, parent, good, bad, weak
        self.home, self.link, self.skip, self.words = home, link, skip, 0
        self.depth = parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("text", "linked", "element", "heading", "item", "tag", "container", "shared", "words", "good", "bad", "weak")

    def __init__(self, text, linked, open_, shared):
        self.text, self.linked, self.element, self.shared = text, linked, open_[-1], shared
        self.words = text.count(" ") + 1
        self.heading = any(x.tag in ("h1", "h2", "h3", "h4", "h5", "h6") for x in open_[-3:])
        self.item = any(x.tag in ("li", "td", "th", "dt", "dd") for x in open_[-4:])
        own = self.element
        while own.parent and own.tag not in _BLOCK:
            own = own.parent
        self.tag, self.container = own.tag, own.parent

    @property
    def home(self) -> bool:
        return self.element.home


def blocks(page: str) -> list[Block]:
    """The page's text blocks in reading order, with what the elements around them say."""
    out: list[Block] = []
    elements = [Element("", None)]
    open_, names = [elements[0]], Counter()
    held: list[str] = []
    linked, at, lowest = 0, 0, 0  # lowest: what was open all the time since the last block

    def close(depth):
        nonlocal lowest
        for x in open_[depth:]:
            names[x.tag] -= 1
        del open_[depth:]
        lowest = min(lowest, open_[-1].depth)

    def flush():
        nonlocal linked, lowest
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, min(linked, len(text)), open_, min(lowest, open_[-1].depth)))
                lowest = open_[-1].depth
            held.clear()
        linked = 0

    def say(text):
        nonlocal linked
        if open_[-1].tag == "head" and text.strip():
            close(len(open_) - 1)
        if text and not open_[-1].skip:
            held.append(text)
            if open_[-1].link:
                linked += len(text.strip())

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if names[tag]:
                depth = next(i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == tag)
                if any(x.tag in _BLOCK for x in open_[depth:]):
                    flush()
                close(depth)
            elif tag in _BLOCK:
                flush()
            continue
        if open_[-1].tag == "head" and tag not in _HEAD:
            if tag in ("html", "head"):
                continue
            close(len(open_) - 1)
        if tag == "br":
            say(" ")
            continue
        if tag in _BLOCK:
            flush()
            ends = _ENDS.get(tag, ())
            for i in range(len(open_) - 1, 0, -1):
                name = open_[i].tag
                if name in ends or name == "p":  # a paragraph ends where any block starts
                    close(i)
                    if not ends:
                        break
                elif name in _BOUND.get(tag, ()) or not ends and name in _BLOCK:
                    break
        if tag in _VOID or m[3].endswith("/>") and (tag in ("svg", "math") or names["math"]):
            continue
        top, (good, bad, weak, hidden) = open_[-1], _hint(tag, m[3])
        starts = tag in _HOME and not bad and not hidden
        if tag == "header" and top.home:
            good, bad = False, 0
        new = Element(tag, top, good, bad, weak, top.home or starts, top.link or tag == "a", top.skip or hidden or tag in _SKIP)
        elements.append(new)
        open_.append(new)
        names[tag] += 1
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(len(open_) - 1)
    say(page[at:])
    flush()
    _weigh(out, elements)
    return out


def _weigh(found: list[Block], elements: list[Element]) -> None:
    """Evidence of the elements around each block.  An element's doubtful words count
    by the share of the page's words outside it; certain ones unless it holds nearly all."""
    total = 0
    for b in found:
        n = b.words * (1 - b.linked / len(b.text))
        b.element.words += n
        total += n
    for x in reversed(elements):  # children come after their parents
        if x.parent:
            x.parent.words += x.words
    said: dict[int, tuple[float, float, float]] = {}
    for x in elements:
        good, bad, weak = said[id(x.parent)] if x.parent else (0.0, 0.0, 0.0)
        outside = 1 - x.words / total if total else 0.0
        if x.home and not x.bad and x.tag in _HOME:
            bad = weak = 0.0  # an article begins anew, whatever it stands in
        good, bad, weak = max(good, float(x.good)), max(bad, x.bad * min(1.0, 5 * outside)), max(weak, x.weak * min(1.0, 2 * outside))
        said[id(x)] = good, bad, weak
    for b in found:
        b.good, b.bad, b.weak = said[id(b.element)]


FEATURES = ("bias", "length", "links", "sentences", "heading", "item", "paragraph", "closing", "good", "weak", "bad", "edge")
# Weights without training pages, and what fitted ones are drawn towards.
PRIOR = np.array([-1.9, 0.8, -4.0, 0.4, 0.5, -0.5, 0.2, -2.5, 1.2, -3.0, -8.0, -0.3])


def features(found: list[Block]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(found), len(FEATURES)))
    for i, b in enumerate(found):
        stops = min(1.0, 8 * len(_STOP.findall(b.text)) / b.words)
        place = i / max(1, len(found) - 1)
        out[i] = (1, math.log1p(b.words), b.linked / len(b.text), stops, b.heading, b.item and not b.home, b.tag in ("p", "blockquote", "pre"),
                  not b.home and bool(_CLOSING.search(b.text, 0, 200)), b.good, b.weak, b.bad, abs(2 * place - 1) ** 4)
    return out


def content_odds(found: list[Block], weights: np.ndarray = PRIOR) -> list[float]:
    """Log odds of being content; in and outside of an article or main element they
    differ by 8 on pages that have one."""
    home = any(b.home and b.bad < 0.5 for b in found)
    odds = features(found) @ weights + (np.where([b.home for b in found], 4.0, -4.0) if home else 0.0)
    return np.clip(odds, -9, 9).tolist()


def fit(rows: np.ndarray, labels: np.ndarray, prior: np.ndarray = PRIOR, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's steps, drawn towards ``prior`` as by a tenth as many blocks."""
    if not len(rows) or labels.all() or not labels.any():
        return prior
    weights, pull = prior.copy(), np.full(len(prior), max(1.0, len(rows) / 10) / 4)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (p - labels) + pull * (weights - prior)
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + np.diag(pull), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def smoothness(found: list[Block], adjacent: float = 1.5, near: float = 0.6) -> list[tuple[int, int, float]]:
    """Edges between blocks: reading order, weighted by the shared part of the
    paths, and the last block before of the same kind under the same container."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            deeper = max(found[i - 1].element.depth, b.element.depth, 1)
            edges.append((i - 1, i, adjacent * (b.shared / deeper) ** 2))
        container = (id(b.container), b.tag)
        if container in last and last[container] != i - 1:
            edges.append((last[container], i, near))
        last[container] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]], scale: int = 1000) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    A node's costs are -log of the probabilities of the two labels; their
    lesser flows through at once, so one terminal edge is left.  Then Dinic:
    levels by breadth, blocking flows by depth, until the sink is cut off.
    """
    n = len(odds)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def join(a, b, there, back):
        out[a].append(len(to)), to.append(b), room.append(there)
        out[b].append(len(to)), to.append(a), room.append(back)

    for i, x in enumerate(odds):
        whole = round(scale * abs(x))  # -log(1 - p) + log(p) is the log odds
        if x > 0:
            join(source, i, whole, 0)
        elif whole:
            join(i, sink, whole, 0)
    for a, b, w in edges:
        join(a, b, round(scale * w), round(scale * w))
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nth, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
            while nth[a] < len(out[a]):
                e = out[a][nth[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                nth[a] += 1
            if nth[a] < len(out[a]):
                path.append(out[a][nth[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                nth[a] += 1
            else:
                break


def main_text(page: str | None, weights: np.ndarray = PRIOR) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    side = minimum_cut(content_odds(found, weights), smoothness(found))
    return "\n\n".join(b.text for b, content in zip(found, side, strict=True) if content)


def _examples(batches):
    """Features and labels of the blocks of pages with an article or main element."""
    for batch in slices(batches, "html"):
        for page in batch.column(0).to_pylist():
            found = blocks(page or "")
            labels = [b.home and b.bad < 0.5 for b in found]
            if any(labels):
                yield pa.RecordBatch.from_arrays([pa.array(features(found).tolist(), pa.list_(pa.float64())), pa.array(labels, pa.bool_())], ["features", "label"])


def trained(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = 500, train_blocks: int = 50_000) -> np.ndarray:
    """Weights fitted on a bounded sample: the pages of least hash among those with labels."""
    rows = pages.select(F.xxhash64(F.col(id_col).cast("string")).alias("order"), F.col(html_col).cast("string").alias("html"))
    rows = rows.where(F.col("html").rlike(r"(?i)<(?:article|main)[\s>]"))
    least = [r["order"] for r in rows.select("order").distinct().orderBy("order").limit(train_pages).collect()]
    if not least:
        return PRIOR
    sample = rows.where(F.col("order") <= least[-1]).dropDuplicates(["order"]).orderBy("order").select("html")
    found = sample.mapInArrow(_examples, "features array<double>, label boolean").limit(train_blocks).collect()
    return fit(np.array([r["features"] for r in found]).reshape(-1, len(FEATURES)), np.array([r["label"] for r in found], float))


def _extract(weights: np.ndarray):
    def run(batches):
        for batch in slices(batches, "html"):
            texts = [main_text(x, weights) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **sample) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(_extract(trained(pages, id_col, html_col, **sample)), schema)
