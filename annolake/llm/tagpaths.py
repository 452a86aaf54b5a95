"""Main text of web pages by tag-path ratios.

A page is read as a flat run of blocks. Every block has its root-to-leaf path of tags (with class and id words). Per path, text
length, punctuation and the length of link texts are summed over its blocks; the ratios of the first two to the number of
blocks, the share of text outside links, and the path's sum are fused into one weight. A class, id or role that as a whole names boilerplate (footer, ads,
cookie-notice, comment-list; not related-work or menu-design, whose other words say something), a tag that does (nav, footer), and a place outside the
<article> or <main> of a page that has one, or else outside the container of its only h1, scale a block's weight down: they are a prior,
and between blocks that nothing names the ratios decide. Weights are
smoothed over the neighbouring blocks in page order, each neighbour counting the less the more containers lie between, so
a heading takes part in its paragraphs' weight and an advert beside them does not. Blocks whose weight reaches a share of
the page's mean weight (by text) are content. The lowest container of nearly all content is the article's own: its other
blocks (short items, captions, formulas) belong to it unless their names tell boilerplate.

Defined cases: null and empty pages, and pages whose blocks all lie in menus, footers, forms and the like, give an empty string; unclosed
and stray tags are tolerated, a tag without its end is text; unknown character references stay as they are; a page without
any markup is its own text; repeated rows are extracted alike; other columns are not read. Work is row-local and linear in
the page, however deep its nesting.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import util

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"[\s ]+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCT = re.compile(r"[.,;:!?。，、；：！？]")
_HUGE = re.compile(r"&#[0-9]{4000,};?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?![a-z0-9-])", re.I) for t in "script style noscript template textarea title iframe svg select option noframes".split()}
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr
    math mi mo mn ms mtext mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mstyle semantics annotation canvas""".split()
)
#: Elements that never hold main text.
OUTSIDE = frozenset("nav header footer aside form button menu dialog head".split()) | frozenset(RAW)
#: Fixed words in class, id or role that name boilerplate.
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted
    banner nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead footer foot sidebar side aside
    widget widgets comment comments commentlist disqus respond reply replies discussion cookie cookies consent gdpr notice
    notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations trending pagination pager toolbar search copyright legal disclaimer hidden skip toc
    complementary contentinfo""".split()
)
#: Words that beside one of NAMES change nothing: "site-footer" is a footer, "related-work" is not related links.
BESIDE = frozenset(
    """top bottom left right main side site page global primary secondary inner outer box bar block list item items link links area section container
    wrapper wrap row col column panel content text body form button icon title heading group slot unit space zone region mobile desktop sticky fixed
    js is has the user reader readers article articles post posts entry blog news story stories buttons icons boxes bars blocks lists areas""".split()
)
ROOTS = frozenset(["article", "main"])
CLOSES = {
    "p": frozenset(["p"]),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Elements that are one block of a text even if line breaks divide it.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre".split())
SCOPE = frozenset("ul ol table div article section main body td th blockquote".split())

#: Priors of blocks in boilerplate by name, in boilerplate by tag, outside the page's <article> or <main>, and in no paragraph.
BY_NAME, BY_TAG, AWAY, LOOSE = 0.02, 0.01, 0.3, 0.15
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
#: Weight of the neighbours at each distance, and what each container in between leaves of it.
KERNEL, BETWEEN = (0.6, 0.25), 0.15
SHARE = 0.2


def _tells(token: str) -> bool:
    """Whether a whole class, id or role names boilerplate: one of NAMES, and besides only words that change nothing."""
    words = [w.lower() for w in _WORD.findall(token)]
    return not NAMES.isdisjoint(words) and all(w in NAMES or w in BESIDE for w in words)


def _label(tag: str, attrs: str) -> tuple[str, float]:
    """Path step of an element, and its prior."""
    prior = BY_TAG if tag in OUTSIDE else 1.0
    if not attrs or attrs.isspace():
        return tag, prior
    names, out = [], False
    for key, a, b, c in _ATTR.findall(attrs):
        value, key = a or b or c, key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            prior = BY_TAG
        elif key == "style":
            prior = BY_TAG if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) else prior
        else:
            names += [w.lower() for w in _WORD.findall(value)]
            out |= tag not in ("html", "body", "article", "main") and any(map(_tells, value.split()))
    return (f"{tag}.{'.'.join(names)}" if names else tag), min(prior, BY_NAME if out else 1.0)


class Blocks:
    """A page's blocks in order, and the tree of elements that they lie in; element 0 is the page."""

    def __init__(self, page: str):
        self.parent, self.tag, self.depth, self.path, self.rooted = [0], [""], [0], [0], [False]
        #: for each block its innermost element that is not inline, prior and text
        self.element: list[int] = []
        self.prior: list[float] = []
        self.text: list[str] = []
        self.linked: list[int] = []  # characters inside links
        self._in_link = 0
        self._paths: dict[tuple[int, str], int] = {}
        self._stack: list[tuple[str, int, float, bool]] = []  # tag, element, prior so far, inline
        self._open: dict[str, list[int]] = defaultdict(list)  # places of open tags in the stack
        self._gone: set[int] = set()  # places of inline elements that were closed out of order
        self._blocks: list[int] = []  # places of elements that are not inline
        self._parts: list[str] = []
        self._read(page)

    def _flush(self) -> None:
        if self._parts:
            raw = "".join(self._parts)
            self._parts.clear()
            linked, self._in_link = self._in_link, 0
            if "&" in raw:
                raw = html_lib.unescape(_HUGE.sub("�", raw))
            text = _SPACE.sub(" ", raw).strip()
            if text:
                self.element.append(self._stack[-1][1] if self._stack else 0)
                self.prior.append(self._stack[-1][2] if self._stack else 1.0)
                self.text.append(text)
                self.linked.append(min(linked, len(text)))

    def _add(self, text: str) -> None:
        self._parts.append(text)
        if self._open.get("a"):
            self._in_link += len(text)

    def _cut(self, size: int) -> None:
        """Close what was opened from place `size` on."""
        while len(self._stack) > size:
            tag, _, _, inline = self._stack.pop()
            at = len(self._stack)
            if at in self._gone:
                self._gone.discard(at)
            else:
                self._open[tag].pop()
            if not inline:
                self._blocks.pop()

    def _last(self, tags: frozenset[str]) -> int:
        return max((self._open[t][-1] for t in tags if self._open.get(t)), default=-1)

    def _push(self, tag: str, step: str, prior: float, inline: bool) -> None:
        _, above, so_far, _ = self._stack[-1] if self._stack else ("", 0, 1.0, False)
        element = above
        if not inline:
            element = len(self.parent)
            self.parent.append(above)
            self.tag.append(tag)
            self.depth.append(self.depth[above] + 1)
            self.path.append(self._paths.setdefault((self.path[above], step), len(self._paths) + 1))
            self.rooted.append(self.rooted[above] or tag in ROOTS)
            self._blocks.append(len(self._stack))
        self._open[tag].append(len(self._stack))
        self._stack.append((tag, element, min(so_far, prior), inline))

    @staticmethod
    def _end(page: str, at: int) -> int:
        """Place of the > that ends a tag, past quoted values; -1 if there is none."""
        while m := _STOP.search(page, at):
            if m[0] == ">":
                return m.start()
            close = page.find(m[0], m.end())
            if close < 0:
                return page.find(">", m.end())
            at = close + 1
        return -1

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._add(page[at:lt])
            if lt == n:
                break
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            m = _NAME.match(page, lt)
            if m is None and page[lt + 1 : lt + 2] not in ("!", "?"):
                self._add("<")
                at = lt + 1
                continue
            end = self._end(page, m.end()) if m else page.find(">", lt)
            if end < 0:  # no tag ends after this
                self._add(page[lt:])
                break
            at = end + 1
            if m is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                if page[end - 1] != "/":
                    stop = RAW[tag].search(page, at)
                    close = page.find(">", stop.end()) if stop else -1
                    at = n if close < 0 else close + 1
                if tag not in ("script", "style", "template", "noscript"):
                    self._flush()
            elif tag in ("br", "hr"):
                self._flush()
            elif tag not in VOID:
                self._enter(tag, page[m.end() : end])
        self._flush()

    def _close(self, tag: str) -> None:
        inline = tag in INLINE
        places = self._open.get(tag)
        if not inline:
            self._flush()
            if places:
                self._cut(places[-1])
        elif places and places[-1] > (self._blocks[-1] if self._blocks else -1):
            k = places[-1]
            if self._stack[k][2] < (self._stack[k - 1][2] if k else 1.0):
                self._flush()
            if k == len(self._stack) - 1:
                self._cut(k)
            else:
                places.pop()
                self._gone.add(k)

    def _enter(self, tag: str, attrs: str) -> None:
        step, prior = _label(tag, attrs)
        if tag in INLINE:
            if prior < 1:
                self._flush()
            self._push(tag, step, prior, True)
            return
        self._flush()
        closes = CLOSES.get(tag) or (CLOSES["p"] if tag in CLOSES_P else frozenset())
        if closes:
            k = self._last(closes)
            if k >= 0 and k >= self._last(SCOPE):
                self._cut(k)
        self._push(tag, step, prior, False)

    def between(self, a: int, b: int, most: int = 8) -> int:
        """How many containers lie between two blocks' elements (`most` stands for that and more)."""
        a, b = (self.parent[x] if self.tag[x] in PARTS else x for x in (a, b))
        d = 0
        while a != b and d < most:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            d += 1
        return d


def _rooted(page: Blocks) -> list[bool]:
    """Which blocks lie in <article> or <main>; on a page without either, in the lowest container that the page's only h1 shares with another block."""
    if any(page.rooted) or page.tag.count("h1") != 1:
        return [page.rooted[e] for e in page.element]
    own = [0] * len(page.parent)
    for e in page.element:
        own[e] += 1
    for e in range(len(own) - 1, 0, -1):
        own[page.parent[e]] += own[e]
    head = page.tag.index("h1")
    box = page.parent[head]
    while box and own[box] <= own[head]:
        box = page.parent[box]
    if not box or page.tag[box] in ("html", "body"):
        return [False] * len(page.element)
    inside = [e == box for e in range(len(own))]
    for e in range(1, len(own)):
        inside[e] |= inside[page.parent[e]]
    return [inside[e] for e in page.element]


def weights(page: Blocks) -> tuple[list[float], list[float]]:
    """Fused and smoothed weight of each block, and its prior."""
    length: dict[int, int] = defaultdict(int)
    punct: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    count: dict[int, int] = defaultdict(int)
    paths = [page.path[e] for e in page.element]
    for path, text, links in zip(paths, page.text, page.linked, strict=True):
        length[path] += len(text)
        linked[path] += links
        punct[path] += len(_PUNCT.findall(text))
        count[path] += 1
    fused = {p: (1 + length[p] / count[p]) * (1 + punct[p] / count[p]) * length[p] ** 0.5 * (1.05 - linked[p] / length[p]) for p in length}
    rooted = _rooted(page)
    away = AWAY if any(r and p == 1 for r, p in zip(rooted, page.prior, strict=True)) else 1.0
    prior = [p * (1.0 if r else away) * (1.0 if page.tag[e] in PROSE else LOOSE) for p, r, e in zip(page.prior, rooted, page.element, strict=True)]
    own = [fused[path] * p for path, p in zip(paths, prior, strict=True)]
    out = []
    for i, e in enumerate(page.element):
        total, weight = own[i], 1.0
        for d, share in enumerate(KERNEL, 1):
            for j in (i - d, i + d):
                if 0 <= j < len(own):
                    k = share * BETWEEN ** page.between(e, page.element[j])
                    total, weight = total + k * own[j], weight + k
        # a block's own names hold whatever stands beside it
        out.append(min(total / weight, max(own[i], prior[i] * total / weight)))
    return out, prior


def content(page: Blocks, share: float = SHARE) -> list[bool]:
    """Which blocks are content: those whose weight reaches `share` of the mean weight, each block counted by its text and prior."""
    w, prior = weights(page)
    by = [len(t) * p for t, p in zip(page.text, prior, strict=True)]
    mean = sum(x * y for x, y in zip(w, by, strict=True)) / sum(by)
    return [x >= share * mean for x in w]


def main_text(page: str | None, share: float = SHARE) -> str:
    """Text of the article of one page."""
    if not page:
        return ""
    found = Blocks(page)
    if not any(p > BY_TAG for p in found.prior):
        return ""
    chosen = content(found, share)
    # text of content below each element, and what can be a container: no block of its own alone
    held, inner, direct = [0] * len(found.parent), [0] * len(found.parent), [0] * len(found.parent)
    for e, text, yes in zip(found.element, found.text, chosen, strict=True):
        held[e] += len(text) * yes
        direct[e] += 1
    for e in range(len(held) - 1, 0, -1):
        held[found.parent[e]] += held[e]
        inner[found.parent[e]] += bool(inner[e] or direct[e])
    box = 0
    for e in range(1, len(held)):
        if held[e] >= 0.8 * held[0] and found.tag[e] not in PARTS and (inner[e] or direct[e] > 1) and found.depth[e] > found.depth[box]:
            box = e
    inside = [e == box for e in range(len(held))]
    for e in range(1, len(held)):
        inside[e] |= inside[found.parent[e]]
    return " ".join(t for e, t, p, yes in zip(found.element, found.text, found.prior, chosen, strict=True) if yes or inside[e] and p == 1)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in util.slices(whole, "html", 8 << 20):
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
