"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with its root-to-leaf path of block elements.
Per path, text length, punctuation and link text are added up; paths that hold prose have
long, punctuated blocks with little of it in links. Block scores are smoothed along the page, fused
with what the markup itself says (article and main elements; menus, adverts and the like by
element name, class, id or role), and paths above the threshold are the content.

Defined cases: null or empty html gives empty text; unclosed, misnested and unknown tags
are tolerated, in time linear in the page; a page without any content path gives empty text; equal rows give equal results.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from gablework.llm.pretokens import text_batches

OPENING = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile("[>\"']")
NAMES = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")

RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr ruby rt rp img".split()
)
# What an opening tag closes when it is still open.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "thead": {"thead", "tbody"}, "tbody": {"thead", "tbody"},
}
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
BARRIER = frozenset("article aside blockquote body div footer form header main nav section table td th ul ol".split())

FURNITURE_TAGS = frozenset("head nav header footer aside form menu button select dialog fieldset object audio video canvas".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay comment comments "
    "disqus reply replies respond related recommended share sharing social newsletter subscribe subscription signup login search widget pagination pager "
    "copyright disclaimer skip complementary contentinfo form".split()
)
# Name parts that tell of a page's state, as in has-sidebar or no-comments, not of the element.
STATES = frozenset("has no with without not hide hides show shows".split())
CONTENT_TAGS = frozenset({"article", "main"})
CONTENT_NAMES = frozenset({"main", "article", "articlebody"})


class Paths:
    """Root-to-leaf paths as numbers: each is its parent's number and one more step. 0 is the empty path."""

    def __init__(self):
        self.steps, self.parents = [""], [-1]
        self._known: dict[tuple[int, str], int] = {}

    def below(self, parent: int, step: str) -> int:
        found = self._known.setdefault((parent, step), len(self.steps))
        if found == len(self.steps):
            self.steps.append(step)
            self.parents.append(parent)
        return found

    def spans(self) -> tuple[list[int], list[int]]:
        """First and last place of each path's subtree, all paths in depth-first order."""
        sizes = [1] * len(self.steps)
        for i in range(len(sizes) - 1, 0, -1):  # a parent has the lesser number
            sizes[self.parents[i]] += sizes[i]
        first, free = [0] * len(sizes), [1] * len(sizes)
        for i in range(1, len(sizes)):
            up = self.parents[i]
            first[i] = free[up]
            free[up] += sizes[i]
            free[i] = first[i] + 1
        return first, [f + n - 1 for f, n in zip(first, sizes)]


class Tags:
    """Markup of a page, one piece after the other."""

    def __init__(self, page: str):
        self.page = page
        self._hopeless: set[int] = set()  # opening quotes from which no tag ends
        self._last = page.rfind(">")
        self._ahead: re.Match | None = None  # first stop behind the name last looked at

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """The next piece from ``at``: its place and end, ``/`` of an end tag, name and attributes (empty but for tags)."""
        page = self.page
        while (found := OPENING.search(page, at)) is not None:
            at = found.end()
            if found[0] == "<!--":
                end = page.find("-->", at)
                return found.start(), len(page) if end < 0 else end + 3, "", "", ""
            if at > self._last:
                continue
            end = self._end(at) if found[2] else page.find(">", at)
            if end >= 0:
                return found.start(), end + 1, found[1] or "", found[2] or "", page[at:end]
        return None

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, not one in quotes; -1 if there is none."""
        page, opened = self.page, []
        if self._ahead is None or self._ahead.start() < at:
            self._ahead = STOP.search(page, at)
        stop = self._ahead
        while stop is not None:
            if stop[0] == ">":
                return stop.start()
            closing = -1 if stop.start() in self._hopeless else page.find(stop[0], stop.end())
            opened.append(stop.start())
            if closing < 0:
                break
            stop = STOP.search(page, closing + 1)
        self._hopeless.update(opened)
        return -1


@dataclass
class Block:
    path: int
    furniture: bool
    content: bool
    form: bool = False  # in a form, but for that not furniture; a form below a content element is furniture
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


@dataclass(frozen=True)
class TagPathRules:
    smooth: int = 1  # blocks to either side
    threshold: float = 0.35  # share of the best path's score
    most_linked: float = 0.6
    wrapping: float = 0.75  # share of a page's text above which a form is its wrapper


@dataclass(frozen=True)
class Open:
    """An open element, and what it and those around it say."""

    tag: str = ""
    path: int = 0
    furniture: bool = False
    content: bool = False
    form: bool = False
    wrapped: bool = False  # a content element stands inside the innermost form


def read_blocks(page: str, paths: Paths) -> list[Block]:
    """Text blocks of a page in order, empty ones left out."""
    blocks: list[Block] = []
    stack = [Open()]
    count: Counter[str] = Counter()  # open elements by name
    current: Block | None = None
    tags = Tags(page)
    at = 0

    def add(raw: str) -> None:
        nonlocal current
        text = entities.unescape(raw) if "&" in raw else raw
        if current is None:
            if not text or text.isspace():
                return
            top = stack[-1]
            # A page may be wrapped in one form: a content element inside it speaks louder.
            form = top.form and not top.wrapped
            current = Block(top.path, top.furniture or form and top.content, top.content, form)
            blocks.append(current)
        current.pieces.append(text)
        if count["a"]:
            current.linked += len(text.strip())

    def pop_to(index: int) -> None:
        nonlocal current
        for element in stack[index:]:
            count[element.tag] -= 1
            if element.tag not in INLINE:
                current = None
        del stack[index:]

    while (found := tags.find(at)) is not None:
        start, end, slash, name, attributes = found
        if start > at:
            add(page[at:start])
        at = end
        name = name.lower()
        if not name:
            continue
        if slash:
            for i in range(len(stack) - 1, 0 if count[name] else len(stack), -1):
                if stack[i].tag == name:
                    pop_to(i)
                    break
                if name in INLINE and stack[i].tag not in INLINE:
                    break  # an inline end tag does not reach out of its block
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            continue
        if name in ("br", "hr"):
            current = None
        if name in VOID:
            continue
        closed = CLOSES.get(name, set()) | ({"p"} if name in CLOSES_P else set())
        if any(count[x] for x in closed):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closed:
                    pop_to(i)
                    break
                if stack[i].tag in BARRIER:
                    break
        step, furniture, content = _evidence(name, attributes)
        top = stack[-1]
        path = top.path if name in INLINE else paths.below(top.path, step)
        wrapped = name != "form" and (top.wrapped or content)
        stack.append(Open(name, path, top.furniture or furniture, top.content or content, top.form or name == "form", wrapped))
        count[name] += 1
        if name not in INLINE:
            current = None
    add(page[at:])
    return blocks


def _evidence(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Step of the path, and whether the element speaks for furniture or for content."""
    furniture, content, step = tag in FURNITURE_TAGS and tag != "form", tag in CONTENT_TAGS, tag
    if attributes and "=" in attributes or "hidden" in attributes:
        for found in NAMES.finditer(attributes):
            name = found[1].lower()
            value = (found[2] or found[3] or found[4] or "").lower()
            if name in ("hidden", "aria-hidden"):
                furniture |= value != "false"
                continue
            parts = [WORDS.findall(x) for x in value.split()]
            words = {w for x in parts if len(x) < 2 or x[0] not in STATES for w in x}
            furniture |= bool(words & FURNITURE_NAMES) and tag not in ("html", "body")
            content |= bool(words & CONTENT_NAMES)
            if name == "class" and value:
                step = f"{tag}.{'.'.join(sorted(value.split()))}"
    return step, furniture, content


def main_text(page: str, rules: TagPathRules = TagPathRules()) -> str:
    paths = Paths()
    blocks = [(b, t) for b in read_blocks(page, paths) if (t := b.text())]
    open_ = [(b, t) for b, t in blocks if not b.furniture]
    size = {form: sum(len(t) - min(b.linked, len(t)) for b, t in open_ if b.form == form) for form in (False, True)}
    if size[True] <= rules.wrapping * (size[False] + size[True]):
        open_ = [(b, t) for b, t in open_ if not b.form]  # a form for readers, not one around the page
    if any(b.content for b, _ in open_):
        open_ = [(b, t) for b, t in open_ if b.content]
    if not open_:
        return ""
    totals: dict[int, list[float]] = {}
    for b, t in open_:
        sums = totals.setdefault(b.path, [0, 0, 0, 0])
        for i, x in enumerate((1, len(t), len(PUNCTUATION.findall(t)), min(b.linked, len(t)))):
            sums[i] += x
    ratio = {p: (size / n) * (1 + marks / n) * (1 - linked / size) for p, (n, size, marks, linked) in totals.items()}
    scores = [ratio[b.path] for b, _ in open_]
    k = rules.smooth
    smooth = [sum(scores[max(0, i - k) : i + k + 1]) / len(scores[max(0, i - k) : i + k + 1]) for i in range(len(scores))]
    fused: dict[int, float] = {}
    for (b, _), s, own in zip(open_, smooth, scores):
        # The markup's own word for content outweighs ratios; a heading follows what it stands over.
        value = max(s if _heading(paths.steps[b.path]) else (s * own) ** 0.5, float("inf") if b.content else 0.0)
        fused[b.path] = max(fused.get(b.path, 0.0), value)
    best = max((v for v in fused.values() if v != float("inf")), default=0.0)
    kept, menu = [], []
    for b, _ in open_:
        _, size, _, linked = totals[b.path]
        menu.append(linked > rules.most_linked * size and not _heading(paths.steps[b.path]) and paths.steps[b.path] != "p")
        kept.append(not menu[-1] and fused[b.path] >= rules.threshold * best and fused[b.path] > 0)
    return " ".join(t for (_, t), k in zip(open_, _bridged(paths, [b.path for b, _ in open_], kept, menu)) if k)


def _bridged(paths: Paths, own: list[int], kept: list[bool], menu: list[bool]) -> list[bool]:
    """Short blocks, such as list items, cells and quotes, stay between kept ones of the parent they stand below."""
    out = list(kept)
    first, last = paths.spans()
    at = [i for i, k in enumerate(kept) if k]
    for before, after in zip(at, at[1:]):
        parent = paths.parents[own[before]]
        if parent > 0 and paths.parents[own[after]] == parent:
            for i in range(before + 1, after):
                out[i] = not menu[i] and first[parent] <= first[own[i]] <= last[parent]
    return out


def _heading(step: str) -> bool:
    return re.match(r"h[1-6](?:\.|$)", step) is not None


def extract(pages: DataFrame, html: str = "html", into: str = "text", rules: TagPathRules = TagPathRules()) -> DataFrame:
    """All columns but the html, and the main text; a column named as ``into`` is replaced."""
    kept = [c for c in pages.columns if c not in (html, into)]
    fields = ", ".join([*[f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept], f"`{into}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in text_batches(batch, html):
                texts = pa.array([main_text(x, rules) for x in found], pa.string())
                rows = batch.slice(first, len(found))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], texts], [*kept, into])

    return pages.select(*[f"`{c}`" for c in [*kept, html]]).mapInArrow(run, fields)
