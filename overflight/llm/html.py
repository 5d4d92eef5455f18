"""Main text of HTML pages by tag-path ratios.

A page is read as a sequence of text blocks, each with the path of block
elements (with classes) from the root to it. Text that markup itself declares
to be something else (scripts, forms, navigation, adverts, reader comments ...)
is left out first. For every distinct path the text length and the number of
punctuation marks are summed over its nodes and divided by their number; both
series, in page order of the paths, are smoothed with their neighbours and
multiplied. Paths whose product reaches a share of the largest one are content.
Their containers are taken whole: from the parent of a content path upwards as
long as it holds at least half of the text of the element around it, up to the
page itself. All paths in such a container are content but those whose text is
mostly links. Without a top heading in them, an element in front that has one
belongs to them. The text is every block of the content paths, in page order.

Where a page marks its article or main part and that part has text, only paths
inside it compete. An article (or main part without one) that holds a content
path is one container, whatever sections divide it.

Class and id names declare an element only as whole names (``sidebar``), or if
all words of a name speak of page furniture (``share-buttons``); ``legal-text``
or ``social-history`` say nothing. Names that may as well stand on an article's
section (``discussion``, ``related``) count only outside a marked article, and
not if the path with the best ratios carries one. Formulas (MathML) are text,
drawings (SVG) are not.

Defined results: null, empty and text-free pages give an empty text. Broken
markup is closed as browsers do for paragraphs, list items and table cells; an
element never closed ends with its parent. Equal rows each give a row, pages
may have any length, an empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from overflight.llm.common import portions

# Element names by how HTML treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr math mrow mi mo mn mtext msup msub mfrac msqrt semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes noscript template svg annotation".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {  # an open element that a start tag ends, and the elements beyond which it does not look
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
# Elements, roles and class or id words that declare something other than article text.
APART = frozenset("nav footer aside form button select input label fieldset menu dialog head object applet canvas "
                  "audio video map".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
APART_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox banner sponsor sponsored promo nav navbar navigation menu topbar "
    "breadcrumb breadcrumbs footer sidebar aside cookie cookies consent gdpr popup modal overlay newsletter signup login "
    "comment comments commentlist disqus respond replies share sharing pagination pager widget toolbar masthead "
    "copyright skip".split())
DOUBTFUL_WORDS = frozenset(
    "side social related recommended notice notification alert promotion subscribe subscription reply discussion "
    "feedback legal disclaimer".split())
# Words that say nothing of their own beside those.
COMPANIONS = frozenset(
    "site page main top bottom left right global primary secondary wrapper wrap container box block area section list "
    "item items bar links link buttons button icons icon form posts post articles article stories news unit slot panel "
    "group inner outer row col column holder header head title policy warning message msg".split())
HEADER_NAMES = frozenset("header hdr site-header page-header top-header main-header header-top siteheader pageheader".split())
ARTICLE = frozenset(("article", "main"))

TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTES = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…·]")
SMOOTHING = np.array([0.25, 0.5, 0.25])
CONTENT_SHARE = 0.1
HOLDS_SHARE = 0.5
LINKED_SHARE = 0.6


@dataclass
class Block:
    path: tuple[str, ...]
    marked: bool  # inside an article or main element
    part: int  # steps of the path down to the outermost article, or main element where there is none; 0 without either
    doubt: bool  # inside an element whose name may declare it, outside a marked part
    linked: int  # characters inside links
    text: str


class _Open:
    __slots__ = ("tag", "apart", "doubt", "marked", "link", "step")

    def __init__(self, tag: str, apart: bool, doubt: bool, marked: bool, link: bool, step: str | None):
        self.tag, self.apart, self.doubt, self.marked, self.link, self.step = tag, apart, doubt, marked, link, step


APART_NAME, DOUBTFUL_NAME, PLAIN_NAME = 2, 1, 0


def named(name: str) -> int:
    """What a single class or id name says of an element."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    if not any(w in APART_WORDS or w in DOUBTFUL_WORDS for w in words):
        return PLAIN_NAME
    if len(words) == 1:
        return APART_NAME if words[0] in APART_WORDS else DOUBTFUL_NAME
    if all(w in APART_WORDS or w in DOUBTFUL_WORDS or w in COMPANIONS for w in words):
        return APART_NAME
    return DOUBTFUL_NAME if any(w in APART_WORDS for w in words) else PLAIN_NAME


def _declared(tag: str, attributes: str, marked: bool) -> tuple[bool, bool, str]:
    """Whether an element is declared to be other than article text, whether it may be, and its step in paths."""
    if not attributes.strip():
        return tag in APART or (tag == "header" and not marked), False, tag
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTES.findall(attributes)}
    role, classes = found.get("role", "").lower(), found.get("class", "")
    names = f"{classes} {found.get('id', '')}".split()
    says = max(map(named, names), default=PLAIN_NAME)
    bare = f" {attributes.lower()} "
    apart = (
        tag in APART or role in APART_ROLES or says == APART_NAME
        or (not marked and (tag == "header" or any(n.lower() in HEADER_NAMES for n in names)))
        or found.get("aria-hidden", "").lower() == "true" or re.search(r"\shidden[\s=]", bare) is not None
        or re.search(r"display\s*:\s*none", found.get("style", "").lower()) is not None
    )
    if tag in ("html", "body", "main"):
        apart, says = False, PLAIN_NAME
    elif tag == "article":
        apart = says == APART_NAME
    return apart, says == DOUBTFUL_NAME and not marked, f"{tag}.{'.'.join(classes.split())}" if classes.strip() else tag


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, without those that are declared to be something else."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[tuple[str, bool]] = []

    def part() -> int:
        steps = main = 0
        for o in stack:
            steps += o.step is not None
            if o.tag == "article":
                return steps
            if o.marked and not main:
                main = steps
        return main

    def flush() -> None:
        raw = "".join(p for p, _ in parts)
        text = " ".join(raw.split())
        if text:
            linked = sum(len(p.strip()) for p, link in parts if link)
            path = tuple(o.step for o in stack if o.step)
            out.append(Block(path, any(o.marked for o in stack), part(), bool(stack) and stack[-1].doubt, linked, text))
        parts.clear()

    def close(depth: int) -> None:
        if any(o.step for o in stack[depth:]):
            flush()
        del stack[depth:]

    def add(text: str) -> None:
        if text and not (stack and stack[-1].apart):
            parts.append((html.unescape(text), bool(stack) and stack[-1].link))

    at = 0
    while True:
        m = TOKENS.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag in INLINE and stack[depth].step:
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in ENDS_PARAGRAPH or tag in SIBLINGS:
            ended, beyond = SIBLINGS.get(tag, ({"p"}, ENDS_PARAGRAPH - {"p"}))
            found = None
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in ended:
                    found = depth
                    if tag not in ("tr", "tbody"):
                        break
                elif stack[depth].tag in beyond:
                    break
            if found is not None:
                close(found)
        inline = tag in INLINE
        if not inline:
            flush()
        if tag in VOID or m[3].endswith("/"):
            continue
        above = stack[-1] if stack else _Open("", False, False, False, False, None)
        apart, doubt, step = _declared(tag, m[3], above.marked)
        marked = above.marked or tag in ARTICLE or re.search(r"role\s*=\s*[\"']?main\b", m[3]) is not None
        doubt = (above.doubt or doubt) and not marked
        stack.append(_Open(tag, above.apart or apart, doubt, marked, above.link or tag == "a", None if inline else step))
    flush()
    return out


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.concatenate((values[:1], values, values[-1:]))
    return np.convolve(padded, SMOOTHING, mode="valid")


class _Ratios:
    """The distinct paths of some blocks in page order, with their scores."""

    def __init__(self, found: list[Block]):
        self.order = list(dict.fromkeys(b.path for b in found))
        self.number = {path: i for i, path in enumerate(self.order)}
        nodes, self.length, marks, linked, links = (np.zeros(len(self.order)) for _ in range(5))
        self.parts: dict[tuple[str, ...], int] = {}
        self.doubt: dict[tuple[str, ...], bool] = {}
        for b in found:
            i = self.number[b.path]
            nodes[i] += 1
            self.length[i] += len(b.text)
            marks[i] += len(PUNCTUATION.findall(b.text))
            linked[i] += 0 if b.marked else b.linked
            links[i] += b.linked
            self.parts.setdefault(b.path, b.part)
            self.doubt.setdefault(b.path, b.doubt)
        self.linkless = links <= LINKED_SHARE * self.length
        plain = np.where(linked > LINKED_SHARE * self.length, 0.0, 1.0)
        self.fused = _smooth(self.length / nodes * plain) * _smooth((1 + marks) / nodes * plain) * plain * np.log1p(self.length)

    def best_is_doubtful(self) -> bool:
        return self.doubt[self.order[int(self.fused.argmax())]]


def _is_page(container: tuple[str, ...]) -> bool:
    return all(step.split(".")[0] in ("html", "body") for step in container)


def content_paths(found: list[Block]) -> set[tuple[str, ...]]:
    """The paths whose fused, smoothed length and punctuation ratios reach the threshold, and what belongs to them."""
    r = _Ratios(found)
    chosen = {path for path, score in zip(r.order, r.fused) if score > 0 and score >= CONTENT_SHARE * r.fused.max()}
    held: dict[tuple[str, ...], float] = {}
    for path, i in r.number.items():
        if r.linkless[i]:
            for depth in range(len(path)):
                held[path[:depth]] = held.get(path[:depth], 0.0) + r.length[i]

    def climbed(container: tuple[str, ...]) -> tuple[str, ...]:
        while container and not _is_page(container[:-1]) and held.get(container, 0) >= HOLDS_SHARE * held.get(container[:-1], 0):
            container = container[:-1]
        return container

    # Their containers, but not the page itself unless text stands right under it; or the whole marked part around them.
    around = {path[:r.parts[path]] if r.parts[path] else climbed(path[:-1]) for path in chosen}
    kept = {path for path in r.order if r.linkless[r.number[path]] and any(path[:len(c)] == c for c in around)}
    if not any(step in ("h1",) for path in kept | chosen for step in path):
        first = min(r.number[path] for path in kept | chosen) if kept | chosen else 0
        beside = {c[:-1] for c in around if c}
        titled = [path for path in r.order[:first] if "h1" in path and any(path[:len(c)] == c and len(path) > len(c) + 1 for c in beside)]
        lead = {path[:len(c) + 1] for path in titled for c in beside if path[:len(c)] == c}
        kept |= {path for path in r.order[:first] if r.linkless[r.number[path]] and any(path[:len(c)] == c for c in lead)}
    return kept | chosen


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if any(b.marked for b in found):
        found = [b for b in found if b.marked]
    elif any(b.doubt for b in found) and not _Ratios(found).best_is_doubtful():
        found = [b for b in found if not b.doubt]
    if not found:
        return ""
    paths = content_paths(found)
    return "\n".join(b.text for b in found if b.path in paths)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, "html"):
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id").cast(pa.int64()), "url": batch.column("url").cast(pa.string()),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
