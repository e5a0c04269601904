"""Leaf blocks of HTML pages: runs of text between block-level tags, with where they stand."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW_TAGS = frozenset("script style noscript template textarea iframe".split())
#: Elements deeper than this are not told apart from their parents, as in browsers.
DEEPEST = 512
#: A start tag on the left ends an open element on the right, up to the nearest of its containers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_PARAGRAPH_STOPS = {"article", "aside", "div", "section", "td", "th", "li", "body", "button", "main", "nav", "footer", "header", "form"}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: frozenset[str]
    link_chars: int


def _marks(attributes: str) -> frozenset[str]:
    """Words of class, id and role, and "hidden" for what is not shown."""
    if not attributes or attributes.isspace():
        return frozenset()
    words = {w for found in _NAMES.findall(attributes) for w in _WORD.findall("".join(found).lower())}
    if _HIDDEN.search(attributes):
        words.add("hidden")
    return frozenset(words)


def blocks(page: str | None) -> Iterator[Block]:
    """The non-empty leaf blocks in page order; unclosed and misnested tags are taken as browsers do, roughly.

    Behind the last `>` of a page there are no tags, only text. Every tag that is
    tried before it ends there at the latest, so broken pages take linear time.
    """
    page = page or ""
    stack: list[tuple[str, frozenset[str]]] = []
    above: tuple[tuple[str, ...], frozenset[str]] | None = None  # tags and names of the stack, while it stays as it is
    deeper = 0
    parts: list[str] = []
    links = anchors = 0
    place, size = 0, len(page)
    tags_end = page.rfind(">") + 1

    def flush() -> Block | None:
        nonlocal links, above
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        chars, links = links, 0
        if not text:
            return None
        if above is None:
            above = tuple(name for name, _ in stack), frozenset().union(*(marks for _, marks in stack))
        return Block(text, *above, chars)

    def cut(i: int) -> None:
        nonlocal above, anchors
        anchors -= sum(name == "a" for name, _ in stack[i:])
        del stack[i:]
        above = None

    def pop_to(names: set[str], stops: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                cut(i)
                return
            if stack[i][0] in stops:
                return

    def add(piece: str) -> None:
        nonlocal links
        parts.append(piece)
        if anchors:
            links += len(piece.strip())

    while place < size:
        found = _TAG.search(page, place, tags_end) if place < tags_end else None
        if found is None:
            add(page[place:])
            break
        if found.start() > place:
            add(page[place : found.start()])
        place = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            break
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        ends = found["end"] or found["end2"]
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW_TAGS:
            if not ends:
                close = re.compile(f"</{re.escape(name)}", re.I).search(page, place)
                if close is None:
                    break
                place = page.find(">", close.end()) + 1 or size
            continue
        if name in BLOCK_TAGS and (block := flush()):
            yield block
        if ends and deeper:
            deeper -= 1
            continue
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
            continue
        if name in BLOCK_TAGS:
            pop_to({"p"}, _PARAGRAPH_STOPS)
        if name in CLOSES:
            pop_to(*CLOSES[name])
        if name not in VOID_TAGS and not (found["attributes"] or "").endswith("/"):
            if len(stack) >= DEEPEST:
                deeper += 1
                continue
            stack.append((name, _marks(found["attributes"] or found["attributes2"] or "")))
            anchors += name == "a"
            above = None
    if block := flush():
        yield block
