"""Leaf blocks of an HTML page with what stands around them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

#: Fixed lists of HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select option optgroup datalist".split()
)
RAW = "script|style|noscript|template|textarea|title|iframe|xmp"
#: A start tag of the first closes an open element of the second kind.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th"), "tfoot": ("tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table td th body html".split())
#: An open p beyond one of these stays open at a start tag other than p.
P_SCOPES = frozenset("table td th button body article div".split())
#: What may stand in head; any other start tag, and text, ends a head that is still open.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
_FLOW = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "li main menu nav ol p pre section table td th tr ul".split()
)
#: Start tags that end an open choice list or drawing, whose end tag is missing then.
ENDS_CHOICE = _FLOW | frozenset("input select textarea".split())
ENDS_DRAWING = _FLOW | frozenset("b big br code em embed hr i img nobr ruby s small span strike strong sub sup tt u var".split())
CHOICE = frozenset("select option optgroup".split())
DRAWING = frozenset("svg math".split())
#: Parts of drawings that may hold HTML.
HOLDS_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<(?P<raw>{RAW})\b(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[A-Za-z][^\s/>]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?][^>]*>|<[A-Za-z/!?][^>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass(eq=False)
class Element:
    """`parent` is the element around it; `notes` is for what a reader finds out once per element."""

    tag: str
    names: frozenset[str]
    main: bool
    parent: Element | None = None
    notes: object = None


@dataclass
class Block:
    """White space made single, the innermost element around it, and its link share."""

    text: str
    inner: Element | None
    linked: float

    @property
    def path(self) -> tuple[Element, ...]:
        """The elements around it from the outside in."""
        out, at = [], self.inner
        while at is not None:
            out.append(at)
            at = at.parent
        return tuple(reversed(out))


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    inner: Element | None = None
    linked: int = 0


class _Stack:
    """The open elements; where those of a tag lie is known without a search, however many are open."""

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.hidden = 0

    def top(self) -> Element | None:
        return self.elements[-1] if self.elements else None

    def push(self, element: Element) -> None:
        element.parent = self.top()
        self.places.setdefault(element.tag, []).append(len(self.elements))
        self.elements.append(element)
        self.hidden += element.tag in HIDDEN

    def cut(self, at: int) -> None:
        """Close all elements from place `at` on."""
        while len(self.elements) > at:
            tag = self.elements.pop().tag
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN

    def has(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def last(self, tags: Iterable[str]) -> int:
        """The innermost place of one of the tags, -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def first(self, tags: Iterable[str]) -> int | None:
        """The outermost place of one of the tags."""
        return min((self.places[t][0] for t in tags if self.places.get(t)), default=None)


_NONE: frozenset[str] = frozenset()


def _element(tag: str, rest: str) -> Element:
    names, main = _NONE, False
    if "=" in rest:
        words = []
        for key, a, b, c in ATTRIBUTE.findall(rest):
            if key.lower() == "data-main":
                main = True
            else:
                words += PIECES.findall(a or b or c)
        names = frozenset(w.lower() for w in words)
    return Element(tag, names, main)


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of visible text in page order.

    A block ends where a block element starts or ends; inline elements and line breaks do not
    end it. Comments, scripts, styles and other hidden elements are passed over, as is a tag
    cut off at the end. Unclosed and stray tags are taken as browsers do in the common cases:
    head, select, svg and math without an end tag end where something stands that they cannot hold.
    """
    out: list[Block] = []
    stack = _Stack()
    now = _Open()

    def flush() -> None:
        nonlocal now
        if now.parts:
            raw = "".join(now.parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                out.append(Block(text, now.inner, now.linked / max(1, len(raw))))
            now = _Open()

    def close(tags: tuple[str, ...], stop: frozenset[str]) -> None:
        at = stack.last(tags)
        if at > stack.last(stop.difference(tags)):
            stack.cut(at)

    def leave(tag: str) -> None:
        """Out of the outermost hidden element that cannot hold a start tag `tag`, or text (an empty tag)."""
        ends = [("head",)] if tag not in IN_HEAD else []
        ends += [CHOICE] if tag in ENDS_CHOICE else []
        ends += [DRAWING] if tag in ENDS_DRAWING and stack.first(HOLDS_HTML) is None else []
        at = [place for place in map(stack.first, ends) if place is not None]
        if at:
            stack.cut(min(at))

    for token in TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            blank = text.isspace()
            if stack.hidden and not blank:
                leave("")
            if not stack.hidden and (now.parts or not blank):
                if not now.parts:
                    now.inner = stack.top()
                now.parts.append(text)
                if stack.has("a"):
                    now.linked += len(text)
            continue
        raw = token["raw"]
        if raw is None and token["tag"] is None:
            continue
        tag, rest = (raw or token["tag"]).lower(), token["rest"]
        if stack.hidden and tag[0] != "/":
            leave(tag)
        if raw is not None:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if stack.has(tag):
                if tag not in INLINE:
                    flush()
                stack.cut(stack.last((tag,)))
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            if now.parts:
                now.parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            if tag != "p" or stack.has("p"):
                close(("p",), P_SCOPES if tag != "p" else SCOPES)
            if tag in CLOSES:
                close(CLOSES[tag], SCOPES)
        if rest.endswith("/") and tag in ("svg", "path", "use"):
            continue
        stack.push(_element(tag, rest))
    flush()
    return out
