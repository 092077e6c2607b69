"""A small tolerant reader of HTML: the block elements of a page as a tree, and its text in blocks."""

from __future__ import annotations

import html
import re
from collections import Counter

#: Elements of HTML by their role (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe svg canvas object head title select textarea button".split())
RAW = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: Elements that stay in an open head: the start of any other, and text, ends it.
IN_HEAD = frozenset("head title meta link base style script noscript template".split())
BLANK = " \t\n\f\r"
#: An opening tag ends an open element of these, if it is nearer than the container named behind.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/><]*+)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^<>]*+>|<[!?/][^>]*+>|(?P<text>[^<]+)|(?P<lone><)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME = re.compile(r"[a-z]+")


class Tree:
    """Block elements in page order: ``tag``, ``parent`` (of smaller number), ``names``; segments of own text."""

    def __init__(self):
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.names: list[frozenset[str]] = []
        #: (element, text with white space joined, characters inside links)
        self.segments: list[tuple[int, str, int]] = []

    def add(self, tag: str, parent: int, attrs: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        found = ATTRIBUTE.findall(attrs) if attrs else ()
        words = NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", " ".join(f"{k} {v}" if k.lower() == "hidden" else v for k, v in found)).lower())
        self.names.append(frozenset(words))
        return len(self.tag) - 1


def parse(page: str | None) -> Tree:
    """The tree of a page; a null or empty page has only its root."""
    tree = Tree()
    root = tree.add("body", -1)
    #: Open elements: (tag, element of the tree it stands in or is, whether its text is dropped)
    stack: list[tuple[str, int, bool]] = [("body", root, False)]
    pieces: list[str] = []
    link_chars, links = 0, 0
    #: Open elements by tag: a search of the stack is made only for what is there.
    open_tags: Counter[str] = Counter()

    def flush(element: int) -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tree.segments.append((element, text, link_chars))
            pieces.clear()
        link_chars = 0

    def pop_to(size: int) -> None:
        nonlocal links
        while len(stack) > size:
            tag, element, _ = stack.pop()
            open_tags[tag] -= 1
            if tag == "a":
                links -= 1
            if element != stack[-1][1]:
                flush(element)

    def nearest(tags: tuple[str, ...], stops: tuple[str, ...]) -> int | None:
        if not any(open_tags[tag] for tag in tags):
            return None
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in tags:
                return at
            if stack[at][0] in stops:
                return None
        return None

    page = page or ""
    at, last = 0, page.rfind(">")
    while at < len(page):
        if at <= last or page.startswith("<!--", at):
            match = TOKEN.match(page, at)
            at, text = match.end(), match["text"] or match["lone"]
        else:
            # Behind the last ">" no tag can end: what is no comment is text.
            comment = page.find("<!--", at)
            end = len(page) if comment < 0 else comment
            at, text = end, page[at:end]
        if text is not None:
            if stack[-1][0] == "head" and html.unescape(text).strip(BLANK):
                pop_to(len(stack) - 1)
            if not stack[-1][2]:
                decoded = html.unescape(text) if "&" in text else text
                pieces.append(decoded)
                if links:
                    link_chars += len(decoded.strip())
            continue
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["close"]:
            if tag in ("html", "body"):
                if stack[-1][0] == "head":
                    pop_to(len(stack) - 1)
                continue
            place = nearest((tag,), ("td", "th") if tag in INLINE else ())
            if place is not None:
                pop_to(place)
            elif tag == "p":
                # An end without a start is an empty paragraph: it parts what stands around it.
                flush(stack[-1][1])
            continue
        if tag in ("html", "body"):
            if tag == "body":
                place = nearest(("head",), ())
                if place is not None:
                    pop_to(place)
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            pop_to(len(stack) - 1)
        if tag == "br" or tag in VOID:
            pieces.append(" ")
            if tag == "hr":
                flush(stack[-1][1])
            continue
        if tag in CLOSES_P:
            place = nearest(("p",), ("td", "th", "li", "div", "article", "section", "body"))
            if place is not None:
                pop_to(place)
        if tag in IMPLIED:
            place = nearest(*IMPLIED[tag])
            while place is not None:
                pop_to(place)
                place = nearest(*IMPLIED[tag])
        element, dropped = stack[-1][1], stack[-1][2] or tag in DROPPED
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if match["attrs"].rstrip().endswith("/") and tag not in CLOSES_P and tag not in INLINE:
            continue
        if tag == "a":
            links += 1
        if tag not in INLINE and not dropped:
            flush(element)
            element = tree.add(tag, element, match["attrs"])
        stack.append((tag, element, dropped))
        open_tags[tag] += 1
    pop_to(1)
    flush(root)
    return tree
