"""A lenient HTML tree, for wrapper induction: elements with tag, role words and children; text is decoded."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Generator, Iterator
from functools import wraps

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_P = BLOCKS - frozenset("body head html tbody td tfoot th thead tr title dd dt li legend figcaption summary".split())
#: What a start tag closes, up to the element that keeps it apart.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_NAMED = frozenset("class id role hidden aria-hidden itemprop".split())
_WORDS = re.compile(r"[a-z]+")


def deep(f: Callable[..., Generator]) -> Callable:
    """A function that recurs without Python's stack: f yields calls of f.each, of its own or others', and is sent what they return."""

    @wraps(f)
    def call(*args):
        stack, value = [f(*args)], None
        while stack:
            try:
                inner = stack[-1].send(value)
            except StopIteration as end:
                stack.pop()
                value = end.value
            else:
                stack.append(inner)
                value = None
        return value

    call.each = f
    return call


class Node:
    """An element: ``words`` are the letter parts of class, id, role and itemprop, ``tokens`` their whole words."""

    __slots__ = ("tag", "words", "tokens", "children")

    def __init__(self, tag: str, words: frozenset[str] = frozenset(), tokens: frozenset[str] = frozenset()):
        self.tag, self.words, self.tokens = tag, words, tokens
        self.children: list[Node | str] = []


def _role_words(attributes: str) -> tuple[frozenset[str], frozenset[str]]:
    out: set[str] = set()
    tokens: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in _NAMED:
            continue
        value = value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            out.add("hidden")
            tokens.add("hidden")
        elif name != "aria-hidden":
            out.update(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
            tokens.update(value.split())
    return frozenset(out), frozenset(tokens)


def parse(text: str) -> Node:
    """The tree of a page. Missing end tags are implied, stray ones ignored, comments dropped; every text is kept once."""
    root = Node("#root")
    stack = [root]
    named: Counter[str] = Counter()  # open elements by tag
    at = 0

    def add(piece: str) -> None:
        if piece:
            stack[-1].children.append(html.unescape(piece) if "&" in piece else piece)

    def end(i: int) -> None:
        named.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(tags: tuple[str, ...], walls: tuple[str, ...]) -> None:
        if not any(named[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                end(i)
                return
            if stack[i].tag in walls:
                return

    while m := _TAG.search(text, at):
        add(text[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if named[tag]:
                end(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in ENDS_P:
            close(("p",), ("button", "td", "th", "table", "caption"))
        if tag in CLOSES:
            close(*CLOSES[tag])
        node = Node(tag, *(_role_words(m[3]) if m[3] and m[3].strip() else ()))
        stack[-1].children.append(node)
        if tag in RAW:
            last = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
            inner = text[at : last.start() if last else len(text)]
            at = last.end() if last else len(text)
            if inner and tag in ("title", "textarea"):
                node.children.append(html.unescape(inner))
        elif tag not in VOID:
            stack.append(node)
            named[tag] += 1
    tail = text[at:]
    add(tail)
    return root


def texts(node: Node) -> Iterator[str]:
    """All text below a node; line breaks count as blanks."""
    ahead = node.children[::-1]
    while ahead:
        child = ahead.pop()
        if isinstance(child, str):
            yield child
        elif child.tag == "br":
            yield " "
        else:
            ahead += child.children[::-1]
