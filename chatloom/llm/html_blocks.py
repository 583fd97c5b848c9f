"""HTML to leaf blocks: (path, text, link share) of every rendered piece of text, in page order.

One scan by a tag pattern; malformed markup (unclosed or crossed tags, a page cut off in a tag) never
fails. Text of elements that are not rendered is skipped.
"""
from __future__ import annotations

import html
import re
from typing import NamedTuple

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?i)(?<![\w-])(class|id|role|type)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPLIT = re.compile(r"[a-z0-9]+")
# HTML's white space plus the no-break space of &nbsp; are folded by str.split(); see fold()
SKIPPED = frozenset("script style title noscript template iframe object svg math canvas audio video head textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img br input label""".split())
# a start tag in the first column ends open elements of the second
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
ENDS = {k: frozenset(v.split()) for k, v in ENDS.items()}


class Block(NamedTuple):
    path: tuple[tuple[str, ...], ...]   # from the root: (tag, name tokens of class, id, role)
    text: str
    linked: float                       # share of the text inside links


def fold(text: str) -> str:
    return " ".join(text.split())


def element(tag: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (tag,)
    names = [t for m in NAMES.finditer(attributes) for t in SPLIT.findall((m[2] or m[3] or m[4] or "").lower())]
    return (tag, *names)


def blocks(page: str | None) -> list[Block]:
    """Blocks of a page; none for a null or empty one."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    path: tuple | None = ()
    pieces: list[str] = []
    linked = 0
    link_depth = 0
    at = 0

    def flush():
        nonlocal linked
        if pieces:
            text = "".join(pieces)
            if "&" in text:
                text = html.unescape(text)
            size = len(text)
            text = fold(text)
            if text:
                out.append(Block(tuple(stack), text, min(1.0, linked / size)))
            pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            pieces.append(text)
            if link_depth:
                linked += len(text)

    while True:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                link_depth = 0
            if tag in INLINE:
                continue
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if open_at is not None:
                flush()
                del stack[open_at:]
            elif tag == "p":
                flush()
            continue
        if tag in SKIPPED and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag == "head" and end is None:
                continue                                # a head that never closes hides nothing
            flush()
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            link_depth = 1
        if tag in INLINE:
            continue
        flush()
        if tag == "hr" or tag in VOID or attributes.endswith("/"):
            continue
        if any(e[0] == "p" for e in stack[-2:]):       # a block ends an open paragraph
            while stack and any(e[0] == "p" for e in stack[-2:]):
                stack.pop()
        if tag in ENDS and stack and stack[-1][0] in ENDS[tag]:
            stack.pop()
        stack.append(element(tag, attributes))
    flush()
    return out
