"""HTML pages as leaf blocks with the tags and names around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Fixed values of the HTML standard: elements that start a block, elements
#: without an end tag, elements whose content is not markup.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title xmp".split())
PARSED = frozenset(("svg", "template"))  # of them, those that do not swallow the page without an end tag
#: start tags that end an open element of the same group
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("thead", "tbody", "tr", "td", "th"),
         "tfoot": ("thead", "tbody", "tr", "td", "th")}
_SCOPE = frozenset("table ul ol dl select menu".split())  # what such an end does not cross
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNQUOTED_SLASH = re.compile(r"=\s*[^\s\"']*/$")  # belongs to an attribute's value
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    tags: tuple[str, ...]   # open block elements, outermost first
    names: frozenset[str]   # words in their class, id and role
    text: str               # white space collapsed
    linked: float           # share of the characters inside links


def _names(attributes: str) -> list[str]:
    if not attributes:
        return []
    found = []
    for m in _NAMED.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "")
        found += _PART.findall(value.lower())
    return found


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks of a page in page order. Comments, scripts,
    styles and other raw content are skipped; character references are decoded;
    an unfinished tag at the end is dropped."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    text: list[str] = []
    depth = linked = pos = 0
    endless: set[str] = set()  # raw elements without an end tag from here on

    def flush() -> None:
        nonlocal linked
        raw = "".join(text)
        text.clear()
        if raw and (flat := " ".join(html.unescape(raw).split())):
            out.append(Block(tuple(t for t, _ in stack), frozenset(n for _, ns in stack for n in ns), flat,
                             min(1.0, linked / max(len(raw.strip()), 1))))
        linked = 0

    def close(names: tuple[str, ...], scope: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    while True:
        m = _TOKEN.search(page, pos)
        piece = page[pos:m.start()] if m else page[pos:]
        if piece:
            text.append(piece)
            if depth:
                linked += len(piece.strip())
        if not m:
            break
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending = bool(m[1] or m[4])
        if tag in RAW:
            attributes = m[3] or m[6] or ""
            closed = tag == "svg" and attributes.endswith("/") and not _UNQUOTED_SLASH.search(attributes)
            if not ending and not closed and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
                if end:
                    pos = end.end()
                elif tag in PARSED:
                    endless.add(tag)
                else:
                    pos = len(page)
        elif tag == "br":
            text.append(" ")
        elif tag == "a":
            depth = 0 if ending else 1
        elif tag in BLOCK:
            flush()
            if ending:
                close((tag,), frozenset())
                depth = 0
            else:
                if tag not in ("html", "head", "body") and stack and stack[-1][0] == "p":
                    stack.pop()  # a block ends a paragraph
                if tag == "body":
                    close(("head",), frozenset())
                if tag in _ENDS:
                    close(_ENDS[tag], _SCOPE)
                if tag not in VOID:
                    stack.append((tag, _names(m[3] or m[6] or "")))
    flush()
    return out
