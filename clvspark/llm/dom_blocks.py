"""HTML to leaf blocks: the runs of text between block boundaries, with what stands above each.

A forgiving single pass over the markup: comments, declarations and raw
elements (scripts, styles) give no text; void and self-closed elements have
no end; an end tag closes back to its start tag if that is open; block starts
close an open paragraph, items and cells close their like. Unclosed markup
runs to the end, but of the raw elements only scripts and styles do: others
without an end tag are taken as empty. Drawings and templates give no text
up to their own end tag, a drawing at most up to an HTML block in it. The
head gives no text and ends at its end tag, or at the first text or element
that cannot stand in it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# fixed values: element names as HTML defines them
RAW = frozenset("script style iframe textarea select".split())
PAIRED = frozenset("svg template".split())
IN_HEAD = frozenset("title meta link base script style noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}}

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>")
_LOOSE = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW}
_RAW_EDGE = {t: re.compile(rf"<(/?){t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style")}
_PAIR = {t: re.compile(rf"<(/?){t}(?=[\s/>]|\Z)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>", re.I) for t in PAIRED}
_TITLE_EDGE = re.compile(r"<(/title|title|/head|body)(?=[\s/>]|\Z)[^>]*>?", re.I)
_FOREIGN_END = re.compile(rf"<(?:{'|'.join(sorted(BLOCK - {'title'}))})(?=[\s/>])", re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Collapsed text, the marks of all open elements (tags and words of class, id, role), and its linked characters."""

    text: str
    marks: frozenset[str]
    tag: str
    linked: int


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
    return (f"<{tag}>", *dict.fromkeys(_WORD.findall(names.lower())))


def _pairs(page: str, tag: str) -> dict[int, tuple[int, int]]:
    """By the end of a start tag of ``tag``: where its own end tag starts and ends. Unclosed ones are not in it."""
    found: dict[int, tuple[int, int]] = {}
    started: list[int] = []
    for m in _PAIR[tag].finditer(page):
        if m[1]:
            if started:
                found[started.pop()] = m.span()
        elif not m[2].rstrip().endswith("/"):
            started.append(m.end())
    return found


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks with text, in page order; none for a null or empty page."""
    if not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    count: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    marks: frozenset[str] | None = None
    links = heads = 0
    pairs: dict[str, dict[int, tuple[int, int]]] = {}
    unended: set[str] = set()

    def flush() -> None:
        nonlocal marks
        if not parts:
            return
        text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
        if text:
            linked = sum(len(p.strip()) for p, in_link in parts if in_link)
            tag = next((t for t, _ in reversed(stack) if t in BLOCK), "")
            out.append(Block(text, frozenset(count) if marks is None else marks, tag, linked))
        parts.clear()

    def pop() -> None:
        nonlocal links, heads
        tag, own = stack.pop()
        links -= tag == "a"
        heads -= tag == "head"
        for m in own:
            count[m] -= 1
            if not count[m]:
                del count[m]

    def leave_head() -> None:
        while heads:
            pop()

    def raw_end(tag: str, at: int) -> int | None:
        """Behind the next end tag of a raw element; None if there is none."""
        end = None if tag in unended else _RAW_END[tag].search(page, at)
        if end is None:
            unended.add(tag)
        return end and end.end()

    at, size = 0, len(page)
    while at < size:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = size
        if open_at > at:
            if heads and stack[-1][0] == "head" and not page[at:open_at].isspace():
                leave_head()
            if not heads:
                parts.append((page[at:open_at], links > 0))
        if open_at == size:
            break
        if page.startswith("<!--", open_at):
            end = page.find("-->", open_at + 4)
            at = size if end < 0 else end + 3
            continue
        if page[open_at + 1:open_at + 2] in ("!", "?"):
            end = page.find(">", open_at)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(page, open_at + 1) or _LOOSE.match(page, open_at + 1)
        if not found:
            if not heads:
                parts.append(("<", links > 0))
            at = open_at + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if closing:
            if tag in BLOCK:
                flush()
            if any(t == tag for t, _ in reversed(stack)):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if heads and tag not in IN_HEAD:
            leave_head()
        empty = attributes.rstrip().endswith("/")
        if tag in RAW:
            if empty and tag in _RAW_EDGE:  # with an end tag of its own, as HTML reads it, or closed, as XHTML does
                edge = _RAW_EDGE[tag].search(page, at)
                empty = edge is None or not edge[1]
            end = None if empty else raw_end(tag, at)
            if end is not None:
                at = end
            elif not empty and tag in _RAW_EDGE:
                at = size
            parts.append((" ", False))
            continue
        if tag in PAIRED:
            if not empty:
                if tag not in pairs:
                    pairs[tag] = _pairs(page, tag)
                if at in pairs[tag]:
                    start, end = pairs[tag][at]
                    html_again = _FOREIGN_END.search(page, at, start) if tag == "svg" else None
                    if html_again and "<foreignobject" in page[at:html_again.start()].lower():
                        html_again = None
                    at = html_again.start() if html_again else end
            parts.append((" ", False))
            continue
        if heads and tag == "title":
            edge = _TITLE_EDGE.search(page, at)
            if edge and edge[1].lower() == "/title":
                at = edge.end()
                continue
        if tag in BLOCK:
            flush()
            while stack and (stack[-1][0] == "p" or _open_paragraph(stack)):
                pop()
            closes = CLOSES.get(tag)
            if closes:
                while stack and stack[-1][0] not in BLOCK:
                    pop()
                while stack and stack[-1][0] in closes:
                    pop()
        if tag in VOID or empty:
            parts.append((" ", False))
            continue
        own = _marks(tag, attributes)
        stack.append((tag, own))
        links += tag == "a"
        heads += tag == "head"
        for m in own:
            count[m] = count.get(m, 0) + 1
    flush()
    return out


def _open_paragraph(stack: list[tuple[str, tuple[str, ...]]]) -> bool:
    """Whether an open paragraph has only inline elements above it on the stack."""
    for tag, _ in reversed(stack):
        if tag == "p":
            return True
        if tag in BLOCK:
            return False
    return False
