"""Visible text of HTML and plain sources, every part of which leads back to its source.

A view is a text and a list of runs (view begin, view end, source begin, source end).  A run is literal (both
spans equally long and equal character by character) or atomic (an entity or a line break: all or nothing).
Offsets are code points.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

#: Elements without visible text, and those that end a line.
HIDDEN = frozenset(("script", "style"))
CODE_TAGS = frozenset(("code", "pre"))
LINE_TAGS = frozenset(("p", "br", "div", "li", "blockquote", "pre", "h1", "h2", "h3", "tr", "hr"))
_URL = re.compile(r"(?i)\b(?:https?|ftp)://[^\s<>\"')\]]+|\bwww\.[^\s<>\"')\]]+")
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_MARKDOWN_IMAGE = re.compile(r"!\[([^\]]*)\]\([^)]*\)")


@dataclass
class View:
    name: str
    source: str
    text: str = ""
    runs: list[tuple[int, int, int, int, bool]] = field(default_factory=list)
    images: list[tuple[int, int]] = field(default_factory=list)
    #: Parts of the text that are code by their element, the outermost of nested ones.
    code: list[tuple[int, int]] = field(default_factory=list)

    def add(self, shown: str, begin: int, end: int, literal: bool) -> None:
        if shown:
            self.runs.append((len(self.text), len(self.text) + len(shown), begin, end, literal))
            self.text += shown

    def source_span(self, begin: int, end: int) -> tuple[int, int]:
        """The source of a part of the view; a part of an atomic run takes all of it."""
        spans = []
        for vb, ve, sb, se, literal in self.runs:
            if vb < end and begin < ve:
                spans.append((sb + max(begin, vb) - vb, sb + min(end, ve) - vb) if literal else (sb, se))
        return (min(s for s, _ in spans), max(e for _, e in spans)) if spans else (0, 0)


class _Reader(HTMLParser):
    def __init__(self, view: View):
        super().__init__(convert_charrefs=False)
        self.view, self.hidden = view, 0
        self.depth, self.opened = 0, 0
        self.lines = [0]
        for m in re.finditer("\n", view.source):
            self.lines.append(m.end())

    def _here(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        begin = self._here()
        end = begin + len(self.get_starttag_text() or "")
        if tag in CODE_TAGS:
            self.depth += 1
        if tag in HIDDEN:
            self.hidden += 1
        elif tag in LINE_TAGS:
            self.view.add("\n", begin, end, False)
        elif tag == "img":
            self.view.images.append((begin, end))
            alt = dict(attrs).get("alt") or ""
            at = self.view.source.find(alt, begin, end) if alt else -1
            if at >= 0:
                self.view.add(alt, at, at + len(alt), True)
        if tag in CODE_TAGS and self.depth == 1:
            self.opened = len(self.view.text)

    def handle_endtag(self, tag):
        if tag in CODE_TAGS and self.depth:
            self.depth -= 1
            if not self.depth:
                self.close_code()
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in LINE_TAGS:
            begin = self._here()
            self.view.add("\n", begin, max(begin, self.view.source.find(">", begin) + 1), False)

    def close_code(self) -> None:
        if len(self.view.text) > self.opened:
            self.view.code.append((self.opened, len(self.view.text)))

    def handle_data(self, data):
        if not self.hidden:
            self.view.add(data, self._here(), self._here() + len(data), True)

    def _reference(self, raw: str) -> None:
        if not self.hidden:
            begin = self._here()
            # the closing semicolon may be missing
            end = begin + len(raw) + self.view.source.startswith(";", begin + len(raw))
            self.view.add(html.unescape(self.view.source[begin:end]), begin, end, False)

    def handle_entityref(self, name):
        self._reference(f"&{name}")

    def handle_charref(self, name):
        self._reference(f"&#{name}")


def make_view(source: str | None, name: str, is_html: bool) -> View:
    view = View(name, source or "")
    if is_html:
        reader = _Reader(view)
        reader.feed(view.source)
        reader.close()
        if reader.depth:
            reader.close_code()
    else:
        at = 0
        for m in sorted([*_ENTITY.finditer(view.source), *_MARKDOWN_IMAGE.finditer(view.source)], key=lambda m: m.start()):
            if m.start() < at:
                continue
            view.add(view.source[at : m.start()], at, m.start(), True)
            if m[0].startswith("&"):
                view.add(html.unescape(m[0]), *m.span(), False)
            else:
                view.images.append(m.span())
                view.add(m[1], *m.span(1), True)
            at = m.end()
        view.add(view.source[at:], at, len(view.source), True)
    view.text = _URL.sub(lambda m: " " * len(m[0]), view.text)
    return view


def views(fields: dict[str, str | None]) -> list[View]:
    """Title and Text are plain, Body is HTML; tags are no text."""
    return [make_view(fields[n], n, n == "Body") for n in ("Title", "Body", "Text") if fields.get(n)]


def searchable(fields: dict[str, str | None]) -> str:
    return "\n".join(v.text for v in views(fields))
