"""One page's markup as flat lists: the only Python that runs per page.

Needs nothing but the standard library, so that it can travel to the workers.
"""

from __future__ import annotations

import re
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
# text inside these is not part of the text of what surrounds them
HIDDEN = frozenset(["script", "style", "template", "rt", "rp"])
VERBATIM = frozenset(["pre", "textarea"])
_ASCII_SPACE = re.compile(r"[\n\t\x0c\r ]+\Z")
_ATTRIBUTES = r'(?: +[a-zA-Z][-\w:]*="[^"&]*")*'
# Markup that can be read in one way only, piece by piece: text, script or style without tags, title without references,
# start tag with quoted attributes, the same closed at once, end tag, named reference. Elements whose content is read in a way of its own are left out.
_PLAIN = re.compile(
    "([^<&]+)"
    rf"|<(script|style)({_ATTRIBUTES})>((?:[^<]|<(?![/!]))*)</\2>"
    "|<title>([^<&]*)</title>"
    r"|<(?!(?i:script|style|title|textarea|template|xmp|iframe|noembed|noframes|noscript|plaintext|svg|math)\b)"
    rf"([a-zA-Z][a-zA-Z0-9]*)({_ATTRIBUTES})( ?/)?>"
    "|</([a-zA-Z][a-zA-Z0-9]*)>"
    "|&([a-zA-Z][a-zA-Z0-9]*);",
    re.ASCII,
)
_ATTRIBUTE = re.compile(r'([a-zA-Z][-\w:]*)="([^"&]*)"', re.ASCII)
_TEXT, _RAW, _TITLE, _START, _CLOSED, _END, _NAMED = 1, 4, 5, 7, 8, 9, 10


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name.lower(), value) for name, value in _ATTRIBUTE.findall(text)] if text else []


class PageTree(HTMLParser):
    """Elements in document order with parent, extent and text range.

    ``elements`` holds [parent, last, depth, tag, attributes, first_text, end_text]: the
    descendants of element i are i+1..last, its visible strings first_text..end_text-1.
    """

    def __init__(self, markup: str):
        self.elements: list[list] = []
        self.texts: list[str] = []
        self.text_parents: list[int] = []
        self._open: list[int] = []
        self._open_tags: dict[str, int] = {}
        self._hidden = 0
        self._verbatim = 0
        self._pending: list[str] = []
        self._closed_void: list[str] = []
        done = self._plain(markup)
        if done < len(markup):
            super().__init__(convert_charrefs=False)  # what the library needs is made for pages that it reads
            self.feed(markup[done:] if done else markup)
            self.close()
        self._flush()
        while self._open:
            self._close_last()

    def _plain(self, markup: str) -> int:
        """Read plain markup from the start on, and tell where the first other piece begins: from there on the library reads it.

        Its parser takes several searches for each tag; these pieces take one, and give the same events.
        """
        done = 0
        for found in iter(_PLAIN.scanner(markup).match, None):
            done, kind = found.end(), found.lastindex
            if kind == _TEXT:
                self._pending.append(found[_TEXT])
            elif kind == _END:
                self.handle_endtag(found[_END].lower())
            elif kind == _START:
                self.handle_starttag(found[6].lower(), _attributes(found[_START]))
            elif kind == _CLOSED:
                self.handle_startendtag(found[6].lower(), _attributes(found[_START]))
            elif kind == _NAMED:
                self.handle_entityref(found[_NAMED])
            else:
                tag = "title" if kind == _TITLE else found[2]
                self.handle_starttag(tag, _attributes(found[3]) if kind == _RAW else [])
                if found[kind]:
                    self._pending.append(found[kind])
                self.handle_endtag(tag)
        return done

    def _flush(self) -> None:
        if not self._pending:
            return
        text = "".join(self._pending)
        self._pending.clear()
        if self._hidden:
            return
        if not self._verbatim and _ASCII_SPACE.match(text):
            text = "\n" if "\n" in text else " "
        self.texts.append(text)
        self.text_parents.append(self._open[-1] if self._open else -1)

    def _close_last(self) -> None:
        element = self.elements[self._open.pop()]
        tag = element[3]
        element[1] = len(self.elements) - 1
        element[6] = len(self.texts)
        self._open_tags[tag] -= 1
        self._hidden -= tag in HIDDEN
        self._verbatim -= tag in VERBATIM

    def _start(self, tag: str, attrs: list) -> None:
        self._flush()
        values = {name: value or "" for name, value in attrs}
        if "class" in values:
            values["class"] = " ".join(values["class"].split())
        parent = self._open[-1] if self._open else -1
        self._open.append(len(self.elements))
        self.elements.append([parent, -1, len(self._open) - 1, tag, values, len(self.texts), -1])
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        self._hidden += tag in HIDDEN
        self._verbatim += tag in VERBATIM

    def _end(self, tag: str) -> None:
        self._flush()
        if not self._open_tags.get(tag):
            return
        while True:
            closed = self.elements[self._open[-1]][3]
            self._close_last()
            if closed == tag:
                return

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)
        if tag in VOID:
            self._end(tag)
            self._closed_void.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        self._end(tag)

    def handle_endtag(self, tag):
        if tag in self._closed_void:
            self._closed_void.remove(tag)
        else:
            self._end(tag)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_entityref(self, name):
        self._pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
        except ValueError:
            code = 0xFFFD
        text = ""
        if code < 256:
            text = bytes([code]).decode("windows-1252", "ignore")
        if not text:
            text = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"
        self._pending.append(text)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self._pending.append(data[6:])
            self._flush()
