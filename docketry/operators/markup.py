"""Visible text of one HTML or SGML document.

Spark has no tag stack, so this scan runs inside an Arrow UDF, one document at a time. It only
finds the text nodes; all line work happens in Catalyst afterwards.
"""

from __future__ import annotations

import re
from html.entities import html5

# Element kinds, table words and div marks whose content is left out.
DROPPED_ELEMENTS = frozenset(
    ("script", "style", "meta", "link", "head", "title",
     "nav", "noscript", "iframe", "button", "input", "img")
)
DROPPED_TABLE_WORDS = ("Document Format Files", "Filing Detail", "tableFile", "Navigation")
DROPPED_DIV_MARKS = ("header", "footer", "breadCrumb", "formDiv", "mailer")

# HTML elements that never have content, and those whose text is not part of the page text.
VOID_ELEMENTS = frozenset(
    ("area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
     "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
     "param", "source", "spacer", "track", "wbr")
)
SILENT_ELEMENTS = frozenset(("rt", "rp", "template"))
PREFORMATTED_ELEMENTS = frozenset(("pre", "textarea"))
_TRACKED = (
    DROPPED_ELEMENTS | SILENT_ELEMENTS | PREFORMATTED_ELEMENTS | frozenset(("table", "div"))
)

# One markup token. A quote only opens a value directly after "="; possessive repeats keep
# the scan linear on broken markup.
_TOKEN = re.compile(
    r"""<(?:
        !--(?P<comment>.*?)(?:--!?>|\Z)
      | !\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)
      | /\s*(?P<close>[a-zA-Z][^\s/>\x00]*+)[^>]*+>
      | (?P<open>[a-zA-Z][^\s/>\x00]*+)
        (?P<rest>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^>\s"'][^>\s]*+)?+|["'])*+)>
      | (?:[!?]|/(?=[^a-zA-Z\s]))[^>]*+>
    )""",
    re.VERBOSE | re.DOTALL,
)
_RAW_END = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in ("script", "style")
}
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)\s*(?:=+\s*("[^"]*"|'[^']*'|[^>\s]*))?""")
_BARE_VALUE_END = re.compile(r"""=\s*[^\s"'>][^>\s]*\Z""")
_REFERENCE = re.compile(r"&(?:#(?:([0-9]+)|[xX]([0-9a-fA-F]+))|([a-zA-Z][-.a-zA-Z0-9]*));?")
_ASCII_BLANK = re.compile(r"[ \n\t\f\r]+\Z")


def _character(match: re.Match) -> str:
    decimal, hexadecimal, name = match.groups()
    if name is not None:
        return html5.get(name + ";") or html5.get(name) or "&" + name
    digits, base = (decimal, 10) if decimal is not None else (hexadecimal, 16)
    code = int(digits, base) if len(digits) < 12 else 0x110000
    if 0 <= code < 256:
        # Pages often mean Windows-1252 when they write references below 256.
        try:
            return bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            return chr(code)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def decode_references(text: str) -> str:
    """Resolve character references; unknown names stay as they are, without semicolon."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _is_dropped_div(attributes: str) -> bool:
    if not attributes or not any(mark in attributes for mark in DROPPED_DIV_MARKS):
        if "&" not in attributes:
            return False
    values = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        values[name.lower()] = decode_references(value)
    named = f"{values.get('id', '')} {values.get('class', '')}"
    return any(mark in named for mark in DROPPED_DIV_MARKS)


class _Scan:
    """Open elements and text nodes seen so far; every method is constant time per token."""

    def __init__(self) -> None:
        self.open: list[tuple[str, bool]] = []
        self.open_count: dict[str, int] = {}
        self.dropped = 0
        self.dropped_divs = 0
        self.silent = 0
        self.preformatted = 0
        self.tables = 0
        self.table_start = 0
        self.nodes: list[tuple[str, bool]] = []

    def push(self, name: str, attributes: str) -> None:
        hidden_div = False
        if name in _TRACKED:
            hidden_div = name == "div" and _is_dropped_div(attributes)
            if name == "table" and not self.dropped:
                if not self.tables:
                    self.table_start = len(self.nodes)
                self.tables += 1
            self.count(name, hidden_div, 1)
        self.open.append((name, hidden_div))
        self.open_count[name] = self.open_count.get(name, 0) + 1

    def pop(self) -> str:
        name, hidden_div = self.open.pop()
        self.open_count[name] -= 1
        if name in _TRACKED:
            self.count(name, hidden_div, -1)
            if name == "table" and not self.dropped:
                self.tables -= 1
                if not self.tables:
                    self.leave_table()
        return name

    def count(self, name: str, hidden_div: bool, step: int) -> None:
        if name in DROPPED_ELEMENTS:
            self.dropped += step
        elif name in SILENT_ELEMENTS:
            self.silent += step
        elif name in PREFORMATTED_ELEMENTS:
            self.preformatted += step
        elif hidden_div:
            self.dropped_divs += step

    def leave_table(self) -> None:
        # An inner table's text is part of the outer one's, so the outermost decides.
        text = "".join(node for node, _ in self.nodes[self.table_start:])
        if any(word in text for word in DROPPED_TABLE_WORDS):
            del self.nodes[self.table_start:]

    def close(self, name: str) -> None:
        if self.open_count.get(name):
            while self.pop() != name:
                pass

    def text(self, raw: str) -> None:
        if not raw or self.dropped or self.silent:
            return
        text = decode_references(raw)
        if not self.preformatted and text.isspace() and _ASCII_BLANK.match(text):
            text = "\n" if "\n" in text else " "
        self.nodes.append((text, self.dropped_divs > 0))

    def finish(self) -> str:
        while self.open:
            self.pop()
        return "\n".join(node for node, hidden in self.nodes if not hidden)


def visible_text(html: str | None) -> str | None:
    """Text nodes of a document in order, joined by line ends."""
    if html is None:
        return None
    scan = _Scan()
    at = 0
    # Nothing behind the last ">" is a tag; looking there again and again would be quadratic.
    last = html.rfind(">") + 1
    while True:
        token = _TOKEN.search(html, at, last)
        if token is None:
            break
        scan.text(html[at:token.start()])
        at = token.end()
        kind = token.lastgroup
        if kind == "rest":
            name, rest = token["open"].lower(), token["rest"]
            if name in VOID_ELEMENTS:
                continue
            if rest.endswith("/") and not _BARE_VALUE_END.search(rest):
                continue
            if end := _RAW_END.get(name):
                # Raw text, and dropped in any case: go on behind the end tag.
                closing = end.search(html, at)
                at = closing.end() if closing else len(html)
                continue
            scan.push(name, rest if name == "div" else "")
        elif kind == "close":
            scan.close(token["close"].lower())
        elif kind == "comment" and not token[0].endswith(("-->", "--!>")):
            at = len(html)  # never closed
        elif kind == "cdata":
            if not (scan.dropped or scan.silent):
                scan.nodes.append((token["cdata"], scan.dropped_divs > 0))
    scan.text(html[at:].partition("<!--")[0])
    return scan.finish()
