"""A second page reader on the standard library's HTML parser, to check the first."""

from html.parser import HTMLParser

VOID = frozenset(
    "area base basefont br col embed frame hr img input isindex link meta param source track wbr".split()
)
HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))
ENDS_ANCHOR = frozenset(("a", "fieldset", "table", "td", "th"))
STRENGTH = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}


class StdlibReader(HTMLParser):
    """Collects the fields of one page while the markup streams by."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.anchors: list[tuple[str | None, list[str]]] = []
        self.description: str | None = None
        self._pending: list[str] = []
        self._open: list[str] = []
        self._open_anchors: list[list[str]] = []
        self._hidden = 0
        self._described = False
        self._title_depth: int | None = None
        self._title_parts: list[str | None] | None = None
        self._at_end = False

    @property
    def title(self) -> str | None:
        """The title's only text; null when it is empty or mixed with elements."""
        parts = self._title_parts
        return parts[0] if parts and len(parts) == 1 else None

    def read(self, html: str) -> None:
        self.feed(html)
        self._at_end = True
        self.close()
        self._end_text()

    # A tag or comment that the document breaks off in is not text.
    def parse_starttag(self, i: int) -> int:
        return self._or_end(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._or_end(super().parse_endtag(i))

    def parse_comment(self, i: int, report: int = 1) -> int:
        return self._or_end(super().parse_comment(i, report))

    def _or_end(self, position: int) -> int:
        return len(self.rawdata) if position < 0 and self._at_end else position

    def handle_data(self, data: str) -> None:
        self._pending.append(data)

    def _end_text(self) -> None:
        if not self._pending:
            return
        raw = "".join(self._pending)
        self._pending.clear()
        if self._title_depth is not None and len(self._open) == self._title_depth:
            blank = not raw.strip(" \t\n\r\f")
            self._title_parts.append(("\n" if "\n" in raw else " ") if blank else raw)
        if self._hidden:
            return
        text = raw.strip()
        if text:
            self.texts.append(text)
            for pieces in self._open_anchors:
                pieces.append(text)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def handle_decl(self, decl: str) -> None:
        self._end_text()

    def handle_pi(self, data: str) -> None:
        self._end_text()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        if tag in ENDS_ANCHOR:
            while self._open and self._open[-1] == "a":
                self._close_last()
        if self._title_depth is not None and len(self._open) == self._title_depth:
            self._title_parts.append(None)
        if tag == "meta" and not self._described:
            self._read_meta(attrs)
        if tag in VOID:
            return
        self._open.append(tag)
        if tag in HIDDEN:
            self._hidden += 1
        elif tag == "a":
            pieces: list[str] = []
            self.anchors.append((_attribute(attrs, "href"), pieces))
            self._open_anchors.append(pieces)
        elif tag == "title" and self._title_parts is None:
            self._title_depth, self._title_parts = len(self._open), []

    def handle_endtag(self, tag: str) -> None:
        strength = STRENGTH.get(tag, 100)
        for name in reversed(self._open):
            if name == tag:
                break
            if STRENGTH.get(name, 100) > strength:
                return
        else:
            return
        self._end_text()
        while self._close_last() != tag:
            pass

    def _close_last(self) -> str:
        if self._title_depth == len(self._open):
            self._title_depth = None
        tag = self._open.pop()
        if tag in HIDDEN:
            self._hidden -= 1
        elif tag == "a":
            self._open_anchors.pop()
        return tag

    def _read_meta(self, attrs: list[tuple[str, str | None]]) -> None:
        if _attribute(attrs, "name") == "description":
            self._described = True
            self.description = _attribute(attrs, "content")


def _attribute(attrs, name):
    return next((value or "" for key, value in attrs if key == name), None)
