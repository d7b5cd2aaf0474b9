"""Title, description, visible text and links of HTML pages.

One Arrow pass over (html, base URL) yields all fields; it is the only step that
leaves the JVM. Everything after it (canonical form, classification, dedup) is
relational.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom import schemas
from linkloom.functions import urls
from linkloom.profile import SiteProfile

# Elements without content, elements whose text is not visible, tags
# that end a directly enclosing open anchor, and how strongly an open element
# resists the end tag of an element further out (100 when not listed).
_VOID = frozenset(
    "area base basefont br col embed frame hr img input isindex link meta param source track wbr".split()
)
_HIDDEN = frozenset(("template", "rt", "rp"))
_ENDS_ANCHOR = frozenset(("a", "fieldset", "table", "td", "th"))
_STRENGTH = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_SKIPPED_HREFS = ("mailto:", "tel:", "javascript:")

# Pages are converted in small groups, by rows and by size of the bodies, so that an
# output batch stays far below what one Arrow string column can hold.
_ROWS_PER_OUTPUT_BATCH = 256
_BYTES_PER_OUTPUT_BATCH = 64 * 1024 * 1024

_PARSED_FIELDS = [
    T.StructField("title", T.StringType()),
    T.StructField("meta_description", T.StringType()),
    T.StructField("text_content", T.StringType()),
    T.StructField("page_links", T.ArrayType(schemas.LINK_INFO)),
    T.StructField("malformed_hrefs", T.ArrayType(T.StringType())),
]


# Inside a tag: anything but ">", with quoted values taken whole. Atomic, so an unclosed
# quote or tag costs no backtracking.
_INSIDE = r"""(?>[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*+"""
# Groups: 1 raw-text element (its content goes with it), 2 end tag, 3 start tag, 4 its inside.
# Comments and declarations match without a group. What the document breaks off in is not text.
_MARKUP = re.compile(
    rf"""<(?:
        !--.*?(?:--!?>|\Z)
      | (script|style)(?=[\s/>]){_INSIDE}(?:>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)
      | [!?][^>]*(?:>|\Z)
      | /([a-z][^\s/>]*)[^>]*(?:>|\Z)
      | ([a-z][^\s/>]*)({_INSIDE})(?:>|\Z)
    )""",
    re.VERBOSE | re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/=>"'][^\s/=>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'][^\s]*)))?"""
)
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"']+/\s*\Z""")


class _PageReader:
    """Collects the fields of one page while the markup streams by."""

    def __init__(self) -> None:
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

    @property
    def title(self) -> str | None:
        """The title's only text; null when it is empty or mixed with elements."""
        parts = self._title_parts
        return parts[0] if parts and len(parts) == 1 else None

    def read(self, html: str) -> None:
        position = 0
        for found in _MARKUP.finditer(html):
            start = found.start()
            if start > position:
                self._pending.append(html[position:start])
            position = found.end()
            raw, end_tag, start_tag, inside = found.groups()
            if start_tag:
                self._start(start_tag.lower(), inside)
            elif end_tag:
                self._end(end_tag.lower())
            else:
                self._end_text()
                if raw:
                    self._child_of_title()
        self._pending.append(html[position:])
        self._end_text()

    def _end_text(self) -> None:
        if not self._pending:
            return
        raw = "".join(self._pending)
        self._pending.clear()
        if not raw:
            return
        if "&" in raw:
            raw = unescape(raw)
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

    def _child_of_title(self) -> None:
        if self._title_depth is not None and len(self._open) == self._title_depth:
            self._title_parts.append(None)

    def _start(self, tag: str, inside: str) -> None:
        self._end_text()
        if tag in _ENDS_ANCHOR:
            while self._open and self._open[-1] == "a":
                self._close_last()
        self._child_of_title()
        if tag in _VOID:
            if tag == "meta" and not self._described:
                self._read_meta(_attributes(inside))
            return
        self._open.append(tag)
        if tag in _HIDDEN:
            self._hidden += 1
        elif tag == "a":
            pieces: list[str] = []
            self.anchors.append((_attributes(inside).get("href"), pieces))
            self._open_anchors.append(pieces)
        elif tag == "title" and self._title_parts is None:
            self._title_depth, self._title_parts = len(self._open), []
        if inside.endswith("/") and not _UNQUOTED_SLASH.search(inside):
            self._close_last()

    def _end(self, tag: str) -> None:
        if not self._open or self._open[-1] != tag:
            strength = _STRENGTH.get(tag, 100)
            for name in reversed(self._open):
                if name == tag:
                    break
                if _STRENGTH.get(name, 100) > strength:
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
        if tag in _HIDDEN:
            self._hidden -= 1
        elif tag == "a":
            self._open_anchors.pop()
        return tag

    def _read_meta(self, attributes: dict[str, str]) -> None:
        if attributes.get("name") == "description":
            self._described = True
            self.description = attributes.get("content")


def _attributes(inside: str) -> dict[str, str]:
    """Attributes of a tag; the first of a name counts, no value reads as empty."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(inside):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


# The common shapes, which resolution leaves as they are: no empty or dot segment, query,
# fragment, parameters or white space.
_PLAIN_ORIGIN = re.compile(r"https?://[A-Za-z0-9._:\-]+(?=[/?#]|\Z)")
_PLAIN_SEGMENTS = r"(?:/(?!\.)[^/?#;\x00-\x20]+)*/?"
_PLAIN_HREF = re.compile(rf"({_PLAIN_ORIGIN.pattern})?{_PLAIN_SEGMENTS}\Z")


def _absolute(base: str, origin: str | None, href: str) -> str:
    """``urljoin`` with a shortcut for plain absolute and root-relative references."""
    plain = _PLAIN_HREF.match(href)
    if plain and plain.group(1):
        return href
    if plain and origin:
        return origin + href
    return urljoin(base, href)


def _resolve(base: str, anchors: list[tuple[str | None, list[str]]]) -> tuple[list, list]:
    """Admitted anchors as (absolute URL, anchor text), and hrefs that cannot be resolved."""
    links, malformed = [], []
    plain_origin = _PLAIN_ORIGIN.match(base)
    origin = plain_origin.group() if plain_origin else None
    for href, pieces in anchors:
        if not href or href.startswith(_SKIPPED_HREFS):
            continue
        try:
            absolute = _absolute(base, origin, href)
        except ValueError:
            malformed.append(href)
            continue
        if absolute.startswith(("http://", "https://")):
            links.append((absolute, "".join(pieces)))
    return links, malformed


def _parse_page(html: str, base: str) -> tuple:
    page = _PageReader()
    page.read(html)
    links, malformed = _resolve(base, page.anchors)
    return page.title, page.description, " ".join(page.texts), links, malformed


def _parsed_columns(pages: list[tuple | None]) -> list[pa.Array]:
    """Parsed pages (None where there is nothing to parse) as Arrow columns."""
    fields = [[p[k] if p else None for p in pages] for k in range(5)]
    offsets, urls_flat, texts_flat = [0], [], []
    for links in fields[3]:
        for url, text in links or ():
            urls_flat.append(url)
            texts_flat.append(text)
        offsets.append(len(urls_flat))
    mask = pa.array([links is None for links in fields[3]], pa.bool_())
    structs = pa.StructArray.from_arrays(
        [pa.array(urls_flat, pa.string()), pa.array(texts_flat, pa.string())], ["url", "anchor_text"]
    )
    return [
        *(pa.array(fields[k], pa.string()) for k in range(3)),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, mask=mask),
        pa.array(fields[4], pa.list_(pa.string())),
    ]


def _row_groups(bodies: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive (start, length) groups within both output limits, at least one row each."""
    start, size = 0, 0
    for row, length in enumerate(pc.binary_length(bodies).to_pylist()):
        length = length or 0
        full = row - start >= _ROWS_PER_OUTPUT_BATCH or size + length > _BYTES_PER_OUTPUT_BATCH
        if full and row > start:
            yield start, row - start
            start, size = row, 0
        size += length
    if start < len(bodies):
        yield start, len(bodies) - start


def parse_pages(
    results: DataFrame, html: str = "html", base: str = "final_url", keep: list[str] | None = None
) -> DataFrame:
    """Add title, meta_description, text_content, page_links and malformed_hrefs.

    ``keep`` names the input columns to carry along (default: all). Leave the body
    out where it is not needed again. Rows with a null body get null fields.
    """
    keep = results.columns if keep is None else keep
    needed = results.select(*dict.fromkeys([*keep, html, base]))
    html_at, base_at = needed.columns.index(html), needed.columns.index(base)
    kept_at = [needed.columns.index(c) for c in keep]
    names = [*keep, *(f.name for f in _PARSED_FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, length in _row_groups(whole.column(html_at)):
                batch = whole.slice(start, length)
                bodies = batch.column(html_at).to_pylist()
                bases = batch.column(base_at).to_pylist()
                parsed = [
                    None if body is None else _parse_page(body, base_url or "")
                    for body, base_url in zip(bodies, bases)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept_at), *_parsed_columns(parsed)], names=names
                )

    schema = T.StructType([*(needed.schema[c] for c in keep), *_PARSED_FIELDS])
    return needed.mapInArrow(run, schema)


def _judged_links(parsed: DataFrame, profile: SiteProfile, *keep: str) -> DataFrame:
    """The kept columns, pos and link: its target in stored form and why it may not be stored."""

    def canonical(link: Column) -> Column:
        first = urls.normalize_url(link["url"], profile)
        return F.struct(first.alias("first"), link["anchor_text"].alias("anchor_text"))

    def stored(link: Column) -> Column:
        # A bracketed host loses its brackets in canonical form, so storing it again can
        # change it once more; every other canonical URL is a fixed point.
        again = F.when(
            link["first"].rlike(r"^https?://(?:[^/]*:){2}"),
            urls.normalize_url(link["first"], profile),
        ).otherwise(link["first"])
        return F.struct(
            link["first"].alias("first"),
            urls.url_parts(link["first"]).alias("parts"),
            again.alias("to_url"),
            link["anchor_text"].alias("anchor_text"),
        )

    def checked(link: Column) -> Column:
        reason = F.when(
            link["to_url"] == link["first"], urls.parts_rejection(link["parts"])
        ).otherwise(urls.rejection_reason(link["to_url"]))
        return F.struct(
            link["to_url"].alias("to_url"),
            link["anchor_text"].alias("anchor_text"),
            urls.host_on_site(link["parts"]["host"], profile).alias("is_internal"),
            reason.alias("reason"),
        )

    # Computed inside the array, so that filters and joins further on read plain fields
    # instead of computing the URL expressions again.
    links = reduce(F.transform, (canonical, stored, checked), F.col("page_links"))
    return parsed.select(*keep, F.posexplode(links).alias("pos", "link"))


def explode_links(parsed: DataFrame, profile: SiteProfile, *keep: str) -> DataFrame:
    """One row per anchor occurrence: the kept columns, pos, to_url, anchor_text, is_internal.

    Targets that may not be stored (see ``rejection_reason``) are left out.
    """
    return (
        _judged_links(parsed, profile, *keep)
        .filter("link.reason IS NULL")
        .select(*keep, "pos", "link.to_url", "link.anchor_text", "link.is_internal")
    )


def rejected_links(parsed: DataFrame, profile: SiteProfile, *keep: str) -> DataFrame:
    """Anchors left out of the link table, with the reason."""
    malformed = parsed.select(
        *keep, F.explode("malformed_hrefs").alias("href"), F.lit("malformed").alias("reason")
    )
    judged = _judged_links(parsed, profile, *keep, "page_links").filter("link.reason IS NOT NULL")
    href = F.get("page_links", F.col("pos"))["url"].alias("href")
    return malformed.unionByName(judged.select(*keep, href, F.col("link.reason").alias("reason")))
