"""Main text of web pages: markup first, then a suffix array over the pages of a host.

Each page is read into blocks of text with a zone: ``chrome`` (menus, headers, footers, asides,
forms, adverts, notices, comments: by element, role or class word), ``article`` (in an article or
main element), ``content`` (in an element with a class word for content) or ``open``. Script,
style and the like are left out.

The candidates of a page are its article zone; without one, its content zone; without that, its
open blocks that are not mostly links; if there are none, all open blocks. The suffixes of the
candidates' token streams are cut to ``RUN`` tokens and hashed with their host. First the leading
bits of all hashes are dealt in order, packed as gaps, into buckets of bounded size: where too few
agree, no run is repeated. The whole hashes of the rest, few as a rule, are dealt and sorted:
neighbours that agree form the runs that are repeated. A run on ``LEAST_PAGES`` distinct texts of
a host or more is boilerplate, however many pages the host has. It is cut in every zone: a block
or sentence that such runs cover mostly, and any stretch of ``CUT`` tokens that they cover. If
nothing is left of a page, all its candidates are the text.

Copies of an article repeat it rightly, so pages with equal or nearly equal candidates count once.
Nearly equal: pages of a host that share a band of minimum hashes over pairs of tokens, and agree
in ``NEAR_PERCENT`` of 64 of them, and what is connected so.

Defined cases: null or empty html gives an empty text; a null or odd url counts as the host
``''``; repeated pages are each extracted (and do not make their text boilerplate); unclosed and stray tags are tolerated; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import map_texts
from linkloom.llm.components import components
from linkloom.llm.ngram_join import word_hashes
from linkloom.scratch import stage

RUN = 6
LEAST_PAGES = 3
COVER_PERCENT = 80
CUT = 2 * RUN  # shorter repeats inside a sentence of its own are turns of phrase
NEAR_PERCENT = 80
BANDS, BAND_ROWS, MINIMA = 8, 5, 64
LINK_PERCENT = 60
BUCKET_BYTES = 32 << 20
_MAX_BROADCAST_BYTES = 32 << 20
_MAX_BUCKETS = 1 << 16
_SLICE = 1 << 16
_PART = 1 << 21  # characters of pages hashed at once
_CHUNK = 1 << 22  # suffixes whose hashes are sorted and packed at once
_MAX_FILTER_BITS = 28
_FEW_PAGES = 32  # whose hashes stay in a processor's cache
_SENTENCE_ENDS = frozenset(".!?…。！？")
CHROME, OPEN, CONTENT, ARTICLE = 0, 1, 2, 3

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
# Elements of HTML by kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object select option button canvas audio video".split())
_CHROME = frozenset("nav footer aside form dialog menu".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSED_BY_NEXT = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
# Class and id words that tell what an element is for.
_CHROME_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead footer sidebar aside widget ad ads advert "
    "adverts advertisement advertising banner sponsor sponsored promo promotion notice notices cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended comment comments reply replies respond disqus pagination pager toolbar hidden".split()
)
_CONTENT_WORDS = frozenset("article content post entry story main maintext".split())
# First parts of names that tell of a layout or a state, and names that style only.
_MODIFIERS = frozenset("has no with without not is hide show sm md lg xl xs overflow backface".split())
_STYLE_PARTS = frozenset("hidden".split())
# Of _RAW: what holds characters only, and what holds markup that must itself be balanced.
_SCRIPT = frozenset("script style".split())
_CHARACTERS = frozenset("script style textarea title iframe".split())


def _kinds(names: str) -> set[str]:
    """What class and id names tell of an element: ``chrome``, ``content``, ``header``."""
    out = set()
    for name in names.split():
        parts = _WORD.findall(name)
        if len(parts) > 1:
            if parts[0] in _MODIFIERS:
                continue
            parts = [w for w in parts if w not in _STYLE_PARTS or name == "visually-hidden"]
        if not _CHROME_WORDS.isdisjoint(parts):
            out.add("chrome")
        elif "header" in parts:
            out.add("header")
        elif not _CONTENT_WORDS.isdisjoint(parts):
            out.add("content")
    return out


def _after_raw(page: str, at: int, name: str, outer: set[str], endless: set[str]) -> int:
    """Where the page goes on after the start of a raw element that ends at ``at``.

    One that is not closed inside its parent ends at the next tag; only a script or style
    takes the rest of the page.
    """
    if name not in endless:
        done = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
        if not done:
            endless.add(name)
        elif name in _CHARACTERS:
            return done.end()
        else:
            opened: dict[str, int] = {}
            last = at
            while tag := _TAG.search(page, last):
                last = tag.end()
                if tag[2] is None:
                    continue
                inner = tag[2].lower()
                if not tag[1]:
                    if inner == name and name in ("option", "button", "select"):
                        break  # these do not nest
                    if inner in _SCRIPT and inner not in endless:
                        last = _after_raw(page, last, inner, outer, endless)
                    elif inner not in _VOID and not tag[3].endswith("/"):
                        opened[inner] = opened.get(inner, 0) + 1
                elif opened.get(inner):
                    opened[inner] -= 1
                elif inner == name:
                    return last
                elif inner in outer:
                    break
    if name in _SCRIPT:
        return len(page)
    following = _TAG.search(page, at)
    return following.start() if following else len(page)


def _zone(name: str, attributes: str, now: int) -> int:
    """The zone inside an element that stands in the zone ``now``."""
    if name in ("html", "body"):
        return now
    if now == CHROME and name != "main" and "main" not in attributes.lower():
        return CHROME
    if name in _CHROME:
        return CHROME
    own: dict[str, str] = {}
    if attributes and not attributes.isspace():
        own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    role = own.get("role", "").lower()
    if role in _ROLES or "hidden" in own or own.get("aria-hidden") == "true":
        return CHROME
    if "display:none" in own.get("style", "").replace(" ", "").lower():
        return CHROME
    if name == "main" or role == "main":
        return ARTICLE  # no part of chrome, wherever it stands
    if now == CHROME:
        return CHROME
    if name == "article" or role == "article":
        return ARTICLE
    kinds = _kinds(f"{own.get('class', '')} {own.get('id', '')}".lower()) if own else set()
    if "content" in kinds and name != "header":
        return max(now, CONTENT)
    if "chrome" in kinds or ((name == "header" or "header" in kinds) and now < CONTENT):
        return CHROME
    return now


def blocks(page: str | None) -> list[tuple[int, int, str]]:
    """(zone, per cent of characters in links, text) of each block, in page order."""
    page = page or ""
    out: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int]] = []
    zone, links, in_link = OPEN, 0, 0
    pieces: list[str] = []
    endless: set[str] = set()  # raw elements without an end tag from here on

    def say(raw: str) -> None:
        nonlocal links
        if raw:
            pieces.append(raw)
            links += len(raw) if in_link else 0

    def end_block() -> None:
        nonlocal links
        if pieces:
            size = sum(map(len, pieces))
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append((zone, 100 * links // size, text))
            pieces.clear()
        links = 0

    def close(depth: int) -> None:
        nonlocal zone, in_link
        for name, _ in stack[depth:]:
            in_link -= name == "a"
        zone = stack[depth][1]
        del stack[depth:]

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if not tag:
            say(page[at:])
            break
        say(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        inline = name in _INLINE
        if tag[1]:
            if not inline:
                end_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if zone != stack[depth][1]:
                        end_block()
                    close(depth)
                    break
                if inline and stack[depth][0] not in _INLINE:
                    break  # a stray end tag does not close a block
            continue
        if name in _RAW:
            if not tag[3].endswith("/"):
                at = _after_raw(page, at, name, {n for n, _ in stack}, endless)
            if not inline:
                pieces.append(" ")
            continue
        if not inline:
            end_block()
            while stack and stack[-1][0] in _INLINE:
                close(len(stack) - 1)
            if stack and stack[-1][0] in _CLOSED_BY_NEXT:
                ends = _CLOSED_BY_NEXT[stack[-1][0]]
                if ends is None or name in ends:
                    close(len(stack) - 1)
        if name in _VOID or tag[3].endswith("/"):
            continue
        inner = _zone(name, tag[3], zone)
        if inner != zone:
            end_block()
        stack.append((name, zone))
        in_link += name == "a"
        zone = inner
    end_block()
    return out


def repeated(streams: list[list[str]], run: int = RUN, percent: int = 0, least: int = LEAST_PAGES) -> list[np.ndarray]:
    """For each stream, which tokens lie in a substring of ``run`` tokens or more that stands in
    at least ``least`` streams and ``percent`` hundredths of them. In memory, for few streams."""
    sizes = np.array([len(s) + 1 for s in streams], np.int64)
    number: dict[str, int] = {}
    text = np.fromiter(
        (number.setdefault(t, len(number)) for s in streams for t in (*s, "")), np.int64, int(sizes.sum())
    )
    ends = np.cumsum(sizes)
    text[ends - 1] = len(number) + np.arange(len(streams))  # borders, each once
    owner = np.repeat(np.arange(len(streams)), sizes)
    # Ranks of suffixes by their first 1, 2, 4, ... tokens, up to ``run``; none passes a border
    # and equals another.
    rank, depth = np.unique(text, return_inverse=True)[1], 1
    while depth < run:
        step = min(depth, run - depth)
        after = np.full(len(rank), -1, np.int64)
        after[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1]
        depth += step
    order = np.lexsort((owner, rank))  # the suffix array, to that depth
    r, o = rank[order], owner[order]
    fresh = np.ones(len(r), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (o[1:] != o[:-1])
    pages = np.bincount(r, weights=fresh).astype(np.int64)
    starts = np.flatnonzero(pages[rank] >= max(least, -(-percent * len(streams) // 100)))
    marks = np.zeros(len(text) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + run, len(text)), -1)
    covered = np.cumsum(marks[:-1]) > 0
    return [covered[e - n : e - 1] for e, n in zip(ends, sizes)]


def candidates(page: list[tuple[int, int, str]]) -> list[str]:
    """The blocks that may belong to the main text."""
    for zone in (ARTICLE, CONTENT):
        if any(z == zone for z, _, _ in page):
            return [t for z, _, t in page if z >= zone]
    plain = [t for z, link, t in page if z == OPEN and link < LINK_PERCENT]
    return plain or [t for z, _, t in page if z == OPEN]


def cut(texts: list[str], covered: np.ndarray | None) -> str:
    """The text of a page from its candidates and the repeated tokens of their stream."""
    if covered is None or not covered.any():
        return " ".join(texts)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0]))))
    drop = np.zeros(len(covered), bool)
    for start, end in zip(edges[::2], edges[1::2]):
        drop[start:end] = end - start >= CUT
    kept, at = [], 0
    before = np.concatenate(([0], np.cumsum(covered))).tolist()
    for text in texts:
        words = text.split(" ")
        if before[at] == before[at + len(words)]:  # nothing is covered
            kept += words
            at += len(words)
            continue
        ends = [k for k, w in enumerate(words, 1) if w[-1:] in _SENTENCE_ENDS]
        for start, end in ((0, len(words)), *zip([0, *ends], [*ends, len(words)])):
            if 100 * (before[at + end] - before[at + start]) >= COVER_PERCENT * (end - start):
                drop[at + start : at + end] = True
        kept += [w for w, gone in zip(words, drop[at : at + len(words)]) if not gone]
        at += len(words)
    return " ".join(kept or texts)


def choose(page: list[tuple[int, int, str]], covered: np.ndarray | None) -> str:
    """The text of a page from its blocks and the repeated tokens of its candidates."""
    return cut(candidates(page), covered)


class _Numbers(dict):
    """A number of 64 bits for each token."""

    def __missing__(self, token: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        out = self[token] = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _numbered(numbers: _Numbers, pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens each page has, and the number of each token."""
    streams = [" ".join(texts).split(" ") if texts else [] for texts in pages]
    sizes = np.array([len(s) for s in streams], np.int64)
    return sizes, np.fromiter(map(numbers.__getitem__, chain.from_iterable(streams)), np.uint64, int(sizes.sum()))


def _hashed(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """As ``_numbered``, with other numbers, which are reckoned on the pages' bytes at once."""
    streams = [" ".join(texts) for texts in pages if texts]
    sizes = np.array([sum(t.count(" ") + 1 for t in texts) for texts in pages], np.int64)
    return sizes, word_hashes(" ".join(streams).encode("utf-8", "surrogatepass"), cased=True)


def _suffixes(
    numbers: _Numbers, hosts: list[str], pages: list[list[str]], run: int, told: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, first token, hash of host and ``run`` tokens) of all suffixes that have so many.

    ``told`` has the pages' sizes and the numbers of their tokens, if not those of ``_hashed``.
    """
    sizes, tokens = told or _hashed(pages)
    page = np.repeat(np.arange(len(sizes)), sizes)
    first = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(first + run <= sizes[page])
    h = np.array([numbers[f"host {x}"] for x in hosts], np.uint64)[page[at]]
    for k in range(run):
        h = h * np.uint64(0x9E3779B97F4A7C15) + tokens[at + k]
    return page[at], first[at], _mixed(h)


_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, MINIMA, np.uint64) | np.uint64(1)


def _signatures(numbers: _Numbers, hosts: list[str], pages: list[list[str]]) -> list[tuple[list[int], bytes] | None]:
    """Band keys and the low bits of the minimum hashes of each page with ``RUN`` tokens."""
    out: list[tuple[list[int], bytes] | None] = [None] * len(pages)
    long = [k for k, t in enumerate(pages) if sum(x.count(" ") + 1 for x in t) >= RUN]
    if not long:
        return out
    least = []
    for a in range(0, len(long), _FEW_PAGES):
        some = long[a : a + _FEW_PAGES]
        texts = [pages[k] for k in some]
        page, _, h = _suffixes(numbers, [hosts[k] for k in some], texts, 2, _numbered(numbers, texts))
        first = np.flatnonzero(_starts(page))
        least.append(np.stack([np.minimum.reduceat(_upper(h * f), first) for f in _FACTORS], 1))
    for k, row in zip(long, np.concatenate(least)):
        bands = row[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
        keys = [
            int.from_bytes(hashlib.blake2b(f"{hosts[k]} {i} ".encode() + b.tobytes(), digest_size=8).digest(), "little", signed=True)
            for i, b in enumerate(bands)
        ]
        out[k] = keys, (row & np.uint64(255)).astype(np.uint8).tobytes()
    return out


def _upper(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)


def _near(table: pa.Table) -> pa.Table:
    """Pairs of nearly equal units: each with the first of its band, else with the one before."""
    band, unit = table["band"].to_numpy(), table["unit"].to_numpy()
    signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, MINIMA)
    order = np.lexsort((unit, band))
    band, unit, signature = band[order], unit[order], signature[order]
    new = _starts(band)
    head = np.maximum.accumulate(np.where(new, np.arange(len(band)), 0))
    pairs = []
    for other in (head, np.maximum(head, np.arange(len(band)) - 1)):
        same = (signature == signature[other]).sum(1)
        at = np.flatnonzero((100 * same >= NEAR_PERCENT * MINIMA) & (unit != unit[other]))
        pairs.append(np.stack((unit[at], unit[other[at]]), 1))
    pairs = np.unique(np.concatenate(pairs), axis=0)
    return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})


def _short(h: np.ndarray) -> bytes:
    """The low 48 bits of each hash; the bucket tells more of them."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _starts(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def _packed(values: np.ndarray, span: int) -> bytes:
    """Sorted numbers below ``span``, repeats allowed: their low bytes, and what is above them as
    steps in unary (Elias-Fano), so that close numbers take little more than a byte."""
    n = len(values)
    width = 1 if 8 * n + (span >> 8) <= 16 * n + (span >> 16) else 2
    steps = (values >> np.uint64(8 * width)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(steps[-1]) + 1 if n else 0, np.uint8)
    unary[steps] = 1
    low = (values & np.uint64((1 << 8 * width) - 1)).astype(f"<u{width}")
    return bytes([width]) + n.to_bytes(8, "little") + low.tobytes() + np.packbits(unary).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    low = np.frombuffer(raw, f"<u{width}", n, 9)
    steps = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=9 + n * width)))
    return ((steps - np.arange(n)).astype(np.uint64) << np.uint64(8 * width)) | low


def _order(h: np.ndarray) -> np.ndarray:
    """What sorts numbers; those that leave room for their place are sorted with it."""
    bits = len(h).bit_length()
    if not len(h) or int(h.max()).bit_length() + bits > 64:
        return np.argsort(h)
    return (np.sort((h << np.uint64(bits)) | np.arange(len(h), dtype=np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _few_groups(h: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, each with its distinct groups, but no more of them than ``LEAST_PAGES``."""
    order = _order(h)
    h, group = h[order], group[order]
    new = _starts(h)
    shared = np.flatnonzero(~(new & np.append(new[1:], True)))
    group[shared] = group[shared][np.lexsort((group[shared], h[shared]))]
    new |= _starts(group)
    h, group = h[new], group[new]
    place = np.arange(len(h))
    few = place - np.maximum.accumulate(np.where(_starts(h), place, 0)) < LEAST_PAGES
    return h[few], group[few]


def _enough(h: np.ndarray) -> np.ndarray:
    """Of sorted hashes, those that stand there ``LEAST_PAGES`` times or more, once each."""
    often = h[LEAST_PAGES - 1 :][h[LEAST_PAGES - 1 :] == h[: len(h) - LEAST_PAGES + 1]]
    return often[_starts(often)]


def _passing(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Places of the hashes whose leading bits are marked in ``bitmap``."""
    at = h >> np.uint64(65 - (8 * len(bitmap)).bit_length())
    return np.flatnonzero((bitmap[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8)) & np.uint8(128))


def _parts(pages: list[list[str]]):
    """(from, to) of pages that have ``_PART`` characters or so, one page at least."""
    start = size = 0
    for k, texts in enumerate(pages, 1):
        size += sum(map(len, texts))
        if size >= _PART or k == len(pages):
            yield start, k
            start, size = k, 0


def _chunks(batches, bitmap: np.ndarray | None = None):
    """Hashes of all suffixes that pass ``bitmap``, and the groups of their pages, in chunks."""
    numbers = _Numbers()
    held, count = [], 0
    for batch in batches:
        hosts, pages, group = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
        for a, b in _parts(pages):
            page, _, h = _suffixes(numbers, hosts[a:b], pages[a:b], RUN)
            if bitmap is not None:
                at = _passing(h, bitmap)
                page, h = page[at], h[at]
            held.append((h, group[a + page]))
            count += len(h)
            if count >= _CHUNK:
                yield tuple(map(np.concatenate, zip(*held)))
                held, count = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _by_bucket(h: np.ndarray, bits: int, buckets: int):
    """(bucket, from, to) of sorted hashes of ``bits`` bits, by the leading ones."""
    edges = [b << (bits - buckets.bit_length() + 1) for b in range(1, buckets)]
    ends = [0, *np.searchsorted(h, np.array(edges, np.uint64)).tolist(), len(h)]
    return ((b, i, j) for b, (i, j) in enumerate(zip(ends, ends[1:])) if i < j)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    types = (pa.int64(), *[pa.binary()] * (len(names) - 1))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _sketch(bits: int, buckets: int):
    """The leading ``bits`` of all suffixes' hashes, packed, a chunk's part of a bucket in a row.

    One for each group of a chunk that has them, ``LEAST_PAGES`` at most.
    """

    def work(batches):
        for h, group in _chunks(batches):
            h, _ = _few_groups(h >> np.uint64(64 - bits), group)
            span = (1 << bits) // buckets
            yield _rows(
                [(b, _packed(h[i:j] - np.uint64(b * span), span)) for b, i, j in _by_bucket(h, bits, buckets)],
                ["bucket", "hashes"],
            )

    return work


def _often(span: int):
    """Those of a bucket that stand there often enough to be repeated."""

    def of_bucket(table: pa.Table) -> pa.Table:
        own = _enough(np.sort(np.concatenate([_unpacked(x.as_py()) for x in table["hashes"]])))
        found = {"bucket": pa.array([table["bucket"][0].as_py()], pa.int64()), "n": pa.array([len(own)], pa.int64())}
        return pa.table({**found, "hashes": pa.array([_packed(own, span)], pa.binary())}).slice(0, min(1, len(own)))

    return of_bucket


def _bitmap(often: DataFrame, bits: int, buckets: int, count: int) -> np.ndarray:
    """Which leading bits of a hash stand there often: at most 2 ** ``_MAX_FILTER_BITS`` marks."""
    left = min(bits, _MAX_FILTER_BITS, max(20, count.bit_length() + 5))
    size = (1 << left) // buckets

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marks = np.zeros(size, bool)
                marks[_unpacked(raw) >> np.uint64(bits - left)] = True
                rows.append((bucket, np.packbits(marks).tobytes()))
            return _rows(rows, ["bucket", "marks"])

        return step

    out = np.zeros((1 << left) // 8, np.uint8)
    for row in map_texts(often, ["bucket", "hashes"], "bucket long, marks binary", make).collect():
        out[row.bucket * size // 8 : (row.bucket + 1) * size // 8] = np.frombuffer(row.marks, np.uint8)
    return out


def _shared(bitmap: np.ndarray, buckets: int):
    """The suffixes that pass, with groups that have them, a chunk's part of a bucket in a row."""

    def work(batches):
        for h, group in _chunks(batches, bitmap):
            h, group = _few_groups(h, group)
            yield _rows(
                [(b, group[i:j].tobytes(), h[i:j].tobytes()) for b, i, j in _by_bucket(h, 64, buckets)],
                ["bucket", "groups", "hashes"],
            )

    return work


def _repeats(table: pa.Table) -> pa.Table:
    """The suffixes of a bucket that enough groups have."""
    h, group = (np.concatenate([np.frombuffer(x.as_py(), t) for x in table[k]]) for k, t in (("hashes", np.uint64), ("groups", np.int64)))
    return pa.table({"hashes": pa.array([_enough(_few_groups(h, group)[0]).tobytes()], pa.binary())})


def _dealt(buckets: int, bitmap: np.ndarray | None = None):
    """Batch function: distinct suffixes of the units that pass ``bitmap`` and the units' groups,
    one row a bucket."""

    def make():
        numbers = _Numbers()

        def step(batch: pa.RecordBatch):
            for a in range(0, batch.num_rows, _SLICE):
                part = batch.slice(a, _SLICE)
                units, firsts = np.unique(part.column(0).to_numpy(), return_index=True)
                host, texts, group = (part.column(k).take(pa.array(firsts)) for k in (1, 2, 3))
                group = group.to_numpy()
                page, _, h = _suffixes(numbers, host.to_pylist(), texts.to_pylist(), RUN)
                if bitmap is not None:
                    at = _passing(h, bitmap)
                    page, h = page[at], h[at]
                bucket = (h >> np.uint64(48)).astype(np.int64) % buckets
                order = np.lexsort((h, page, bucket))
                page, h, bucket = page[order], h[order], bucket[order]
                new = _starts(h) | _starts(page)
                page, h, bucket = page[new], h[new], bucket[new]
                ends = np.flatnonzero(_starts(bucket)).tolist() + [len(h)]
                rows = []
                for i, j in zip(ends, ends[1:]):
                    own, local = np.unique(page[i:j], return_inverse=True)
                    rows.append((int(bucket[i]), units[own].tobytes(), group[own].tobytes(), local.astype(np.uint16).tobytes(), _short(h[i:j])))
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 4))],
                    ["bucket", "units", "groups", "local", "hashes"],
                )

        return step

    return make


def _of_bucket(table: pa.Table) -> pa.Table:
    """Per unit, its suffixes that units of enough groups of the host share."""
    units, groups, hashes = [], [], []
    for k in range(table.num_rows):
        local = np.frombuffer(table["local"][k].as_py(), np.uint16)
        units.append(np.frombuffer(table["units"][k].as_py(), np.int64)[local])
        groups.append(np.frombuffer(table["groups"][k].as_py(), np.int64)[local])
        hashes.append(_long(table["hashes"][k].as_py()))
    unit, group, h = np.concatenate(units), np.concatenate(groups), np.concatenate(hashes)
    order = np.lexsort((unit, group, h))
    unit, group, h = unit[order], group[order], h[order]
    new = _starts(unit) | _starts(h)
    unit, group, h = unit[new], group[new], h[new]
    run = np.cumsum(_starts(h)) - 1
    many = np.bincount(run, weights=_starts(group) | _starts(h))[run] >= LEAST_PAGES
    unit, h = unit[many], h[many]
    order = np.argsort(unit, kind="stable")
    unit, h = unit[order], h[order]
    ends = np.flatnonzero(_starts(unit)).tolist() + [len(h)]
    return pa.table(
        {
            "unit": pa.array(unit[ends[:-1]], pa.int64()),
            "marks": pa.array([_short(h[i:j]) for i, j in zip(ends, ends[1:])], pa.binary()),
        }
    )


def _read_pages():
    numbers = _Numbers()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts = batch.column(3).to_pylist()
        read = [candidates(blocks(h.as_py())) for h in batch.column(2)]
        units = [
            int.from_bytes(hashlib.blake2b("\x1f".join((x, *t)).encode(), digest_size=8).digest(), "little", signed=True)
            for x, t in zip(hosts, read)
        ]
        signed = [s or (None, None) for s in _signatures(numbers, hosts, read)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), batch.column(3), pa.array(units, pa.int64()),
                pa.array([k for k, _ in signed], pa.list_(pa.int64())),
                pa.array([x for _, x in signed], pa.binary()),
                pa.array(read, pa.list_(pa.string())),
            ],
            ["key", "url", "host", "unit", "bands", "signature", "texts"],
        )

    return step


def _cut_pages(key: str, repeats: np.ndarray | None = None):
    """Batch function: the pages' texts without what is repeated: ``repeats``, or their own marks."""

    def marked(page: np.ndarray, h: np.ndarray, marks: list) -> np.ndarray:
        ends = np.searchsorted(page, np.arange(len(marks) + 1)).tolist()
        at = [
            i + np.flatnonzero(np.isin(h[i:j] & np.uint64((1 << 48) - 1), _long(b"".join(own))))
            for i, j, own in zip(ends, ends[1:], marks)
            if own
        ]
        return np.concatenate(at) if at else np.zeros(0, np.int64)

    def among(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
        at = _passing(h, bitmap)
        return at[repeats[np.minimum(np.searchsorted(repeats, h[at]), len(repeats) - 1)] == h[at]]

    def make():
        numbers = _Numbers()
        if repeats is not None and len(repeats):
            left = max(20, len(repeats).bit_length() + 5)
            bits = np.zeros(1 << left, bool)
            bits[repeats >> np.uint64(64 - left)] = True
            bitmap = np.packbits(bits)

        def step(batch: pa.RecordBatch):
            every = [batch.column(k).to_pylist() for k in range(2, batch.num_columns)]
            for a, b in _parts(every[1]):
                hosts, pages, *marks = (x[a:b] for x in every)
                at = ()
                if repeats is None or len(repeats):
                    told = _hashed(pages)
                    page, first, h = _suffixes(numbers, hosts, pages, RUN, told)
                    at = among(h, bitmap) if repeats is not None else marked(page, h, *marks)
                if len(at):
                    ends = np.cumsum(told[0])
                    start = (ends - told[0])[page[at]] + first[at]
                    size = int(ends[-1])
                    steps = np.bincount(start, minlength=size + 1) - np.bincount(start + RUN, minlength=size + 1)
                    covered = np.cumsum(steps)[:size] > 0
                    texts = [cut(p, covered[e - n : e]) for p, e, n in zip(pages, ends.tolist(), told[0].tolist())]
                else:
                    texts = [cut(p, None) for p in pages]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b], batch.column(1)[a:b], pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    [key, "url", "text", "n_chars"],
                )

        return step

    return make


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of ``pages``: key, url, ``text`` and ``n_chars``."""
    key_type = pages.schema[key].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    told = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), html, host.alias("host"))
    schema = f"key {key_type}, url string, host string, unit long, bands array<long>, signature binary, texts array<string>"
    read = stage(map_texts(told, ["key", "url", html, "host"], schema, lambda: _read_pages()), "candidates", "zstd")
    size = F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t))
    volume = read.agg(F.sum(size)).first()[0] or 0
    buckets = min(_MAX_BUCKETS, 1 << (64 + volume // BUCKET_BYTES - 1).bit_length())
    signed = read.filter("bands IS NOT NULL").groupBy("unit").agg(
        F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    bands = signed.select("unit", F.explode("bands").alias("band"))
    bands = bands.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("band"))).filter("n > 1")
    bands = bands.join(signed.select("unit", "signature"), "unit").select("unit", "signature", "band")
    near = bands.groupBy(F.pmod(F.xxhash64("band"), F.lit(buckets))).applyInArrow(_near, "u long, v long")
    groups = stage(components(near), "groups").select(F.col("node").alias("unit"), F.col("component").alias("_group"))
    if groups.count() * 16 <= _MAX_BROADCAST_BYTES:
        groups = F.broadcast(groups)
    grouped = read.select("unit", "host", "texts").join(groups, "unit", "left")
    grouped = grouped.withColumn("group", F.coalesce("_group", "unit"))
    out = f"`{key}` {key_type}, url string, text string, n_chars long"
    bits = max(20, (2 * volume).bit_length())
    told = grouped.select("host", "texts", "group")
    sketch = told.mapInArrow(_sketch(bits, buckets), "bucket long, hashes binary").groupBy("bucket")
    often = stage(sketch.applyInArrow(_often((1 << bits) // buckets), "bucket long, n long, hashes binary"), "often")
    count = often.agg(F.sum("n")).first()[0] or 0
    bitmap = _bitmap(often, bits, buckets, count)
    if 8 * count <= _MAX_BROADCAST_BYTES:  # the repeats go to every task: neither marks nor texts are shuffled
        shared = told.mapInArrow(_shared(bitmap, buckets), "bucket long, groups binary, hashes binary")
        found = shared.groupBy("bucket").applyInArrow(_repeats, "hashes binary").collect()
        repeats = np.sort(np.frombuffer(b"".join(x.hashes for x in found), np.uint64))
        return map_texts(read, ["key", "url", "host", "texts"], out, _cut_pages(key, repeats))
    dealt = map_texts(
        grouped, ["unit", "host", "texts", "group"],
        "bucket long, units binary, groups binary, local binary, hashes binary", _dealt(buckets, bitmap),
    )
    marks = stage(dealt.groupBy("bucket").applyInArrow(_of_bucket, "unit long, marks binary"), "marks")
    weight = marks.agg(F.sum(F.octet_length("marks") + 16)).first()[0] or 0
    marks = marks.groupBy("unit").agg(F.collect_list("marks").alias("marks"))
    if weight <= _MAX_BROADCAST_BYTES:  # texts are not shuffled
        marks = F.broadcast(marks)
    marked = read.join(marks, "unit", "left")
    return map_texts(marked, ["key", "url", "host", "texts", "marks"], out, _cut_pages(key))
