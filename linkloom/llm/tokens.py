"""Token ids and token counts of texts of any length, as a public tokenizer gives them.

Both vocabularies used here split a text before they merge bytes or letters, and no piece of
that split crosses the white space described below. ``Encoder`` therefore works on units, keeps
the ids of units it has seen (bounded), and sends only new ones to the library.

Units. ``byte_bpe``: one space and the non-space run after it, or a run of other white space,
taken as the vocabulary's own split takes it. ``word_bpe``: a non-space run; white space gives
nothing. White space is the Unicode property, not Python's ``\\s``. A text that holds a special
string goes to the library piece by piece around it, because the string is found before the
split and ends the white space before it.

Huge documents are encoded by overlap resynchronisation (``encode_long``): overlapping chunks
are encoded with offsets and spliced at a boundary that both encodings share and that is proven
stable: white space ends there in the text, and ``AGREE`` tokens after it are the same in both.
If there is none, the overlap is widened, up to the rest of the document.

Defined cases: null and empty texts have no tokens; repeated rows are counted each; no text is
cut, padded or left out; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_texts

CHUNK = 1 << 16
OVERLAP = 1 << 10
AGREE = 8
TOGETHER = 1 << 21
MEMO = 400_000
LIMIT = 2048

# Fixed value: the characters with the Unicode property White_Space.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BYTE_UNITS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_WORD_UNITS = re.compile(f"[^{_WS}]+")
# Python's split() takes these for white space, too.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def path_of(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _of_ranks(file: str):
    """The byte-level merges of a rank file, several times as fast for single words as the
    library that reads the JSON file of the same vocabulary, and with the same ids."""
    import public_tokenizers
    import tiktoken

    with open(file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return coder.encode_ordinary


class _Seen(dict):
    """Numbers units in the order they come; ``fresh`` holds those not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.fresh.append(unit)
        return number


class Encoder:
    """Ids of texts under one tokenizer file; ``kind`` is ``byte_bpe`` or ``word_bpe``."""

    def __init__(self, file: str, kind: str, memo: int = MEMO, ranks: str | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.by_ranks = _of_ranks(ranks) if ranks else None
        self.by_word = {"byte_bpe": False, "word_bpe": True}[kind]
        self.limit = memo
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.border, self.border_id = next(iter(special.items()))
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self._forget()

    def _forget(self) -> None:
        self.seen = _Seen()
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.arena = np.zeros(0, np.uint32)

    def _learn(self) -> None:
        """Encode the fresh units, joined by a special string, and append them to the arena."""
        fresh, self.seen.fresh = self.seen.fresh, []
        ids = [self.arena]
        plain = [u for u in fresh if not self.special.fullmatch(u)]
        if self.by_ranks:
            plain_ids = (np.asarray(self.by_ranks(u), np.uint32) for u in plain)
            for u in fresh:
                special = self.special.fullmatch(u)
                ids.append(self._direct(u) if special else next(plain_ids))
            self._append(ids, len(fresh))
            return
        joined = [self.border.join(plain[k : k + 512]) for k in range(0, len(plain), 512)]
        got: list[np.ndarray] = []
        for e in self.library.encode_batch_fast(joined, add_special_tokens=False):
            all_ids = np.asarray(e.ids, np.uint32)
            got += np.split(all_ids, np.flatnonzero(all_ids == self.border_id))
        plain_ids = iter(got)
        at_start = {k * 512 for k in range(len(joined))}
        k = 0
        for u in fresh:
            if self.special.fullmatch(u):
                own = self._direct(u)
            else:
                own = next(plain_ids)
                own = own if k in at_start else own[1:]
                k += 1
            ids.append(own)
        self._append(ids, len(fresh))

    def _direct(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _append(self, ids: list[np.ndarray], many: int) -> None:
        """``ids``: the arena so far and the ids of each new unit."""
        new = np.fromiter((len(x) for x in ids[1:]), np.int64, many)
        self.arena = np.concatenate(ids)
        self.size = np.concatenate((self.size, new))
        self.first = np.cumsum(self.size) - self.size

    def _findall(self, text: str) -> list[str]:
        if not self.by_word:
            return _BYTE_UNITS.findall(text)
        return _WORD_UNITS.findall(text) if _SEPARATORS.search(text) else text.split()

    def pieces(self, text: str) -> list[str]:
        """The units of a text; a special string is one of its own."""
        if "<|" not in text or not self.special.search(text):
            return self._findall(text)
        parts = self.special.split(text)
        return [u for k, p in enumerate(parts) for u in ([p] if k % 2 else self._findall(p))]

    def number(self, units: list[str]) -> np.ndarray:
        """Places of the units in the tables ``first`` and ``size``."""
        if len(self.seen) > self.limit:
            self._forget()
        at = np.fromiter(map(self.seen.__getitem__, units), np.int64, len(units))
        if self.seen.fresh:
            self._learn()
        return at

    def ids_at(self, at: np.ndarray) -> np.ndarray:
        sizes = self.size[at]
        skip = np.cumsum(sizes) - sizes
        return self.arena[np.repeat(self.first[at] - skip, sizes) + np.arange(int(sizes.sum()))]

    def encode(self, text: str) -> np.ndarray:
        return self.ids_at(self.number(self.pieces(text)))

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; texts of about ``TOGETHER`` characters are looked up at a time."""
        begin = length = 0
        for k, text in enumerate(texts):
            length += len(text)
            if length >= TOGETHER or k + 1 == len(texts):
                yield from self._encode_some(texts[begin : k + 1])
                begin, length = k + 1, 0

    def _encode_some(self, texts: list[str]) -> list[np.ndarray]:
        short = [self.pieces(t) if len(t) <= CHUNK else [] for t in texts]
        at = self.number([u for units in short for u in units])
        ends = np.cumsum([len(units) for units in short])
        tokens = np.concatenate([[0], np.cumsum(self.size[at])])[np.concatenate([[0], ends])]
        ids = self.ids_at(at)
        return [
            self.encode_long(t) if len(t) > CHUNK else ids[tokens[k] : tokens[k + 1]]
            for k, t in enumerate(texts)
        ]

    def with_starts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and for each the place of its unit if it is the unit's first token, else -1."""
        pieces = self.pieces(text)
        at = self.number(pieces)
        places, end = np.empty(len(pieces), np.int64), 0
        for k, unit in enumerate(pieces):
            places[k] = text.index(unit, end)
            end = places[k] + len(unit)
        sizes = self.size[at]
        starts = np.full(int(sizes.sum()), -1, np.int64)
        some = sizes > 0
        starts[(np.cumsum(sizes) - sizes)[some]] = places[some]
        return self.ids_at(at), starts

    def encode_long(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
        """Ids of a text by overlapping chunks; the same as ``encode``."""
        if len(text) <= chunk:
            return self.encode(text)
        done: list[np.ndarray] = []
        ids, starts = self.with_starts(text[:chunk])
        base, end, width = 0, chunk, overlap
        while end < len(text):
            begin = max(base, end - width)
            following = min(len(text), end + chunk)
            more, more_starts = self.with_starts(text[begin:following])
            cut = self._splice(text, ids, starts, base, more, more_starts, begin)
            if cut:
                done.append(ids[: cut[0]])
                ids, starts = more[cut[1] :], more_starts[cut[1] :]
                base, end, width = begin, following, overlap
            elif begin > base:
                width *= 4
            else:  # the overlap is the whole chunk by now, and the new encoding holds all of it
                ids, starts, end, width = more, more_starts, following, overlap
        return np.concatenate([*done, ids])

    def _splice(self, text, ids, starts, base, more, more_starts, begin) -> tuple[int, int] | None:
        """Places in both lists of one proven boundary, the last with ``AGREE`` tokens after it.

        White space that no encoding can join with what stands before it ends at the boundary,
        so everything after it is encoded alike wherever the text before it began.
        """
        there = {int(s) + begin: j for j, s in enumerate(more_starts) if s >= 0}
        for i in range(len(ids) - AGREE, -1, -1):
            if starts[i] < 0:
                continue
            at = base + int(starts[i])
            if at <= begin:
                return None
            j = there.get(at)
            if j is None or not np.array_equal(ids[i : i + AGREE], more[j : j + AGREE]):
                continue
            before = text[at - 1]
            if before.isspace() if self.by_word else text[at] == " " and not before.isspace():
                return i, j
        return None


_encoders: dict[tuple[str, str, str | None], Encoder] = {}


def encoder(file: str, kind: str, ranks: str | None = None) -> Encoder:
    """One encoder for each process, so its memo serves later tasks too."""
    if (file, kind, ranks) not in _encoders:
        _encoders[file, kind, ranks] = Encoder(file, kind, ranks=ranks)
    return _encoders[file, kind, ranks]


def count_tokens(
    docs: DataFrame, file: str, kind: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    key_type = docs.schema[key].dataType.simpleString()

    def make():
        code = encoder(file, kind)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = code.encode_all([t or "" for t in batch.column(1).to_pylist()])
            counts = [len(ids) for ids in got]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                [key, "n_bytes", "n_tokens"],
            )

        return step

    sized = docs.select(key, text, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    out = map_texts(sized, [key, text, "n_bytes"], f"`{key}` {key_type}, n_bytes long, n_tokens long", make)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_points(n: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    at = 0
    while at < n:
        length = first if at == 0 else size
        yield at, length
        at += length


def piece_table(
    docs: DataFrame, file: str, size: int, end_id: int = 0, key: str = "doc_id", text: str = "text",
    ranks: str | None = None,
) -> DataFrame:
    """Per piece of each document: key, row (to tell repeated keys apart), piece, start, length, crc."""
    key_type = docs.schema[key].dataType.simpleString()

    def make():
        code = encoder(file, "byte_bpe", ranks)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, pieces, starts, lengths, crcs = [], [], [], [], []
            got = code.encode_all([t or "" for t in batch.column(1).to_pylist()])
            for r, text_ids in enumerate(got):
                ids = np.append(text_ids, np.uint32(end_id))
                for k, (start, length) in enumerate(cut_points(len(ids), size)):
                    rows.append(r)
                    pieces.append(k)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(crc_of_ids(ids[start : start + length]))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                ],
                [key, "piece", "start", "length", "ids_crc32"],
            )

        return step

    schema = f"`{key}` {key_type}, piece int, start long, length long, ids_crc32 long"
    return map_texts(docs, [key, text], schema, make)
