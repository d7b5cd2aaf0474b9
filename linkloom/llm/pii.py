"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

Kinds. ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are the base: leftmost, non-overlapping
matches per kind, those that fail their check dropped. The method adds ``iban`` (mod 97);
``inner_card`` and ``inner_phone``, plainly written numbers that a longer base match swallowed
together with its neighbours before failing; and ``local_phone`` (7 to 12 digits without a
country code), which counts only beside a context word, because plain digits prove nothing.

Each span has a score: the weight of its validator plus a bonus for a context word within
``CONTEXT`` characters before it. Base spans stay whatever their score.

Defined cases: a null or empty text has no spans; repeated rows are each scanned; other columns
of the input are ignored by ``find`` and kept by ``mask``. Every scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "inner_card", "inner_phone", "local_phone")
CONTEXT = 40
ACCEPT = 0.6
# Score of a confirmed span without context, and the words that raise it.
WEIGHT = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "inner_card": 0.7, "inner_phone": 0.7, "local_phone": 0.3}
BONUS = 0.4
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "payment", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "inner_card": ("card", "visa", "payment", "credit", "karte", "carte", "tarjeta"),
    "inner_phone": ("phone", "tel", "call", "mobile", "fax"),
    "local_phone": ("phone", "telephone", "telefon", "téléphone", "teléfono", "mobile", "fax"),
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits fails or matches at its first digit, so later starts need no try.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.,/-])\(?[0-9]{2,5}\)?(?:[\x20/-][0-9]{2,4}){1,3}(?![0-9A-Za-z/-])")
_INNER_CARD = re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9A-Za-z])")
_INNER_PHONE = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])")
_DIGIT = re.compile("[0-9]")
_WORDS = {k: re.compile(r"(?<!\w)(?:" + "|".join(v) + r")s?(?!\w)", re.I) for k, v in CONTEXT_WORDS.items()}


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = ((2 * int(d) - 9 if d > "4" else 2 * int(d)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Each address ends a run of local-part characters at an ``@``, so only those are tried."""
    found, free, last = [], 0, 0
    at = text.find("@")
    while at >= 0:
        before = text[max(free, last) : at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, m.end()))
            free = m.end()
        last = at + 1
        at = text.find("@", last)
    return found


def _apart(found: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of ``found`` that overlap none of ``taken``, by one sweep over both."""
    out, reach = [], 0
    order = sorted([(a, 0, b) for a, b in taken] + [(a, 1, b) for a, b in found])
    ahead = len(taken) and sorted(taken)
    k = 0
    for a, new, b in order:
        if not new:
            reach, k = max(reach, b), k + 1
        elif a >= reach and (not ahead or k >= len(ahead) or ahead[k][0] >= b):
            out.append((a, b))
    return out


def _proposed(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "email") for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((*m.span(), "phone"))
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            out.append((*m.span(), "iban"))
    taken = [(a, b) for a, b, _ in out]
    tests = (
        (_INNER_CARD, "inner_card", luhn),
        (_INNER_PHONE if "+" in text else None, "inner_phone", lambda d: 10 <= len(d) <= 15),
        (_LOCAL_PHONE, "local_phone", lambda d: 7 <= len(d) <= 12),
    )
    for pattern, kind, holds in tests:
        more = [m.span() for m in pattern.finditer(text) if holds(_digits(m[0]))] if pattern else []
        more = _apart(more, taken)
        taken += more
        out += [(a, b, kind) for a, b in more]
    return out


def spans(text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind; code points, end exclusive."""
    text = text or ""
    kept = []
    for start, end, kind in _proposed(text):
        near = _WORDS[kind].search(text[max(0, start - CONTEXT) : start])
        score = round(min(1.0, WEIGHT[kind] + (BONUS if near else 0.0)), 2)
        if kind in BASE or score >= ACCEPT:
            kept.append((start, end, kind, score))
    return sorted(kept, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans merge."""
    if not text:
        return text
    out, done = [], 0
    for start, end, kind, _ in spans(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


SPAN = "struct<start:int,end:int,kind:string,score:double>"


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the key and its spans as an array of structs."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        span = pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]
        )

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [
                [dict(zip(("start", "end", "kind", "score"), s)) for s in spans(t.as_py())]
                for t in batch.column(1)
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(span))], [key, "spans"]
            )

        return step

    return map_texts(docs, [key, text], f"`{key}` {kind}, spans array<{SPAN}>", make)


def mask(docs: DataFrame, text: str = "text", count: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``count``, if there, is counted again."""
    columns = docs.columns
    at = columns.index(text)
    schema = docs.schema

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array([masked(t.as_py()) for t in batch.column(at)], pa.string())
            return batch.set_column(at, columns[at], texts)

        return step

    out = map_texts(docs, [f"`{c}`" for c in columns], schema, make)
    if count in columns:
        size = F.length(text).cast(schema[count].dataType)
        out = out.withColumn(count, F.when(F.col(text).isNull(), F.col(count)).otherwise(size))
    return out.select(*columns)


def digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    found = find(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def joined(array):
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def digest_brute(doc_id: int, text: str | None) -> tuple:
    """One row of ``digest`` by the plain patterns, for tests."""
    text = text or ""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    got = [(m.start(), 0, m.end()) for m in email.finditer(text)]
    got += [(m.start(), 1, m.end()) for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    got += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))]
    got += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    line = ",".join(f"{BASE[k]}:{a}:{b}" for a, k, b in sorted(got))
    n = [sum(k == j for _, k, _ in got) for j in range(4)]
    return (doc_id, *n, hashlib.sha256(line.encode()).hexdigest())
