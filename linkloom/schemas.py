"""Declared schemas. Rows are keyed by canonical URL, never by a counter."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _I, _L, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)

LINK_INFO = _struct(("url", _S, True), ("anchor_text", _S, True))

RAW = _struct(
    ("url", _S, False),
    ("final_url", _S, True),
    ("http_status", _I, True),
    ("content_type", _S, True),
    ("content_length", _L, True),
    ("html", _S, True),
    ("response_time_ms", _I, True),
    ("is_html", _B, True),
    ("error", _S, True),
    ("fetched_at", _TS, False),
)

URLS = _struct(
    ("url", _S, False),
    ("scheme", _S, True),
    ("host", _S, False),
    ("path", _S, True),
    ("query", _S, True),
    ("is_internal", _B, False),
    ("discovered_at", _TS, False),
)

FRONTIER = _struct(
    ("url", _S, False),
    ("status", _S, False),
    ("depth", _I, False),
    ("priority", _I, False),
    ("discovered_from", _S, True),
    ("next_fetch_at", _TS, False),
    ("attempt_count", _I, False),
    ("last_error", _S, True),
    ("created_at", _TS, False),
    ("updated_at", _TS, False),
)

PAGES = _struct(
    ("url", _S, False),
    ("fetched_at", _TS, False),
    ("final_url", _S, True),
    ("http_status", _I, True),
    ("content_type", _S, True),
    ("content_length", _L, True),
    ("content_hash", _S, True),
    ("response_time_ms", _I, True),
    ("title", _S, True),
    ("meta_description", _S, True),
    ("html", _S, True),
    ("text_content", _S, True),
    ("is_html", _B, False),
)

LINKS = _struct(
    ("from_url", _S, False),
    ("pos", _I, False),
    ("to_url", _S, False),
    ("anchor_text", _S, True),
    ("is_internal", _B, False),
    ("nofollow", _B, False),
    ("discovered_at", _TS, False),
)

FETCH_ATTEMPTS = _struct(
    ("url", _S, False),
    ("attempted_at", _TS, False),
    ("success", _B, False),
    ("http_status", _I, True),
    ("error_type", _S, True),
    ("error_message", _S, True),
    ("response_time_ms", _I, True),
)

TABLES = {
    "urls": URLS,
    "frontier": FRONTIER,
    "pages": PAGES,
    "links": LINKS,
    "fetch_attempts": FETCH_ATTEMPTS,
}
