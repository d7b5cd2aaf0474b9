"""Content hash, fetch-error classes, back-off and display columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.profile import SiteProfile


def content_hash(text: Column) -> Column:
    """SHA-256 of the text as hex; null for null or empty text."""
    return F.when(text != "", F.sha2(text, 256))


def is_html_type(content_type: Column) -> Column:
    return F.coalesce(content_type, F.lit("")).contains("text/html")


def attempt_success(error: Column) -> Column:
    return error.isNull()


def error_type(error: Column) -> Column:
    return F.when(error.contains("timed out"), F.lit("timeout")).when(
        error != "", F.lit("request_error")
    )


def retry_at(failed_at: Column, failures_before: Column, profile: SiteProfile) -> Column:
    """When a URL is due again after a failure: the pause grows with earlier failures."""
    seconds = profile.backoff_base_sec * F.pow(F.lit(profile.backoff_factor), failures_before)
    return failed_at + F.make_dt_interval(secs=seconds)


def status_label(status: Column) -> Column:
    """HTTP status for display; null and 0 read N/A."""
    return F.when(status != 0, status.cast("string")).otherwise("N/A")


def title_label(title: Column) -> Column:
    return F.when(title != "", F.substring(title, 1, 60)).otherwise("N/A")
