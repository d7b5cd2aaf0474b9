"""Site profile: everything that is specific to one crawled site."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SiteProfile:
    """Rules and limits for one site. Only the host suffix has no default.

    The pattern, prefix, parameter and limit values below are fixed values that
    results depend on.
    """

    host_suffix: str
    # False: any host ending in the suffix counts, also without a dot before it.
    strict_host: bool = False

    article_likes: tuple[str, ...] = ("%/ru/articles/%", "%/ru/companies/%/articles/%")
    hub_likes: tuple[str, ...] = ("%/ru/hubs/%/articles%",)
    # Matched against the whole path; \p{Nd} is a decimal digit of any script.
    crawl_patterns: tuple[str, ...] = (
        r"/ru/articles/\p{Nd}+/",
        r"/ru/companies/.+/articles/\p{Nd}+/",
        r"/ru/hubs/.+/articles/(/page\p{Nd}+)?/",
    )
    disallowed_prefixes: tuple[str, ...] = ("/search/", "/api/", "/auth/", "/kek/", "/sandbox/")
    tracking_params: tuple[str, ...] = (
        "utm_source",
        "utm_medium",
        "utm_campaign",
        "utm_content",
        "utm_term",
    )

    seed_template: str = "https://{host}/ru/hubs/machine_learning/articles/page{page}/"
    seed_first_page: int = 21
    seed_last_page: int = 99
    seed_priority: int = 10
    link_priority: int = 100

    max_depth: int = 2
    max_pages: int = 1000
    site_gap_sec: int = 10
    other_gap_sec: int = 3
    max_attempts: int = 3
    backoff_base_sec: int = 5
    backoff_factor: int = 3
