"""URL columns: canonical form, parts, classification and admission.

Pure ``Column`` expressions, so they run in the JVM next to the scan. The rules
follow Python's ``urllib.parse``; ``parse_url`` is not used because it rejects or
nulls many URLs that occur on the web.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.profile import SiteProfile

# RFC 3986 appendix B with the scheme restricted to legal characters. Groups:
# 1 scheme, 2 authority, 3 path, 4 query.
_SPLIT = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
)
# The common shape, where canonical form and parts need no general split: lower-case
# web URL without port, user info, parameters and query.
_PLAIN = r"(?s)^https?://[a-z0-9._\-]+(?:/[^?#;\t\r\n]*)?(?:#.*)?\z"
_PLAIN_TAIL = r"(?s)^([^#]*?)/?(?:#.*)?\z"
# Leading C0 controls and blanks, and tab, CR and LF anywhere, are not part of a URL.
_NOISE = r"^[\x00-\x20]+|[\t\r\n]+"

# Schemes whose last path segment may carry ";params".
_SCHEMES_WITH_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
# Schemes that are written with "//" even when the host is empty.
_SCHEMES_WITH_HOST = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh",
    "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
# Characters whose NFKC form contains one of / ? # @ : and which are
# therefore not allowed in an authority.
_UNSAFE_IN_HOST = (
    "[⁇⁈⁉℀℁℅℆⩴︓︖"
    "﹕﹖﹟﹫＃／：？＠]"
)
# An IPv6 literal (at most one "::", optional dotted tail and zone) or an IPvFuture one.
_BRACKETED_OK = (
    r"(?i)^(?:v[0-9a-f]+\..+"
    r"|(?=(?:[^:]*:){2,8}[^:]*\z)"
    r"(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}"
    r"|(?:[0-9a-f]{1,4}:){6}\d{1,3}(?:\.\d{1,3}){3}"
    r"|(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,6})?::"
    r"(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,6})?"
    r"|(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,4})?::"
    r"(?:[0-9a-f]{1,4}:){0,5}\d{1,3}(?:\.\d{1,3}){3})"
    r"(?:%[^%]+)?)\z"
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Keeps nested URL expressions linear in size; the optimizer would otherwise
    inline every use.
    """
    return F.transform(F.array(value), body)[0]


def _parts(url: Column) -> Column:
    """Struct of scheme (lower case), authority, path (without ";params") and query."""

    def named(part: Column) -> Column:
        scheme, path = F.lower(part[0]), part[2]
        has_params = path.contains(";") & scheme.isin(*_SCHEMES_WITH_PARAMS)
        return F.struct(
            scheme.alias("scheme"),
            part[1].alias("authority"),
            F.when(has_params, F.regexp_replace(path, r";[^/]*\z", "")).otherwise(path).alias("path"),
            part[3].alias("query"),
        )

    # One match for all four groups: a cleaned URL has no line feed, so it can part them.
    clean = F.regexp_replace(url, _NOISE, "")
    return _let(F.split(F.regexp_replace(clean, _SPLIT, "$1\n$2\n$3\n$4"), "\n", -1), named)


def _is_malformed(authority: Column) -> Column:
    """Authorities that a URL parser refuses."""
    opens, closes = authority.contains("["), authority.contains("]")
    inside = F.regexp_extract(authority, r"^[^\[]*\[([^\]]*)", 1)
    return (
        (opens != closes)
        | (opens & closes & ~inside.rlike(_BRACKETED_OK))
        | (authority.rlike(r"[^\x00-\x7F]") & authority.rlike(_UNSAFE_IN_HOST))
    )


def _host_info(authority: Column) -> Column:
    """Authority without user info."""
    return F.when(authority.contains("@"), F.regexp_replace(authority, r"(?s)^.*@", "")).otherwise(
        authority
    )


def _host(info: Column) -> Column:
    """Lower-case host, empty when there is none."""
    return F.lower(
        F.when(info.contains("["), F.regexp_extract(info, r"\[([^\]]*)", 1)).otherwise(
            F.substring_index(info, ":", 1)
        )
    )


def _port_suffix(info: Column) -> Column:
    """``:port`` without leading zeros; empty when the port is absent, 0 or invalid."""
    digits = F.regexp_extract(info, r"^(?:[^\[:]*|[^\]]*\][^:]*):0*([1-9][0-9]{0,4})\z", 1)
    return F.when(info.contains(":"), _let(digits, _port_in_range)).otherwise("")


def _port_in_range(digits: Column) -> Column:
    return F.when(digits.try_cast("int") <= 65535, F.concat(F.lit(":"), digits)).otherwise("")


def _decode(text: Column) -> Column:
    decoded = F.url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(text.contains("%") | text.contains("+"), decoded).otherwise(text)


def _encode(text: Column) -> Column:
    # The JVM leaves "*" and escapes "~"; the wanted form is the other way round.
    encoded = F.replace(
        F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )
    return F.when(text.rlike(r"[^A-Za-z0-9_.~\-]"), encoded).otherwise(text)


def _canonical_query(query: Column, tracking_params: tuple[str, ...]) -> Column:
    """Sorted by key, values of one key in input order, without tracking parameters."""
    pairs = F.filter(F.split(query, "&", -1), lambda p: p != "")
    decoded = F.transform(
        pairs,
        lambda p, i: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            i.alias("i"),
            _decode(F.regexp_replace(p, r"^[^=]*=?", "")).alias("v"),
        ),
    )
    kept = F.filter(decoded, lambda p: ~F.lower(p["k"]).isin(*tracking_params))
    return F.array_join(
        F.transform(
            F.sort_array(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))
        ),
        "&",
    )


def _assemble(scheme: Column, netloc: Column, path: Column, query: Column) -> Column:
    slashes = F.lit("//")
    needs_slashes = path.startswith("//") | (
        scheme.isin(*_SCHEMES_WITH_HOST) & path.startswith("/")
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when((netloc != "") | needs_slashes, F.concat(slashes, netloc)).otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def normalize_url(url: Column, profile: SiteProfile) -> Column:
    """Canonical form: lower-case scheme and host, no user info, fragment or tracking
    parameters, a path that ends in "/", and sorted, re-encoded query parameters.
    A URL that cannot be parsed is returned unchanged."""

    def canonical(parts: Column) -> Column:
        path, query = parts["path"], parts["query"]
        pieces = F.struct(
            _let(
                _host_info(parts["authority"]), lambda i: F.concat(_host(i), _port_suffix(i))
            ).alias("netloc"),
            F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/"))).alias("path"),
            F.when(query == "", query)
            .otherwise(_canonical_query(query, profile.tracking_params))
            .alias("query"),
        )
        return _let(
            pieces, lambda p: _assemble(parts["scheme"], p["netloc"], p["path"], p["query"])
        )

    def general(u: Column) -> Column:
        return _let(
            _parts(u), lambda p: F.when(_is_malformed(p["authority"]), u).otherwise(canonical(p))
        )

    return _let(
        url,
        lambda u: F.when(u.rlike(_PLAIN), F.regexp_replace(u, _PLAIN_TAIL, "$1/")).otherwise(
            general(u)
        ),
    )


def url_parts(url: Column) -> Column:
    """Struct of scheme, host (lower case, without port, null when absent), path, query."""

    def named(scheme: Column, host: Column, path: Column, query: Column) -> Column:
        return F.struct(
            scheme.alias("scheme"), host.alias("host"), path.alias("path"), query.alias("query")
        )

    def general(parts: Column) -> Column:
        host = _let(_host_info(parts["authority"]), _host)
        valid = ~_is_malformed(parts["authority"])
        return named(
            parts["scheme"],
            F.when(valid, F.nullif(host, F.lit(""))),
            parts["path"],
            parts["query"],
        )

    def plain(u: Column) -> Column:
        after_scheme = F.substring_index(u, "#", 1)
        host = F.split_part(after_scheme, F.lit("/"), F.lit(3))
        start = F.locate("/", u, 9)
        path = F.when(start > 0, F.substr(after_scheme, start)).otherwise("")
        return named(F.substring_index(u, ":", 1), host, path, F.lit(""))

    return _let(
        url, lambda u: F.when(u.rlike(_PLAIN), plain(u)).otherwise(_let(_parts(u), general))
    )


def url_scheme(url: Column) -> Column:
    return url_parts(url)["scheme"]


def url_host(url: Column) -> Column:
    """Lower-case host without port, null when there is none."""
    return url_parts(url)["host"]


def url_path(url: Column) -> Column:
    return url_parts(url)["path"]


def url_query(url: Column) -> Column:
    return url_parts(url)["query"]


def host_on_site(host: Column, profile: SiteProfile) -> Column:
    """Whether a host belongs to the profile's site; false for none."""
    if profile.strict_host:
        match = (host == profile.host_suffix) | host.endswith("." + profile.host_suffix)
    else:
        match = host.endswith(profile.host_suffix)
    return F.coalesce(match, F.lit(False))


def is_internal_url(url: Column, profile: SiteProfile) -> Column:
    return host_on_site(url_host(url), profile)


def should_crawl(url: Column, profile: SiteProfile) -> Column:
    """True for URLs of the site whose whole path matches a crawl pattern."""
    pattern = "(?s)^(?:" + "|".join(profile.crawl_patterns) + r")\z"
    match = _let(
        url_parts(url), lambda p: host_on_site(p["host"], profile) & p["path"].rlike(pattern)
    )
    return F.coalesce(match, F.lit(False))


def is_allowed(url: Column, profile: SiteProfile) -> Column:
    """Robots rule: on the site and under none of the disallowed path prefixes."""

    def allowed(parts: Column) -> Column:
        blocked = [parts["path"].startswith(prefix) for prefix in profile.disallowed_prefixes]
        return host_on_site(parts["host"], profile) & ~reduce(or_, blocked, F.lit(False))

    return F.coalesce(_let(url_parts(url), allowed), F.lit(False))


def _like_any(url: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(or_, (url.like(p) for p in patterns), F.lit(False))


def is_article(url: Column, profile: SiteProfile) -> Column:
    return _like_any(url, profile.article_likes)


def is_hub(url: Column, profile: SiteProfile) -> Column:
    return _like_any(url, profile.hub_likes)


def parts_rejection(parts: Column) -> Column:
    """Why a canonical URL with these ``url_parts`` may not be stored; null when it may."""
    web = F.coalesce(parts["scheme"].isin("http", "https"), F.lit(False))
    return F.when(~web, F.lit("unsupported scheme")).when(
        parts["host"].isNull(), F.lit("no host")
    )


def rejection_reason(url: Column) -> Column:
    """Why a canonical URL may not be stored; null when it may."""
    return _let(url_parts(url), parts_rejection)


def site_gap_seconds(host: Column, profile: SiteProfile) -> Column:
    """Minimum pause between two fetches of one host."""
    return F.when(host_on_site(host, profile), profile.site_gap_sec).otherwise(profile.other_gap_sec)
