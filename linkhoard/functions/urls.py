"""URL columns: cleaning, validity, parts, and reference resolution."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a strip, the save endpoint, and the
# sitemap names probed in this order.
WHITESPACE = " \t\n\r\f\u000b\u0000"
SAVE_ENDPOINT = "https://web.archive.org/save/"
SITEMAP_NAMES = (
    "sitemap_index.xml.gz",
    "sitemap-index.xml.gz",
    "sitemap_index.xml",
    "sitemap-index.xml",
    "sitemap.xml.gz",
    "sitemap.xml",
)

# RFC 3986 building blocks. Repeated groups are possessive: Java then matches them in a loop, and
# very long texts cannot exhaust the stack.
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_PCT = r"%[0-9A-Fa-f]{2}"
_NAME = r"A-Za-z0-9\-._~!$&'()*+,;="
_AUTHORITY = (
    rf"(?:(?:[{_NAME}:]|{_PCT})*+@)?"  # user info
    rf"(?:\[[0-9A-Fa-f:.]+\]|(?:[{_NAME}]|{_PCT})*+)"  # IP literal or name
    r"(?::[0-9]*)?"  # port
)
_PATH = rf"(?:[{_NAME}:@/]|{_PCT})*+"
_TAIL = rf"(?:\?(?:[{_NAME}:@/?]|{_PCT})*+)?(?:#(?:[{_NAME}:@/?]|{_PCT})*+)?"
_AFTER_SCHEME = rf"(?://{_AUTHORITY}(?:/{_PATH})?|(?!//){_PATH}){_TAIL}\z"
_HTTP_URL = rf"^(?i:https?):{_AFTER_SCHEME}"
_ANY_REFERENCE = rf"^(?:{_SCHEME}:)?{_AFTER_SCHEME}"
_HOST = rf"^{_SCHEME}://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^:/?#]*)"
_ROOT = rf"^({_SCHEME}://[^/?#]*)"


def strip(url: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (NULL stays NULL)."""
    return F.btrim(url, F.lit(WHITESPACE))


def is_blank(value: Column) -> Column:
    """True for NULL and for whitespace-only text."""
    return value.isNull() | (strip(value) == "")


def with_scheme(url: Column) -> Column:
    """Prefix ``http://`` unless a line of the text starts with ``http(s)://``."""
    return F.when(url.rlike(r"(?dm)^https?://"), url).otherwise(F.concat(F.lit("http://"), url))


def is_http_url(url: Column) -> Column:
    """True if the text is a well-formed http or https URL; NULL counts as malformed."""
    return F.coalesce(url.rlike(_HTTP_URL), F.lit(False))


def is_reference(text: Column) -> Column:
    """True if the text is a well-formed absolute or relative URL reference."""
    return F.coalesce(text.rlike(_ANY_REFERENCE), F.lit(False))


def host(url: Column) -> Column:
    """Host without user info and port; NULL when the URL has no authority."""
    found = F.regexp_extract(url, _HOST, 1)
    return F.when(found != "", found)


def request_path(url: Column) -> Column:
    """Path and query as sent to a server: at least ``/``, no fragment."""
    rest = F.regexp_replace(url, rf"^{_SCHEME}://[^/?#]*|#.*$", "")
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))


def request_key(url: Column) -> Column:
    """What a request for an absolute http(s) URL asks for; URLs with one key get one answer.

    Scheme and host in lower case, no user info, no default port, then path and query as sent. Any other text is its own key.
    """
    scheme = F.lower(F.regexp_extract(url, r"^((?i)https?)://", 1))
    place = F.lower(F.regexp_extract(url, rf"^{_SCHEME}://(?:[^/?#@]*@)?([^/?#]*)", 1))
    bare = F.when(scheme == "http", F.regexp_replace(place, r":(?:80)?$", "")).otherwise(F.regexp_replace(place, r":(?:443)?$", ""))
    return F.when(scheme == "", url).otherwise(F.concat(scheme, F.lit("://"), bare, request_path(url)))


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def save_url(url: Column, endpoint: str = SAVE_ENDPOINT) -> Column:
    """Address that asks the archive to save ``url``; NULL asks for the bare endpoint."""
    return F.concat(F.lit(endpoint), F.coalesce(strip(url), F.lit("")))


def child_url(base: Column, name: Column) -> Column:
    """Join a name to a base URL with exactly one slash added when needed."""
    return F.concat(base, F.when(base.endswith("/"), "").otherwise("/"), name)


def robots_url(url: Column) -> Column:
    """``/robots.txt`` on the same scheme, host and port."""
    return F.concat(F.regexp_extract(url, _ROOT, 1), F.lit("/robots.txt"))


def _without_dot_segments(path: Column) -> Column:
    """Fold ``.`` and ``..`` segments of an absolute path (RFC 3986, 5.2.4)."""
    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    ends_in_directory = F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0)
    folded = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_in_directory, "/").otherwise(""))
    return F.when(path.contains("/."), folded).otherwise(path)


def resolve(base: Column, reference: Column) -> Column:
    """Resolve a URL reference against an absolute base URL (RFC 3986, 5.2)."""
    root = F.regexp_extract(base, _ROOT, 1)
    scheme = F.regexp_extract(base, rf"^({_SCHEME}:)", 1)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    base_path = F.substring(bare, F.length(root) + 1, F.length(bare))
    folder = F.regexp_replace(F.when(base_path == "", "/").otherwise(base_path), r"[^/]*$", "")
    ref_path = F.regexp_extract(reference, r"^[^?#]*", 0)
    ref_tail = F.substring(reference, F.length(ref_path) + 1, F.length(reference))
    return (
        F.when(reference.rlike(rf"^{_SCHEME}:"), reference)
        .when(reference.startswith("//"), F.concat(scheme, reference))
        .when(reference == "", base)
        .when(reference.startswith("#"), F.concat(without_fragment(base), reference))
        .when(reference.startswith("?"), F.concat(bare, reference))
        .when(reference.startswith("/"), F.concat(root, _without_dot_segments(ref_path), ref_tail))
        .otherwise(F.concat(root, _without_dot_segments(F.concat(folder, ref_path)), ref_tail))
    )


def host_matches(host_: Column, hosts: Iterable[str | re.Pattern]) -> Column:
    """True if the host equals one of the strings or contains a match of one of the patterns.

    Patterns use Java regular expression syntax.
    """
    exact = [h for h in hosts if isinstance(h, str)]
    patterns = [h.pattern for h in hosts if not isinstance(h, str)]
    verdict = host_.isin(exact) if exact else F.lit(False)
    for pattern in patterns:
        verdict = verdict | host_.rlike(pattern)
    return F.coalesce(verdict, F.lit(False))
