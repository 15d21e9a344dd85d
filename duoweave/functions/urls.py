"""URL checks and link normalisation as native column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading characters dropped before parsing (C0 controls and space), and
# characters removed anywhere (tab, CR, LF), as the stdlib URL splitter does.
_LEADING_JUNK = r"^[\x{00}-\x{20}]+"
_REMOVED = r"[\t\r\n]"
SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_AUTHORITY = rf"^{SCHEME}://([^/?#]*)"
_ORIGIN = rf"^({SCHEME}://[^/?#]*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _prepared(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), _LEADING_JUNK, ""),
                            _REMOVED, "")


def netloc(c) -> Column:
    """Authority part (user, host, port) of an absolute URL, '' if none."""
    return F.regexp_extract(_prepared(c), _AUTHORITY, 1)


_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_IPV6_FULL = rf"^(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{6}}{_IPV4})\z"
_IPV6_SHORT = rf"^(?:{_HEX}(?::{_HEX})*)?::(?:(?:{_HEX}:)*(?:{_HEX}|{_IPV4}))?\z"
_FUTURE = r"^v[0-9A-Fa-f]+\.[^\n]+\z"


def bracketed_host_ok(host: Column) -> Column:
    """Whether the text between brackets is an IPv6 address (with a zone, if any) or an IPvFuture one.

    A shortened address stands for at least one group, so it writes out seven
    at most; a dotted end counts as two.
    """
    address = F.substring_index(host, "%", 1)
    zone = ~host.contains("%") | host.rlike("%[^%]+\\z") & (F.length(address) + 1 + F.length(
        F.substring_index(host, "%", -1)) == F.length(host))
    groups = F.size(F.array_remove(F.split(address, ":", -1), "")) + F.when(address.contains("."), 1).otherwise(0)
    six = address.rlike(_IPV6_FULL) | (address.rlike(_IPV6_SHORT) & (groups <= 7))
    return F.when(host.startswith("v"), host.rlike(_FUTURE)).otherwise(zone & six)


@lru_cache
def unsafe_characters() -> str:
    """Characters beyond ASCII whose compatibility form holds a mark that ends an authority or its parts."""
    return "".join(c for c in map(chr, range(0x80, 0x110000)) if unicodedata.decomposition(c)
                   and any(x in unicodedata.normalize("NFKC", c) for x in "/?#@:"))


def is_valid_url(c) -> Column:
    """Scheme and authority both present, bracketed host and characters of the authority valid.

    Mirrors "parse with the stdlib splitter; scheme and netloc non-empty;
    a parse error means invalid".  Spaces inside the host are accepted.
    """
    u = _prepared(c)
    auth = F.regexp_extract(u, _AUTHORITY, 1)
    has_open = auth.contains("[")
    has_close = auth.contains("]")
    bracket_ok = (
        F.when(has_open != has_close, F.lit(False))
        .when(has_open, bracketed_host_ok(F.regexp_extract(auth, r"\[([^\]]*)", 1)))
        .otherwise(F.lit(True))
    )
    safe = F.translate(auth, unsafe_characters(), "") == auth
    return u.rlike(rf"^{SCHEME}://[^/?#]") & bracket_ok & safe


def in_domain(c, domain: str) -> Column:
    """The domain string occurs in the authority (a flag, never a filter)."""
    return netloc(c).contains(domain)


def origin(c) -> Column:
    """scheme://authority of a URL, '' if it has none."""
    return F.regexp_extract(_col(c), _ORIGIN, 1)


def absolute_url(href, base) -> Column:
    """Resolve an href against the URL of the page it was found on.

    Absolute hrefs pass; '//host' takes the page scheme; '/path' takes the
    page origin; '#frag' and '?q' attach to the page URL; other relative
    paths attach to the page's directory.  ``.`` and ``..`` segments of a
    resolved path are taken out; an empty href is the page itself.
    """
    h = _col(href)
    b = _col(base)
    base_no_frag = F.regexp_replace(b, r"#.*\z", "")
    base_no_query = F.regexp_replace(base_no_frag, r"\?.*\z", "")
    scheme = F.regexp_extract(b, rf"^({SCHEME}):", 1)
    directory = F.regexp_replace(base_no_query, r"[^/]*\z", "")
    directory = F.when(directory.rlike(rf"^{SCHEME}://[^/]*\z"), F.concat(base_no_query, F.lit("/"))) \
        .otherwise(directory)
    return (
        F.when(h.rlike(rf"^{SCHEME}:"), h)
        .when(h == "", b)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), without_dots(F.concat(origin(b), h)))
        .when(h.startswith("#"), F.concat(base_no_frag, h))
        .when(h.startswith("?"), F.concat(base_no_query, h))
        .otherwise(without_dots(F.concat(directory, h)))
    )


def without_dots(url: Column) -> Column:
    """The URL with the ``.`` and ``..`` segments of its path resolved."""
    head = origin(url)
    rest = F.substring(url, F.length(head) + 1, F.length(url))
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    tail = F.substring(rest, F.length(path) + 1, F.length(rest))
    parts = F.split(path, "/", -1)
    first = F.array(F.lit(""))
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), first, lambda acc, s: (
        F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))))
    last = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.{1,2}(/|\z)"), F.concat(head, F.array_join(kept, "/"), last, tail)).otherwise(url)


def normalize_link(c) -> Column:
    """Drop every trailing slash."""
    return F.regexp_replace(_col(c), r"/+\z", "")
