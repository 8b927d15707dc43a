"""URL functions: parts, allowlist, resolution of hrefs, external ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def scheme(url) -> Column:
    return F.lower(F.try_parse_url(_c(url), F.lit("PROTOCOL")))


def host(url) -> Column:
    """Lower-cased host name; NULL when the URL cannot be parsed."""
    return F.lower(F.try_parse_url(_c(url), F.lit("HOST")))


def has_port(url) -> Column:
    """True when the authority names a port (HOST drops it, AUTHORITY keeps it)."""
    auth = F.try_parse_url(_c(url), F.lit("AUTHORITY"))
    hostport = F.regexp_replace(auth, r"^.*@", "")
    return F.coalesce(hostport.rlike(r":\d+$"), F.lit(False))


def allowed(url, hosts, require_https: bool = True, forbid_port: bool = True) -> Column:
    """Output-URL allowlist: https, host in ``hosts``, no explicit port.

    An unparseable URL (e.g. one with a space) is rejected."""
    hosts = [h.lower() for h in hosts]
    ok = host(url).isin(hosts)
    if require_https:
        ok = ok & (scheme(url) == "https")
    if forbid_port:
        ok = ok & ~has_port(url)
    return F.coalesce(ok, F.lit(False))


def origin(url) -> Column:
    """scheme://authority of an absolute URL."""
    return F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def _strip_query_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def _strip_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 remove_dot_segments as a stack fold over the path's segments
    (``aggregate``): '.' is dropped, '..' pops the previous segment (never
    above the root), and a path ending in '.' or '..' keeps a trailing '/'."""
    segs = F.split(path, "/")
    body = F.slice(segs, 2, F.greatest(F.size(segs) - 1, F.lit(0)))     # after the leading ''
    folded = F.aggregate(
        body, F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                          .when(seg == ".", acc)
                          .otherwise(F.concat(acc, F.array(seg))))
    last = F.element_at(segs, -1)
    trailing = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    rebuilt = F.when(F.size(folded) == 0, F.lit("/")) \
        .otherwise(F.concat(F.lit("/"), F.array_join(folded, "/"), trailing))
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), rebuilt).otherwise(path)


def resolve(href, base) -> Column:
    """Resolve an href against a base URL like ``urllib.parse.urljoin`` (RFC
    3986), entirely in the JVM: reference forms by prefix, then the merged
    path's dot segments removed. An empty href gives NULL."""
    h, b = _c(href), _c(base)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_replace(h, r"^[^?#]*", "")
    b_nq = _strip_query_fragment(b)
    b_path = F.regexp_extract(b_nq, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*(.*)$", 1)
    b_dir = F.regexp_extract(b_path, r"^(.*/)", 1)
    merged = F.when(h_path.startswith("/"), h_path) \
        .otherwise(F.concat(F.when(b_dir == "", F.lit("/")).otherwise(b_dir), h_path))
    relative = F.concat(origin(b), remove_dot_segments(merged), h_rest)
    return (F.when(F.coalesce(h, F.lit("")) == "", F.lit(None).cast("string"))
            .when(h.rlike(_SCHEME), h)
            .when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), h))
            .when(h.startswith("?"), F.concat(b_nq, h))
            .when(h.startswith("#"), F.concat(_strip_fragment(b), h))
            .otherwise(relative))


def last_path_segment(url) -> Column:
    """External id from a URL: its last '/'-separated piece, trailing '/' ignored."""
    seg = F.element_at(F.split(F.regexp_replace(_c(url), "/+$", ""), "/"), -1)
    return F.when(seg != "", seg)
