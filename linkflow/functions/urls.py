"""URL algebra as native column expressions (no Python workers).

A URL is split by the RFC 3986 expression, which accepts what a strict parser rejects: once, into an
array of its five parts, which all further steps work on. Functions return "" for "no URL"; null
counts as "".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3986 = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

# What the engine's URL rules name.
TRACKING_KEYS = ("fbclid", "gclid", "ref", "spo", "spm", "pk_campaign", "pk_kwd")
TRACKING_PREFIXES = ("utm_", "mc_")
AMP_KEYS = ("outputtype", "amp")
SKIPPED_SCHEMES = ("javascript:", "mailto:", "tel:", "data:")
NON_ARTICLE = r"(?i)(?:^|/)(?:tag|tags|category|categories|author|authors|page|login|search|wp-admin|cart|checkout|account|privacy|terms|cookie)(?:/|$)"
PROMOTION_TITLE = r"(?i)^(?:advertisement|sponsored|promoted)(?:\s+content)?$|\brent\s+(?:this|a)\s+thread\b|\bunlock\s+the\s+power\s+of\s+advertising\b"
ASSETS = r"\.(?:css|js|png|jpg|jpeg|gif|svg|zip|pdf)$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for all its uses in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Stands between parts; a URL holds none (it is dropped).
_NUL = "\x00"


def parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment as an array, by one pass of the expression."""
    bare = F.translate(F.coalesce(url, F.lit("")), _NUL, "")
    return F.split(F.regexp_replace(bare, "(?s)" + RFC3986, _NUL.join(f"${i}" for i in range(1, 6))), _NUL, 5)


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), RFC3986, group)


def scheme_of(url: Column) -> Column:
    return F.lower(part(url, 1))


def path_of(url: Column) -> Column:
    return part(url, 3)


def query_of(url: Column) -> Column:
    return part(url, 4)


def _host(authority: Column) -> Column:
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def host_of(url: Column) -> Column:
    """Lower-case host without user and port."""
    return _host(part(url, 2))


def is_http_url(url: Column) -> Column:
    return scheme_of(url).isin("http", "https") & (part(url, 2) != "")


def external_id(url: Column) -> Column:
    return F.concat(F.lit("a:"), F.substring(F.sha1(url.cast("binary")), 1, 16))


def context_key(url: Column) -> Column:
    """The key of a browser context: the host without ``www.``."""
    return let(F.regexp_replace(host_of(url), r"^www\.", ""), lambda h: F.when(h == "", "default").otherwise(h))


def _join(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column | None = None) -> Column:
    out = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(authority != "", F.concat(F.lit("//"), authority)).otherwise(""), path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    )
    return out if fragment is None else F.concat(out, F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))


def _without_dots(path: Column) -> Column:
    """Resolves ``.`` and ``..`` segments of an absolute path."""
    pieces = F.split(path, "/")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    last = F.element_at(pieces, -1)
    kept = F.aggregate(
        pieces, F.expr("cast(array() as array<string>)"), lambda acc,
        s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    )
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(path.contains("/."), resolved).otherwise(path)


def _skipped(href: Column) -> Column:
    out = href == ""
    for s in SKIPPED_SCHEMES:
        out = out | href.startswith(s)
    return out


def _against(base: Column, h: Column) -> Column:
    """The parts of a reference with parts ``h`` against a base with parts ``base``."""
    own, scheme = h[2], F.lower(base[0])
    folder = F.regexp_extract(base[2], r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    path = F.when(own == "", base[2]).when(own.startswith("/"), _without_dots(own)).otherwise(_without_dots(F.concat(folder, own)))
    query = F.when((own == "") & (h[3] == ""), base[3]).otherwise(h[3])
    absent = F.array_join(base, "") == ""
    return F.when((h[0] != "") | absent, h).when(h[1] != "", F.array(scheme, h[1], own, h[3], h[4])).otherwise(F.array(scheme, base[1], path, query, h[4]))


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` against ``base``: absolute, ``//host``, ``/path``, ``?query``, ``#fragment`` and relative forms."""
    known = F.struct(F.trim(F.coalesce(href, F.lit(""))).alias("href"), parts(base).alias("base"), parts(F.trim(F.coalesce(href, F.lit("")))).alias("own"))

    def joined(x: Column) -> Column:
        absolute = (x["own"][0] != "") | (F.array_join(x["base"], "") == "")
        return F.when(_skipped(x["href"]), "").when(absolute, x["href"]).otherwise(let(_against(x["base"], x["own"]), lambda r: _join(r[0], r[1], r[2], r[3], r[4])))

    return let(known, joined)


def _decode(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encode(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def filter_query(query: Column, keep: Callable[[Column], Column]) -> Column:
    """Re-encoded ``k=v`` pairs whose decoded key is kept, in order; duplicates and blanks stay."""
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(pairs, lambda p: F.struct(_decode(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"), _decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.array_join(F.transform(F.filter(pairs, lambda p: keep(p["k"])), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.when(query == "", "").otherwise(kept)


def _is_tracking(key: Column, extra: Column | None) -> Column:
    low = F.lower(key)
    bad = low.isin(*TRACKING_KEYS)
    for p in TRACKING_PREFIXES:
        bad = bad | low.startswith(p)
    if extra is not None:
        bad = bad | F.array_contains(F.transform(F.coalesce(extra, F.expr("cast(array() as array<string>)")), F.lower), low)
    return bad


def _is_amp(key: Column) -> Column:
    return F.lower(key).isin(*AMP_KEYS)


def _without_amp(path: Column) -> Column:
    end = F.regexp_replace(path, "/amp$", "")
    return F.when(path.endswith("/amp/"), F.regexp_replace(path, "/amp/$", "/")).when(path == "/amp", "/").when(path.endswith("/amp"), end).otherwise(path)


def strip_tracking(url: Column, extra: Column | None = None) -> Column:
    """Drops the fragment and tracking keys (and ``extra``, an array of keys); re-encodes the query."""
    return let(parts(url), lambda r: _join(F.lower(r[0]), r[1], r[2], filter_query(r[3], lambda k: ~_is_tracking(k, extra))))


def strip_amp(url: Column) -> Column:
    """Drops an ``/amp`` path end and AMP query keys; keeps the fragment."""
    return let(parts(url), lambda r: _join(F.lower(r[0]), r[1], _without_amp(r[2]), filter_query(r[3], lambda k: ~_is_amp(k)), r[4]))


def allowed_hosts(home: Column, allowed: Column | None = None) -> Column:
    """The listed hosts, or the home page's host with and without ``www.``."""
    own = let(
        host_of(home),
        lambda h: F.when(h == "", F.expr("cast(array() as array<string>)")).otherwise(F.array(h, F.when(h.startswith("www."), F.substr(h, F.lit(5))).otherwise(F.concat(F.lit("www."), h))))
    )
    if allowed is None:
        return own
    listed = F.filter(F.transform(allowed, lambda h: F.lower(F.trim(h))), lambda h: h != "")
    return F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, listed).otherwise(own)


def canonicalize(url: Column, base: Column | None = None, home: Column | None = None, allowed: Column | None = None, extra: Column | None = None) -> Column:
    """A cleaned absolute URL, or "" if it is no http URL, has a bad port, or its host is not allowed."""
    start = F.coalesce(base, home) if base is not None and home is not None else base if base is not None else home
    trimmed = F.trim(F.coalesce(url, F.lit("")))
    # AMP and tracking keys go in one pass: a query that is decoded and encoded twice is as after once.
    keep = lambda k: ~(_is_tracking(k, extra) | _is_amp(k))

    def clean(r: Column) -> Column:
        scheme = F.lower(r[0])
        path = F.regexp_replace(_without_amp(r[2]), r";[^/]*$", "")
        port = F.regexp_extract(r[1], r":(\d{1,5})$", 1)
        both = F.struct(scheme.alias("scheme"), _host(r[1]).alias("host"), port.alias("port"), F.when(path == "", "/").otherwise(path).alias("path"))
        return let(both, lambda x: _checked(x, r))

    def _checked(x: Column, r: Column) -> Column:
        scheme, port = x["scheme"], x["port"]
        usual = (port == "") | (port == "0") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
        netloc = F.concat(x["host"], F.when(usual, "").otherwise(F.concat(F.lit(":"), port.cast("int").cast("string"))))
        good = scheme.isin("http", "https") & (r[1] != "") & ((port == "") | (F.try_to_number(port, F.lit("99999")) <= 65535))
        if home is not None or allowed is not None:
            hosts = allowed_hosts(home if home is not None else F.lit(""), allowed)
            good = good & let(hosts, lambda h: (F.size(h) == 0) | F.array_contains(h, x["host"]))
        return F.when(good, _join(scheme, netloc, x["path"], filter_query(r[3], keep))).otherwise("")

    if start is None:
        return let(parts(trimmed), clean)
    known = F.struct(trimmed.alias("href"), parts(start).alias("base"), parts(trimmed).alias("own"))
    return let(known, lambda x: F.when(_skipped(x["href"]), "").otherwise(let(_against(x["base"], x["own"]), clean)))


def is_non_article(url: Column) -> Column:
    return path_of(url).isin("", "/") | path_of(url).rlike(NON_ARTICLE)


def is_promotion(url: Column, title: Column) -> Column:
    """Advertisement by title, or a targeted-ad pseudo thread."""
    ad_query = F.exists(F.split(query_of(url), "&"), lambda p: F.lower(_decode(p)) == "do=tad")
    return F.trim(F.coalesce(title, F.lit(""))).rlike(PROMOTION_TITLE) | (F.lower(path_of(url)).endswith("/misc.php") & ad_query)


def is_asset(url: Column) -> Column:
    return path_of(url).rlike(ASSETS)


def is_insecure(url: Column, hosts: Column, ssl_verify: Column | None = None) -> Column:
    """Whether TLS is not verified: the source says so, or the host is, or is below, a listed one."""
    listed = F.exists(hosts, lambda h: (host_of(url) == h) | host_of(url).endswith(F.concat(F.lit("."), h)))
    return listed if ssl_verify is None else F.when(ssl_verify.isNotNull() & ~ssl_verify, True).otherwise(listed)


def same_host(a: Column, b: Column) -> Column:
    x, y = host_of(a), host_of(b)
    return (x != "") & (y != "") & ((x == y) | x.endswith(F.concat(F.lit("."), y)) | y.endswith(F.concat(F.lit("."), x)))
