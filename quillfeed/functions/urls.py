"""URL column expressions (PRJ15-21, PRJ33).

URLs are split with the generic-syntax regex of RFC 3986 (appendix B), which is
as lenient as a standard-library URL split (no exception on spaces or odd
characters), unlike ``parse_url`` / ``try_parse_url``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3986 appendix B: groups 2=scheme 4=authority 5=path 7=query 9=fragment
URL_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"
HOST_RE = r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)"


def url_scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, URL_RE, 2))


def url_netloc(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 4)


def url_path(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 5)


def url_query(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 7)


def url_fragment(u: Column) -> Column:
    return F.regexp_extract(u, URL_RE, 9)


def url_host(u: Column) -> Column:
    """Lower-cased host without user info or port; NULL when there is no authority."""
    h = F.lower(F.regexp_extract(url_netloc(u), HOST_RE, 1))
    return F.when(h != "", h)


def url_hash(u: Column) -> Column:
    """PRJ17: sha256 hex of the URL exactly as resolved (before re-encoding)."""
    return F.sha2(u, 256)


def article_key(url_hash_col: Column, title: Column) -> Column:
    """PRJ18: url_hash followed by sha256 of the title without outer white space."""
    return F.concat(url_hash_col, F.sha2(F.regexp_replace(title, r"(?U)^\s+|\s+$", ""), 256))


def quote_segment(seg: Column) -> Column:
    """Percent-encode one path segment like a standard ``quote`` (safe: A-Z a-z 0-9 _ . - ~).

    ``url_encode`` is form style: it writes space as ``+``, leaves ``*`` and
    encodes ``~``; three replaces turn it into path style."""
    e = F.url_encode(seg)
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def quote_path(path: Column) -> Column:
    """PRJ16: encode every segment of a path, keep the ``/`` separators (``%`` is encoded again)."""
    return F.array_join(F.transform(F.split(path, "/", -1), quote_segment), "/")


SAFE_PATH_RE = r"^[A-Za-z0-9_.~/-]*$"


def reencode_url(u: Column) -> Column:
    """PRJ16: URL with its path percent-encoded and the other parts kept.

    A path made only of characters ``quote`` leaves alone re-encodes to
    itself; such URLs (the usual case) are returned as they are, and only the
    rest is split and reassembled."""
    unchanged = url_path(u).rlike(SAFE_PATH_RE) & ~u.rlike(r"(\?#|[?#]$)")
    return F.when(unchanged, u).otherwise(_reencode_url(u))


def _reencode_url(u: Column) -> Column:
    scheme = F.regexp_extract(u, URL_RE, 2)
    netloc = url_netloc(u)
    q = url_query(u)
    frag = url_fragment(u)
    has_auth = F.regexp_extract(u, URL_RE, 3) != ""
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(has_auth, F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
        quote_path(url_path(u)),
        F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")),
        F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
    )


def ensure_https_www(domain: Column) -> Column:
    """PRJ20: ``https://`` or ``https://www.`` prefix (or nothing) becomes ``https://www.``.

    Other schemes are not recognised and get the prefix in front, as in the reference."""
    return F.regexp_replace(domain, r"^(https://(www\.)?)?", "https://www.")


def is_https_url(u: Column) -> Column:
    """PRJ21: scheme is https and an authority is present."""
    return F.coalesce((url_scheme(u) == "https") & (url_netloc(u) != ""), F.lit(False))


def is_http_url(u: Column) -> Column:
    """Validation for publisher Domain/Feed: http(s) scheme with a host."""
    return F.coalesce(url_scheme(u).isin("http", "https") & (url_netloc(u) != ""), F.lit(False))


def host_label(u: Column) -> Column:
    """PRJ33: host name with dots replaced by underscores (metric label)."""
    return F.replace(url_host(u), F.lit("."), F.lit("_"))


DOT_SEGMENT_RE = r"/\.{1,2}(/|$)"


def remove_dot_segments(path: Column) -> Column:
    """Absolute path without ``.`` and ``..`` segments; ``..`` at the root is dropped."""
    parts = F.slice(F.split(path, "/"), 2, F.size(F.split(path, "/")))
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolve_against(base: Column, ref: Column) -> Column:
    """PRJ19: resolve a reference against a site URL (RFC 3986, section 5).

    References with a scheme of their own (``data:`` included) and empty strings
    pass through; ``//h/p`` takes the scheme, ``/p`` the host, ``p`` the folder of
    the base, ``?q`` its path and ``#f`` its path and query. ``.`` and ``..``
    segments of a resolved path are removed. Both values are bound once (a
    one-element ``transform``), so their expressions are not copied."""
    return F.transform(F.array(F.struct(base.alias("base"), ref.alias("ref"))), lambda x: _resolve(x["base"], x["ref"]))[0]


def _resolve(base: Column, ref: Column) -> Column:
    site = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    rest = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(url_path(base), r"^(.*/)", 1)
    merged = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    merged = F.when(merged.rlike(DOT_SEGMENT_RE), remove_dot_segments(merged)).otherwise(merged)
    return (
        F.when(ref.isNull() | (ref == "") | ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:/?#]+:)", 1), ref))
        .when(ref.startswith("?"), F.concat(site, url_path(base), rest))
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), ref))
        .otherwise(F.concat(site, merged, rest))
    )
