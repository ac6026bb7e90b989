"""Addresses: resolution against a base, absolute form, site and path."""

from __future__ import annotations

import re
from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")
#: Characters that stay as they are in a path and in a query.
_PATH, _QUERY = "/%:@!$&'()*+,;=~-._[]|^", "/%:@!$&()*+,;=~-._?[]|^`{}\\"


def _host(netloc: str) -> str | None:
    user, at, host = netloc.rpartition("@")
    name, colon, port = host.partition(":")
    try:
        name = name.lower() if name.isascii() else name.lower().encode("idna").decode()
    except UnicodeError:
        return None
    if not name or re.search(r"[\s<>\"|^%\\]", name) or port and not port.isdigit():
        return None
    return user + at + name + (colon + port if port else "")


def _path(path: str) -> str:
    """Without segments that are empty or only quotes, and with the other quotes encoded."""
    parts = [p for p in re.sub("%22", '"', path, flags=re.I).split("/") if p.strip() and p.strip('"')]
    return quote("/" + "/".join(parts), safe=_PATH)


def resolve_text(base: str | None, href: str | None) -> str | None:
    """``href`` against ``base`` as browsers do it, its path tidied; None if that is no web address."""
    if base is None or href is None:
        return None
    h = href.strip()
    if len(h) >= 2 and h[0] == h[-1] == '"':
        h = h[1:-1].strip()
    h = re.sub(r"[\t\r\n]", "", h)
    try:
        if not _SCHEME.match(h):
            h = h.replace("\\", "/") if "?" not in h else h
        parts = urlsplit(urljoin(base, h))
        host = _host(parts.netloc)
    except ValueError:
        return None
    if parts.scheme.lower() not in ("http", "https") or host is None:
        return None
    port = {"http": ":80", "https": ":443"}[parts.scheme.lower()]
    return urlunsplit((parts.scheme.lower(), host.removesuffix(port), _path(parts.path), quote(parts.query, safe=_QUERY), quote(parts.fragment, safe=_QUERY)))


def resolve(base: Column, href: Column) -> Column:
    """The absolute address of a link; null if it isn't one of the web. Batches of text, no shuffle."""

    @F.pandas_udf("string")
    def run(bases: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series([resolve_text(b, h) for b, h in zip(bases, links, strict=True)], dtype=object)

    return run(base, href)


def absolute(raw: Column) -> Column:
    """A host, a host with a path or an address as an absolute address, without a slash at the end; null if it is none."""
    text = F.trim(raw)
    whole = F.when(text.rlike("(?i)^https?://"), text).otherwise(F.concat(F.lit("https://"), text))
    good = (F.length(text) > 0) & whole.rlike(r"(?i)^https?://[^/\s?#]+") & ~whole.rlike(r"(?i)^https?://[^/?#]*[\s<>^|%]")
    origin = F.lower(F.regexp_extract(whole, r"(?i)^(https?://[^/?#]+)", 1))
    rest = F.regexp_replace(F.regexp_replace(whole, r"(?i)^https?://[^/?#]+", ""), " ", "%20")
    return F.when(good, F.regexp_replace(F.concat(origin, F.when(rest.rlike("^[?#]"), F.concat(F.lit("/"), rest)).otherwise(rest)), "/$", ""))


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def same_site(one: Column, other: Column) -> Column:
    """The hosts are equal or one is a subdomain of the other."""
    a, b = host(one), host(other)
    return F.coalesce((a == b) | a.endswith(F.concat(F.lit("."), b)) | b.endswith(F.concat(F.lit("."), a)), F.lit(False))


def path(url: Column) -> Column:
    """Lower-case path; empty if the address is none."""
    good = host(url).isNotNull()
    found = F.lower(F.regexp_extract(url, r"(?i)^https?://[^/?#]*([^?#]*)", 1))
    return F.when(good, F.when(found == "", "/").otherwise(found)).otherwise("")
