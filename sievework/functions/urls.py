"""URL predicates as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Lower-cased host without a port or a leading ``www.``; empty where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), r"^www\.", "")


def within(host_col: Column, domain: Column) -> Column:
    """Whether a host is the domain or below it."""
    return (host_col != "") & ((host_col == domain) | F.endswith(host_col, F.concat(F.lit("."), domain)))


def within_any(host_col: Column, domains: Sequence[str]) -> Column:
    """Whether a host is one of the domains or below one."""
    hit = F.lit(False)
    for d in domains:
        hit = hit | within(host_col, F.lit(d))
    return hit


def on_site(url: Column, scope: Column, ad_hosts: Sequence[str] = ()) -> Column:
    """Whether a result belongs to the site its query asked for; scope ``*`` takes all but ad hosts."""
    h = host(url)
    return F.when(h == "", False).when(scope == "*", ~within_any(h, ad_hosts)).otherwise(within(h, scope))


def url_key(url: Column) -> Column:
    """What two URLs share if they count as the same: lower case, trimmed, without closing slashes."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"/+$", "")


def path(url: Column) -> Column:
    """Path of a URL, empty where there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def longest_segment(url: Column) -> Column:
    """Longest segment of the URL's path, the first of equals, percent-decoded."""
    parts = F.split(path(url), "/")
    best = F.aggregate(parts, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return F.coalesce(F.try_url_decode(F.regexp_replace(best, r"\+", "%2B")), best)
