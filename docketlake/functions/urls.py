"""Web addresses: parts, one written form, scope and redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that follow visitors.
TRACKING = ("utm_[a-z_]+", "fbclid", "gclid", "dclid", "msclkid", "yclid", "mc_cid", "mc_eid", "igshid", "_ga", "_gl", "ref_src", "spm", "vero_id", "wickedid")
#: Query parameters that carry secrets.
SECRETS = ("api_?key", "key", "token", "access_token", "auth", "signature", "sig", "password", "secret")


def decoded(url: Column) -> Column:
    """Percent escapes resolved; a url that cannot be decoded stays."""
    return F.when(url.contains("%"), F.coalesce(F.try_url_decode(F.regexp_replace(url, r"\+", "%2B")), url)).otherwise(url)


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty without a scheme."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def extension_of(url: Column) -> Column:
    """Lower-case extension with its dot of the last path part; empty if none or longer than 6."""
    return F.lower(F.regexp_extract(path_of(url), r"/[^/]*(\.[A-Za-z0-9]{1,5})$", 1))


def is_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i)https?://[^/?#\s]+"), F.lit(False))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, no fragment, no tracking parameters, the rest in its order."""
    base = F.concat(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)", 1)), F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?i)({'|'.join(TRACKING)})(=|$)")), "&")
    return F.concat(base, path_of(url), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def in_domain(host: Column, pattern: str) -> Column:
    """Exact host or a subdomain of it; a pattern with a leading dot matches as a suffix."""
    p = pattern.lower()
    return host.endswith(p) if p.startswith(".") else (host == p) | host.endswith(f".{p}")


def in_any_domain(host: Column, patterns: Sequence[str]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | in_domain(host, p)
    return found


def redacted(url: Column) -> Column:
    """Values of secret parameters and user passwords blanked out."""
    u = F.regexp_replace(url, r"(?i)([?&](?:" + "|".join(SECRETS) + r")=)[^&#]*", "$1REDACTED")
    return F.regexp_replace(u, r"(://)[^/?#@]*@", "$1REDACTED@")


def folded_text(*parts: Column) -> Column:
    """Address, title and the like as one lower-case text with separators as spaces, for term tests."""
    return F.translate(F.lower(F.concat_ws(" ", *parts)), "_-/", "   ")


def guard(url: Column, allowed: Sequence[str], include: Sequence[str] = (), exclude: Sequence[str] = (), terms: Sequence[str] = ()) -> Column:
    """Why a final address is refused, or null: domain, include patterns, exclude patterns, exclude terms, in this order."""
    plain = decoded(url)
    reason = F.lit(None).cast("string")
    folded = folded_text(plain)
    if terms:
        hit = F.lit(False)
        for t in terms:
            hit = hit | folded.contains(t.lower())
        reason = F.when(hit, F.lit("matches_excluded_term")).otherwise(reason)
    if exclude:
        hit = F.lit(False)
        for p in exclude:
            hit = hit | url.rlike(p) | plain.rlike(p)
        reason = F.when(hit, F.lit("matches_excluded_pattern")).otherwise(reason)
    if include:
        hit = F.lit(False)
        for p in include:
            hit = hit | url.rlike(p) | plain.rlike(p)
        reason = F.when(~hit, F.lit("outside_include_patterns")).otherwise(reason)
    if allowed:
        reason = F.when(~in_any_domain(host_of(url), allowed), F.lit("outside_allowed_domains")).otherwise(reason)
    return reason


def public_host(host: Column) -> Column:
    """False for localhost names and private, loopback, link-local or reserved IPv4 addresses."""
    local = host.rlike(r"^(localhost|.*\.local|.*\.internal|.*\.localhost)$")
    private = host.rlike(r"^(0|10|127|169\.254|172\.(1[6-9]|2[0-9]|3[01])|192\.168|100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.")
    return (host != "") & ~local & ~private


def redacted_in_text(text: Column) -> Column:
    """A text in which the addresses are redacted, fragments included; what stands around them stays."""
    t = F.regexp_replace(text, rf"(?i)([?&](?:{'|'.join(SECRETS)})=)[^&#\s]*", "$1REDACTED")
    return F.regexp_replace(t, r"(?i)(https?://)[^/?#@\s]*@", "$1REDACTED@")
