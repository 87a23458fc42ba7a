"""Tests of raw web pages, link texts and network names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketlake.functions.text import collapse
from docketlake.functions.urls import extension_of

#: Traces of frameworks that draw a page in the browser.
FRAMEWORKS = ("ng-app=", "ng-strict-di=", "__NEXT_DATA__", 'id="__next"', 'id="root"', 'id="app"', "data-reactroot", "window.__NUXT__")
#: The same for pages met while crawling.
SHELL_MARK = r"""(?i)ng-app=|<app-root|__NEXT_DATA__|<div\s+id=["'](?:root|app|__next)["']\s*>"""
#: Texts of links that lead around a site, not to its content.
NAVIGATION = r"(?i)^(home|skip to|my (drafts|notes|saved|account)|sign (in|up|out)|log ?(in|out)|search|contact|help|faq|about|privacy|terms|cookie|feedback|order|cart|checkout|translate|share|print|copyright|accessibility|back to top|menu|close|toggle)$"
#: Extensions of files worth downloading.
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".txt", ".json", ".mp3", ".mp4", ".wav", ".m4a")


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags, for measuring it; readers of whole documents do more."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript|nav)\b.*?</\1\s*>", " ")
    return collapse(F.regexp_replace(bare, r"<[^>]*>", " "))


def is_shell(html: Column, least: int = 200) -> Column:
    """A page that a framework draws in the browser: a trace of one and less than ``least`` characters of text."""
    low, found = F.lower(html), F.lit(False)
    for mark in FRAMEWORKS:
        found = found | low.contains(mark.lower())
    return F.coalesce(found & (F.length(visible_text(html)) < least), F.lit(False))


def is_crawl_shell(html: Column, most_links: int = 5, head: int = 5000) -> Column:
    """A crawled page with few anchors and a framework's trace in its head; an empty one is none."""
    links = F.regexp_count(F.lower(html), F.lit("<a "))
    return F.coalesce((links <= most_links) & F.substring(html, 1, head).rlike(SHELL_MARK), F.lit(False))


def is_navigation(link_text: Column, longest: int = 100) -> Column:
    """Whether the text of a link is one of a site's own controls."""
    t = F.trim(link_text)
    return F.coalesce((F.length(t) <= longest) & t.rlike(NAVIGATION), F.lit(False))


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the patterns, in any case, is found; no pattern matches everything."""
    found = F.lit(not patterns)
    for p in patterns:
        found = found | F.coalesce(text.rlike(f"(?i){p}"), F.lit(False))
    return found


def is_document_link(url: Column, include: Sequence[str] = ()) -> Column:
    """A downloadable extension, or an address that an include pattern matches."""
    wanted = matches_any(url, include) if include else F.lit(False)
    return extension_of(url).isin(*DOCUMENT_EXTENSIONS) | wanted


def ipv4_number(host: Column) -> Column:
    """The number of a dotted IPv4 address, null for anything else."""
    part = lambda i: F.try_element_at(F.split(host, r"\."), F.lit(i)).try_cast("long")
    number = part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4)
    fits = F.least(part(1), part(2), part(3), part(4)) >= 0
    return F.when(host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & fits & (F.greatest(part(1), part(2), part(3), part(4)) <= 255), number)


#: IPv4 blocks that are not public (first address, bits of the prefix).
RESERVED_BLOCKS = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.88.99.0", 24),
    ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("224.0.0.0", 4), ("240.0.0.0", 4),
)


def is_public_address(host: Column) -> Column:
    """Whether a host may be fetched from: no local name, no reserved IPv4 block, no local or mapped IPv6 address."""
    number = ipv4_number(host)
    reserved = F.lit(False)
    for first, bits in RESERVED_BLOCKS:
        low = sum(int(p) << s for p, s in zip(first.split("."), (24, 16, 8, 0)))
        reserved = reserved | number.between(low, low + 2 ** (32 - bits) - 1)
    six = F.regexp_replace(F.lower(host), r"^\[|\]$", "")
    local_six = six.contains(":") & six.rlike(r"^(::1?$|::ffff:|f[cd]|fe[89ab]|ff|2001:db8:|64:ff9b:|100::)")
    local = host.rlike(r"(?i)^(localhost|[^.]*)$") & ~six.contains(":") | host.rlike(r"(?i)\.(local|internal|localhost)$")
    return F.coalesce((host != "") & ~local & ~local_six & F.coalesce(~reserved, F.lit(True)), F.lit(False))


def png_tokens(png: Column, pixels: int, overhead: int) -> Column:
    """Tokens of an inline PNG image by the width and height in its header; null if it is no PNG."""
    side = lambda at: F.conv(F.hex(F.substring(png, at, 4)), 16, 10).cast("long")
    is_png = F.hex(F.substring(png, 1, 8)) == "89504E470D0A1A0A"
    return F.when(is_png, F.ceil(side(17) * side(21) / pixels) + overhead)
