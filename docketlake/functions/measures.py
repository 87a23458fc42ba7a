"""Dates, scores, rates, money and hashes as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketlake.functions.text import literal_map

#: Score of a link by its file type.
FILE_TYPE_SCORES = {
    ".pdf": 0.40, ".docx": 0.35, ".doc": 0.30, ".xlsx": 0.25, ".xls": 0.20, ".csv": 0.15, ".txt": 0.10, ".html": -0.05, ".htm": -0.05,
    ".jpg": -0.20, ".jpeg": -0.20, ".png": -0.20, ".gif": -0.20, ".mp4": -0.30, ".zip": -0.15, ".exe": -0.30,
}
#: First three letters of the months.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: z of a two-sided 95 % interval.
Z95 = 1.96


def exact(x: Column, places: int = 6) -> Column:
    """A rate rounded half up as a decimal, which every engine rounds alike, as double."""
    return F.round(x.cast("decimal(38,12)"), places).cast("double")


def ratio(k: Column, n: Column, places: int = 6) -> Column:
    """k / n rounded, null where n is 0."""
    return exact(F.try_divide(k.cast("double"), n.cast("double")), places)


def wilson(k: Column, n: Column, upper: bool, z: float = Z95) -> Column:
    """A bound of the Wilson interval of k in n, clipped to [0, 1]; null for n = 0."""
    p, m = F.try_divide(k.cast("double"), n.cast("double")), n.cast("double")
    centre = p + F.lit(z * z) / (2 * m)
    half = F.lit(z) * F.sqrt(p * (1 - p) / m + F.lit(z * z) / (4 * m * m))
    bound = (centre + half if upper else centre - half) / (1 + F.lit(z * z) / m)
    return F.when(n > 0, exact(F.least(F.greatest(bound, F.lit(0.0)), F.lit(1.0)), 4))


def weighted_score(signals: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Weighted mean of signals, within [0, 1]."""
    total = sum(weights.values())
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), sum((signals[k] * w for k, w in weights.items()), F.lit(0.0)) / total))


def acceptance_class(score: Column, high: float = 0.75, low: float = 0.45) -> Column:
    return F.when(score >= high, "accepted").when(score >= low, "review").otherwise("rejected")


def file_type_score(extension: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(FILE_TYPE_SCORES), extension), F.lit(0.0))


def keyword_score(text: Column, keywords: Sequence[str]) -> tuple[Column, Column]:
    """How many keywords stand in the text, and min(1, 0.3 ln(1 + hits) / ln 2)."""
    hits = sum(((text.contains(k)).cast("int") for k in keywords), F.lit(0))
    return hits, exact(F.least(F.lit(1.0), 0.3 * F.log1p(hits.cast("double")) / F.log1p(F.lit(1.0))), 4)


def link_confidence(file: Column, authority: Column, keywords: Column) -> Column:
    return exact(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.5 + 0.35 * file + 0.25 * authority + 0.25 * keywords)), 4)


def backoff(attempt: Column, base: float = 1.0, factor: float = 2.0, most: float = 60.0) -> Column:
    """Seconds to wait before an attempt (from 1): base, then ``factor`` times more each, at most ``most``."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(factor), attempt - 1))


def containment(a: Column, b: Column) -> Column:
    """Shared elements of two sets over the smaller one."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b)))


def tokens_of(text: Column, characters: int = 4) -> Column:
    """Estimated tokens of a text."""
    return F.ceil(F.length(text) / characters)


def cost_of(input_tokens: Column, output_tokens: Column, input_price: Column, output_price: Column) -> Column:
    """Money for tokens at prices per million."""
    return (input_tokens * input_price + output_tokens * output_price) / 1_000_000


def complete_sum(x: Column) -> Column:
    """A sum that is null when any part is unknown."""
    return F.when(F.count(x) == F.count("*"), F.sum(x))


def name_date(name: Column) -> Column:
    """The date in a file name: month.day.year, year-month-day, month name and year, year; the first valid one."""
    us = r"(?:^|[^0-9])(\d{1,2})[.\-_/](\d{1,2})[.\-_/](20\d{2})"
    iso = r"(20\d{2})[_\-](\d{2})[_\-](\d{2})"
    month = rf"(?:^|[^a-z])({'|'.join(MONTHS)})[a-z]*[_\-. ]*(20\d{{2}})"
    low = F.lower(name)
    part = lambda p, g: F.nullif(F.regexp_extract(low, p, g), F.lit(""))
    made = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    index = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), part(month, 1)).cast("string")
    us_date = F.when(part(us, 3).isNotNull(), made(part(us, 3), part(us, 1), part(us, 2)))
    iso_date = F.when(part(iso, 1).isNotNull(), made(part(iso, 1), part(iso, 2), part(iso, 3)))
    month_date = F.when(part(month, 2).isNotNull(), made(part(month, 2), index, F.lit("1")))
    year_date = F.when(part(r"(20\d{2})", 1).isNotNull(), made(part(r"(20\d{2})", 1), F.lit("1"), F.lit("1")))
    return F.coalesce(us_date, iso_date, month_date, year_date)


def date_bounds(value: Column) -> tuple[Column, Column]:
    """First and last day (as text) of a date known to the year, month or day."""
    n = F.length(value)
    return (
        F.when(n == 4, F.concat(value, F.lit("-01-01"))).when(n == 7, F.concat(value, F.lit("-01"))).otherwise(value),
        F.when(n == 4, F.concat(value, F.lit("-12-31"))).when(n == 7, F.concat(value, F.lit("-31"))).otherwise(value),
    )


def short_id(*parts: Column, size: int = 12) -> Column:
    """A stable id of identity fields: start of the MD5 of their canonical text; null and empty differ."""
    text = F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts))
    return F.substring(F.md5(text), 1, size)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


#: Error categories by what the message says, the first that fits.
ERROR_KINDS = (("timeout", "timed? ?out|deadline"), ("rate_limit", "rate.?limit|too many requests|429"), ("network", "connection|network|dns|reset"), ("not_found", "not found|404"), ("denied", "forbidden|unauthorized|40[13]"), ("parse", "parse|decode|json|schema"))


def error_kind(message: Column) -> Column:
    m = F.lower(message)
    out = F.lit("other")
    for kind, pattern in reversed(ERROR_KINDS):
        out = F.when(m.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def retryable(status_code: Column, kind: Column) -> Column:
    return F.coalesce(status_code.isin(408, 425, 429) | (status_code >= 500), F.lit(False)) | F.coalesce(kind.isin("timeout", "rate_limit", "network"), F.lit(False))
