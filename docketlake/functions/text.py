"""Text functions as column expressions; Python only where the JVM has no equivalent."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that do not tell fuzzy keys apart.
STOP_WORDS = ("a", "an", "the", "of", "in", "at", "by", "for", "to", "from", "hours")
#: Endings of county names, the longest first.
COUNTY_ENDINGS = ("city and borough", "census area", "municipality", "county", "parish", "borough", "city")
#: Postal codes by lower-case state name.
STATE_CODES = {
    name.lower(): code
    for code, name in (
        ("AL", "Alabama"), ("AK", "Alaska"), ("AZ", "Arizona"), ("AR", "Arkansas"), ("CA", "California"), ("CO", "Colorado"), ("CT", "Connecticut"), ("DE", "Delaware"),
        ("FL", "Florida"), ("GA", "Georgia"), ("HI", "Hawaii"), ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"), ("IA", "Iowa"), ("KS", "Kansas"), ("KY", "Kentucky"),
        ("LA", "Louisiana"), ("ME", "Maine"), ("MD", "Maryland"), ("MA", "Massachusetts"), ("MI", "Michigan"), ("MN", "Minnesota"), ("MS", "Mississippi"), ("MO", "Missouri"),
        ("MT", "Montana"), ("NE", "Nebraska"), ("NV", "Nevada"), ("NH", "New Hampshire"), ("NJ", "New Jersey"), ("NM", "New Mexico"), ("NY", "New York"), ("NC", "North Carolina"),
        ("ND", "North Dakota"), ("OH", "Ohio"), ("OK", "Oklahoma"), ("OR", "Oregon"), ("PA", "Pennsylvania"), ("RI", "Rhode Island"), ("SC", "South Carolina"), ("SD", "South Dakota"),
        ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"), ("VT", "Vermont"), ("VA", "Virginia"), ("WA", "Washington"), ("WV", "West Virginia"), ("WI", "Wisconsin"), ("WY", "Wyoming"),
        ("DC", "District of Columbia"),
    )
}


def literal_map(values: Mapping) -> Column:
    """A constant map column."""
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def fold_text(text: str | None) -> str | None:
    """Evidence form of one text: no soft hyphens, accents, case or punctuation; line hyphens joined."""
    if text is None:
        return None
    text = text.replace("­", "")
    text = re.sub(r"(?<=[^\W\d_])-[ \t]*\n\s*(?=[^\W\d_])", "", text)
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    return " ".join(re.sub(r"[^\w\s]|_", " ", text).split())


def evidence_form(text: Column) -> Column:
    """``fold_text`` as a column: pure ASCII stays in the JVM, only other texts reach Python."""

    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(fold_text, na_action="ignore")

    ascii_form = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(text, r"(?<=[A-Za-z])-[ \t]*\n\s*(?=[A-Za-z])", "")), r"[^\w\s]|_", " "), r"\s+", " "))
    plain = text.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain, ascii_form).otherwise(F.pandas_udf(fold, "string")(F.when(~plain, text)))


def collapse(text: Column) -> Column:
    """White space runs as one space, none outside."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def contains_quote(quote: Column, source: Column, elide: bool = True) -> Column:
    """Whether a quote stands in a source, both in evidence form, as whole words.

    With ``elide`` an ellipsis parts fragments that must follow one another.  A
    quote without words is never present.
    """
    padded = F.concat(F.lit(" "), source, F.lit(" "))
    if not elide:
        return (F.length(quote) > 0) & padded.contains(F.concat(F.lit(" "), quote, F.lit(" ")))
    parts = F.filter(F.transform(F.split(quote, r"\s*(?:…|\.\.\.)\s*"), lambda p: F.trim(p)), lambda p: p != "")
    # the place after each fragment, or null once one is missing
    end = F.aggregate(parts, F.lit(1), lambda at, p: _after(padded, p, at))
    return (F.size(parts) > 0) & end.isNotNull()


def _after(padded: Column, part: Column, at: Column) -> Column:
    found = F.call_function("locate", F.concat(F.lit(" "), part, F.lit(" ")), padded, at)
    return F.when(at.isNotNull() & (found > 0), found + F.length(part))


def fuzzy_words(text: Column) -> Column:
    """Words in lower case without stop words and trailing s, for keys that tolerate wording."""
    words = F.filter(F.split(F.lower(F.trim(text)), r"\s+"), lambda w: ~w.isin(*STOP_WORDS) & (w != ""))
    return F.array_join(F.transform(words, lambda w: F.regexp_replace(w, "s+$", "")), " ")


#: A number as people write it: thousands grouped or not at all.
NUMBER = r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?$|^[+-]?\.[0-9]+$"


def value_key(text: Column) -> Column:
    """Agreement key of a text value: numbers by value, other text without case and spare white space."""
    t = collapse(text)
    number = F.regexp_replace(t, ",", "").try_cast("decimal(38,10)")
    shown = F.regexp_replace(F.regexp_replace(number.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(t.rlike(NUMBER), F.concat(F.lit("n:"), F.when(number == 0, F.lit("0")).otherwise(shown))).otherwise(F.concat(F.lit("t:"), F.lower(t)))


def state_code(text: Column) -> Column:
    """The postal code of a state name or code; anything else stays as typed."""
    codes = literal_map(STATE_CODES | {c.lower(): c for c in STATE_CODES.values()})
    return F.coalesce(F.try_element_at(codes, F.lower(F.trim(text))), text)


def county_key(name: Column) -> Column:
    """A county name in lower case, without punctuation and one generic ending."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9 ]", " "), r"\s+", " "))
    return F.regexp_replace(t, f" ({'|'.join(COUNTY_ENDINGS)})$", "")


def replace_values(column: Column, values: Mapping[str, str]) -> Column:
    """Exact values exchanged, others kept (unit spellings and the like)."""
    return F.coalesce(F.try_element_at(literal_map(values), column), column) if values else column


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """A template with ``{name}`` (required: null if absent or blank) and ``{name?}`` (optional) filled in."""
    parts = re.split(r"(\{[^{}]*\})", template)
    out, required = [], []
    for part in parts:
        if part.startswith("{") and part.endswith("}"):
            name, optional = part[1:-1].rstrip("?"), part.endswith("?}")
            if name not in fields:
                if optional:
                    continue
                raise ValueError(f"unknown field {name!r} in template {template!r}")
            value = F.nullif(F.trim(fields[name].cast("string")), F.lit(""))
            out.append(F.coalesce(value, F.lit("")))
            if not optional:
                required.append(value.isNotNull())
        elif "{" in part or "}" in part:
            raise ValueError(f"malformed template {template!r}")
        elif part:
            out.append(F.lit(part))
    text = collapse(F.concat(*out)) if out else F.lit("")
    for ok in required:
        text = F.when(ok, text)
    return text


def slug(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def char_grams(text: Column, n: int = 4, least: int = 12) -> Column:
    """Distinct character n-grams of a collapsed lower-case text; empty below ``least`` characters."""
    t = F.lower(collapse(text))
    return F.when(F.length(t) >= least, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substring(t, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def spreadsheet_literal(text: Column) -> Column:
    """A cell that a spreadsheet would read as a formula gets a leading apostrophe."""
    return F.when(text.rlike(r"^[\t\r\n]") | text.rlike(r"^\s*[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def from_spreadsheet_literal(text: Column) -> Column:
    """The cell as it was before ``spreadsheet_literal``."""
    return F.regexp_replace(text, r"^'(?=[\t\r\n]|\s*[=+\-@])", "")


def printable(text: Column) -> Column:
    """No control characters that a spreadsheet refuses."""
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def json_body(text: Column) -> Column:
    """A model reply without code fences and prose around the JSON value."""
    t = F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*|\s*```$", "")
    return F.nullif(F.regexp_extract(t, r"(?s)([\[{].*[\]}])", 1), F.lit(""))


def keywords_of(text: Column, stop: Sequence[str] = STOP_WORDS) -> Column:
    """Different words of three letters and more in order of appearance, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]{3,})"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*stop)))


def corrected(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered regular-expression replacements."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def stripped_html(fragment: Column) -> Column:
    """Text of a small HTML fragment: tags to spaces, common entities, white space collapsed."""
    t = F.regexp_replace(fragment, r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&#160;", " "), (" ", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return collapse(t)


def clock(seconds: Column) -> Column:
    """``[hh:mm:ss]`` of a number of seconds."""
    s = F.floor(seconds).cast("int")
    return F.format_string("[%02d:%02d:%02d]", (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), s % 60)


def head_and_tail(text: Column, most: int) -> Column:
    """A review sample: the whole of a short text, else its head and tail around a mark, within ``most`` characters."""
    half = (most - 5) // 2
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, half), F.lit("\n...\n"), F.right(text, F.lit(half))))


#: What parts the windows of a review sample.
SAMPLE_BREAK = "\n...\n"


def sample_windows(text: str, most: int, keywords: Sequence[str] = ()) -> list[str]:
    """Windows of a long text within ``most`` characters in all, with SAMPLE_BREAK between them; a short text is one.

    A fifth each goes to the head, the tail and windows that begin shortly before
    keywords, the rest to four windows spread over the body; without a keyword
    found the body has that share too.
    """
    if len(text) <= most:
        return [text]
    share = (most - 6 * len(SAMPLE_BREAK)) // 5
    if share <= 0:
        return [text[:most]]
    first, last = share, len(text) - share
    found: list[tuple[int, str]] = []
    if keywords:
        size = max(1, share // max(len(keywords), 2))
        low = text.lower()
        for word in keywords:
            at = low.find(word.lower(), first)
            while 0 <= at < last and (len(found) + 1) * size <= max(share, size):
                if all(abs(at - other) >= size for other, _ in found):
                    lo = max(first, at - size // 4)
                    found.append((at, text[lo : lo + size]))
                at = low.find(word.lower(), at + size)
    room = share * 2 if found else share * 3
    if last - first <= room:
        body = [text[first:last]]
    else:
        size = room // 4
        gap = (last - first - size) // 3
        body = [text[first + i * gap : first + i * gap + size] for i in range(4)]
    return [w for w in (text[:first], *(w for _, w in found), *body, text[last:]) if w.strip()]


def review_sample(text: Column, most: int, keywords: Sequence[str] = ()) -> Column:
    """``sample_windows`` joined by SAMPLE_BREAK, as a column."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: SAMPLE_BREAK.join(sample_windows(t, most, keywords)), na_action="ignore")

    return F.pandas_udf(run, "string")(text)
