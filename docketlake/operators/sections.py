"""Sections of plain text, segments, evidence paths and state evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import STATE_CODES, contains_quote, evidence_form

#: How a line begins that opens a section.
SECTION_MARK = r"(?im)^(?:§\s*\d[\d.]*|Sec(?:tion)?\s+\d[\d.]*|Article\s+[A-Z0-9]+|Chapter\s+\d[\d.]*)"
#: Characters at which a part of gathered paragraphs is closed.
PART_CHARS = 2000
_SPACE = r"[ \t\n\f\r]"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_SPACE}+|{_SPACE}+$", "")


def paragraph_parts(paragraphs: Column, least: int = PART_CHARS) -> Column:
    """Paragraphs gathered in order; a part is closed by the paragraph that brings it to ``least`` characters.

    Only the places of the cuts are carried along, so a long text costs no copies of its parts.
    """
    start = F.struct(F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("n"), F.lit(0).alias("i"))

    def step(acc, p):
        n, i = acc["n"] + F.length(p), acc["i"] + 1
        full = n >= least
        return F.struct(F.when(full, F.array_append(acc["cuts"], i)).otherwise(acc["cuts"]).alias("cuts"), F.when(full, 0).otherwise(n).alias("n"), i.alias("i"))

    cuts = F.aggregate(paragraphs, start, step, lambda acc: F.when((F.size(acc["cuts"]) > 0) & (F.element_at(acc["cuts"], -1) == acc["i"]), acc["cuts"]).otherwise(F.array_append(acc["cuts"], acc["i"])))
    starts = F.concat(F.array(F.lit(0)), F.slice(cuts, F.lit(1), F.size(cuts) - 1))
    return F.transform(F.arrays_zip(starts.alias("a"), cuts.alias("b")), lambda z: F.array_join(F.slice(paragraphs, z["a"] + 1, z["b"] - z["a"]), "\n\n"))


def text_sections(texts: DataFrame, id_col: str, text_col: str, least: int = PART_CHARS) -> DataFrame:
    """``(id, section_no, heading, body)``: a text cut at its section marks, else into parts of paragraphs.

    Two marks make sections: what stands before the first is one without a
    heading, a heading is the rest of its line, and sections without a body are
    left out.  Otherwise paragraphs are gathered into numbered parts; a single
    paragraph is one section without a heading.  Null and blank texts give none.
    """
    t = texts.where(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("_t"))
    marked = F.split(F.regexp_replace("_t", SECTION_MARK, "\u0001$0"), "\u0001")
    section = lambda x, i: F.struct(F.when(i == 0, F.lit("")).otherwise(stripped(F.substring_index(x, "\n", 1))).alias("heading"), F.when(i == 0, stripped(x)).otherwise(F.when(x.contains("\n"), stripped(F.substring(x, F.instr(x, "\n") + 1, F.length(x)))).otherwise("")).alias("body"))
    paragraphs = F.filter(F.transform(F.split("_t", rf"\n{_SPACE}*\n"), stripped), lambda p: p != "")
    t = t.select(id_col, marked.alias("_m"), paragraphs.alias("_p"))
    parts = F.transform(paragraph_parts(F.col("_p"), least), lambda x, i: F.struct(F.concat(F.lit("Part "), (i + 1).cast("string")).alias("heading"), x.alias("body")))
    lone = F.transform(F.col("_p"), lambda x: F.struct(F.lit("").alias("heading"), x.alias("body")))
    cut = F.when(F.size("_m") > 2, F.filter(F.transform("_m", section), lambda s: s["body"] != "")).when(F.size("_p") > 1, parts).otherwise(lone)
    return t.select(id_col, F.posexplode(cut).alias("_i", "_s")).select(id_col, (F.col("_i") + 1).alias("section_no"), "_s.heading", "_s.body")


def pipe_row(cells: Column) -> Column:
    """Cells as one bordered row; a null cell is an empty one."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), " | "), F.lit(" |"))


def labelled_lines(rows: Column) -> Column:
    """Rows of cells as lines: below a header (several cells, all filled, different, no numbers) each filled cell
    carries its title; without one, filled cells stand side by side.  Blank rows are left out."""
    clean = F.filter(F.transform(rows, lambda r: F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit(""))))), lambda r: F.exists(r, lambda c: c != ""))
    head = F.get(clean, F.lit(0))
    titled = (F.size(head) > 1) & F.forall(head, lambda c: (c != "") & ~c.rlike(r"^[-+$]?[\d.,]+%?$")) & (F.size(F.array_distinct(head)) == F.size(head))
    plain = F.transform(clean, lambda r: F.array_join(F.filter(r, lambda c: c != ""), " | "))
    below = F.transform(F.slice(clean, F.lit(2), F.greatest(F.size(clean) - 1, F.lit(0))), lambda r: F.array_join(F.filter(F.transform(r, lambda c, i: F.when(c != "", F.concat(F.coalesce(F.get(head, i), F.lit("")), F.lit(": "), c))), lambda c: c.isNotNull()), " | "))
    return F.when(F.size(clean) == 0, F.array().cast("array<string>")).when(~F.coalesce(titled, F.lit(False)), plain).when(F.size(clean) == 1, plain).otherwise(below)


def quote_in_segments(quote: Column, segments: Column) -> Column:
    """Whether one segment holds the quote; both in evidence form, a quote never bridges segments."""
    return F.exists(segments, lambda s: contains_quote(quote, s))


def evidence_nodes(df: DataFrame, id_col: str, json_col: str, path: Sequence[str]) -> DataFrame:
    """``(id, location, value)`` of every node that a path reaches in a JSON text; ``*`` stands for each list entry.

    A location reads like ``item.required_documents[0]``.  Values are JSON text,
    strings without quotation marks; a missing node gives no row, a null has a null value.
    """
    rows = df.select(id_col, F.lit("").alias("location"), F.col(json_col).alias("value"))
    for step in path:
        if step == "*":
            listed = rows.where(F.ltrim("value").startswith("[")).select(id_col, "location", F.posexplode(F.from_json("value", "array<string>")).alias("_i", "value"))
            rows = listed.select(id_col, F.concat("location", F.lit("["), F.col("_i").cast("string"), F.lit("]")).alias("location"), "value")
        else:
            keyed = rows.where(F.ltrim("value").startswith("{")).withColumn("_m", F.from_json("value", "map<string,string>")).where(F.map_contains_key("_m", step))
            rows = keyed.select(id_col, F.when(F.col("location") == "", step).otherwise(F.concat("location", F.lit(f".{step}"))).alias("location"), F.col("_m")[step].alias("value"))
    return rows


def data_arrays(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``(id, field, entries)``: fields of a JSON object that hold a list with entries."""
    fields = df.select(id_col, F.explode(F.from_json(json_col, "map<string,string>")).alias("field", "value")).where(F.ltrim("value").startswith("["))
    return fields.select(id_col, "field", F.json_array_length("value").alias("entries")).where("entries > 0")


def is_empty_json(value: Column) -> Column:
    """Null, blank, or a list or object all of whose leaves are null or blank; 0 and false are something."""
    bare = F.regexp_replace(F.regexp_replace(value, r'"(?:[^"\\]|\\.)*"\s*:', ""), r'(?<![\w"\\])null(?![\w"])|""|[\[\]{},:\s]', "")
    return value.isNull() | (F.trim(value) == "") | (value.rlike(r"^\s*[\[{]") & (bare == "")) | (F.trim(value) == "null")


#: A state's code in an address, and in a cell labelled so.
ADDRESS_STATE = r",\s*([A-Z]{2})\b|\b([A-Z]{2})\s+\d{5}(?:-\d{4})?\b"
LABELLED_STATE = r"(?m)(?:^|\|)[^|:\n]*?(?<![A-Za-z])(?i:state)(?![A-Za-z])[^|:\n]*:[ \t]*([A-Z]{2})[ \t]*(?=\||$)"


def state_evidence(texts: DataFrame, id_col: str, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """``(id, state)``: states that a text tells of.

    Codes in addresses, in cells labelled as state, and alone on the line after
    a line that is a roster name; full names of states as whole words, outside the
    roster names that hold one (``Delaware County`` tells of no Delaware).
    """
    codes = sorted(STATE_CODES.values())
    t = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).alias("_t"))
    held = F.array_union(F.array_union(F.regexp_extract_all("_t", F.lit(ADDRESS_STATE), F.lit(1)), F.regexp_extract_all("_t", F.lit(ADDRESS_STATE), F.lit(2))), F.regexp_extract_all("_t", F.lit(LABELLED_STATE), F.lit(1)))
    coded = t.select(id_col, F.explode(F.array_distinct(held)).alias("state")).where(F.col("state").isin(codes))
    # cards: the code alone below a roster name
    lines = F.filter(F.transform(F.split("_t", "\n"), stripped), lambda x: x != "")
    pairs = t.select(id_col, lines.alias("_l")).where(F.size("_l") > 1).select(id_col, F.explode(F.transform(F.sequence(F.lit(2), F.size("_l")), lambda i: F.struct(F.get("_l", i - 2).alias("name"), F.get("_l", i - 1).alias("state")))).alias("p")).select(id_col, evidence_form(F.col("p.name")).alias("name"), "p.state").where(F.col("state").isin(codes))
    known = names.select(evidence_form(F.col(name_col)).alias("name")).where("name != ''").distinct()
    cards = pairs.join(known, "name", "left_semi").select(id_col, "state")
    # names of states, one row per place; places inside a roster name are taken out
    state_names = {" ".join(n.split()): c for n, c in STATE_CODES.items()}
    spoken = "|".join(sorted(state_names, key=len, reverse=True))
    form = t.select(id_col, evidence_form(F.col("_t")).alias("_f")).where(F.col("_f").rlike(rf"\b({spoken})\b"))
    around = F.regexp_extract_all("_f", F.lit(rf"(?:\b\w+ ){{0,4}}\b(?:{spoken})\b(?: \w+){{0,4}}"), F.lit(0))
    inside = known.where(F.col("name").rlike(rf"\b({spoken})\b")).select(F.col("name").alias("_n"))
    asked = form.select(id_col, F.explode(F.array_distinct(around)).alias("_w")).distinct()
    grams = F.transform(F.sequence(F.lit(1), F.size("_x")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(6), F.size("_x") - i + 1)), lambda n: F.array_join(F.slice("_x", i, n), " ")))
    hit = asked.select("_w", F.split("_w", " ").alias("_x")).distinct().select("_w", F.explode(F.flatten(grams)).alias("_n")).join(inside, "_n").groupBy("_w").agg(F.array_sort(F.collect_set("_n"), lambda a, b: F.length(b) - F.length(a)).alias("_gone"))
    left = asked.join(hit, "_w", "left").withColumn("_r", F.aggregate(F.coalesce("_gone", F.array().cast("array<string>")), F.concat(F.lit(" "), "_w", F.lit(" ")), lambda s, n: F.replace(s, F.concat(F.lit(" "), n, F.lit(" ")), F.lit(" | "))))
    named = left.select(id_col, F.explode(F.regexp_extract_all("_r", F.lit(rf"\b({spoken})\b"), F.lit(1))).alias("_s"))
    mapping = F.create_map(*(F.lit(x) for kv in state_names.items() for x in kv))
    return coded.union(cards).union(named.select(id_col, mapping[F.col("_s")].alias("state"))).distinct()


def field_columns(columns: Sequence[str], keys: Sequence[str]) -> list[tuple[str, str | None]]:
    """Declared key fields with the column that bears each name, in any case and word form; None if there is none.

    ``jurisdiction.rate_name`` is looked for as ``Rate Name``, ``rateName`` and the like.
    """
    import re

    def words(name: str) -> str:
        spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", name))
        out: list[str] = []
        initials = ""
        for w in re.sub(r"[_\-]+", " ", spaced).lower().split():
            if len(w) == 1 and w.isalpha():
                initials += w
                continue
            out += [initials, w] if initials else [w]
            initials = ""
        return " ".join(out + [initials] if initials else out)

    by_words: dict[str, str] = {}
    for c in columns:
        by_words.setdefault(words(c), c)
    return [(k, k if k in columns else by_words.get(words(k.split(".")[-1]))) for k in keys]


def severity_of(name: str, kinds: Sequence[str], choices: bool, high: Sequence[str], medium: Sequence[str]) -> str | None:
    """How grave a conflict in a field is: numbers and names with a high token are high, choices and medium tokens medium."""
    plain = name.replace("_", " ").lower()
    if {"number", "integer"} & set(kinds) or any(t in plain for t in high):
        return "high"
    return "medium" if choices or any(t in plain for t in medium) else None


def candidate_block(df: DataFrame, group: str, fields: Sequence[str], order: str, head: str, tail: str) -> DataFrame:
    """``(group, block)``: a block of text that lists each row's fields as JSON, for a model's request.

    A block goes into one request, so a group is as small as the request allows.
    """
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"])
    return df.groupBy(group).agg(lines.alias("_l")).select(group, F.concat(F.lit(head + "\n"), F.array_join("_l", "\n"), F.lit("\n" + tail)).alias("block"))
