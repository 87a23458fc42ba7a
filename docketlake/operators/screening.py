"""Screening of documents: identity terms, revision marks on pages, quotes of evidence, gates of a compile run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import contains_quote

#: Where a stroke crosses a line of text: its height within the line, and how much of it lies over the text.
CROSS_HEIGHT, CROSS_SHARE = (0.35, 0.68), 0.8
#: Height of the bands by which strokes and lines of a page meet.
BAND = 50.0


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def names_term(text: Column, term: Column) -> Column:
    """Whether a text has a term as written or without punctuation; a blank term is in no text."""
    plain = F.lower(text).contains(F.lower(term))
    return F.coalesce((F.trim(term) != "") & (plain | ((_bare(term) != "") & _bare(text).contains(_bare(term)))), F.lit(False))


def identity_gate(text: Column, any_of: Sequence[Column] = (), all_of: Sequence[Column] = (), none_of: Sequence[Column] = ()) -> Column:
    """Why a candidate is not of its target, or null: ``excluded``, ``missing_required``, ``no_identity``.

    Terms are rendered templates; null ones (a field was missing) take no part,
    and a list without terms left asks for nothing.
    """

    def hits(terms: Sequence[Column]) -> tuple[Column, Column]:
        given = sum((t.isNotNull().cast("int") for t in terms), F.lit(0))
        return given, sum((F.coalesce(names_term(text, t), F.lit(False)).cast("int") for t in terms), F.lit(0))

    (_, bad), (every, met), (some, one) = hits(none_of), hits(all_of), hits(any_of)
    return F.when(bad > 0, "excluded").when(met < every, "missing_required").when((some > 0) & (one == 0), "no_identity")


def crossed_lines(marks: DataFrame, lines: DataFrame, page: Sequence[str]) -> DataFrame:
    """``(page.., line_no, mark_no)``: lines of text that a horizontal stroke crosses.

    ``lines`` (page.., line_no, x0, x1, y0, height), ``marks`` (page.., mark_no, x0,
    x1, y).  Strokes meet lines by page and band, so a page of many of both makes
    no product.
    """
    low, high = CROSS_HEIGHT
    spans = F.sequence(F.floor(F.col("y0") / BAND), F.floor((F.col("y0") + F.col("height")) / BAND))
    a = lines.where("height > 0").select(*page, "line_no", F.col("x0").alias("_a0"), F.col("x1").alias("_a1"), "y0", "height", F.explode(spans).alias("_band"))
    b = marks.where("x1 > x0").select(*page, "mark_no", F.col("x0").alias("_b0"), F.col("x1").alias("_b1"), "y", F.floor(F.col("y") / BAND).alias("_band"))
    at = (F.col("y") - F.col("y0")) / F.col("height")
    over = (F.least("_a1", "_b1") - F.greatest("_a0", "_b0")) / (F.col("_b1") - F.col("_b0"))
    return a.join(b, [*page, "_band"]).where(at.between(low, high) & (over >= CROSS_SHARE)).select(*page, "line_no", "mark_no").distinct()


def revision_state(pages: DataFrame, crossed: DataFrame, document: str, readable: str, noted: str) -> DataFrame:
    """``(document, state, evidence)``: ``flagged`` with what was found, ``unknown`` if a page could not be read, else ``no_findings``."""
    strokes = crossed.groupBy(document).agg(F.count("*").alias("_strokes"))
    per = pages.groupBy(document).agg(F.bool_and(F.coalesce(F.col(readable), F.lit(False))).alias("_read"), F.bool_or(F.coalesce(F.col(noted), F.lit(False))).alias("_noted"))
    both = per.join(strokes, document, "left").withColumn("_strokes", F.coalesce("_strokes", F.lit(0)))
    evidence = F.concat_ws(",", F.when(F.col("_strokes") > 0, "strikeout"), F.when(F.col("_noted"), "header"))
    return both.select(document, F.when(evidence != "", "flagged").when(~F.col("_read"), "unknown").otherwise("no_findings").alias("state"), evidence.alias("evidence"))


def evidence_contract(rows: DataFrame, key: str, value: str, quote: str, source: str) -> DataFrame:
    """``(key, claims, quoted, verified, valid)``: evidence is valid if every value has a quote and every quote stands in its source.

    ``value`` and so on name columns in evidence form.
    """
    stands = contains_quote(F.col(quote), F.col(source)) & F.col(quote).isNotNull()
    return rows.groupBy(key).agg(F.count(value).alias("claims"), F.count(quote).alias("quoted"), F.count_if(stands).alias("verified"), F.bool_and(F.col(value).isNull() | F.coalesce(stands, F.lit(False))).alias("valid"))


def compile_gates(groups: DataFrame, severity: str, warnings: int) -> DataFrame:
    """``(gate, count, fails)``: gates of a compile run: suspicious groups from a severity on, and provenance warnings."""
    n = groups.agg(*(F.count_if(F.col(severity) == s).alias(s) for s in ("high", "medium", "low")))
    upto = {"high": F.col("high"), "medium": F.col("high") + F.col("medium"), "low": F.col("high") + F.col("medium") + F.col("low")}
    rows = F.explode(F.array(*(F.struct(F.lit(f"suspicious_{g}").alias("gate"), c.alias("count")) for g, c in upto.items()), F.struct(F.lit("provenance").alias("gate"), F.lit(warnings).cast("bigint").alias("count"))))
    return n.select(rows.alias("r")).select("r.gate", "r.count", (F.col("r.count") > 0).alias("fails"))


def paired_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """``(keys, state, left_id, right_id)`` of every key of the left: ``paired`` if it stands once on both sides, ``ambiguous``
    if more than once on either, ``alone`` if the right has none; folded before the join."""
    a = left.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(left_id).alias(left_id))
    b = right.groupBy(*keys).agg(F.count("*").alias("_m"), F.min(right_id).alias(right_id))
    state = F.when(F.col("_m").isNull(), "alone").when((F.col("_n") == 1) & (F.col("_m") == 1), "paired").otherwise("ambiguous")
    j = a.join(b, list(keys), "left").withColumn("state", state)
    paired = F.col("state") == "paired"
    return j.select(*keys, "state", F.when(paired, F.col(left_id)).alias(left_id), F.when(paired, F.col(right_id)).alias(right_id))
