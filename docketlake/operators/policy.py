"""Decision tables and classifiers of the acquisition stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.measures import exact


def robots_decisions(spark: SparkSession) -> DataFrame:
    """``(mode, acked, robots, allowed, code, warned)``: what a crawl policy makes of each state of a robots file.

    ``ignore`` and ``warn`` go on (``warn`` says so); ``enforce`` stops at a
    disallowed page, and at an unknown one unless somebody answered for it.
    """
    rows = []
    for mode in ("ignore", "warn", "enforce"):
        for acked in (True, False):
            for robots in ("allowed", "disallowed", "unknown"):
                stopped = mode == "enforce" and (robots == "disallowed" or (robots == "unknown" and not acked))
                rows.append((mode, acked, robots, not stopped, f"robots_{robots}" if stopped else None, mode == "warn" and robots != "allowed"))
    return spark.createDataFrame(rows, "mode string, acked boolean, robots string, allowed boolean, code string, warned boolean")


def keyword_classifier(docs: DataFrame, id_col: str, text_col: str, required: Sequence[str], welcome: Sequence[str], least: int, head: int = 10_000) -> DataFrame:
    """``(id, passes, score)``: at least ``least`` required keywords in the head of a text; score 0.7 and 0.3 of the shares.

    Texts under 50 characters fail with 0; an empty list counts as met.
    """
    sample = F.lower(F.substring(text_col, 1, head))
    hits = lambda words: sum((sample.contains(w).cast("int") for w in words), F.lit(0))
    share = lambda words: hits(words) / len(words) if words else F.lit(1.0)
    long = F.length(text_col) >= 50
    passes = long & (hits(required) >= least if required else F.lit(True))
    return docs.select(id_col, passes.alias("passes"), F.when(long, exact(0.7 * share(required) + 0.3 * share(welcome), 4)).otherwise(F.lit(0.0)).alias("score"))


def curation(human: Column, failed: Column, held: Column, automatic: Column) -> tuple[Column, Column]:
    """``(decision, curated)``: a person's ``keep`` or ``reject`` goes before everything, a failure before a hold, a hold
    before what was found automatically; null in any of them is no."""
    no = F.lit(False)
    decision = F.when(human == "reject", "reject").when(human == "keep", "keep").when(F.coalesce(failed, no), "failed").when(F.coalesce(held, no), "held").otherwise("automatic")
    curated = F.when(human == "reject", False).when(human == "keep", True).when(F.coalesce(failed, no) | F.coalesce(held, no), False).otherwise(F.coalesce(automatic, no))
    return decision, curated
