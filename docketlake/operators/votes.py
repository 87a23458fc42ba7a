"""Votes over conflicting values, and the metrics of compared sources."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions.measures import exact, ratio, wilson
from docketlake.session import broadcast_if_small

#: Confidence levels from low to high.
LEVELS = ("none", "low", "medium", "high")


def url_vote(claims: DataFrame, keys: Sequence[str], value_key: str, value: str, url: str, scope: str, quote: str, position: str) -> DataFrame:
    """The value of each cell by the vote of its different addresses.

    ``claims`` holds answers only.  One value: high confidence with two or more
    addresses (null is one), else medium.  Several values: low, a conflict; the
    voters are the claims of scope target if there are any, else all; most
    different addresses win, ties go to the earliest.  Shown is the winner's
    claim with a quote, of scope target, earliest, in this order.  Result:
    (keys, value, url, support, n_values, conflict, confidence).
    """
    c = claims.withColumn("_own", (F.col(scope) == "target").cast("int")).withColumn("_url", F.coalesce(F.col(url), F.lit("\x00")))
    shown = F.struct((F.coalesce(F.col(quote), F.lit("")) == "").cast("int").alias("a"), (-F.col("_own")).alias("b"), F.col(position).alias("c"))
    votes = c.groupBy(*keys, value_key).agg(
        F.count_distinct("_url").alias("all_urls"),
        F.count_distinct(F.when(F.col("_own") == 1, F.col("_url"))).alias("own_urls"),
        F.count_distinct(F.when(F.coalesce(F.trim(F.col(url)), F.lit("")) != "", F.col(url))).alias("support"),
        F.min(position).alias("first"),
        F.min(F.when(F.col("_own") == 1, F.col(position))).alias("own_first"),
        F.min_by(F.struct(F.col(value).alias("value"), F.col(url).alias("url")), shown).alias("shown"),
    )
    cells = votes.groupBy(*keys).agg(F.count("*").alias("n_values"), F.max("own_urls").alias("any_own"), F.collect_list(F.struct("all_urls", "own_urls", "support", "first", "own_first", "shown")).alias("v"))
    # different values of one cell are few: they were folded above
    order = lambda own: F.array_max(F.transform("v", lambda x: F.struct(F.when(own, x["own_urls"]).otherwise(x["all_urls"]).alias("n"), (-F.when(own, F.coalesce(x["own_first"], x["first"])).otherwise(x["first"])).alias("at"), x["support"].alias("support"), x["all_urls"].alias("urls"), x["shown"].alias("shown"))))
    best = cells.withColumn("w", order(F.col("any_own") > 0))
    confidence = F.when(F.col("n_values") > 1, "low").when(F.col("w.urls") >= 2, "high").otherwise("medium")
    return best.select(*keys, F.col("w.shown.value").alias("value"), F.col("w.shown.url").alias("url"), F.col("w.support").alias("support"), "n_values", (F.col("n_values") > 1).alias("conflict"), confidence.alias("confidence"))


def weakest(level: Column) -> Column:
    """The lowest confidence level of a group."""
    rank = F.array_position(F.array(*(F.lit(x) for x in LEVELS)), level)
    return F.element_at(F.array(*(F.lit(x) for x in LEVELS)), F.min(rank).cast("int"))


def count_vote(claims: DataFrame, keys: Sequence[str], value_key: str, scope: str, tie: str) -> DataFrame:
    """The value of each unit by the number of observations; claims of scope target vote alone if there are any.

    Ties go to the value with the smallest ``tie``.  Result: (keys, value_key,
    votes, n_values, cited): cited is the winner's smallest tie, of any scope.
    """
    own = (F.col(scope) == "target").cast("int")
    votes = claims.groupBy(*keys, value_key).agg(F.count("*").alias("all"), F.sum(own).alias("own"), F.min(tie).alias("cited"), F.min(F.when(own == 1, F.col(tie))).alias("own_tie"))
    w = Window.partitionBy(*keys)
    sized = votes.withColumns({"any_own": F.max("own").over(w), "n_values": F.count("*").over(w)})
    votes_ = F.when(F.col("any_own") > 0, F.col("own")).otherwise(F.col("all"))
    tie_ = F.when(F.col("any_own") > 0, F.col("own_tie")).otherwise(F.col("cited"))
    ranked = sized.withColumns({"votes": votes_, "_tie": tie_}).withColumn("_n", F.row_number().over(w.orderBy(F.col("votes").desc(), F.col("_tie").asc_nulls_last())))
    return ranked.where("_n = 1").select(*keys, value_key, "votes", "n_values", "cited")


def strict_majority(answers: DataFrame, keys: Sequence[str], value: str, least: int = 2) -> DataFrame:
    """``(keys, value, votes, voters)`` where one value has more than half of at least ``least`` voters (null is a value)."""
    counts = answers.groupBy(*keys, value).agg(F.count("*").alias("votes"))
    total = counts.groupBy(*keys).agg(F.sum("votes").alias("voters"), F.max("votes").alias("_most"))
    return counts.join(total, list(keys)).where(f"votes = _most and votes * 2 > voters and voters >= {least}").drop("_most")


def cell_status(answers: DataFrame, keys: Sequence[str], value: str, role: str) -> DataFrame:
    """``(keys, status)``: all_na, reference_only, unanimous, partial (some contenders silent) or disputed."""
    contender = F.col(role) != "reference"
    g = answers.groupBy(*keys).agg(
        F.count(F.when(contender, F.col(value))).alias("given"),
        F.count_if(contender).alias("asked"),
        F.size(F.collect_set(F.when(contender, F.col(value)))).alias("kinds"),
        F.count(F.when(~contender, F.col(value))).alias("reference"),
    )
    status = F.when((F.col("given") == 0) & (F.col("reference") == 0), "all_na").when(F.col("given") == 0, "reference_only").when(F.col("kinds") > 1, "disputed").when(F.col("given") < F.col("asked"), "partial").otherwise("unanimous")
    return g.select(*keys, status.alias("status"))


def category(x: Column, base: Column) -> Column:
    """How a value compares with a base value, null being no answer."""
    return F.when(x.isNull() & base.isNull(), "both_na").when(x.isNull(), "missing").when(base.isNull(), "new").when(x == base, "agree").otherwise("changed")


def confusion(pairs: DataFrame, by: Sequence[str], x: str, base: str) -> DataFrame:
    """Counters of the categories and of true and false answers, per group."""
    c = category(F.col(x), F.col(base))
    n = lambda *names: F.count_if(c.isin(*names))
    return pairs.groupBy(*by).agg(
        *(n(k).alias(k) for k in ("both_na", "agree", "changed", "new", "missing")),
        n("agree").alias("tp"),
        n("changed", "new").alias("fp"),
        n("changed", "missing").alias("fn"),
        F.count("*").alias("cells"),
    )


def metrics(pairs: DataFrame, label: str, column: str, x: str, base: str) -> DataFrame:
    """Precision, recall, F1, accuracy with Wilson bounds per label and column, and pooled (column ``*``) by a rollup."""
    c = category(F.col(x), F.col(base))
    n = lambda *names: F.count_if(c.isin(*names))
    g = pairs.rollup(label, column).agg(n("agree").alias("tp"), n("changed", "new").alias("fp"), n("changed", "missing").alias("fn"), n("agree", "both_na").alias("right"), F.count("*").alias("cells")).where(F.col(label).isNotNull())
    return g.select(
        label, F.coalesce(column, F.lit("*")).alias(column), "tp", "fp", "fn", "cells",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"), ratio(F.col("right"), F.col("cells")).alias("accuracy"),
        wilson(F.col("right"), F.col("cells"), False).alias("accuracy_low"), wilson(F.col("right"), F.col("cells"), True).alias("accuracy_high"),
    )


def pair_agreement(answers: DataFrame, keys: Sequence[str], label: str, value: str) -> DataFrame:
    """``(a, b, common, equal, agreement, jaccard)`` of all pairs of sources that share an item.

    Items are short rows, one answer per source; a task counts the pairs of its
    items by matrix products and sends on one row per pair, so no pair rows are
    made per item and the number of sources is not bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            item = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            names, values = flat.field(0).dictionary_encode(), flat.field(1).dictionary_encode()
            who, said, n = np.asarray(names.indices), np.asarray(values.indices), len(names.dictionary)
            given = np.zeros((len(lists), n), np.float32)
            given[item, who] = 1
            common = given.T @ given
            equal = np.zeros_like(common)
            for v in range(len(values.dictionary)):
                same = np.zeros_like(given)
                same[item[said == v], who[said == v]] = 1
                equal += same.T @ same
            i, j = np.nonzero(np.triu(common, 1))
            a, b = names.dictionary.take(pa.array(i)), names.dictionary.take(pa.array(j))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(common[i, j].astype(np.int64)), pa.array(equal[i, j].astype(np.int64))], names=["x", "y", "common", "equal"])

    items = answers.groupBy(*keys).agg(F.collect_list(F.struct(F.col(label).alias("label"), F.col(value).cast("string").alias("value"))).alias("_l")).where(F.size("_l") > 1).select("_l")
    pairs = items.mapInArrow(count, "x string, y string, common bigint, equal bigint").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("common").alias("common"), F.sum("equal").alias("equal"))
    n = answers.groupBy(F.col(label).alias("_s")).agg(F.count("*").alias("_n"))
    both = pairs.join(broadcast_if_small(n.select(F.col("_s").alias("a"), F.col("_n").alias("_na"))), "a").join(broadcast_if_small(n.select(F.col("_s").alias("b"), F.col("_n").alias("_nb"))), "b")
    return both.select("a", "b", "common", "equal", ratio(F.col("equal"), F.col("common")).alias("agreement"), ratio(F.col("common"), F.col("_na") + F.col("_nb") - F.col("common")).alias("jaccard"))


def unit_metrics(pairs: DataFrame, label: str, unit: str, x: str, base: str) -> DataFrame:
    """Per label: units answered, units whose every answer is right, and the share of these."""
    right = F.col(x).isNotNull() & (F.col(x) == F.col(base))
    per_unit = pairs.groupBy(label, unit).agg(F.count(x).alias("answers"), F.count_if(right).alias("right"))
    return per_unit.groupBy(label).agg(
        F.count("*").alias("units"), F.count_if(F.col("answers") > 0).alias("answered"), F.count_if((F.col("answers") > 0) & (F.col("right") == F.col("answers"))).alias("all_right"), F.sum("answers").alias("answers"), F.sum("right").alias("right")
    ).withColumn("all_right_share", ratio(F.col("all_right"), F.col("answered")))


def completeness(fields: Sequence[Column], context: Sequence[Column], items: Column) -> Column:
    """0.3, 0.2 times the filled share of the context and 0.5 times the share of items at least half filled."""
    full = lambda c: (F.coalesce(F.trim(c.cast("string")), F.lit("")) != "").cast("int")
    own = sum((full(c) for c in context), F.lit(0)) / max(len(context), 1)
    return exact(F.least(F.lit(1.0), 0.3 + 0.2 * own + 0.5 * items), 4)


def judged_support(rows: DataFrame, item: Sequence[str], position: str, group: str, support: str, quoted: str) -> DataFrame:
    """A judge's verdicts under the rules that follow it: ``(item, position, support, group_no)``.

    An item none of whose candidates has a quote is unclear throughout; a group
    whose candidates are judged differently is unclear; groups are numbered from
    0 in the order of their first candidate.
    """
    of_item, of_group = Window.partitionBy(*item), Window.partitionBy(*item, group)
    kinds = F.size(F.collect_set(support).over(of_group))
    marked = rows.withColumns({"_any": F.bool_or(quoted).over(of_item), "_kinds": kinds, "_first": F.min(position).over(of_group)})
    numbered = marked.withColumn("group_no", F.dense_rank().over(of_item.orderBy("_first")) - 1)
    settled = F.when(~F.col("_any") | (F.col("_kinds") > 1), "unclear").otherwise(F.col(support))
    return numbered.select(*item, position, settled.alias("support"), "group_no")
