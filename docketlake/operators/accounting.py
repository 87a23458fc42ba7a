"""Costs, usage, outcomes and quality of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions.measures import complete_sum, error_kind, ratio
from docketlake.operators.joins import first_of


def money(x: Column) -> Column:
    return x.cast("decimal(18,6)")


def delivered_once(results: DataFrame, key: str = "record_id") -> DataFrame:
    """Runs that were delivered again, unchanged, count once."""
    return first_of(results, [key], [F.col("extracted_at"), F.col("source_id")])


def run_costs(results: DataFrame) -> DataFrame:
    """Per model: records, cost, tokens and time; ``unknown`` counts records without a cost."""
    r = delivered_once(results)
    return r.groupBy("model").agg(
        F.count("*").alias("records"), F.coalesce(F.sum(money(F.col("cost"))), F.lit(0)).cast("decimal(18,6)").cast("double").alias("cost"),
        F.count_if(F.col("cost").isNull()).alias("unknown"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )


def total_usage(results: DataFrame) -> DataFrame:
    """Per model: token sums, null as soon as one record's usage is unknown."""
    return delivered_once(results).groupBy("model").agg(complete_sum(F.col("input_tokens")).alias("input_tokens"), complete_sum(F.col("output_tokens")).alias("output_tokens"))


def model_quality(results: DataFrame) -> DataFrame:
    """Per model: mean completeness, quote fidelity and seconds a document."""
    r = delivered_once(results)
    score = F.when(~F.isnan("completeness_score"), F.col("completeness_score"))
    return r.groupBy("model").agg(
        F.count("*").alias("documents"), ratio(F.sum(score.cast("decimal(18,6)")), F.count(score)).alias("mean_completeness"),
        F.sum("unverified_quotes").alias("unverified_quotes"), ratio(F.count_if(F.col("unverified_quotes") == 0), F.count("unverified_quotes")).alias("clean_share"),
        ratio(F.sum(F.col("processing_time").cast("decimal(18,6)")), F.count("processing_time")).alias("mean_seconds"),
    )


def status_counts(df: DataFrame, by: str, status: str, size: str) -> DataFrame:
    """Counts and bytes per (by, status), per by and in all, in one pass (grouping sets)."""
    return df.groupingSets([[F.col(by), F.col(status)], [F.col(by)], []], F.col(by), F.col(status)).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.grouping(by).alias("all_groups"), F.grouping(status).alias("all_statuses"))


def error_rollup(df: DataFrame, message: str) -> DataFrame:
    """Messages counted by kind."""
    return df.where(F.col(message).isNotNull()).groupBy(error_kind(F.col(message)).alias("kind")).agg(F.count("*").alias("n"), F.count_distinct(message).alias("kinds_of_text"))


def mixed_lineage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: how many different values, rows without one and the first four values."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_n", F.row_number().over(Window.partitionBy("column").orderBy(F.col("value").asc_nulls_last())))
    return ranked.groupBy("column").agg(F.count("value").alias("different"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("_n") <= 4) & F.col("value").isNotNull(), F.struct("_n", "value")))), lambda x: x["value"]), ", ").alias("examples"))


def completions(df: DataFrame, owner: str, retry: Column) -> DataFrame:
    """``(owner, outcomes, complete)``: an owner is complete once no outcome asks for another try."""
    return df.groupBy(owner).agg(F.count("*").alias("outcomes"), F.bool_and(~retry).alias("complete"))
