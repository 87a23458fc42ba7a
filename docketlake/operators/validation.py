"""Validation of tables against references: staged cells, priorities, record and cell lines in one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.text import from_spreadsheet_literal

#: Priorities, the most urgent first.
PRIORITIES = ("high", "medium", "low", "none")
#: How urgent a look at a pair of answers is: category, what a judge says of it, against a contender, against a reference.
PAIR_PRIORITY = (
    ("both_na", None, "none", "none"), ("agree", None, "low", "low"), ("changed", None, "high", "high"), ("changed", "same", "low", "low"), ("changed", "primary", "low", "medium"),
    ("changed", "other", "high", "high"), ("new", None, "medium", "medium"), ("new", "corroborated", "low", "medium"), ("new", "supported", "low", "low"), ("new", "unsupported", "high", "high"),
    ("new", "unclear", "medium", "medium"), ("missing", None, "medium", "low"), ("missing", "supported", "high", "high"), ("missing", "unsupported", "low", "low"), ("missing", "unclear", "medium", "medium"),
)
#: The mark of a known absence.
NA = "NA"


def read_source(spark: SparkSession, path: str, columns: dict[str, str], reference: bool = False) -> DataFrame:
    """A CSV table of a source: named columns only, all text, formula guards undone, blanks null.

    ``columns`` maps titles in the file to field names.  ``NA`` is null in a
    contender's table and stays in a reference's, where it is a labelled absence.
    """
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("encoding", "UTF-8").csv(path)
    clean = lambda c: F.when((F.trim(c) == "") | (F.lit(not reference) & (F.trim(c) == NA)), F.lit(None)).otherwise(from_spreadsheet_literal(c))
    missing = [t for t in columns if t not in raw.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return raw.select(*(clean(F.col(f"`{t}`")).alias(n) for t, n in columns.items()))


def pair_priority(category: Column, judged: Column, reference: Column) -> Column:
    """How urgent a pair is, by the decision table; ``judged`` is what a judge says, null without one."""
    key = F.concat_ws("/", category, F.coalesce(judged, F.lit("-")))
    cell = lambda i: F.create_map(*(F.lit(x) for row in PAIR_PRIORITY for x in (f"{row[0]}/{row[1] or '-'}", row[i])))
    return F.when(reference, F.try_element_at(cell(3), key)).otherwise(F.try_element_at(cell(2), key))


def rank_of(priority: Column) -> Column:
    return F.array_position(F.array(*(F.lit(p) for p in PRIORITIES)), priority).cast("int")


def record_lines(cells: DataFrame, key: str, label: str, role: str) -> DataFrame:
    """``(key, state, priority, miss)``: records that the primary source lacks, or has alone.

    ``missing_row``: high if most of the other contenders, two at least, have the
    record, medium if any has, low if only a reference has.  ``extra_row``: no
    one else has it though others were asked; high if two others were.
    """
    asked = cells.where(F.col(role).isin("primary", "challenger")).select(label).distinct()
    others_in_all = max(0, asked.count() - 1)
    has = lambda *roles: F.bool_or(F.col(role).isin(*roles))
    g = cells.groupBy(key).agg(has("primary").alias("mine"), F.count_distinct(F.when(F.col(role) == "challenger", F.col(label))).alias("others"), has("reference").alias("referred"))
    lacking = F.when((F.col("others") >= 2) & (2 * F.col("others") > others_in_all), "high").when(F.col("others") > 0, "medium").when(F.col("referred"), "low")
    asked_too = "high" if others_in_all >= 2 else "medium" if others_in_all else None
    alone = F.when((F.col("others") == 0) & ~F.col("referred"), F.lit(asked_too).cast("string"))
    lines = g.select(key, F.when(F.col("mine"), "extra_row").otherwise("missing_row").alias("state"), F.when(F.col("mine"), alone).otherwise(lacking).alias("priority"), F.when(~F.col("mine") & F.col("referred"), "extraction").otherwise("").alias("miss"))
    return lines.where("priority is not null")


def cell_lines(cells: DataFrame, keys: Sequence[str], label: str, role: str, value: str) -> DataFrame:
    """``(keys, state, priority, miss)`` of each item that the primary source has a row for.

    The priority is the most urgent of the pairs of the primary's value with each
    other source's; a ``new`` value is corroborated if a third source gives it.
    Each source has one value per item, null for NA.
    """
    mine = cells.where(F.col(role) == "primary").select(*keys, F.col(value).alias("_mine"))
    counts = cells.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_same")).agg(F.count("*").alias("_n"))
    state = cells.groupBy(*keys).agg(
        F.count(value).alias("_valued"), F.count_if(F.col(value).isNotNull() & (F.col(role) != "reference")).alias("_given"), F.count_distinct(value).alias("_kinds"), F.count("*").alias("_held"),
        F.bool_or(F.col(value).isNotNull() & (F.col(role) == "reference")).alias("_referred"),
    )
    status = F.when(F.col("_valued") == 0, "all_na").when(F.col("_given") == 0, "reference_only").when(F.col("_kinds") > 1, "disputed").when(F.col("_valued") == F.col("_held"), "unanimous").otherwise("partial")
    pairs = cells.where(F.col(role) != "primary").select(*keys, F.col(role).alias("_role"), F.col(value).alias("_base")).join(mine, list(keys)).join(counts.withColumnRenamed("_same", "_mine"), [*keys, "_mine"], "left")
    x, base = F.col("_mine"), F.col("_base")
    category = F.when(x.isNull() & base.isNull(), "both_na").when(x.isNull(), "missing").when(base.isNull(), "new").when(x == base, "agree").otherwise("changed")
    judged = F.when((category == "new") & (F.coalesce("_n", F.lit(0)) > 1), "corroborated")
    urgent = pairs.groupBy(*keys).agg(F.min(rank_of(pair_priority(category, judged, F.col("_role") == "reference"))).alias("_rank"))
    lines = mine.join(state, list(keys)).join(urgent, list(keys), "left")
    rank = F.coalesce("_rank", F.when(x.isNotNull(), 3).otherwise(4))
    return lines.select(*keys, status.alias("state"), F.element_at(F.array(*map(F.lit, PRIORITIES)), rank).alias("priority"), F.when(x.isNull() & F.col("_referred"), "extraction").otherwise("").alias("miss"))


def in_review_order(lines: DataFrame, key: Sequence[str], name: str = "place") -> DataFrame:
    """Lines with their place: by priority, then by key as JSON and the digest of the content, whatever the engine's order of rows."""
    from docketlake.operators.ranking import with_place

    json = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    keyed = lines.withColumns({"_rank": rank_of(F.col("priority")), "_key": json, "_digest": F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lines.columns)), 256)})
    return with_place(keyed, [F.col("_rank"), F.col("_key"), F.col("_digest")], name).drop("_rank", "_key", "_digest")
