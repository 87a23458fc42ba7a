"""Best representative of each duplicate group, field by field (problem 1).

``survivors``: members are ranked (scope, date, completeness, id) and the value of the
first-ranked one survives.  The rank leaves no tie, so nothing is left to vote on: it is
one aggregate, which combines before the shuffle.

Method: token-level consensus, where values are voted on.  The values of a group are
aligned, every column of the alignment is voted on with the members' weights, and the
existing value closest to the voted consensus survives.

``consensus_values``: weights are graded by scope, date and score and add up over the
members that give a value, so that many may overrule one.  All different values of a
group take part, as rows: each is aligned with the group's heaviest value, columns are
voted on by an aggregate, and no group is ever gathered.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.session import cut

FIELDS = ("online_permitting", "permit_fee", "review_days", "setback_ft", "contact_office", "required_documents")
#: Placeholders that answer nothing, without case and spaces.
PLACEHOLDERS = (
    "", "-", "--", "---", "–", "—", "?", "??", ".", "...", "…", "*", "n/a", "na", "n.a.", "n.a", "#n/a", "n/d", "nan", "null", "nil", "unknown", "unk", "unspecified",
    "notstated", "notspecified", "notprovided", "notgiven", "notavailable", "notapplicable", "notfound", "notlisted", "notmentioned", "notknown", "noanswer", "noinformation",
    "nodata", "tbd", "tba", "tobedetermined", "tobeannounced", "undetermined", "pending", "xxx", "missing", "blank", "empty", "(blank)", "(none)", "<na>", "<null>",
)
_ITEM = "struct<state:string,ahj:string,permit_type:string,section:string," + ",".join(f"{f}:string" for f in FIELDS) + ">"
_DATA = f"struct<item:{_ITEM},scope:string,source_date:string>"


def section_key(section: Column) -> Column:
    """A code section without its label, dashes of one kind and no spaces; null if blank."""
    s = F.lower(F.regexp_replace(section, r"[‐-―−]", "-"))
    s = F.regexp_replace(s, r"^[\s§]*(sections?|sect?|secs|s|§)?\s*[.:]?[\s§]*(?=[\d(a-z])", "")
    s = F.regexp_replace(s, r"(\s+|[.,;:]+$)", "")
    return F.nullif(s, F.lit(""))


def permit_key(permit_type: Column) -> Column:
    """A permit type as its words in lower case; null if blank."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(permit_type), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def date_key(text: Column) -> Column:
    """A loosely written date as yyyymmdd, null if there is none.

    Year first, day with named month, named month with day, and month/day/year
    (day first if the first number cannot be a month).
    """
    t = F.lower(F.trim(text))
    number = lambda pattern, group: F.regexp_extract(t, pattern, group).try_cast("int")
    months = F.lit("janfebmaraprmayjunjulaugsepoctnovdec")
    month_of = lambda c: ((F.instr(months, c) + 2) / 3).cast("int")
    iso, day_first, month_first, slashed = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", r"^(\d{1,2})(?:st|nd|rd|th)?[ .-]+([a-z]{3})[a-z]*[ .,-]+(\d{4})", r"^([a-z]{3})[a-z]*[ .]+(\d{1,2})(?:st|nd|rd|th)?[ ,]+(\d{4})", r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
    a, b = number(slashed, 1), number(slashed, 2)
    value = (
        F.when(t.rlike(iso), number(iso, 1) * 10000 + number(iso, 2) * 100 + number(iso, 3))
        .when(t.rlike(slashed), number(slashed, 3) * 10000 + F.when(a > 12, b * 100 + a).otherwise(a * 100 + b))
        .when(t.rlike(day_first), number(day_first, 3) * 10000 + month_of(F.regexp_extract(t, day_first, 2)) * 100 + number(day_first, 1))
        .when(t.rlike(month_first), number(month_first, 3) * 10000 + month_of(F.regexp_extract(t, month_first, 1)) * 100 + number(month_first, 2))
        .when(t.rlike(r"^\d{4}-\d{2}$"), F.regexp_replace(t, "-", "").try_cast("int") * 100)
        .when(t.rlike(r"^\d{4}$"), t.try_cast("int") * 10000)
    )
    return F.when((value > 10_000_000) & (value < 99_999_999), value)


def filled_value(raw: Column) -> Column:
    """The text of a field's value, plain or as {value, quote}; null if the field is not filled.

    Absent, null, blank, placeholder and lists with nothing but such fill nothing;
    false, 0 and No do.
    """
    value = F.when(raw.startswith("{"), F.get_json_object(raw, "$.value")).otherwise(raw)
    none = lambda c: F.regexp_replace(F.lower(c), r"\s+", "").isin(*PLACEHOLDERS)
    listed = F.from_json(value, "array<string>")
    empty = F.when(value.startswith("["), F.coalesce(F.forall(listed, lambda x: x.isNull() | none(x)), F.lit(False))).otherwise(none(value))
    return F.when(value.isNotNull() & ~empty, value)


def rule_observations(observations: DataFrame, results: DataFrame) -> DataFrame:
    """Observations with their rule key, rank parts and the filled values of the six fields.

    A record delivered twice counts with its highest score.  Unreadable data and a
    null id, target, section or permit type belong to no rule and are left out.
    """
    scores = results.where("record_id is not null").groupBy("record_id").agg(F.max("completeness_score").alias("score"))
    d = observations.select("obs_id", "target", "record_id", F.from_json("data", _DATA).alias("d")).where("obs_id is not null and target is not null")
    d = d.select("obs_id", "target", "record_id", section_key(F.col("d.item.section")).alias("section"), permit_key(F.col("d.item.permit_type")).alias("permit"), F.coalesce((F.lower(F.trim("d.scope")) == "target").cast("int"), F.lit(0)).alias("own"), F.coalesce(date_key(F.col("d.source_date")), F.lit(0)).alias("dated"), *(filled_value(F.col(f"d.item.{f}")).alias(f) for f in FIELDS))
    d = d.where("section is not null and permit is not null")
    return d.join(scores, "record_id", "left").drop("record_id").withColumn("score", F.coalesce(F.when(~F.isnan("score"), F.col("score")), F.lit(-1.0)))


def fold_groups(rows: DataFrame) -> DataFrame:
    """One row per group of two or more: its id and size, and for each field its best
    member as ``struct<rank.., value>``, null if none fills it.

    Repeated rows of one obs_id count once.  All of it is combined before the
    shuffle, so that a hot group arrives as one row per task.
    """
    rank = lambda f: F.struct("own", "dated", "score", (-F.col("obs_id")).alias("minus_id"), F.col(f).alias("value"))
    best = [F.max(F.when(F.col(f).isNotNull(), rank(f))).alias(f) for f in FIELDS]
    return rows.groupBy("target", "section", "permit").agg(F.min("obs_id").alias("group_id"), F.max("obs_id").alias("last_id"), F.count("*").alias("members"), *best).where("group_id < last_id").drop("last_id")


def align(profile: list[list[str | None]], tokens: list[str]) -> list[list[str | None]]:
    """Add ``tokens`` as a row to a profile (a list of columns), with gaps where needed.

    Needleman-Wunsch over columns: a token that stands in a column costs nothing, any
    other column 1.5 and a gap 1.
    """
    n, m = len(profile), len(tokens)
    depth = len(profile[0]) if profile else 0
    cost = [[float(i + j) if not i or not j else 0.0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        column = profile[i - 1]
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (0.0 if tokens[j - 1] in column else 1.5), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out: list[list[str | None]] = []
    i, j = n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (0.0 if tokens[j - 1] in profile[i - 1] else 1.5):
            i, j = i - 1, j - 1
            out.append([*profile[i], tokens[j]])
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append([*profile[i], None])
        else:
            j -= 1
            out.append([*([None] * depth), tokens[j]])
    return out[::-1]


def tokens_of(value: str) -> list[str]:
    out: list[str] = []
    word = ""
    for c in value.strip().lower():
        if c.isalnum():
            word += c
            continue
        if word:
            out.append(word)
            word = ""
        if not c.isspace():
            out.append(c)
    return out + [word] if word else out


def consensus_index(values: list[str], weights: list[float]) -> int:
    """Index of the value closest to the weighted token consensus of ``values``, which come best first.

    Values are aligned one after the other; each column elects the token (or
    gap) of most weight; the distance of a value is the weight-free number of
    columns where it differs.  Ties go to the earlier value.
    """
    if len(values) < 2:
        return 0
    rows = [tokens_of(v) for v in values]
    if all(r == rows[0] for r in rows):
        return 0
    profile: list[list[str | None]] = [[t] for t in rows[0]]
    for r in rows[1:]:
        profile = align(profile, r) if profile else [[*([None] * rows.index(r)), t] for t in r]
    elected = []
    for column in profile:
        votes: dict[str | None, float] = {}
        for token, weight in zip(column, weights):
            votes[token] = votes.get(token, 0.0) + weight
        elected.append(max(votes, key=votes.get))
    away = [sum(column[i] != e for column, e in zip(profile, elected)) for i in range(len(values))]
    return away.index(min(away))


def survivors(observations: DataFrame, results: DataFrame) -> DataFrame:
    """``(group_id, target, section, permit, members, field, obs_id, value)``: the surviving value of each
    field that a member of a group of two or more fills.

    Ties in scope, date and score go to the smaller obs_id.  Empty tables give an
    empty result.  Other columns of the inputs are not read.
    """
    folded = fold_groups(rule_observations(observations, results))
    entries = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("best")) for f in FIELDS))
    key = ["group_id", "target", "section", "permit", "members"]
    long = folded.select(*key, F.explode(entries).alias("e")).where("e.best is not null")
    return long.select(*key, "e.field", (-F.col("e.best.minus_id")).alias("obs_id"), F.col("e.best.value").alias("value"))


def surviving_records(observations: DataFrame, results: DataFrame) -> DataFrame:
    """One built record per group: its key and the surviving value of each field (null if no member fills it)."""
    s = survivors(observations, results)
    return s.groupBy("group_id", "target", "section", "permit", "members").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS))


def packed_rank() -> Column:
    """Scope and date as one number, score and id: what orders members, the best last."""
    return F.struct((F.col("own").cast("long") * 100_000_000 + F.col("dated")).alias("own_dated"), "score", (-F.col("obs_id")).alias("minus_id"))


def graded_weight(rank: Column) -> Column:
    """Weight of a member by its rank: twice for its own scope, up to twice by its score, up to twice by its year (2000 to 2050)."""
    own, dated = F.floor(rank["own_dated"] / 100_000_000), rank["own_dated"] % 100_000_000
    recent = F.when(dated > 0, F.least(F.greatest((F.floor(dated / 10000) - 2000) / 50, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return (1 + own) * (1 + F.least(F.greatest(rank["score"], F.lit(0.0)), F.lit(1.0))) * (1 + recent)


def aligned_to(center: list[str], tokens: list[str]) -> list[tuple[int, int, str | None]]:
    """``(column, insertion, token)`` of tokens aligned with a center: a token or None at each of its columns (from 1,
    insertion 0), and the tokens inserted after a column, numbered from 1."""
    if not center:
        return [(0, k, t) for k, t in enumerate(tokens, 1)]
    out: list[tuple[int, int, str | None]] = []
    at = inserted = 0
    for column in align([[t] for t in center], tokens):
        if column[0] is None:
            inserted += 1
            out.append((at, inserted, column[1]))
        else:
            at, inserted = at + 1, 0
            out.append((at, 0, column[1]))
    return out


def token_distance(a: list[str], b: list[str]) -> int:
    """Edit distance over tokens."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _aligned(centers: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([[{"place": c, "insertion": k, "token": t} for c, k, t in aligned_to(tokens_of(a), tokens_of(b))] for a, b in zip(centers, values)])


def _away(elected: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([token_distance([] if e is None else list(e), tokens_of(v)) for e, v in zip(elected, values)], dtype="int32")


def consensus_values(observations: DataFrame, results: DataFrame) -> DataFrame:
    """``(group_id, target, section, permit, field, obs_id, value, members, support)``: for each field that a member of a
    group of two or more fills, the existing value closest to the weighted token consensus of all its values.

    ``support`` is the share of weight that gave this very value.  Ties go to the
    heavier value, then to the best-ranked member, whose obs_id is given.
    Repeated rows of one obs_id count once; empty tables give an empty result.
    """
    key, cell = ["target", "section", "permit"], ["_a", "_b"]
    # a field of a group travels as 128 bits: two hashes of its key, the last three bits of which are the field's number
    rows = rule_observations(observations, results).withColumns({"_a": F.xxhash64(*key), "_h": F.xxhash64(F.lit("2"), *reversed(key)), "rank": packed_rank()})
    groups = rows.groupBy("_a", F.shiftright("_h", 3).alias("_g")).agg(F.min("obs_id").alias("group_id"), F.count_distinct("obs_id").alias("members"), *(F.first(k).alias(k) for k in key)).where("members > 1")
    entries = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("f"), F.col(f).alias("value")) for i, f in enumerate(FIELDS)))).alias("e")
    long = rows.select("_a", "_h", "rank", entries).where("e.value is not null").select("_a", (F.shiftleft(F.shiftright("_h", 3), 3) + F.col("e.f")).alias("_b"), "rank", "e.value")
    # a repeated row has the same rank, which holds its id
    once = long.distinct()
    values = cut(once.groupBy(*cell, "value").agg(F.round(F.sum(graded_weight(F.col("rank"))), 6).alias("weight"), F.max("rank").alias("rank")))
    totals = values.groupBy(*cell).agg(F.round(F.sum("weight"), 6).alias("total"), F.count("*").alias("kinds"), F.max_by("value", F.struct("weight", "rank")).alias("center"))
    # a field with one value needs no vote
    asked = cut(values.join(totals, cell))
    several = asked.where("kinds > 1")
    votes = several.select(*cell, "weight", "total", F.explode(F.pandas_udf(_aligned, "array<struct<place:int,insertion:int,token:string>>")("center", "value")).alias("a"))
    counted = votes.groupBy(*cell, "a.place", "a.insertion", "a.token").agg(F.sum("weight").alias("w"), F.first("total").alias("total"))
    # whoever has nothing at an inserted place votes for nothing
    elected = counted.groupBy(*cell, "place", "insertion").agg(F.max(F.struct(F.when(F.col("token").isNotNull(), F.round("w", 6)).otherwise(-1.0).alias("w"), "token")).alias("best"), F.round(F.first("total") - F.sum(F.when(F.col("token").isNotNull(), F.col("w")).otherwise(0.0)), 6).alias("nothing"))
    text = elected.where("best.w >= nothing and best.token is not null").groupBy(*cell).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "insertion", F.col("best.token").alias("token")))), lambda x: x["token"]).alias("elected"))
    judged = several.join(text, cell, "left").withColumn("away", F.pandas_udf(_away, "int")("elected", "value")).drop("elected", "kinds", "center")
    chosen = judged.groupBy(*cell).agg(F.max_by(F.struct("value", "weight", "rank", "total"), F.struct(-F.col("away"), "weight", "rank")).alias("c"))
    alone = asked.where("kinds = 1").select(*cell, F.struct("value", "weight", "rank", "total").alias("c"))
    field = F.element_at(F.array(*map(F.lit, FIELDS)), (F.pmod("_b", F.lit(8)) + 1).cast("int")).alias("field")
    out = chosen.unionByName(alone).withColumn("_g", F.shiftright("_b", 3)).join(groups, ["_a", "_g"])
    return out.select("group_id", *key, field, (-F.col("c.rank.minus_id")).alias("obs_id"), "c.value", "members", (F.col("c.weight") / F.col("c.total")).alias("support"))
