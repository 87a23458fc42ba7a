"""Shared building blocks of the queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import literal_map
from docketlake.plans.registry import Tables
from docketlake.sources.records import field_quote, field_value

FIELDS = ("online_permitting", "permit_fee", "review_days", "setback_ft", "contact_office", "required_documents")
#: Written forms of an answer without case and punctuation.
ANSWERS = {"yes": "Yes", "y": "Yes", "no": "No", "n": "No", "sometimes": "Sometimes", "never": "Never", "na": "NA", "notapplicable": "NA"}

#: SQL of ``answers``: the last answer of each source to each item.
ANSWERS_SQL = """
answers as (
  select cluster_id, field, label, any_value(role) as role, arg_max(answer, (labelled_at, answer)) as answer, arg_max(target_id, (labelled_at, answer)) as target_id from (
    select cluster_id, field, replace(lower(trim(label)), '_', '-') as label, role, labelled_at, target_id,
      map {'yes': 'Yes', 'y': 'Yes', 'no': 'No', 'n': 'No', 'sometimes': 'Sometimes', 'never': 'Never', 'na': 'NA', 'notapplicable': 'NA'}[regexp_replace(lower(value), '[^a-z]', '', 'g')] as answer
    from cells where assessed) where answer is not null group by cluster_id, field, label)"""

#: SQL of ``claims``: the filled fields of every observation, one row each.
CLAIMS_SQL = """
raw as (select obs_id, target, data->>'url' as url, data->>'scope' as scope, id, data->'item' as item from observations),
long as (select obs_id, target, url, scope, id, unnest(['online_permitting','permit_fee','review_days','setback_ft','contact_office']) as field, item from raw),
vals as (select obs_id, target, url, scope, id, field,
  case when json_type(item, '$.' || field) = 'OBJECT' then json_extract_string(item, '$.' || field || '.value') else json_extract_string(item, '$.' || field) end as value,
  case when json_type(item, '$.' || field) = 'OBJECT' then json_extract_string(item, '$.' || field || '.quote') end as quote from long),
claims as (select *, case when regexp_matches(trim(value), '^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\\.[0-9]+)?$') then 'n:' || cast(cast(replace(trim(value), ',', '') as decimal(20,4)) as varchar) else 't:' || lower(trim(value)) end as value_key
  from vals where value is not null and lower(trim(value)) not in ('', '-', '—', 'n/a', 'na', 'unknown', 'not stated'))"""


def answers(t: Tables) -> DataFrame:
    """``(cluster_id, field, label, role, answer, target_id)``: each source's last answer; ties go to the later class by name."""
    key = F.regexp_replace(F.lower("value"), "[^a-z]", "")
    c = t.cells.where("assessed").select("cluster_id", "field", F.translate(F.lower(F.trim("label")), "_", "-").alias("label"), "role", "labelled_at", "target_id", F.try_element_at(literal_map(ANSWERS), key).alias("answer"))
    order = F.struct("labelled_at", "answer")
    return c.where("answer is not null").groupBy("cluster_id", "field", "label").agg(F.first("role").alias("role"), F.max_by("answer", order).alias("answer"), F.max_by("target_id", order).alias("target_id"))


def claim_key(value: Column) -> Column:
    """Numbers to four places, other text without case."""
    v = F.trim(value)
    number = v.rlike(r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?$")
    return F.when(number, F.concat(F.lit("n:"), F.regexp_replace(v, ",", "").try_cast("decimal(20,4)").cast("string"))).otherwise(F.concat(F.lit("t:"), F.lower(v)))


def claims(t: Tables) -> DataFrame:
    """``(obs_id, target, url, scope, id, field, value, quote, value_key)``: filled scalar fields of observations."""
    scalar = FIELDS[:5]
    parsed = t.observations.select("obs_id", "target", "id", F.from_json("data", f"struct<url:string,scope:string,item:struct<{','.join(f + ':string' for f in scalar)}>>").alias("d"))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"d.item.{f}").alias("raw")) for f in scalar)))
    long = parsed.select("obs_id", "target", F.col("d.url").alias("url"), F.col("d.scope").alias("scope"), "id", each.alias("e"))
    rows = long.select("obs_id", "target", "url", "scope", "id", "e.field", field_value(F.col("e.raw")).alias("value"), field_quote(F.col("e.raw")).alias("quote"))
    return rows.where(F.col("value").isNotNull() & ~F.lower(F.trim("value")).isin("", "-", "—", "n/a", "na", "unknown", "not stated")).withColumn("value_key", claim_key(F.col("value")))


def against_reference(t: Tables, reference: str = "desk-west") -> DataFrame:
    """``(cluster_id, field, label, x, base, target_id)``: answers of all other sources beside those of one reference."""
    a = answers(t)
    base = a.where(F.col("label") == reference).select("cluster_id", "field", F.col("answer").alias("base"))
    x = a.where(F.col("label") != reference).select("cluster_id", "field", "label", F.col("answer").alias("x"), "target_id")
    return x.join(base, ["cluster_id", "field"]).select("cluster_id", "field", "label", F.nullif("x", F.lit("NA")).alias("x"), F.nullif("base", F.lit("NA")).alias("base"), "target_id")


#: SQL of ``against_reference``.
PAIRS_SQL = (
    ANSWERS_SQL
    + """,
pairs as (select a.cluster_id, a.field, a.label, nullif(a.answer, 'NA') as x, nullif(b.answer, 'NA') as base, a.target_id from answers a join answers b using (cluster_id, field) where a.label <> 'desk-west' and b.label = 'desk-west')"""
)
