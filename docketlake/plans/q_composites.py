"""Queries: whole pipelines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions import urls
from docketlake.operators import votes
from docketlake.plans import pipelines
from docketlake.plans.common import ANSWERS_SQL, answers, claims
from docketlake.plans.q_votes import _URL_VOTE_SQL
from docketlake.plans.registry import Registry, Tables
from docketlake.plans.schema_plan import SchemaPlan

R = Registry()

SCHEMA = """{"type": "object", "properties": {"url": {"type": "string", "format": "uri"}, "scope": {"type": "string"},
 "items": {"type": "array", "items": {"type": "object", "properties": {"state": {"type": "string", "title": "State"}, "ahj": {"type": "string", "title": "AHJ Name"}, "section": {"type": "string"}, "permit_type": {"type": "string"}, "contact_office": {"type": "string", "title": "Office"}}}}},
 "$metadata": {"identity": {"keys": ["section", "permit_type"], "partition": ["state", "ahj"]}}}"""


@R.add("""
with f as (select obs_id, data->>'url' as url, data->>'scope' as scope, data->'item'->>'state' as state, data->'item'->>'ahj' as ahj, data->'item'->>'section' as section, data->'item'->>'permit_type' as permit_type, case when json_type(data, '$.item.contact_office') = 'OBJECT' then null else data->'item'->>'contact_office' end as office from observations),
k as (select *, lower(trim(coalesce(state,''))) as a, lower(trim(coalesce(ahj,''))) as b, lower(trim(coalesce(section,''))) as c, lower(trim(coalesce(permit_type,''))) as d,
 (coalesce(trim(url),'')<>'')::int + (coalesce(trim(scope),'')<>'')::int + (coalesce(trim(state),'')<>'')::int + (coalesce(trim(ahj),'')<>'')::int + (coalesce(trim(section),'')<>'')::int + (coalesce(trim(permit_type),'')<>'')::int + (coalesce(trim(office),'')<>'')::int as filled from f),
r as (select *, count(*) over (partition by a, b, c, d) - 1 as dup, row_number() over (partition by a, b, c, d order by filled desc, obs_id) as rn from k)
select url, scope, state as "State", ahj as "AHJ Name", section, permit_type, office as "Office", case when dup > 0 then 'Merged ' || dup || ' duplicate(s) on: section=''' || section || ''', permit_type=''' || permit_type || '''' end as merge_note from r where rn = 1""")
def cmp_compile_rows(t: Tables) -> DataFrame:
    """CMP1, CMP2: payloads compiled to deduplicated, titled rows under a schema."""
    d = F.from_json("data", "struct<url:string,scope:string,item:struct<state:string,ahj:string,section:string,permit_type:string,contact_office:string>>")
    payload = t.observations.select("obs_id", d.alias("d"))
    plain = F.when(~F.col("d.item.contact_office").startswith("{"), F.col("d.item.contact_office"))
    item = F.struct(F.col("d.item.state").alias("state"), F.col("d.item.ahj").alias("ahj"), F.col("d.item.section").alias("section"), F.col("d.item.permit_type").alias("permit_type"), plain.alias("contact_office"))
    records = payload.select("obs_id", F.to_json(F.struct(F.col("d.url").alias("url"), F.col("d.scope").alias("scope"), F.array(item).alias("items"))).alias("payload"))
    return pipelines.compile_rows(records, SchemaPlan.load(SCHEMA), "payload", "obs_id")


@R.add(_URL_VOTE_SQL + """,
w as (select target, max(case when field = 'permit_fee' then value end) as permit_fee, max(case when field = 'contact_office' then value end) as contact_office, ['none','low','medium','high'][min(list_position(['none','low','medium','high'], confidence))] as confidence, count(*) as answered from cellvote group by target)
select t.target_id, t.name, coalesce(permit_fee, 'NA') as permit_fee, coalesce(contact_office, 'NA') as contact_office, coalesce(confidence, 'none') as confidence, coalesce(answered, 0) as answered from targets t left join w on w.target = t.target_id""")
def cmp_roster_table(t: Tables) -> DataFrame:
    """CMP2, PRJ8: one row per target, voted values or NA."""
    cells = votes.url_vote(claims(t), ["target", "field"], "value_key", "value", "url", "scope", "quote", "obs_id").withColumnRenamed("target", "target_id")
    return pipelines.roster_table(t.targets.select("target_id", "name"), cells, ["permit_fee", "contact_office"])


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"
_FOLD = "translate(lower(coalesce(url, '')), '_-/', '   ')"
_SELECT_SQL = f"""
with c as (select target_id, url, min(artifact_id) as artifact_id from digger_artifacts where target_id is not null and url is not null group by 1, 2),
g as (select *, {_HOST} as host, case when contains({_FOLD}, 'minutes') then 'draft' when regexp_matches(url, 'lang=es') then 'excluded' when not regexp_matches({_FOLD}, 'permit|ordinance|code|checklist|fee') then 'irrelevant' end as stop from c),
a as (select *, row_number() over (partition by target_id, host order by artifact_id) as h from g where stop is null), b as (select *, row_number() over (partition by target_id order by artifact_id) as r from a where h <= 2),
o as (select g.target_id, g.url, g.artifact_id, coalesce(g.stop, case when b.r <= 3 then 'selected' end, 'outranked') as outcome from g left join b on b.target_id = g.target_id and b.url = g.url)"""


def _selected(t: Tables) -> DataFrame:
    c = t.digger_artifacts.where("target_id is not null and url is not null").groupBy("target_id", "url").agg(F.min("artifact_id").alias("artifact_id"))
    folded = urls.folded_text(F.col("url"))
    gates = [("draft", ~folded.contains("minutes")), ("excluded", ~F.col("url").rlike("lang=es")), ("irrelevant", folded.rlike("permit|ordinance|code|checklist|fee"))]
    return pipelines.select_candidates(c, "target_id", "url", gates, [F.col("artifact_id")], 3, 2)


@R.add(_SELECT_SQL + " select * from o")
def cmp_candidate_selection(t: Tables) -> DataFrame:
    """CMP4, CMP6, CMP7: candidates through all gates to the capped best."""
    return _selected(t).select("target_id", "url", "artifact_id", "outcome")


@R.add(_SELECT_SQL + " select target_id, arg_max(outcome, list_position(['draft', 'excluded', 'irrelevant', 'outranked', 'selected'], outcome)) as outcome from o group by target_id")
def cmp_target_outcomes(t: Tables) -> DataFrame:
    """CMP8, AGG26: what became of each target's candidates."""
    return pipelines.target_outcomes(_selected(t), "target_id", ["draft", "excluded", "irrelevant"])


@R.add(f"""
with {ANSWERS_SQL}, a as (select cluster_id, field, label, role, nullif(answer, 'NA') as answer from answers),
g as (select cluster_id, field, count(case when role <> 'reference' then answer end) as given, count_if(role <> 'reference') as asked, count(distinct case when role <> 'reference' then answer end) as kinds, count(case when role = 'reference' then answer end) as reference from a group by all),
s as (select cluster_id, field, case when given = 0 and reference = 0 then 'all_na' when given = 0 then 'reference_only' when kinds > 1 then 'disputed' when given < asked then 'partial' else 'unanimous' end as status from g),
c as (select cluster_id, field, answer, count(*) as votes from a where role <> 'reference' group by all), v as (select *, sum(votes) over (partition by cluster_id, field) as voters from c),
m as (select cluster_id, field, answer as majority, votes, cast(voters as bigint) as voters from v where votes * 2 > voters and voters >= 2),
r as (select cluster_id, field, count(distinct answer) as reference_kinds, min(answer) as reference from a where role = 'reference' group by all)
select s.cluster_id, s.field, status, majority, votes, voters, reference_kinds, reference, case when (majority is not null and reference is not null and majority <> reference) or reference_kinds > 1 then 'high' when status = 'disputed' then 'medium' when status in ('partial', 'reference_only') then 'low' else 'none' end as priority
from s left join m using (cluster_id, field) left join r using (cluster_id, field)""")
def cmp_validation_lines(t: Tables) -> DataFrame:
    """CMP33, CMP34: every item with status, majority, reference and priority."""
    a = answers(t).withColumn("answer", F.nullif("answer", F.lit("NA")))
    return pipelines.validation_lines(a, ["cluster_id", "field"], "label", "role", "answer")


@R.add("""
with d as (select s.source_id, lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{64})', 1)) as d from captured_sources s where s.size > 0), c as (select d.* from d join captured_texts using (source_id))
select d.source_id, min(c.source_id) as donor from d join c using (d) where d.source_id not in (select source_id from captured_texts) group by 1""")
def cmp_donors(t: Tables) -> DataFrame:
    """CMP16: copies without a text that inherit one."""
    d = t.captured_sources.where("size > 0").select("source_id", F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)).alias("d"))
    return pipelines.donated(d, d.join(t.captured_texts.select("source_id"), "source_id", "left_semi"), "d", "source_id")


@R.add("select distinct target_id from digger_artifacts where target_id is not null and target_id not in (select target_id from digger_artifacts where target_id is not null and (status is null or status in ('captured', 'discovered')))")
def cmp_withdrawn(t: Tables) -> DataFrame:
    """CMP17: owners with nothing left to keep or to try."""
    live = t.digger_artifacts.where("target_id is not null and (status is null or status in ('captured', 'discovered'))").select("target_id")
    return t.digger_artifacts.where("target_id is not null").select("target_id").distinct().join(live, "target_id", "left_anti")
