"""Queries: votes, comparison metrics, accounting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions.measures import exact, ratio, wilson
from docketlake.operators import accounting, votes
from docketlake.plans.common import ANSWERS_SQL, CLAIMS_SQL, PAIRS_SQL, against_reference, answers, claims
from docketlake.plans.registry import Registry, Tables

R = Registry()
_DEC = "cast(round(cast({} as decimal(38,12)), {}) as double)"


def _ratio(k: str, n: str, places: int = 6) -> str:
    return f"cast(round(cast(case when ({n}) <> 0 then cast({k} as double) / cast({n} as double) end as decimal(38,12)), {places}) as double)"


_WILSON = "cast(round(cast(least(greatest(({p} + 3.8416/(2*{n}) {s} 1.96*sqrt({p}*(1-{p})/{n} + 3.8416/(4*{n}*{n})))/(1+3.8416/{n}), 0.0), 1.0) as decimal(38,12)), 4) as double)"

_URL_VOTE_SQL = f"""
with {CLAIMS_SQL},
v as (select target, field, value_key, count(distinct coalesce(url, chr(1))) as all_urls, count(distinct case when scope = 'target' then coalesce(url, chr(1)) end) as own_urls,
  count(distinct case when coalesce(trim(url), '') <> '' then url end) as support, min(obs_id) as first, min(case when scope = 'target' then obs_id end) as own_first,
  arg_min(value, (case when coalesce(quote, '') = '' then 1 else 0 end, case when scope = 'target' then 0 else 1 end, obs_id)) as value,
  arg_min(coalesce(url, chr(1)), (case when coalesce(quote, '') = '' then 1 else 0 end, case when scope = 'target' then 0 else 1 end, obs_id)) as url from claims group by all),
c as (select *, count(*) over w as n_values, max(own_urls) over w as any_own from v window w as (partition by target, field)),
r as (select *, row_number() over (partition by target, field order by case when any_own > 0 then own_urls else all_urls end desc, case when any_own > 0 then coalesce(own_first, first) else first end) as rn from c),
cellvote as (select target, field, value, nullif(url, chr(1)) as url, support, n_values, n_values > 1 as conflict, case when n_values > 1 then 'low' when all_urls >= 2 then 'high' else 'medium' end as confidence from r where rn = 1)"""


def _cell_votes(t: Tables) -> DataFrame:
    return votes.url_vote(claims(t), ["target", "field"], "value_key", "value", "url", "scope", "quote", "obs_id")


@R.add(_URL_VOTE_SQL + "select * from cellvote")
def agg_roster_vote(t: Tables) -> DataFrame:
    """AGG6: each target's fields by the vote of different addresses."""
    return _cell_votes(t)


@R.add(_URL_VOTE_SQL + "select target, ['none','low','medium','high'][min(list_position(['none','low','medium','high'], confidence))] as confidence, count(*) as answered from cellvote group by target")
def agg_row_confidence(t: Tables) -> DataFrame:
    """AGG7: a row is as sure as its weakest cell."""
    return _cell_votes(t).groupBy("target").agg(votes.weakest(F.col("confidence")).alias("confidence"), F.count("*").alias("answered"))


@R.add(f"""
with {CLAIMS_SQL},
v as (select target, field, value_key, count(*) as alln, count_if(scope = 'target') as own, min(id) as cited, min(case when scope = 'target' then id end) as own_tie from claims group by all),
c as (select *, max(own) over (partition by target, field) as any_own, count(*) over (partition by target, field) as n_values from v),
r as (select *, case when any_own > 0 then own else alln end as votes, row_number() over (partition by target, field order by case when any_own > 0 then own else alln end desc, case when any_own > 0 then own_tie else cited end nulls last) as rn from c)
select target, field, value_key, votes, n_values, cited from r where rn = 1""")
def agg_observation_vote(t: Tables) -> DataFrame:
    """AGG8, UDF4: each target's fields by the number of observations, without a model."""
    return votes.count_vote(claims(t), ["target", "field"], "value_key", "scope", "id")


@R.add(_URL_VOTE_SQL + "select confidence, count(*) as n, sum(support) as support, count_if(conflict) as conflicts from cellvote group by confidence")
def agg_vote_stats(t: Tables) -> DataFrame:
    """AGG9: what the votes came to."""
    return _cell_votes(t).groupBy("confidence").agg(F.count("*").alias("n"), F.sum("support").alias("support"), F.count_if("conflict").alias("conflicts"))


@R.add(f"""
with {ANSWERS_SQL}, c as (select cluster_id, field, answer, count(*) as votes from answers group by all),
v as (select *, sum(votes) over (partition by cluster_id, field) as voters from c)
select cluster_id, field, answer, votes, cast(voters as bigint) as voters from v where votes * 2 > voters and voters >= 3""")
def agg_majority(t: Tables) -> DataFrame:
    """AGG10: items where one answer has a strict majority of at least three sources."""
    return votes.strict_majority(answers(t), ["cluster_id", "field"], "answer", 3)


@R.add(f"""
with {ANSWERS_SQL}, a as (select cluster_id, field, role, nullif(answer, 'NA') as answer from answers),
g as (select cluster_id, field, count(case when role <> 'reference' then answer end) as given, count_if(role <> 'reference') as asked, count(distinct case when role <> 'reference' then answer end) as kinds, count(case when role = 'reference' then answer end) as reference from a group by all)
select cluster_id, field, case when given = 0 and reference = 0 then 'all_na' when given = 0 then 'reference_only' when kinds > 1 then 'disputed' when given < asked then 'partial' else 'unanimous' end as status from g""")
def agg_cell_status(t: Tables) -> DataFrame:
    """AGG11: how the contenders stand on each item."""
    return votes.cell_status(answers(t).withColumn("answer", F.nullif("answer", F.lit("NA"))), ["cluster_id", "field"], "answer", "role")


@R.add(f"""
with {PAIRS_SQL}, c as (select *, case when x is null and base is null then 'both_na' when x is null then 'missing' when base is null then 'new' when x = base then 'agree' else 'changed' end as k from pairs)
select label, field, count_if(k='both_na') as both_na, count_if(k='agree') as agree, count_if(k='changed') as changed, count_if(k='new') as new, count_if(k='missing') as missing,
  count_if(k='agree') as tp, count_if(k in ('changed','new')) as fp, count_if(k in ('changed','missing')) as fn, count(*) as cells from c group by label, field""")
def agg_confusion(t: Tables) -> DataFrame:
    """AGG12: counters of every source and field against a reference."""
    return votes.confusion(against_reference(t), ["label", "field"], "x", "base")


@R.add(f"""
with {PAIRS_SQL}, c as (select *, case when x is null and base is null then 'both_na' when x is null then 'missing' when base is null then 'new' when x = base then 'agree' else 'changed' end as k from pairs),
g as (select label, field, count_if(k='agree') as tp, count_if(k in ('changed','new')) as fp, count_if(k in ('changed','missing')) as fn, count_if(k in ('agree','both_na')) as r, count(*) as cells from c group by rollup(label, field) having label is not null)
select label, coalesce(field, '*') as field, tp, fp, fn, cells, {_ratio('tp', 'tp + fp')} as precision, {_ratio('tp', 'tp + fn')} as recall, {_ratio('2 * tp', '2 * tp + fp + fn')} as f1, {_ratio('r', 'cells')} as accuracy,
  {_WILSON.format(p='(r::double/cells)', n='cells::double', s='-')} as accuracy_low, {_WILSON.format(p='(r::double/cells)', n='cells::double', s='+')} as accuracy_high from g""")
def agg_metrics(t: Tables) -> DataFrame:
    """AGG13, AGG14: precision, recall, F1, accuracy with Wilson bounds; ``*`` pools the fields (rollup)."""
    return votes.metrics(against_reference(t), "label", "field", "x", "base")


@R.add(f"""
with {ANSWERS_SQL}, w as (select a.label as a, b.label as b, count(*) as common, count_if(a.answer = b.answer) as equal from answers a join answers b using (cluster_id, field) where a.label < b.label group by 1, 2),
n as (select label, count(*) as n from answers group by label)
select w.a, w.b, common, equal, {_ratio('equal', 'common')} as agreement, {_ratio('common', '(x.n + y.n - common)')} as jaccard from w join n x on x.label = w.a join n y on y.label = w.b""")
def agg_pair_agreement(t: Tables) -> DataFrame:
    """AGG15: agreement and overlap of all pairs of sources, in one pass over the items."""
    return votes.pair_agreement(answers(t), ["cluster_id", "field"], "label", "answer")


@R.add(f"""
with {PAIRS_SQL}, u as (select label, target_id, count(x) as answers, count_if(x is not null and x = base) as r from pairs group by label, target_id)
select label, count(*) as units, count_if(answers > 0) as answered, count_if(answers > 0 and r = answers) as all_right, cast(sum(answers) as bigint) as answers, cast(sum(r) as bigint) as right,
  {_ratio('count_if(answers > 0 and r = answers)', 'count_if(answers > 0)')} as all_right_share from u group by label""")
def agg_target_metrics(t: Tables) -> DataFrame:
    """AGG16: targets whose every answer is right, per source."""
    return votes.unit_metrics(against_reference(t), "label", "target_id", "x", "base")


@R.add(f"""
with {PAIRS_SQL} select field, count_if(x is null and base is not null) as missed, count_if(x is not null and base is null) as unsupported, count_if(x <> base) as wrong, count(distinct case when x <> base then label end) as wrong_sources from pairs group by field""")
def agg_diagnosis(t: Tables) -> DataFrame:
    """AGG17: what goes wrong in each field."""
    x, base = F.col("x"), F.col("base")
    return against_reference(t).groupBy("field").agg(F.count_if(x.isNull() & base.isNotNull()).alias("missed"), F.count_if(x.isNotNull() & base.isNull()).alias("unsupported"), F.count_if(x != base).alias("wrong"), F.count_distinct(F.when(x != base, F.col("label"))).alias("wrong_sources"))


@R.add(f"""
with {PAIRS_SQL}, g as (select label, field, avg(case when x is not distinct from base then 1.0 else 0.0 end) >= 0.7 as ok from pairs group by label, field)
select label, bool_and(ok) as passes, count_if(not ok) as failing from g group by label""")
def agg_accuracy_gate(t: Tables) -> DataFrame:
    """AGG18: sources whose accuracy reaches the threshold in every field."""
    per = against_reference(t).groupBy("label", "field").agg((F.avg(F.when(F.col("x").eqNullSafe(F.col("base")), 1.0).otherwise(0.0)) >= 0.7).alias("ok"))
    return per.groupBy("label").agg(F.bool_and("ok").alias("passes"), F.count_if(~F.col("ok")).alias("failing"))


_ONCE = "r as (select distinct on (record_id) * from extraction_results order by record_id, extracted_at, source_id)"


@R.add(f"""
with {_ONCE} select model, count(*) as documents, {_ratio("sum(cast(completeness_score as decimal(18,6)))", "count(completeness_score)")} as mean_completeness, cast(sum(unverified_quotes) as bigint) as unverified_quotes,
  {_ratio("count_if(unverified_quotes = 0)", "count(unverified_quotes)")} as clean_share, {_ratio("sum(cast(processing_time as decimal(18,6)))", "count(processing_time)")} as mean_seconds from r group by model""")
def agg_model_quality(t: Tables) -> DataFrame:
    """AGG19: quality of each model's extractions."""
    return accounting.model_quality(t.extraction_results)


@R.add(f"""
with {CLAIMS_SQL}, g as (select obs_id, count(*) as n from claims group by obs_id)
select o.obs_id, {_DEC.format("least(1.0, 0.3::double + 0.2::double * ((case when coalesce(trim(o.data->>'url'), '') <> '' then 1 else 0 end + case when coalesce(trim(o.data->>'source_date'), '') <> '' then 1 else 0 end) / 2.0::double) + 0.5::double * (coalesce(g.n, 0) / 5.0::double))", 4)} as completeness
from observations o left join g using (obs_id)""")
def agg_completeness(t: Tables) -> DataFrame:
    """AGG20: completeness of observations from context and filled fields."""
    filled = claims(t).groupBy("obs_id").agg(F.count("*").alias("n"))
    d = t.observations.select("obs_id", F.from_json("data", "struct<url:string,source_date:string>").alias("d"))
    joined = d.join(filled, "obs_id", "left")
    return joined.select("obs_id", votes.completeness([], [F.col("d.url"), F.col("d.source_date")], F.coalesce("n", F.lit(0)) / 5).alias("completeness"))


@R.add(f"""
with {_ONCE} select model, count(*) as records, cast(coalesce(sum(cast(cost as decimal(18,6))), 0) as double) as cost, count_if(cost is null) as unknown, cast(coalesce(sum(input_tokens), 0) as bigint) as input_tokens, cast(coalesce(sum(output_tokens), 0) as bigint) as output_tokens from r group by model""")
def agg_accounting(t: Tables) -> DataFrame:
    """AGG28: cost and tokens, each record once."""
    return accounting.run_costs(t.extraction_results)


@R.add(f"with {_ONCE} select model, cast(case when count(input_tokens) = count(*) then sum(input_tokens) end as bigint) as input_tokens, cast(case when count(output_tokens) = count(*) then sum(output_tokens) end as bigint) as output_tokens from r group by model")
def agg_usage(t: Tables) -> DataFrame:
    """AGG30: sums that are unknown if a part is unknown."""
    return accounting.total_usage(t.extraction_results)


@R.add("""
select a.source, a.status, count(*) as n, cast(coalesce(sum(s.size), 0) as bigint) as bytes, cast(grouping(a.source) as int) as all_groups, cast(grouping(a.status) as int) as all_statuses
from digger_artifacts a left join captured_sources s using (artifact_id) group by grouping sets ((a.source, a.status), (a.source), ())""")
def agg_download_summary(t: Tables) -> DataFrame:
    """AGG22: artifacts and bytes by source and status, with totals."""
    df = t.digger_artifacts.select("artifact_id", "source", "status").join(t.captured_sources.select("artifact_id", "size"), "artifact_id", "left")
    out = accounting.status_counts(df, "source", "status", "size")
    return out.withColumns({"all_groups": F.col("all_groups").cast("int"), "all_statuses": F.col("all_statuses").cast("int")})


@R.add("""
with p as (select t.roster, t.target_id, count(a.artifact_id) as n from targets t left join digger_artifacts a on a.target_id = t.target_id and a.status = 'captured' group by 1, 2)
select roster, count(*) as targets, count_if(n > 0) as covered, """ + _ratio("count_if(n > 0)", "count(*)") + """ as coverage, count_if(n > 0) >= 0.8 * count(*) as enough from p group by roster""")
def agg_search_coverage(t: Tables) -> DataFrame:
    """AGG23: share of targets with a captured artifact."""
    got = t.digger_artifacts.where("status = 'captured'").groupBy("target_id").agg(F.count("*").alias("n"))
    p = t.targets.select("roster", "target_id").join(got, "target_id", "left")
    return p.groupBy("roster").agg(F.count("*").alias("targets"), F.count("n").alias("covered"), ratio(F.count("n"), F.count("*")).alias("coverage"), (F.count("n") >= 0.8 * F.count("*")).alias("enough"))


@R.add("""
with m as (select record_id, unnest(validation_notes) as note from extraction_results)
select case when regexp_matches(lower(note), 'timed? ?out|deadline') then 'timeout' when regexp_matches(lower(note), 'rate.?limit|too many requests|429') then 'rate_limit' when regexp_matches(lower(note), 'connection|network|dns|reset') then 'network'
  when regexp_matches(lower(note), 'not found|404') then 'not_found' when regexp_matches(lower(note), 'forbidden|unauthorized|40[13]') then 'denied' when regexp_matches(lower(note), 'parse|decode|json|schema') then 'parse' else 'other' end as kind,
  count(*) as n, count(distinct note) as kinds_of_text from m where note is not null group by 1""")
def agg_error_rollup(t: Tables) -> DataFrame:
    """AGG21, CAT2: notes by kind."""
    return accounting.error_rollup(t.extraction_results.select(F.explode("validation_notes").alias("note")), "note")


@R.add("""
with l as (select unnest([struct_pack(c := 'source', v := source), struct_pack(c := 'lang', v := lang), struct_pack(c := 'target_id', v := target_id)], recursive := true) from documents),
n as (select c as "column", v as value, count(*) as n, row_number() over (partition by c order by v nulls last) as rn from l group by c, v)
select "column", count(value) as different, cast(coalesce(sum(case when value is null then n end), 0) as bigint) as missing, string_agg(case when rn <= 4 then value end, ', ' order by rn) as examples from n group by "column" """)
def agg_mixed_lineage(t: Tables) -> DataFrame:
    """AGG29: different and missing values of lineage columns."""
    return accounting.mixed_lineage(t.documents, ["source", "lang", "target_id"])


@R.add("""
select target_id, count(*) as outcomes, bool_and(not coalesce(status in ('pending', 'retry', 'discovered'), false)) as complete from digger_artifacts where target_id is not null group by target_id""")
def agg_completions(t: Tables) -> DataFrame:
    """AGG26, AGG27: targets without an outcome that asks for another try."""
    retry = F.coalesce(F.col("status").isin("pending", "retry", "discovered"), F.lit(False))
    return accounting.completions(t.digger_artifacts.where("target_id is not null"), "target_id", retry)


@R.add("""
with s as (select source, n_chars, row_number() over (partition by source order by doc_id) as rn from documents where n_chars is not null and source is not null),
a as (select source, avg(n_chars) as mean from s where rn <= 5 group by source), c as (select source, count(*) as n from documents where source is not null group by source)
select source, n, cast(round(cast(mean * n / 4.0 / 1000000 * 2.5 as decimal(38,12)), 6) as double) as dollars from a join c using (source)""")
def agg_cost_estimate(t: Tables) -> DataFrame:
    """AGG34, MTH6: cost of each source from the mean of its first five documents."""
    from pyspark.sql import Window

    d = t.documents.where("source is not null")
    head = d.where("n_chars is not null").withColumn("rn", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).where("rn <= 5").groupBy("source").agg(F.avg("n_chars").alias("mean"))
    return d.groupBy("source").agg(F.count("*").alias("n")).join(head, "source").select("source", "n", exact(F.col("mean") * F.col("n") / 4.0 / 1000000 * 2.5).alias("dollars"))


@R.add("select field, count(*) as n, " + _WILSON.format(p="(count_if(conflict)::double/count(*))", n="count(*)::double", s="-") + " as low, " + _WILSON.format(p="(count_if(conflict)::double/count(*))", n="count(*)::double", s="+") + " as high from cells group by field")
def mth_wilson(t: Tables) -> DataFrame:
    """MTH4: interval of the share of conflicts."""
    k, n = F.count_if("conflict"), F.count("*")
    return t.cells.groupBy("field").agg(n.alias("n"), wilson(k, n, False).alias("low"), wilson(k, n, True).alias("high"))
