"""Queries: validation lines, manifests, accounting, publication and garbage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.operators import manifests, validation
from docketlake.plans.common import ANSWERS_SQL, answers
from docketlake.plans.registry import Registry, Tables

R = Registry()

_LINES_SQL = f"""
with {ANSWERS_SQL}, a as (select cluster_id, field, label, role, nullif(answer, 'NA') as v from answers),
n as (select count(distinct label) - 1 as n from a where role in ('primary', 'challenger')),
g as (select cluster_id, bool_or(role = 'primary') as mine, count(distinct case when role = 'challenger' then label end) as others, bool_or(role = 'reference') as referred from a group by 1),
rec as (select cluster_id, case when mine then 'extra_row' else 'missing_row' end as state, case when mine then case when others = 0 and not referred and n > 0 then case when n >= 2 then 'high' else 'medium' end end
  when others >= 2 and 2 * others > n then 'high' when others > 0 then 'medium' when referred then 'low' end as priority, case when not mine and referred then 'extraction' else '' end as miss from g, n),
p as (select cluster_id, field, v as mine from a where role = 'primary'), c as (select cluster_id, field, v, count(*) as n from a where v is not null group by all),
s as (select cluster_id, field, count(v) as valued, count_if(v is not null and role <> 'reference') as given, count(distinct v) as kinds, count(*) as held, bool_or(v is not null and role = 'reference') as referred from a group by all),
q as (select a.cluster_id, a.field, a.role = 'reference' as ref, p.mine, a.v as base, coalesce(c.n, 0) as same from a join p using (cluster_id, field) left join c on c.cluster_id = a.cluster_id and c.field = a.field and c.v = p.mine where a.role <> 'primary'),
u as (select cluster_id, field, min(case when mine is null and base is null then 4 when mine is null then case when ref then 3 else 2 end when base is null then case when same > 1 and not ref then 3 else 2 end when mine = base then 3 else 1 end) as r from q group by all),
cell as (select cluster_id, field, case when valued = 0 then 'all_na' when given = 0 then 'reference_only' when kinds > 1 then 'disputed' when valued = held then 'unanimous' else 'partial' end as state,
  ['high', 'medium', 'low', 'none'][coalesce(r, case when mine is not null then 3 else 4 end)] as priority, case when mine is null and referred then 'extraction' else '' end as miss from p join s using (cluster_id, field) left join u using (cluster_id, field)),
l as (select cluster_id, '*' as field, state, priority, miss from rec where priority is not null union all select * from cell)"""


def _lines(t: Tables) -> DataFrame:
    a = answers(t).withColumn("answer", F.nullif("answer", F.lit("NA")))
    records = validation.record_lines(a, "cluster_id", "label", "role").select("cluster_id", F.lit("*").alias("field"), "state", "priority", "miss")
    return records.unionByName(validation.cell_lines(a, ["cluster_id", "field"], "label", "role", "answer"))


@R.add(_LINES_SQL + " select cluster_id, field, state, priority, miss from l")
def val_lines(t: Tables) -> DataFrame:
    """CMP33, CMP34, CAT1: cell lines by the whole priority table, and records the primary source lacks or has alone."""
    return _lines(t)


@R.add(_LINES_SQL + """
select cluster_id, field, row_number() over (order by list_position(['high', 'medium', 'low', 'none'], priority), '{"cluster_id":' || cluster_id || ',"field":"' || field || '"}', state) as place from l""")
def val_review_order(t: Tables) -> DataFrame:
    """SRT4, SNK6: validation lines in the order of review: priority, key as JSON, content."""
    return validation.in_review_order(_lines(t), ["cluster_id", "field"]).select("cluster_id", "field", "place")


@R.add(_LINES_SQL + " select field, priority, count(*) as lines, count_if(miss = 'extraction') as missed from l group by rollup(field, priority) having field is not null")
def val_summary(t: Tables) -> DataFrame:
    """CMP36, AGG17: lines and missed answers per field and priority, with the totals of each field."""
    return _lines(t).rollup("field", "priority").agg(F.count("*").alias("lines"), F.count_if(F.col("miss") == "extraction").alias("missed")).where("field is not null")


_RUNS_SQL = """
e as (select distinct record_id, source_id, model, cost, input_tokens, output_tokens, extracted_at from extraction_results),
m as (select 'extract' as stage, model || '/' || cast(cast(extracted_at as date) as varchar) as run_id, 'runs/' || model as path, count(*) as calls, coalesce(sum(input_tokens), 0) + coalesce(sum(output_tokens), 0) as tokens, sum(cast(cost as decimal(18,6))) as cost from e where extracted_at is not null group by all
  union all select 'discover', 'batch-' || batch_no, 'runs', count(*), 0, 0 from digger_artifacts where batch_no is not null group by batch_no),
r as (select 'extract' as stage, model || '/' || cast(cast(extracted_at as date) as varchar) as run_id, record_id as attempt_id, coalesce(input_tokens, 0) + coalesce(output_tokens, 0) as tokens, cast(cost as decimal(18,6)) as cost from e where extracted_at is not null and status_ok
  union all select 'reconcile', 'note', 'n' || source_id, 1, 0.5 from captured_texts where page_count is null)"""


@R.add("with " + _RUNS_SQL.replace("extracted_at from extraction_results", "extracted_at, status <> 'partial' as status_ok from extraction_results") + """,
a as (select stage, run_id, attempt_id, max({'tokens': tokens, 'cost': cost}) as x from r group by all), s as (select stage, run_id, count(*) as rc, sum(x.tokens) as rt, sum(coalesce(x.cost, 0)) as rm from a group by all),
b as (select coalesce(m.stage, s.stage) as stage, rc is not null as by_, coalesce(rc, calls, 0) as calls, coalesce(rt, tokens, 0) as tokens, coalesce(rm, cost, 0) as cost from m full join s on s.stage = m.stage and s.run_id = m.run_id)
select coalesce(stage, '*') as stage, count(*) as runs, cast(sum(calls) as bigint) as calls, cast(sum(tokens) as bigint) as tokens, cast(sum(cost) as double) as cost, count_if(by_) as from_receipts from b group by rollup(stage)""")
def acc_pipeline(t: Tables) -> DataFrame:
    """AGG28, SRC23: usage over discovery, extraction and reconciliation; receipts before manifests, each once.

    Days of a model stand in for extraction runs, their records for receipts, batches for discovery runs.
    """
    e = t.extraction_results.select("record_id", "source_id", "model", "cost", "input_tokens", "output_tokens", "extracted_at", (F.col("status") != "partial").alias("ok")).distinct().where("extracted_at is not null")
    run = F.concat_ws("/", "model", F.col("extracted_at").cast("date").cast("string")).alias("run_id")
    tokens = F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))
    extract = e.groupBy(F.lit("extract").alias("stage"), run, F.concat(F.lit("runs/"), "model").alias("path")).agg(F.count("*").alias("calls"), F.sum(tokens).alias("tokens"), F.sum(F.col("cost").cast("decimal(18,6)")).alias("cost"))
    discover = t.digger_artifacts.where("batch_no is not null").groupBy(F.lit("discover").alias("stage"), F.concat(F.lit("batch-"), F.col("batch_no").cast("string")).alias("run_id"), F.lit("runs").alias("path")).agg(F.count("*").alias("calls"), F.lit(0).alias("tokens"), F.lit(0).alias("cost"))
    receipts = e.where("ok").select(F.lit("extract").alias("stage"), run, F.col("record_id").alias("attempt_id"), tokens.alias("tokens"), F.col("cost").cast("decimal(18,6)").alias("cost"))
    notes = t.captured_texts.where("page_count is null").select(F.lit("reconcile").alias("stage"), F.lit("note").alias("run_id"), F.concat(F.lit("n"), F.col("source_id").cast("string")).alias("attempt_id"), F.lit(1).alias("tokens"), F.lit(0.5).cast("decimal(18,6)").alias("cost"))
    return manifests.pipeline_accounting(extract.unionByName(discover), receipts.unionByName(notes))


_FILES_SQL = """
f as (select coalesce(a.target_id, 'none') as run_id, 'f' || lpad(cast(s.source_id as varchar), 12, '0') as path, nullif(lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{64})', 1)), '') as inode, s.size from captured_sources s join digger_artifacts a using (artifact_id)),
k as (select distinct target as run_id from observations where target is not null)"""


def _files(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Targets stand in for runs, equal bytes for hard links, observations for the checkpoint's entries."""
    digest = F.nullif(F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)), F.lit(""))
    files = t.captured_sources.select("artifact_id", F.concat(F.lit("f"), F.lpad(F.col("source_id").cast("string"), 12, "0")).alias("path"), digest.alias("inode"), "size").join(t.digger_artifacts.select("artifact_id", F.coalesce("target_id", F.lit("none")).alias("run_id")), "artifact_id")
    return files.drop("artifact_id"), t.observations.select(F.col("target").alias("run_id")).where("run_id is not null")


@R.add(f"""
with {_FILES_SQL}, g as (select f.* from f anti join k using (run_id)), h as (select distinct inode from f semi join k using (run_id) where inode is not null),
r as (select *, inode is null or (row_number() over (partition by inode order by path, run_id) = 1 and inode not in (select inode from h)) as counts from g)
select run_id, count(*) as files, cast(coalesce(sum(case when counts then size end), 0) as bigint) as bytes from r group by run_id""")
def gc_orphans(t: Tables) -> DataFrame:
    """CMP19, AGG38, SNK14: runs that nothing refers to and the bytes they alone hold, hard links counted once."""
    return manifests.orphaned(*_files(t))


@R.add("""
with p as (select o.target, o.record_id, x.extracted_at from observations o join (select distinct record_id, extracted_at from extraction_results) x using (record_id) where o.target is not null), d as (select distinct target, record_id, extracted_at from p)
select target, record_id from (select *, row_number() over (partition by target order by extracted_at desc nulls last, record_id desc) as n from d) where n > 3""")
def gc_retention(t: Tables) -> DataFrame:
    """SNK14: records of a target beyond its three newest."""
    d = t.observations.where("target is not null").select("target", "record_id").join(t.extraction_results.select("record_id", "extracted_at").distinct(), "record_id")
    return manifests.retained(d, "target", "extracted_at", "record_id", 3)


@R.add("""
with e as (select target_id as owner, bool_or(status is null or status = 'discovered') as incomplete, list(url) filter (status = 'captured' and url is not null) as artifacts, list(url) filter (coalesce(status, '') <> 'captured' and url is not null) as outcomes from digger_artifacts where target_id is not null group by 1),
u as (select incomplete, unnest(case when incomplete then outcomes else artifacts end) as path from e) select path, bool_or(incomplete) as incomplete from u group by path""")
def gc_reachable_paths(t: Tables) -> DataFrame:
    """CMP19: files that the checkpoint's entries refer to."""
    a = t.digger_artifacts.where("target_id is not null")
    taken = F.col("status") == "captured"
    e = a.groupBy(F.col("target_id").alias("owner")).agg(F.bool_or(F.col("status").isNull() | (F.col("status") == "discovered")).alias("incomplete"), F.collect_set(F.when(taken, F.col("url"))).alias("artifacts"), F.collect_set(F.when(~F.coalesce(taken, F.lit(False)), F.col("url"))).alias("outcomes"))
    return manifests.reachable_paths(e.withColumn("curated", F.array().cast("array<string>")))


@R.add("select 'r1' as run_id, 'compile' as stage, 'rosters' as \"table\", count(*) as rows from rosters union all select 'r1', 'compile', 'targets', count(*) from targets")
def snk_run_manifest(t: Tables) -> DataFrame:
    """SNK11: the manifest rows of a run's tables."""
    return manifests.run_manifest({"targets": t.targets, "rosters": t.rosters}, "r1", "compile").drop("digest")


@R.add("select target_id, roster, coalesce(state, 'NA') as state from targets")
def snk_published(t: Tables) -> DataFrame:
    """SNK4, SNK5, CMP15: a table published through the journal and read again."""
    from uuid import uuid4

    from docketlake.session import checkpoint_dir
    from docketlake.sources.publication import Publisher

    output = f"{checkpoint_dir(t._spark)}/published-{uuid4().hex}/out"
    Publisher(t._spark, output).publish({"targets": t.targets.select("target_id", "roster", F.coalesce("state", F.lit("NA")).alias("state"))})
    return t._spark.read.parquet(f"{output}/targets")
