"""Queries: searches and caches, screening, pairing, index rows and run states."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions import text, urls
from docketlake.operators import joins, ranking, screening
from docketlake.plans import pipelines
from docketlake.plans.common import ANSWERS_SQL, CLAIMS_SQL, answers, claims
from docketlake.plans.registry import Registry, Tables
from docketlake.sources import documents, external

R = Registry()


@R.add("""
with s as (select target_id, name, urls[1] as u, urls[2] as v from targets where len(urls) >= 2)
select target_id, 'organic' as kind, 0 as pos, u as url, name as title from s union all select target_id, 'news', 0, v, 'a ' || name from s union all select target_id, 'news', 0, u, 'b ' || name from s union all select target_id, 'news', 1, v, name from s""")
def src_search_results(t: Tables) -> DataFrame:
    """SRC4: saved search responses as uniform candidates; nested stories are flattened, in place of the news item."""
    item = lambda title, link: F.struct(title.alias("title"), link.alias("link"))
    u, v, n = F.get("urls", F.lit(0)), F.get("urls", F.lit(1)), F.col("name")
    a, b = F.concat(F.lit("a "), n), F.concat(F.lit("b "), n)
    none = F.array().cast("array<struct<title:string,link:string>>")
    news = F.array(F.struct(n.alias("title"), v.alias("link"), F.array(item(a, v), item(b, u)).alias("stories")), F.struct(n.alias("title"), v.alias("link"), none.alias("stories")))
    body = F.to_json(F.struct(F.array(item(n, u)).alias("organic_results"), news.alias("news_results")))
    saved = t.targets.where("size(urls) >= 2").select("target_id", body.alias("body"))
    return documents.search_results(saved, "body", "target_id").select("target_id", "kind", "pos", "url", "title")


@R.add("""
with q as (select target_id, substr(sha256(target_id || chr(31) || coalesce(query, '')), 1, 24) as key from targets), c as (select substr(sha256(t.target_id || chr(31) || coalesce(t.query, '')), 1, 24) as key, a.discovered_at as fetched_at from digger_artifacts a join targets t using (target_id) where a.source = 'search')
select target_id, key from q where not exists (select 1 from c where c.key = q.key and c.fetched_at > timestamp '2024-09-01' - interval 90 days)""")
def src_uncached(t: Tables) -> DataFrame:
    """SRC5: searches without a cached answer that is young enough; the key is a digest of the parameters."""
    asked = t.targets.select("target_id", external.request_key(F.col("target_id"), F.coalesce("query", F.lit(""))).alias("key"))
    cache = t.digger_artifacts.where("source = 'search'").select("target_id", F.col("discovered_at").alias("fetched_at")).join(asked, "target_id").select("key", "fetched_at")
    return external.uncached(asked, cache, "key", 90, "2024-09-01")


@R.add("""
select target_id, coalesce(nullif(trim(query), ''), name || ' ' || coalesce(state || ' ', '') || 'permits') as search, name || coalesce(', ' || state, '') as label, len(list_distinct(list_filter(coalesce(urls, []), lambda u: regexp_matches(u, '^(?i)https?://')))) as configured from targets where name is not null""")
def cmp_search_inputs(t: Tables) -> DataFrame:
    """CMP5: what is searched for each target (its own query before the template), its label and its configured addresses."""
    search = F.coalesce(F.nullif(F.trim("query"), F.lit("")), F.concat_ws(" ", "name", "state", F.lit("permits")))
    web = F.array_distinct(F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: urls.is_http(u)))
    return t.targets.where("name is not null").select("target_id", search.alias("search"), F.concat_ws(", ", "name", "state").alias("label"), F.size(web).cast("bigint").alias("configured"))


@R.add("""
with t as (select target_id, roster, state, list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: w <> '') as w from targets where name is not null), f as (select *, array_to_string(w, ' ') as form from t where len(w) > 0),
k as (select form, count(distinct target_id) as n, count(distinct coalesce(roster, '')) as r, count(distinct coalesce(state, '')) as s from f group by form)
select target_id, form, w[1] as head, len(w) as words, n - 1 as namesakes, concat_ws(',', case when r > 1 then 'roster' end, case when s > 1 then 'state' end) as told_by from f join k using (form)""")
def jn_roster_names(t: Tables) -> DataFrame:
    """CMP37: names of the roster with their heads, their namesakes and what tells these apart."""
    return joins.roster_names(t.targets, "target_id", "name", ["roster", "state"])


_BARE = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"


@R.add(f"""
with j as (select a.artifact_id, a.url, regexp_replace(lower(t.name), '^(city|village) of | (county|township|parish)$', '', 'g') as term, '-' || lower(t.state) as st from digger_artifacts a join targets t using (target_id) where a.url is not null and t.name is not null),
h as (select artifact_id, contains(lower(url), 'minutes') or contains({_BARE.format('url')}, 'minutes') as bad, st is null or contains(lower(url), st) or contains({_BARE.format('url')}, {_BARE.format('st')}) as every, contains(lower(url), term) or contains({_BARE.format('url')}, {_BARE.format('term')}) as one from j)
select artifact_id, case when bad then 'excluded' when not every then 'missing_required' when not one then 'no_identity' end as reason from h""")
def flt_identity_terms(t: Tables) -> DataFrame:
    """FLT4: templated terms: one that excludes, all that are required, one of several; punctuation does not matter."""
    j = t.digger_artifacts.where("url is not null").select("artifact_id", "target_id", "url").join(t.targets.where("name is not null").select("target_id", "name", "state"), "target_id")
    name = F.regexp_replace(F.lower("name"), "^(city|village) of | (county|township|parish)$", "")
    return j.select("artifact_id", screening.identity_gate(F.col("url"), [name], [F.concat(F.lit("-"), "state")], [F.lit("minutes")]).alias("reason"))


_GEOMETRY = """
l as (select l_orderkey as doc, l_linenumber as line_no, 50.0::double as x0, 50.0::double + l_quantity::double * 8 as x1, l_linenumber * 20.0::double as y0, 12.0::double as height from lineitem),
m as (select l_orderkey as doc, l_linenumber as mark_no, 60.0::double as x0, 60.0::double + l_suppkey % 97 * 3.0::double as x1, l_linenumber * 20.0::double + l_partkey % 12 as y from lineitem),
c as (select distinct doc, line_no, mark_no from l join m using (doc) where m.x1 > m.x0 and (y - y0) / height between 0.35 and 0.68 and (least(l.x1, m.x1) - greatest(l.x0, m.x0)) / (m.x1 - m.x0) >= 0.8)"""


def _geometry(t: Tables) -> tuple[DataFrame, DataFrame]:
    d = lambda c: F.col(c).cast("double")
    y0 = F.col("l_linenumber") * 20.0
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line_no"), F.lit(50.0).alias("x0"), (50.0 + d("l_quantity") * 8).alias("x1"), y0.alias("y0"), F.lit(12.0).alias("height"))
    marks = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("mark_no"), F.lit(60.0).alias("x0"), (60.0 + F.col("l_suppkey") % 97 * 3.0).alias("x1"), (y0 + F.col("l_partkey") % 12).alias("y"))
    return marks, lines


@R.add(f"with {_GEOMETRY} select doc, line_no, mark_no from c")
def flt_crossed_lines(t: Tables) -> DataFrame:
    """FLT23, CMP25: lines of text that a stroke crosses, by geometry (line items stand in for lines and strokes)."""
    return screening.crossed_lines(*_geometry(t), ["doc"])


@R.add(f"""
with {_GEOMETRY}, n as (select doc, count(*) as n from c group by doc), p as (select l_orderkey as doc, bool_and(l_returnflag <> 'R') as read, bool_or(l_linestatus = 'F' and l_tax = 0) as noted from lineitem group by 1),
e as (select doc, read, concat_ws(',', case when coalesce(n, 0) > 0 then 'strikeout' end, case when noted then 'header' end) as evidence from p left join n using (doc))
select doc, case when evidence <> '' then 'flagged' when not read then 'unknown' else 'no_findings' end as state, evidence from e""")
def flt_revisions(t: Tables) -> DataFrame:
    """FLT23, CMP10: documents with signs of revision, unreadable ones, and the rest."""
    marks, lines = _geometry(t)
    pages = t.lineitem.select(F.col("l_orderkey").alias("doc"), (F.col("l_returnflag") != "R").alias("readable"), ((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0)).alias("noted"))
    return screening.revision_state(pages, screening.crossed_lines(marks, lines, ["doc"]), "doc", "readable", "noted")


@R.add(f"""
with {CLAIMS_SQL}, f as (select obs_id, trim(regexp_replace(strip_accents(lower(value)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as v, trim(regexp_replace(strip_accents(lower(quote)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as q from claims),
g as (select obs_id, v, nullif(q, '') as q, nullif(v, '') as w from f)
select obs_id, count(w) as claims, count(q) as quoted, count_if(q is not null and w is not null and contains(' ' || q || ' ', ' ' || w || ' ')) as verified, bool_and(w is null or (q is not null and contains(' ' || q || ' ', ' ' || w || ' '))) as valid from g group by obs_id""")
def cmp_evidence_contract(t: Tables) -> DataFrame:
    """CMP22: observations whose every value has a quote that holds it (the value is looked for in the quote)."""
    form = lambda c: F.nullif(text.evidence_form(F.col(c)), F.lit(""))
    c = claims(t).select("obs_id", form("value").alias("v"), form("quote").alias("q"))
    stands = F.coalesce(text.contains_quote(F.col("v"), F.col("q")), F.lit(False))
    return c.groupBy("obs_id").agg(F.count("v").alias("claims"), F.count("q").alias("quoted"), F.count_if(stands & F.col("v").isNotNull()).alias("verified"), F.bool_and(F.col("v").isNull() | stands).alias("valid"))


@R.add("""
with c as (select cluster_id, field, count(distinct lower(trim(value))) as n from cells where assessed and value is not null group by all), g as (select case when n > 3 then 'high' when n > 2 then 'medium' else 'low' end as s from c where n > 1), k as (select count_if(s = 'high') as h, count_if(s = 'medium') as m, count(*) as a from g)
select 'suspicious_high' as gate, h as count, h > 0 as fails from k union all select 'suspicious_medium', h + m, h + m > 0 from k union all select 'suspicious_low', a, a > 0 from k union all select 'provenance', 0, false""")
def cmp_gates(t: Tables) -> DataFrame:
    """CMP3: gates of a compile run by the gravest conflicts."""
    c = t.cells.where("assessed and value is not null").groupBy("cluster_id", "field").agg(F.count_distinct(F.lower(F.trim("value"))).alias("n")).where("n > 1")
    return screening.compile_gates(c.select(F.when(F.col("n") > 3, "high").when(F.col("n") > 2, "medium").otherwise("low").alias("severity")), "severity", 0)


@R.add("""
with a as (select roster, lower(trim(name)) as key, count(*) as n, min(item_id) as item_id from roster_items where name is not null group by 1, 2), b as (select roster, lower(trim(name)) as key, count(*) as m, min(target_id) as target_id from targets where name is not null group by 1, 2),
j as (select a.*, b.m, b.target_id, case when m is null then 'alone' when n = 1 and m = 1 then 'paired' else 'ambiguous' end as state from a left join b using (roster, key))
select roster, key, state, case when state = 'paired' then item_id end as item_id, case when state = 'paired' then target_id end as target_id from j""")
def jn_paired_keys(t: Tables) -> DataFrame:
    """JN7: keys that stand once on both sides are paired, repeated ones ambiguous, others alone."""
    key = F.lower(F.trim("name")).alias("key")
    return screening.paired_keys(t.roster_items.where("name is not null").select("roster", key, "item_id"), t.targets.where("name is not null").select("roster", key, "target_id"), ["roster", "key"], "item_id", "target_id")


@R.add("""
with m as (select distinct model, source_id, extracted_at, case when status = 'partial' then 'failed' else 'success' end as status from extraction_results where extracted_at is not null), l as (select model, arg_max(status, (extracted_at, source_id)) as status, arg_max(source_id, (extracted_at, source_id)) as d from m group by model)
select model from l where status = 'success'""")
def cmp_fresh(t: Tables) -> DataFrame:
    """CMP31: tables whose newest manifest succeeded and still has the digest and fingerprint of now (models stand in for tables)."""
    m = t.extraction_results.where("extracted_at is not null").select("model", "extracted_at", F.col("source_id").alias("digest"), F.when(F.col("status") == "partial", "failed").otherwise("success").alias("status"), F.lit("b1").alias("fingerprint")).distinct()
    now = m.groupBy("model").agg(F.max_by("digest", F.struct("extracted_at", "digest")).alias("digest")).withColumn("fingerprint", F.lit("b1"))
    return pipelines.fresh(m, "model", "extracted_at", "digest", "fingerprint", now)


@R.add("""
with r as (select *, row_number() over (partition by target_id order by size desc nulls last, source_id) as place from (select a.target_id, s.source_id, s.size, a.url, a.mime_type from captured_sources s join digger_artifacts a using (artifact_id) where a.target_id is not null))
select target_id, source_id, '{' || concat_ws(',', '"url":"' || url || '"', '"mime_type":"' || mime_type || '"') || '}' as evidence, place from r""")
def prj_index_rows(t: Tables) -> DataFrame:
    """PRJ12: index rows with JSON columns in the order of target and falling relevance."""
    j = t.captured_sources.select("source_id", "artifact_id", "size").join(t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id", "url", "mime_type"), "artifact_id")
    rows = j.select("target_id", "source_id", "size", F.to_json(F.struct("url", "mime_type")).alias("evidence"))
    return ranking.place_within(rows, ["target_id"], [F.col("size").desc_nulls_last(), F.col("source_id")]).drop("size")


@R.add("select target, record_id, source from observations where record_id is not null and obs_id <= (select max(obs_id) from observations) union select target, record_id, source from observations where record_id is not null and data like '%\"scope\": \"target\"%'")
def set_window_union(t: Tables) -> DataFrame:
    """SET2: items of overlapping windows of a document as one set."""
    o = t.observations.where("record_id is not null")
    return o.select("target", "record_id", "source").unionByName(o.where(F.col("data").contains('"scope": "target"')).select("target", "record_id", "source")).distinct()


@R.add("select source_id, row_number() over (order by original, source_id) as place from captured_sources where original is not null")
def srt_merge_order(t: Tables) -> DataFrame:
    """SRT5: index rows in the order of their paths."""
    return ranking.with_place(t.captured_sources.where("original is not null").select("source_id", "original"), [F.col("original"), F.col("source_id")]).select("source_id", "place")


@R.add("select item_id, roster, row_number() over (partition by roster order by entered_at nulls first, item_id) as place from roster_items")
def srt_roster_order(t: Tables) -> DataFrame:
    """SRT6: roster rows back in the order they came in."""
    return ranking.place_within(t.roster_items.select("item_id", "roster", "entered_at"), ["roster"], [F.col("entered_at").asc_nulls_first(), F.col("item_id")]).drop("entered_at")


@R.add("""
select obs_id, try_cast(regexp_extract(data->>'source_date', '^(\\d{4}-\\d{2}-\\d{2})', 1) as date) is not null as dated, coalesce(try_cast(regexp_extract(data->>'source_date', '^(\\d{4}-\\d{2}-\\d{2})', 1) as date) < date '2020-01-01', false) as old from observations where data like '{%'""")
def dat_nested_date(t: Tables) -> DataFrame:
    """DAT3: dates at a nested path that are dates, and those before a bound."""
    d = F.regexp_extract(F.get_json_object("data", "$.source_date"), r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    return t.observations.where("data like '{%'").select("obs_id", d.isNotNull().alias("dated"), F.coalesce(d < F.lit("2020-01-01").cast("date"), F.lit(False)).alias("old"))


@R.add("""
with k as (select obs_id, unnest(['permit_fee', 'review_days', 'setback_ft', 'contact_office', 'online_permitting', 'required_documents']) as k, data->'item' as i from observations where data like '{%')
select obs_id, count(*) as kept from k where json_type(i, '$.' || k) is not null and json_type(i, '$.' || k) <> 'NULL' group by obs_id""")
def map_compact(t: Tables) -> DataFrame:
    """MAP2: maps without their null entries."""
    item = F.from_json(F.get_json_object("data", "$.item"), "map<string,string>")
    kept = F.map_filter(item, lambda k, v: v.isNotNull() & k.isin("permit_fee", "review_days", "setback_ft", "contact_office", "online_permitting", "required_documents"))
    return t.observations.where("data like '{%'").select("obs_id", F.size(kept).cast("bigint").alias("kept")).where("kept > 0")


@R.add("""
with r as (select distinct record_id, source_id, status, cost, input_tokens, output_tokens, unverified_quotes from extraction_results)
select status, count(*) as records, cast(coalesce(sum(cast(cost as decimal(18,6))), 0) as double) as cost, coalesce(sum(input_tokens + output_tokens), 0)::bigint as tokens, count_if(unverified_quotes > 0) as doubtful from r group by status""")
def agg_run_states(t: Tables) -> DataFrame:
    """AGG9: states of a run with their costs."""
    r = t.extraction_results.select("record_id", "source_id", "status", "cost", "input_tokens", "output_tokens", "unverified_quotes").distinct()
    return r.groupBy("status").agg(F.count("*").alias("records"), F.coalesce(F.sum(F.col("cost").cast("decimal(18,6)")), F.lit(0)).cast("double").alias("cost"), F.coalesce(F.sum(F.col("input_tokens") + F.col("output_tokens")), F.lit(0)).alias("tokens"), F.count_if(F.col("unverified_quotes") > 0).alias("doubtful"))


@R.add(f"""
with {ANSWERS_SQL}, covered as (select distinct target from observations where target is not null), a as (select field, role, nullif(answer, 'NA') as v, target_id, cluster_id from answers),
c as (select cluster_id, field, max(case when role = 'primary' then v end) as mine, bool_or(role = 'primary') as asked, max(case when role = 'reference' then v end) as base, max(target_id) as target_id from a group by all)
select field, count_if(base is not null and mine is null and o.target is not null) as missed_extraction, count_if(base is not null and mine is null and o.target is null) as missed_no_docs, count_if(base is not null and mine <> base) as wrong, count_if(base is null and mine is not null) as candidate_updates from c left join covered o on o.target = c.target_id group by field""")
def agg_diagnosis_by_docs(t: Tables) -> DataFrame:
    """AGG17: why fields are missed: nothing was extracted, or there was no document of the target; wrong ones and news."""
    a = answers(t).withColumn("answer", F.nullif("answer", F.lit("NA")))
    of = lambda role: F.max(F.when(F.col("role") == role, F.col("answer")))
    c = a.groupBy("cluster_id", "field").agg(of("primary").alias("mine"), of("reference").alias("base"), F.max("target_id").alias("target_id"))
    covered = t.observations.where("target is not null").select(F.col("target").alias("target_id")).distinct().withColumn("docs", F.lit(True))
    j = c.join(covered, "target_id", "left")
    missed = F.col("base").isNotNull() & F.col("mine").isNull()
    return j.groupBy("field").agg(F.count_if(missed & F.col("docs").isNotNull()).alias("missed_extraction"), F.count_if(missed & F.col("docs").isNull()).alias("missed_no_docs"), F.count_if(F.col("mine") != F.col("base")).alias("wrong"), F.count_if(F.col("base").isNull() & F.col("mine").isNotNull()).alias("candidate_updates"))


@R.add("select artifact_id, 'See ' || url || case when contains(url, '?') then '&' else '?' end || 'token=REDACTED&x=1 or https://REDACTED@h.example/a for details' as message from digger_artifacts where url is not null")
def str_redacted_text(t: Tables) -> DataFrame:
    """STR12: secrets in addresses within a text blanked out."""
    message = F.concat(F.lit("See "), "url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("token=abc123&x=1 or https://me:pass@h.example/a for details"))
    return t.digger_artifacts.where("url is not null").select("artifact_id", urls.redacted_in_text(message).alias("message"))


@R.add()
def win_chunk_starts(t: Tables) -> DataFrame:
    """WIN14: where to cut recordings: the quietest second near each mark (each cut depends on the last, so no SQL; tested
    against a plain walk). Values of a user's events stand in for levels."""
    levels = t.events.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", F.col("value").cast("double").alias("v")))), lambda x: x["v"]).alias("levels"))
    return levels.select("user_id", external.cut_points_of(F.col("levels"), 5, 2).alias("starts"))


@R.add()
def str_review_windows(t: Tables) -> DataFrame:
    """STR17: review samples: head, windows around keywords, body windows, tail (sequential, so no SQL; tested on made cases)."""
    return t.documents.where("text is not null").select("doc_id", text.review_sample(F.col("text"), 1200, ["permit", "setback"]).alias("sample"))


@R.add("""
with r as (select distinct record_id, source_id, status, unverified_quotes from extraction_results), x as (select source_id, sha256 = sha256(text) as same from captured_texts where text is not null)
select r.record_id from r join captured_sources s using (source_id) join x using (source_id) where r.status <> 'partial' and r.unverified_quotes = 0 and s.size > 0 and x.same""")
def flt_reuse_proof(t: Tables) -> DataFrame:
    """FLT21, CMP23: records that may be used again: whole, quotes verified, and the text's digest is that of the text at hand."""
    r = t.extraction_results.select("record_id", "source_id", "status", "unverified_quotes").distinct().where("status != 'partial' and unverified_quotes = 0")
    whole = t.captured_texts.where((F.sha2("text", 256) == F.col("sha256"))).select("source_id")
    return r.join(t.captured_sources.where("size > 0").select("source_id"), "source_id").join(whole, "source_id").select("record_id")
