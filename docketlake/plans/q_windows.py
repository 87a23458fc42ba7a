"""Queries: ranking, caps, budgets, packing, page statistics."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions import measures, urls
from docketlake.operators import ranking, votes
from docketlake.plans.common import CLAIMS_SQL, PAIRS_SQL, against_reference, claims
from docketlake.plans.q_joins import _PAGES_SQL, scored_pages
from docketlake.plans.registry import Registry, Tables

R = Registry()
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"


@R.add("""
with l as (select user_id, event_type, row_number() over (partition by event_type order by value desc, event_id) as rank from events),
f as (select user_id, event_type, rank from l qualify row_number() over (partition by user_id order by rank, event_type) = 1)
select user_id, event_type, rank, row_number() over (order by rank, event_type) as place from f""")
def win_interleave(t: Tables) -> DataFrame:
    """WIN1: ranked lists taken in turns; each key keeps its first place."""
    listed = t.events.withColumn("rank", F.row_number().over(Window.partitionBy("event_type").orderBy(F.col("value").desc(), "event_id"))).select("user_id", "event_type", "rank")
    return ranking.interleaved(listed, "user_id", "rank", "event_type").select("user_id", "event_type", "rank", "place")


@R.add("""
with d as (select source, url, min(artifact_id) as artifact_id from digger_artifacts where url is not null group by source, url)
select source, url, artifact_id from d qualify row_number() over (partition by source order by artifact_id) <= 20""")
def win_query_limit(t: Tables) -> DataFrame:
    """WIN2: each list without repeats, then its first twenty."""
    d = t.digger_artifacts.where("url is not null").groupBy("source", "url").agg(F.min("artifact_id").alias("artifact_id"))
    return d.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy("artifact_id"))).where("_n <= 20").drop("_n")


@R.add(f"""
with h as (select artifact_id, target_id, {_HOST} as host, extension from digger_artifacts where target_id is not null and url is not null),
a as (select *, row_number() over (partition by target_id, host order by (extension is null)::int, artifact_id desc) as hn from h)
select artifact_id, target_id, row_number() over (partition by target_id order by (extension is null)::int, artifact_id desc) as rank from a where hn <= 2 qualify rank <= 5""")
def win_host_cap(t: Tables) -> DataFrame:
    """WIN3: five candidates a target, two of one host at most."""
    h = t.digger_artifacts.where("target_id is not null and url is not null").select("artifact_id", "target_id", urls.host_of(F.col("url")).alias("host"), "extension")
    order = [F.col("extension").isNull().cast("int"), F.col("artifact_id").desc()]
    return ranking.capped_top(h, ["target_id"], "host", order, 2, 5).select("artifact_id", "target_id", "rank")


_FT = "case lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/[^/]*(\\.[A-Za-z0-9]{1,5})$', 1)) " + " ".join(f"when '{k}' then {v}" for k, v in measures.FILE_TYPE_SCORES.items()) + " else 0.0 end"
_DEC = "cast(round(cast({} as decimal(38,12)), 4) as double)"


@R.add(f"""
with s as (select artifact_id, ({_FT})::double as f, case when ends_with({_HOST}, '.example') then 0.3::double else 0.0::double end as a, (contains(lower(url), 'permit')::int + contains(lower(url), 'guide')::int + contains(lower(url), 'document')::int) as h from digger_artifacts where url is not null),
k as (select *, {_DEC.format("least(1.0::double, 0.3::double * ln(1 + h) / ln(2.0::double))")} as k from s)
select artifact_id, h as hits, k as keyword_score, {_DEC.format("least(1.0::double, greatest(0.0::double, 0.5::double + 0.35::double * f + 0.25::double * a + 0.25::double * k))")} as confidence from k""")
def win_link_scores(t: Tables) -> DataFrame:
    """MTH2: scores of links by file type, authority and keywords."""
    u = F.col("url")
    hits, score = measures.keyword_score(F.lower(u), ["permit", "guide", "document"])
    a = F.when(urls.in_domain(urls.host_of(u), ".example"), 0.3).otherwise(0.0)
    s = t.digger_artifacts.where("url is not null").select("artifact_id", measures.file_type_score(urls.extension_of(u)).alias("f"), a.alias("a"), hits.alias("hits"), score.alias("keyword_score"))
    return s.select("artifact_id", "hits", "keyword_score", measures.link_confidence(F.col("f"), F.col("a"), F.col("keyword_score")).alias("confidence"))


@R.add("""
with d as (select distinct record_id, source_id, completeness_score, unverified_quotes from extraction_results),
j as (select d.record_id, a.target_id, a.url, s.original as path, completeness_score from d join captured_sources s using (source_id) join digger_artifacts a using (artifact_id) where a.target_id is not null),
r as (select *, row_number() over (partition by target_id order by completeness_score desc nulls last, url nulls first, path nulls first, record_id) as rank from j)
select record_id, target_id, rank, rank = 1 as is_primary from r""")
def win_review_rank(t: Tables) -> DataFrame:
    """WIN5: the records of each target in the order of review: relevance, address, path; the first is the primary one."""
    d = t.extraction_results.select("record_id", "source_id", "completeness_score", "unverified_quotes").distinct()
    j = d.join(t.captured_sources.select("source_id", "artifact_id", F.col("original").alias("path")), "source_id").join(t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id", "url"), "artifact_id")
    w = Window.partitionBy("target_id").orderBy(F.col("completeness_score").desc_nulls_last(), "url", "path", "record_id")
    return j.withColumn("rank", F.row_number().over(w)).select("record_id", "target_id", "rank", (F.col("rank") == 1).alias("is_primary"))


@R.add(f"""
with s as (select artifact_id, target_id, ({_FT})::double as f, case when ends_with({_HOST}, '.example') then 0.3::double else 0.0::double end as a, (contains(lower(url), 'permit')::int + contains(lower(url), 'guide')::int + contains(lower(url), 'document')::int) as h from digger_artifacts where url is not null and target_id is not null),
k as (select *, {_DEC.format("least(1.0::double, 0.3::double * ln(1 + h) / ln(2.0::double))")} as k from s), c as (select artifact_id, target_id, {_DEC.format("least(1.0::double, greatest(0.0::double, 0.5::double + 0.35::double * f + 0.25::double * a + 0.25::double * k))")} as confidence from k),
r as (select *, row_number() over (partition by target_id order by artifact_id) as original_rank, row_number() over (partition by target_id order by confidence desc, artifact_id) as rank from c)
select target_id, artifact_id, rank, original_rank from r where rank <= 5""")
def win_link_top(t: Tables) -> DataFrame:
    """WIN4: the five best links of each target, ties in their own order, with the place they had."""
    scores = win_link_scores(t).join(t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id"), "artifact_id")
    return ranking.top_links(scores, ["target_id"], "confidence", "artifact_id", 5).select("target_id", "artifact_id", "rank", "original_rank")


@R.add()
def win_set_cover(t: Tables) -> DataFrame:
    """WIN6: artifacts chosen one by one for the most new fields they tell of (greedy, so no SQL; tested against a plain walk)."""
    d = t.observations.select("target", "obs_id", F.from_json("data", "struct<url:string,item:map<string,string>>").alias("d"))
    rows = d.select("target", "obs_id", F.map_keys(F.map_filter("d.item", lambda k, v: v.isNotNull() & (v != ""))).alias("labels"), F.coalesce(urls.host_of(F.col("d.url")), F.lit("")).alias("host"), F.lit(1.0).alias("relevance"))
    return ranking.set_cover(rows, "target", "labels", "relevance", "host", "obs_id", 3, 2)


@R.add("""
with r as (select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as round from orders)
select o_orderkey, o_custkey, round from r order by round, o_custkey limit 500""")
def win_round_robin(t: Tables) -> DataFrame:
    """WIN7: five hundred downloads staged in turns."""
    return ranking.round_robin(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_custkey", [F.col("o_orderkey")], 500).select("o_orderkey", "o_custkey", "round")


@R.add("select target_id, cast(slot - 1 as int) as slot, url from (select target_id, unnest(urls) as url, generate_subscripts(urls, 1) as slot from targets)")
def win_slots(t: Tables) -> DataFrame:
    """WIN8: jobs by slot, then target."""
    return t.targets.select("target_id", F.posexplode("urls").alias("slot", "url"))


@R.add("""
select l_orderkey, l_linenumber, spent from (select l_orderkey, l_linenumber, l_suppkey, sum(l_quantity) over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity rows unbounded preceding) as spent from lineitem) where spent <= 500""")
def win_budget(t: Tables) -> DataFrame:
    """WIN9: lines of each supplier until the budget is used."""
    return ranking.within_budget(t.lineitem, ["l_suppkey"], "l_quantity", [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")], 500).select("l_orderkey", "l_linenumber", "spent")


@R.add()
def win_batches(t: Tables) -> DataFrame:
    """WIN10: documents of each source packed by number and size (sequential, so no SQL; tested by brute force)."""
    d = t.documents.where("source is not null and n_chars is not null").select("doc_id", "source", "n_chars")
    return ranking.packed(d, "source", "n_chars", "doc_id", 40, 48_000)


@R.add("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from documents where text is not null),
s as (select *, sum(length(trim(line))) over (partition by doc_id order by no rows between 1 following and unbounded following) as after_, sum(length(trim(line))) over (partition by doc_id order by no) as before_ from l)
select doc_id, count(*) as reached from s where coalesce(before_, 0) <= 400 group by doc_id""")
def win_context_reach(t: Tables) -> DataFrame:
    """WIN12: lines from the start within 400 characters of text."""
    lines = t.documents.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    w = Window.partitionBy("doc_id").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("_r", F.sum(F.length(F.trim("line"))).over(w)).where("_r <= 400").groupBy("doc_id").agg(F.count("*").alias("reached"))


@R.add("""
with p as (select source_id, unnest(string_split(text, chr(10) || chr(12) || chr(10))) as x, generate_subscripts(string_split(text, chr(10) || chr(12) || chr(10)), 1) as page from captured_texts),
l as (select source_id, page, list_filter(string_split(x, chr(10)), lambda v: trim(v) <> '') as l from p)
select source_id, page, l[1] as first_line, l[len(l)] as last_line, lag(l[len(l)]) over (partition by source_id order by page) as line_before from l where len(l) > 0""")
def win_page_edges(t: Tables) -> DataFrame:
    """WIN13: first and last line of each page and the last one before it."""
    from docketlake.sources.documents import pages

    p = pages(t.captured_texts, "source_id", "text").select("source_id", F.col("page").cast("bigint").alias("page"), F.filter(F.split("page_text", "\n"), lambda v: F.trim(v) != "").alias("l")).where(F.size("l") > 0)
    last = F.element_at("l", -1)
    return p.select("source_id", "page", F.element_at("l", 1).alias("first_line"), last.alias("last_line"), F.lag(last).over(Window.partitionBy("source_id").orderBy("page")).alias("line_before"))


_PRIORITY = "case when x is null and base is null then 'none' when base is not null and x <> base then 'high' when x is null or base is null then 'medium' else 'low' end"


@R.add(f"with {PAIRS_SQL}, p as (select label, field, cluster_id, {_PRIORITY} as priority from pairs) select label, field, cluster_id, priority, row_number() over (partition by label order by list_position(['high','medium','low','none'], priority), cluster_id, field) as place from p")
def win_priority(t: Tables) -> DataFrame:
    """WIN15: cells in the order in which a person should look."""
    x, base = F.col("x"), F.col("base")
    priority = F.when(x.isNull() & base.isNull(), "none").when(base.isNotNull() & (x != base), "high").when(x.isNull() | base.isNull(), "medium").otherwise("low")
    p = against_reference(t).select("label", "field", "cluster_id", priority.alias("priority"))
    order = F.array_position(F.array(*(F.lit(v) for v in ("high", "medium", "low", "none"))), F.col("priority"))
    return ranking.place_within(p, ["label"], [order, F.col("cluster_id"), F.col("field")])


@R.add(f"""
with {PAIRS_SQL}, f as (select label, field, count_if(x is not distinct from base) as good, count(*) as n from pairs group by 1, 2), r as (select *, row_number() over (partition by label order by good::double / n, field) as weak from f)
select label, cast(sum(good) as bigint) as good, cast(sum(n) as bigint) as n, string_agg(case when weak <= 3 then field end, ', ' order by weak) as weakest from r group by label""")
def win_leaderboard(t: Tables) -> DataFrame:
    """WIN16: sources with their three weakest fields."""
    f = against_reference(t).groupBy("label", "field").agg(F.count_if(F.col("x").eqNullSafe(F.col("base"))).alias("good"), F.count("*").alias("n"))
    w = Window.partitionBy("label").orderBy(F.col("good") / F.col("n"), "field")
    r = f.withColumn("weak", F.row_number().over(w))
    weakest = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("weak") <= 3, F.struct("weak", "field")))), lambda v: v["field"]), ", ")
    return r.groupBy("label").agg(F.sum("good").alias("good"), F.sum("n").alias("n"), weakest.alias("weakest"))


@R.add("""
select status, string_agg(cast(artifact_id as varchar), ',' order by artifact_id) as examples from (select status, artifact_id from digger_artifacts where status is not null qualify row_number() over (partition by status order by artifact_id) <= 10) group by status""")
def win_examples(t: Tables) -> DataFrame:
    """WIN17: the first ten examples of each status."""
    first = t.digger_artifacts.where("status is not null").select("status", "artifact_id").withColumn("_n", F.row_number().over(Window.partitionBy("status").orderBy("artifact_id"))).where("_n <= 10")
    return first.groupBy("status").agg(F.array_join(F.transform(F.array_sort(F.collect_list("artifact_id")), lambda v: v.cast("string")), ",").alias("examples"))


@R.add(f"with {_PAGES_SQL} select source_id, cast(page as int) as page, cast(score as bigint) as score from d")
def agg_dense_pages(t: Tables) -> DataFrame:
    """AGG35: pages that use the keywords most."""
    return ranking.dense_pages(scored_pages(t), "source_id", "score")


@R.add("""
with p as (select source_id, unnest(string_split(text, chr(10) || chr(12) || chr(10))) as x, generate_subscripts(string_split(text, chr(10) || chr(12) || chr(10)), 1) as page from captured_texts),
l as (select source_id, page, unnest(string_split(x, chr(10))) as line from p), n as (select source_id, count(distinct page) as np from l where trim(line) <> '' group by 1)
select source_id, line, count(distinct page) as pages from l join n using (source_id) where trim(line) <> '' group by source_id, line, np having count(distinct page) > greatest(1, np / 2)""")
def agg_running_lines(t: Tables) -> DataFrame:
    """AGG36: lines on more than half of a text's pages."""
    from docketlake.sources.documents import pages

    lines = pages(t.captured_texts, "source_id", "text").select("source_id", "page", F.explode(F.split("page_text", "\n")).alias("line")).where(F.trim("line") != "")
    return ranking.running_lines(lines, "source_id", "page", "line")


@R.add("""
with s as (select o_orderkey, o_orderpriority, o_orderdate, row_number() over (partition by o_custkey order by (o_orderpriority not in ('1-URGENT', '2-HIGH'))::int, o_orderdate desc, o_orderkey) as place from orders) select o_orderkey, place from s""")
def srt_candidates(t: Tables) -> DataFrame:
    """SRT1: known kinds first, then the newest."""
    w = Window.partitionBy("o_custkey").orderBy((~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("int"), F.col("o_orderdate").desc(), "o_orderkey")
    return t.orders.select("o_orderkey", F.row_number().over(w).alias("place"))


@R.add("""
with m as (select distinct record_id, source_id, model, unnest(validation_notes) as note from extraction_results) select record_id, model, note, row_number() over (partition by model order by source_id, note, record_id) as place from m where note is not null""")
def srt_errors(t: Tables) -> DataFrame:
    """SRT3: notes in one order."""
    m = t.extraction_results.select("record_id", "source_id", "model", F.explode("validation_notes").alias("note")).where("note is not null").distinct()
    return ranking.place_within(m, ["model"], [F.col("source_id"), F.col("note"), F.col("record_id")]).select("record_id", "model", "note", "place")


@R.add(f"""
with {CLAIMS_SQL}, q as (select target, field, obs_id, value_key, quote is not null as quoted, case when quote is not null and contains(lower(quote), lower(value)) then 'supported' else 'unsupported' end as support from claims),
g as (select *, bool_or(quoted) over (partition by target, field) as any_, min(obs_id) over (partition by target, field, value_key) as first from q), k as (select target, field, value_key, count(distinct support) as kinds from q group by all)
select target, field, obs_id, case when not any_ or kinds > 1 then 'unclear' else support end as support, dense_rank() over (partition by target, field order by first) - 1 as group_no from g join k using (target, field, value_key)""")
def agg_judge_rules(t: Tables) -> DataFrame:
    """AGG37: verdicts settled by the rules: unclear without a quote or where a group differs; groups numbered by first
    appearance. Candidates are the values of a target's field; one is supported if its quote holds it."""
    held = F.col("quote").isNotNull() & F.contains(F.lower("quote"), F.lower("value"))
    c = claims(t).select("target", "field", "obs_id", "value_key", F.col("quote").isNotNull().alias("quoted"), F.when(held, "supported").otherwise("unsupported").alias("support"))
    return votes.judged_support(c, ["target", "field"], "obs_id", "value_key", "support", "quoted")


@R.add("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from documents where text is not null),
s as (select doc_id, no, line, length(trim(line)) as n, sum(length(trim(line))) over (partition by doc_id order by no) as upto, row_number() over (partition by doc_id order by no) as k from l where length(trim(line)) > 0),
h as (select doc_id, no as hit, upto as at, n as own, k as mid from s where contains(lower(line), 'setback'))
select s.doc_id, h.hit, count(*) as reached, min(s.no) as first, max(s.no) as last from s join h using (doc_id) where s.no <> h.hit and ((s.no > h.hit and (s.upto - h.at <= 400 or s.k = h.mid + 1)) or (s.no < h.hit and (h.at - h.own - s.upto + s.n <= 400 or s.k = h.mid - 1))) group by 1, 2""")
def win_context_around(t: Tables) -> DataFrame:
    """WIN12: lines around each line that names a setback, within 400 characters on either side."""
    lines = t.documents.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line")).withColumn("no", F.col("no") + 1)
    hits = lines.where(F.lower("line").contains("setback")).select("doc_id", F.col("no").alias("hit"))
    return ranking.reach_around(lines, "doc_id", "no", "line", hits, 400).groupBy("doc_id", "hit").agg(F.count("*").alias("reached"), F.min("no").alias("first"), F.max("no").alias("last"))


@R.add("""
with f as (select target, list_distinct(flatten(list(json_keys(data, '$.item')))) as labels, count(*) as n from observations group by target)
select target, n, len(labels) as labels, len(list_filter(['permit_fee', 'review_days', 'setback_ft'], lambda x: not list_contains(labels, x))) = 0 and n >= 2 as sufficient from f""")
def agg_covered_labels(t: Tables) -> DataFrame:
    """AGG25: labels that each target's evidence covers, and whether that suffices."""
    keys = t.observations.select("target", F.map_keys(F.from_json("data", "struct<item:map<string,string>>")["item"]).alias("k"))
    f = keys.groupBy("target").agg(F.array_distinct(F.flatten(F.collect_set("k"))).alias("labels"), F.count("*").alias("n"))
    need = F.array(*(F.lit(x) for x in ("permit_fee", "review_days", "setback_ft")))
    return f.select("target", "n", F.size("labels").cast("bigint").alias("labels"), ((F.size(F.array_except(need, F.col("labels"))) == 0) & (F.col("n") >= 2)).alias("sufficient"))
