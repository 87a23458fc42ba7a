"""Queries: joins, duplicates, set operations."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions import text, urls
from docketlake.operators import dedup, joins
from docketlake.plans.common import ANSWERS_SQL, answers
from docketlake.plans.registry import Registry, Tables

R = Registry()


@R.add("""
select r.item_id, min(t.target_id) as target_id, count(t.target_id) as hits from roster_items r left join targets t on t.roster = r.roster and lower(trim(t.name)) = lower(trim(r.name)) and (t.state is null or upper(trim(r.state)) = t.state) group by r.item_id""")
def jn_roster_lookup(t: Tables) -> DataFrame:
    """JN1: items to roster entries by their key, unmatched ones kept."""
    roster = t.targets.select("roster", F.lower(F.trim("name")).alias("key"), F.col("state").alias("own"), "target_id")
    joined = joins.lookup(t.roster_items.select("item_id", "roster", F.lower(F.trim("name")).alias("key"), "state"), roster, ["roster", "key"])
    fits = F.col("target_id").isNotNull() & (F.col("own").isNull() | F.coalesce(F.upper(F.trim("state")) == F.col("own"), F.lit(False)))
    return joined.groupBy("item_id").agg(F.min(F.when(fits, F.col("target_id"))).alias("target_id"), F.count_if(fits).alias("hits"))


@R.add("""
select t.target_id, t.name, count(o.obs_id) as observations, coalesce(max(o.obs_id), 0) as last_id from targets t left join observations o on o.target = t.target_id group by 1, 2""")
def jn_roster_left(t: Tables) -> DataFrame:
    """JN2: every target with its evidence, also where there is none; observations are folded before the join."""
    per = t.observations.groupBy(F.col("target").alias("target_id")).agg(F.count("*").alias("n"), F.max("obs_id").alias("m"))
    return t.targets.select("target_id", "name").join(per, "target_id", "left").select("target_id", "name", F.coalesce("n", F.lit(0)).alias("observations"), F.coalesce("m", F.lit(0)).alias("last_id"))


@R.add("select target, source, min(obs_id) as obs_id from observations group by target, source")
def jn_observation_dedup(t: Tables) -> DataFrame:
    """JN3: one observation per target and source, the first."""
    from docketlake.sources.records import distinct_observations

    return distinct_observations(t.observations.select("target", "source", "obs_id"), "obs_id").select("target", "source", "obs_id")


@R.add("""
with a as (select row_number() over (order by target_id) as pos, name from targets where roster = 'permitting'), b as (select row_number() over (order by target_id) as pos, name from targets)
select pos, a.name as left_key, b.name as right_key, coalesce(a.name = b.name, false) as matches from a full join b using (pos)""")
def jn_lockstep(t: Tables) -> DataFrame:
    """JN4: two rosters row by row; the rosters are fixed and small, so their order may be made in one place."""
    w = Window.orderBy("target_id")
    a = t.targets.where("roster = 'permitting'").select(F.row_number().over(w).cast("bigint").alias("pos"), "name")
    b = t.targets.select(F.row_number().over(w).cast("bigint").alias("pos"), "name")
    return joins.lockstep(a, b, "pos", "name")


@R.add(f"""
with {ANSWERS_SQL} select cluster_id, field, count(*) as sources, count(distinct role) as roles, string_agg(label, ',' order by label) as labels, count(distinct answer) as kinds from answers group by cluster_id, field""")
def jn_clusters(t: Tables) -> DataFrame:
    """JN5: rows of all sources side by side per key; a key has no more rows than there are sources."""
    return answers(t).groupBy("cluster_id", "field").agg(F.count("*").alias("sources"), F.count_distinct("role").alias("roles"), F.array_join(F.array_sort(F.collect_list("label")), ",").alias("labels"), F.count_distinct("answer").alias("kinds"))


@R.add("""
with q as (select distinct target_id, md5(quote) as id, lower(trim(regexp_replace(quote, '\\s+', ' ', 'g'))) as t from cells where quote is not null and target_id is not null),
s as (select target_id, id, list_sort(list_distinct(list_transform(range(1, length(t) - 2), lambda i: substr(t, i, 4)))) as s from q where length(t) >= 12),
c as (select *, min(id) over (partition by target_id, s) as rep from s), r as (select * from c where id = rep), g as (select target_id, id, unnest(s) as g from r),
p as (select a.target_id, a.id as left_id, b.id as right_id, count(*) as c from g a join g b on a.target_id = b.target_id and a.g = b.g and a.id < b.id group by all)
select p.target_id, left_id, right_id, c::double / least(len(x.s), len(y.s)) as score, 'near' as kind from p join r x on x.id = left_id and x.target_id = p.target_id join r y on y.id = right_id and y.target_id = p.target_id where c::double / least(len(x.s), len(y.s)) >= 0.65
union all select target_id, rep, id, 1.0, 'copy' from c where id <> rep""")
def jn_gram_pairs(t: Tables) -> DataFrame:
    """JN6, MTH5: quotes of one target whose 4-grams overlap by 0.65 of the smaller set, through a prefix-filtered gram join;
    quotes with the same grams are one class, given as its smallest member and the copies of that."""
    q = t.cells.where("quote is not null and target_id is not null").select("target_id", F.md5("quote").alias("item_id"), "quote").distinct()
    return joins.gram_pairs(q.select("target_id", "item_id", text.char_grams(F.col("quote")).alias("grams")), "item_id", "grams", 0.65, ["target_id"])


@R.add("""
with k as (select roster, lower(trim(name)) as key, count(*) as n from roster_items where name is not null group by 1, 2)
select roster, n > 1 as ambiguous, count(*) as keys, cast(sum(n) as bigint) as items from k group by 1, 2""")
def jn_unique_keys(t: Tables) -> DataFrame:
    """JN7: keys that stand once pair up, others are ambiguous."""
    k = t.roster_items.where("name is not null").groupBy("roster", F.lower(F.trim("name")).alias("key")).agg(F.count("*").alias("n"))
    return k.groupBy("roster", (F.col("n") > 1).alias("ambiguous")).agg(F.count("*").alias("keys"), F.sum("n").alias("items"))


@R.add("""
with w as (select doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') as w from documents where text is not null),
d as (select doc_id, ' ' || array_to_string(w, ' ') || ' ' as t from w),
n as (select distinct target_id, array_to_string(list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda x: x <> ''), ' ') as name from targets where name is not null),
f as (select distinct split_part(name, ' ', 1) as first from n),
g as (select doc_id, unnest(range(1, len(w) + 1)) as i, w from w), s as (select doc_id, w, i from g where w[i] in (select first from f)),
m as (select doc_id, n.target_id, count(*) as hits from s join n on array_to_string(w[i:i + len(string_split(n.name, ' ')) - 1], ' ') = n.name group by 1, 2)
select doc_id, target_id, hits from m""")
def jn_dictionary(t: Tables) -> DataFrame:
    """JN9, STR21: all names of the roster in all documents, as whole words, through an n-gram join."""
    return joins.dictionary_hits(t.documents, t.targets, "doc_id", "text", "target_id", "name")


_DECODED = "replace(lower(url), '%2d', '-')"


@R.add("""
with seen as (select distinct target_id, split_part(url, '#', 1) as u from digger_artifacts where batch_no = 0 and url is not null)
select a.artifact_id from digger_artifacts a where a.batch_no > 0 and a.url is not null and a.target_id is not null and not exists (select 1 from seen s where s.target_id = a.target_id and s.u = split_part(a.url, '#', 1))""")
def jn_attempted_anti(t: Tables) -> DataFrame:
    """JN10: addresses not tried before for their target."""
    key = [F.col("target_id"), F.substring_index("url", "#", 1).alias("u")]
    seen = t.digger_artifacts.where("batch_no = 0 and url is not null").select(*key).distinct()
    return t.digger_artifacts.where("batch_no > 0 and url is not null and target_id is not null").select("artifact_id", *key).join(seen, ["target_id", "u"], "left_anti").select("artifact_id")


@R.add("""
select s.source_id from captured_sources s where not exists (select 1 from captured_texts x where x.source_id = s.source_id and x.text is not null) and s.size > 0""")
def jn_completed_anti(t: Tables) -> DataFrame:
    """JN11, STM2: sources without a text yet."""
    return t.captured_sources.where("size > 0").select("source_id").join(t.captured_texts.where("text is not null").select("source_id"), "source_id", "left_anti")


@R.add("""
select t.target_id from targets t where (select count(*) from digger_artifacts a where a.target_id = t.target_id and a.status = 'captured') < 2 and not exists (select 1 from digger_artifacts a where a.target_id = t.target_id and a.status = 'discovered')""")
def jn_insufficient(t: Tables) -> DataFrame:
    """JN12: targets with too little evidence and nothing pending."""
    got = t.digger_artifacts.where("target_id is not null").groupBy("target_id").agg(F.count_if(F.col("status") == "captured").alias("n"), F.count_if(F.col("status") == "discovered").alias("open"))
    enough = got.where("n >= 2 or open > 0").select("target_id")
    return t.targets.select("target_id").join(enough, "target_id", "left_anti")


@R.add("""
with k as (select regexp_extract(original, '[^/]*$') as base, min(source_id) as by_base from captured_sources where original is not null group by 1 having count(*) = 1)
select s.source_id, coalesce(p.source_id, k.by_base) as context_id from captured_sources s left join captured_sources p on p.original = 'landing/00/' || regexp_extract(s.original, '[^/]*$') left join k on k.base = regexp_extract(s.original, '[^/]*$') where s.original is not null""")
def jn_context_lookup(t: Tables) -> DataFrame:
    """JN13: context by full path, else by a base name that is unique."""
    base = F.regexp_extract("original", "([^/]*)$", 1)
    s = t.captured_sources.where("original is not null").select("source_id", base.alias("base"))
    paths = t.captured_sources.select(F.col("original").alias("path"), F.col("source_id").alias("by_path"))
    unique = s.groupBy("base").agg(F.min("source_id").alias("by_base"), F.count("*").alias("n")).where("n = 1").drop("n")
    j = s.withColumn("path", F.concat(F.lit("landing/00/"), F.col("base"))).join(paths, "path", "left").join(unique, "base", "left")
    return j.select("source_id", F.coalesce("by_path", "by_base").alias("context_id"))


@R.add("""
with f as (select a.artifact_id, a.batch_no, a.target_id, a.url, lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{64})', 1)) as d from digger_artifacts a join captured_sources s using (artifact_id) where s.size > 0)
select n.artifact_id, min(o.artifact_id) as prior_id from f n join f o on o.target_id = n.target_id and o.url = n.url and o.d = n.d where n.batch_no > 0 and o.batch_no = 0 group by 1""")
def jn_prior_outcomes(t: Tables) -> DataFrame:
    """JN14, SRC5: earlier outcomes of the same owner and address whose bytes are the same."""
    digest = F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)).alias("d")
    f = t.digger_artifacts.select("artifact_id", "batch_no", "target_id", "url").join(t.captured_sources.where("size > 0").select("artifact_id", digest), "artifact_id")
    old = f.where("batch_no = 0").groupBy("target_id", "url", "d").agg(F.min("artifact_id").alias("prior_id"))
    return f.where("batch_no > 0").join(old, ["target_id", "url", "d"]).select("artifact_id", "prior_id")


@R.add("""
select s.source_id, x.method, coalesce(x.page_count, 0) as pages from captured_sources s left join captured_texts x using (source_id)""")
def jn_ledger(t: Tables) -> DataFrame:
    """JN15: a ledger beside the records, one row each on both sides (else an error)."""
    joined = joins.ledger_merge(t.captured_sources.select("source_id"), t.captured_texts.select("source_id", "method", "page_count"), "source_id")
    return joined.select("source_id", "method", F.coalesce("page_count", F.lit(0)).alias("pages"))


@R.add("""
with h as (select distinct regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) as host, target_id from digger_artifacts where target_id is not null and batch_no = 0),
l as (select distinct regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) as host, url from digger_artifacts where batch_no > 0)
select distinct l.url, h.target_id from l join h using (host)""")
def jn_crawl_fanout(t: Tables) -> DataFrame:
    """JN16: crawled links go to every target that the site was found for."""
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1).alias("host")
    h = t.digger_artifacts.where("target_id is not null and batch_no = 0").select(host, "target_id").distinct()
    links = t.digger_artifacts.where("batch_no > 0").select(host, "url").distinct()
    return links.join(h, "host").select("url", "target_id").distinct()


_PAGES_SQL = """
p as (select source_id, unnest(string_split(text, chr(10) || chr(12) || chr(10))) as x, generate_subscripts(string_split(text, chr(10) || chr(12) || chr(10)), 1) as page from captured_texts),
sc as (select source_id, page, (length(lower(x)) - length(replace(lower(x), 'permit', ''))) // 6 + (length(lower(x)) - length(replace(lower(x), 'setback', ''))) // 7 as score from p),
d as (select source_id, page, score from sc qualify score >= greatest(1, floor(0.4 * max(score) over (partition by source_id))))"""


def scored_pages(t: Tables) -> DataFrame:
    """Pages with how often they use two keywords."""
    from docketlake.sources.documents import pages

    low = F.lower("page_text")
    count = lambda word: F.floor((F.length(low) - F.length(F.replace(low, F.lit(word), F.lit("")))) / len(word))
    return pages(t.captured_texts, "source_id", "text").select("source_id", "page", (count("permit") + count("setback")).alias("score"))


@R.add(f"with {_PAGES_SQL}, l as (select source_id, max(page) as last from p group by source_id), n as (select distinct source_id, unnest(range(greatest(1, page - 1), page + 2)) as page from d) select n.source_id, cast(n.page as int) as page from n join l using (source_id) where n.page <= l.last")
def jn_page_context(t: Tables) -> DataFrame:
    """JN17: dense pages with the pages beside them."""
    from docketlake.operators.ranking import dense_pages

    scored = scored_pages(t)
    last = scored.groupBy("source_id").agg(F.max("page").alias("last"))
    return joins.neighbours_of(dense_pages(scored, "source_id", "score"), "source_id", "page", 1, 1, last)


@R.add("""
select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by user_id""")
def jn_latest(t: Tables) -> DataFrame:
    """JN18, STM3: the newest row of each key."""
    return joins.latest(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


_PATHS_SQL = """
f as (select distinct regexp_extract(original, '^(.*)/[^/]*$', 1) as path from captured_sources where original is not null),
b as (select distinct regexp_extract(original, '^(.*)/[^/]*$', 1) as path from captured_sources where size = 0 and original is not null)"""


def _folders(t: Tables) -> tuple[DataFrame, DataFrame]:
    named, folder = t.captured_sources.where("original is not null"), F.regexp_extract("original", "^(.*)/[^/]*$", 1).alias("path")
    return named.select(folder).distinct(), named.where("size = 0").select(folder).distinct()


@R.add(f"with {_PATHS_SQL} select path from f where exists (select 1 from b where b.path = f.path or starts_with(f.path, b.path || '/') or starts_with(b.path, f.path || '/'))")
def jn_path_overlap(t: Tables) -> DataFrame:
    """JN19: folders that equal, hold or lie in a blocked one; all files of size 0 block."""
    f, b = _folders(t)
    return joins.overlapping_paths(f, b, "path")


@R.add("select t.target_id, lpad(cast(c.code as varchar), 5, '0') as code from targets t left join (select regexp_replace(lower(name), ' (county|parish)$', '') as key, state, min(geo_id) as code from targets where geo_id is not null group by 1, 2) c on c.key = regexp_replace(lower(t.name), ' (county|parish)$', '') and c.state = t.state")
def jn_area_code(t: Tables) -> DataFrame:
    """JN20: area codes by state and name without its ending."""
    key = F.regexp_replace(F.lower("name"), " (county|parish)$", "").alias("key")
    codes = t.targets.where("geo_id is not null and state is not null").groupBy(key, "state").agg(F.min("geo_id").alias("code"))
    return t.targets.select("target_id", key, "state").join(codes, ["key", "state"], "left").select("target_id", F.lpad("code", 5, "0").alias("code"))


_FULL = " + ".join(f"(coalesce(trim(cast({c} as varchar)), '') <> '')::int" for c in ("lang", "source", "target_id", "url"))


@R.add(f"""
with k as (select *, lower(trim(coalesce(text, ''))) as k, {_FULL} as filled from documents),
r as (select *, count(*) over (partition by k) - 1 as duplicates, row_number() over (partition by k order by filled desc, doc_id) as rn from k)
select doc_id, lang, source, target_id, url, duplicates from r where rn = 1""")
def agg_exact_dedup(t: Tables) -> DataFrame:
    """AGG1: one document per text, the most complete, then the first."""
    d = t.documents.select("doc_id", "text", "lang", "source", "target_id", "url")
    k = d.withColumn("k", F.md5(dedup.key_of(d, "text"))).drop("text")
    return dedup.exact_duplicates(k, ["k"], "doc_id").drop("k")


@R.add(f"""
with k as (select *, lower(trim(coalesce(source, ''))) as a, lower(trim(coalesce(lang, ''))) as b from documents),
r as (select *, count(*) over (partition by a, b) - 1 as duplicates, row_number() over (partition by a, b order by {_FULL} desc, doc_id) as rn from k)
select doc_id, case when duplicates > 0 then 'Merged ' || duplicates || ' duplicate(s) on: ' || coalesce(nullif(concat_ws(', ', case when trim(source) <> '' then 'source=''' || case when length(source) > 30 then substr(source, 1, 27) || '...' else source end || '''' end, case when trim(lang) <> '' then 'lang=''' || case when length(lang) > 30 then substr(lang, 1, 27) || '...' else lang end || '''' end), ''), 'all key fields') end as note from r where rn = 1""")
def agg_merge_note(t: Tables) -> DataFrame:
    """AGG3: what each survivor stands for."""
    d = t.documents.select("doc_id", "lang", "source", "target_id", "url")
    return dedup.exact_duplicates(d, ["source", "lang"], "doc_id").select("doc_id", dedup.merge_note(["source", "lang"], F.col("duplicates")).alias("note"))


@R.add()
def agg_wildcard_dedup(t: Tables) -> DataFrame:
    """AGG2, SET4: items whose fuzzy keys match where null matches anything (greedy, so no SQL; tested by brute force)."""
    d = t.roster_items.select("item_id", "roster", "state", text.fuzzy_words(F.col("name")).alias("words"), "record_id")
    return dedup.wildcard_duplicates(d, ["roster", "words"], ["state", "record_id"], "item_id").select("item_id", "roster", "words", "group_pos", "members")


@R.add("""
with l as (select doc_id, coalesce(lower(trim(text)), '') as k, unnest([struct_pack(c := 'lang', v := nullif(trim(lang), '')), struct_pack(c := 'source', v := nullif(trim(source), ''))], recursive := true) from documents),
f as (select md5(k) as k, c as "column", v, min(doc_id) as pos from l where v is not null group by all), r as (select *, row_number() over (partition by k, "column" order by pos, v) as n from f)
select k, "column", max(n) as n_values, string_agg(case when n <= 3 then v end, ' | ' order by n) as examples from r group by k, "column" having max(n) > 1""")
def agg_conflicts(t: Tables) -> DataFrame:
    """AGG4: columns on which copies of one text disagree."""
    d = t.documents.select("doc_id", "lang", "source", F.md5(F.coalesce(F.lower(F.trim("text")), F.lit(""))).alias("k"))
    return dedup.conflicts(d, ["k"], ["lang", "source"], "doc_id")


@R.add("""
with k as (select *, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority) as rk from orders),
m as (select *, min(rk) over (partition by o_custkey, o_orderstatus) as top from k), c as (select o_custkey, o_orderstatus, count(distinct rk) as kinds from k group by 1, 2)
select o_orderkey from m join c using (o_custkey, o_orderstatus) where rk is null or kinds < 2 or rk = top""")
def agg_redundant_features(t: Tables) -> DataFrame:
    """AGG5: of ranked features that share a bucket only the most authoritative stays."""
    return dedup.redundant_features(t.orders, ["o_custkey", "o_orderstatus"], "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey")


@R.add("""
with d as (select source_id, size, lower(regexp_extract(sha256, '([0-9A-Fa-f]{64})', 1)) as digest from captured_sources)
select source_id, row_number() over (partition by digest order by size desc, source_id) = 1 as kept from d""")
def agg_identical_files(t: Tables) -> DataFrame:
    """AGG31: of files with the same bytes the best one is kept."""
    d = t.captured_sources.select("source_id", "size", F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)).alias("digest"))
    return dedup.identical_copies(d, "digest", [F.col("size").desc(), F.col("source_id")]).select("source_id", "kept")


@R.add("""
with s as (select o_custkey as g, o_orderkey as id, list_sort(list(distinct l_partkey % 7)) as s from orders join lineitem on l_orderkey = o_orderkey group by 1, 2),
e as (select g, id, first_value(id) over (partition by g, s order by id) as best, s from s), k as (select * from e where id = best),
i as (select a.id, arg_min(b.id, (-len(b.s), b.id, b.id)) as "by" from k a join k b on a.g = b.g and len(a.s) < len(b.s) and len(list_intersect(a.s, b.s)) = len(a.s) group by a.id)
select id as o_orderkey, best as "by" from e where id <> best union all select id, "by" from i""")
def agg_covered(t: Tables) -> DataFrame:
    """AGG32: orders whose part groups lie within another order of the customer."""
    sets = t.orders.select("o_custkey", "o_orderkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") % 7).alias("p")), "o_orderkey").groupBy("o_custkey", "o_orderkey").agg(F.collect_set("p").alias("s"))
    return dedup.covered_documents(sets.withColumn("r", F.col("o_orderkey")), ["o_custkey"], "s", "r", "o_orderkey")


@R.add("""
with k as (select a.artifact_id, a.target_id, split_part(a.url, '#', 1) as u, lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{64})', 1)) as d from digger_artifacts a join captured_sources s using (artifact_id) where s.size > 0 and a.target_id is not null),
m as (select *, min(artifact_id) over (partition by target_id, u) as a, min(artifact_id) over (partition by target_id, d) as b from k)
select artifact_id, target_id from m where a = artifact_id and b = artifact_id""")
def agg_two_key(t: Tables) -> DataFrame:
    """AGG33: sources per target whose address and bytes are both new."""
    k = t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id", F.substring_index("url", "#", 1).alias("u")).join(t.captured_sources.where("size > 0").select("artifact_id", F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)).alias("d")), "artifact_id")
    return dedup.two_key_survivors(k, ["target_id"], "u", "d", "artifact_id").select("artifact_id", "target_id")


@R.add("""
with k as (select a.artifact_id, a.target_id, url_decode(a.url) as u, lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{64})', 1)) as d from digger_artifacts a join captured_sources s using (artifact_id) where a.status = 'captured' and coalesce(a.source, '') <> 'roster_url' and a.target_id is not null),
m as (select *, u is null or min(artifact_id) over (partition by target_id, u) = artifact_id as a, nullif(d, '') is null or min(artifact_id) over (partition by target_id, d) = artifact_id as b from k)
select target_id, count(*) as accepted from m where a and b group by target_id""")
def agg_accepted_sources(t: Tables) -> DataFrame:
    """AGG24: accepted sources of each target that nobody configured, mirrors by address or bytes counted once."""
    a = t.digger_artifacts.where("status = 'captured' and coalesce(source, '') != 'roster_url' and target_id is not null").select("artifact_id", "target_id", urls.decoded(F.col("url")).alias("u"))
    k = a.join(t.captured_sources.select("artifact_id", F.nullif(F.lower(F.regexp_extract("sha256", "([0-9A-Fa-f]{64})", 1)), F.lit("")).alias("d")), "artifact_id")
    return dedup.two_key_survivors(k, ["target_id"], "u", "d", "artifact_id").groupBy("target_id").agg(F.count("*").alias("accepted"))


@R.add("""
select url, target_id, min(k) as kind from (select unnest(urls) as url, target_id, 'configured' as k from targets union all select url, target_id, 'search' from digger_artifacts where source = 'search' and target_id is not null) where url is not null group by url, target_id""")
def set_union_configured(t: Tables) -> DataFrame:
    """SET1: configured and found candidates; configured wins."""
    configured = t.targets.select(F.explode("urls").alias("url"), "target_id").where("url is not null").distinct().withColumn("kind", F.lit("configured"))
    found = t.digger_artifacts.where("source = 'search' and target_id is not null and url is not null").select("url", "target_id").distinct().withColumn("kind", F.lit("search"))
    return configured.unionByName(found.join(configured, ["url", "target_id"], "left_anti"))


@R.add("select distinct source_id from captured_sources where size > 0 except select source_id from captured_texts")
def set_except(t: Tables) -> DataFrame:
    """SET3: what is on disk but not admitted."""
    return t.captured_sources.where("size > 0").select("source_id").subtract(t.captured_texts.select("source_id"))


@R.add("select source, min(doc_id) as first_id, dense_rank() over (order by min(doc_id)) as place from documents where source is not null group by source")
def set_distinct_ordered(t: Tables) -> DataFrame:
    """SET5: different values in order of first appearance."""
    from docketlake.operators.ranking import with_place

    first = t.documents.where("source is not null").groupBy("source").agg(F.min("doc_id").alias("first_id"))
    return with_place(first, [F.col("first_id")])


@R.add(f"with {_PATHS_SQL}, u as (select path from f union select regexp_extract(path, '^([^/]*)', 1) from b) select path from u where not exists (select 1 from u o where starts_with(u.path, o.path || '/'))")
def set_minimal_paths(t: Tables) -> DataFrame:
    """SET6: folders without one that another folder holds; all files of size 0 add their first folder."""
    f, b = _folders(t)
    return joins.minimal_paths(f.union(b.select(F.substring_index("path", "/", 1))), "path")


@R.add("""
with o as (select artifact_id, url, status, batch_no from digger_artifacts where batch_no <= 1), n as (select artifact_id, url, status, batch_no from digger_artifacts where batch_no = 2),
x as (select url, max(artifact_id) as artifact_id from o group by url), y as (select url, max(artifact_id) as artifact_id from n group by url)
select url, artifact_id from y union all select url, artifact_id from x where url not in (select url from y)""")
def snk_upsert(t: Tables) -> DataFrame:
    """SNK8, SNK10, STM1: keyed upsert of a new batch over earlier state."""
    last = lambda df: df.groupBy("url").agg(F.max("artifact_id").alias("artifact_id"))
    a = t.digger_artifacts
    return joins.upsert(last(a.where("batch_no <= 1")), last(a.where("batch_no = 2")), ["url"])


@R.add("""
select source_id, target_id from (select s.source_id, a.target_id from captured_sources s join digger_artifacts a using (artifact_id) where a.batch_no < 3 and a.target_id not in (select target_id from digger_artifacts where batch_no in (3, 4) and target_id is not null)
union all select s.source_id, a.target_id from captured_sources s join digger_artifacts a using (artifact_id) where a.batch_no = 3 and a.target_id is not null)""")
def snk_merge_index(t: Tables) -> DataFrame:
    """SNK9: an index after owners were promoted and withdrawn."""
    j = t.captured_sources.select("source_id", "artifact_id").join(t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id", "batch_no"), "artifact_id")
    old, new = j.where("batch_no < 3").select("source_id", "target_id"), j.where("batch_no = 3").select("source_id", "target_id")
    named = t.digger_artifacts.where("target_id is not null").select("target_id", "batch_no")
    gone = named.where("batch_no in (3, 4)").select("target_id")
    return joins.merge_index(old, new, gone, "target_id")


@R.add("select o.target, count(*) as orphans from observations o anti join (select distinct record_id from extraction_results where status <> 'partial') r using (record_id) group by o.target")
def snk_orphans(t: Tables) -> DataFrame:
    """SNK14: rows that nothing refers to any more."""
    kept = t.extraction_results.where("status != 'partial'").select("record_id").distinct()
    return t.observations.join(kept, "record_id", "left_anti").groupBy("target").agg(F.count("*").alias("orphans"))


@R.add("""
with recursive l as (select distinct l_partkey as src, l_suppkey as dst from lineitem), e as (select 'p' || src as src, 's' || dst as dst from l union select 's' || dst, 'p' || src from l),
b as (select 'p1' as page, 0 as depth union all select e.dst, b.depth + 1 from b join e on e.src = b.page where b.depth < 2)
select page, min(depth) as depth from b group by page""")
def src_crawl(t: Tables) -> DataFrame:
    """SRC7: pages within two links of a seed, at their smallest depth, over all links (the part-supplier graph stands in for links)."""
    pairs = t.lineitem.select(F.concat(F.lit("p"), "l_partkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b")).distinct()
    links = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(pairs.select("b", "a"))
    seeds = t._spark.createDataFrame([("p1",)], "page string")
    return joins.reachable(links, seeds, 2)


__all__ = ["R", "urls"]
