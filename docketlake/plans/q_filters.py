"""Queries: filters, predicates and scalar functions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions import measures, text, urls
from docketlake.plans.common import CLAIMS_SQL, claims
from docketlake.plans.registry import Registry, Tables

R = Registry()
_FOLD = "translate(lower(coalesce(url, '')), '_-/', '   ')"


@R.add(f"""
select artifact_id, case when regexp_matches({_FOLD}, 'draft|superseded|archive') then 'draft' when regexp_matches(url, 'lang=es') then 'excluded' when not (contains({_FOLD}, 'permit') or contains({_FOLD}, 'ordinance') or contains({_FOLD}, 'code') or contains({_FOLD}, 'checklist')) then 'irrelevant'
  when lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/[^/]*(\\.[A-Za-z0-9]{{1,5}})$', 1)) in ('.jpg', '.jpeg', '.png', '.gif', '.mp4', '.zip', '.exe') then 'unsupported' else 'kept' end as outcome
from digger_artifacts where url is not null""")
def flt_candidate_gates(t: Tables) -> DataFrame:
    """FLT1-FLT3, FLT5: the first gate that stops a candidate."""
    u = F.col("url")
    folded = urls.folded_text(u)
    relevant = folded.contains("permit") | folded.contains("ordinance") | folded.contains("code") | folded.contains("checklist")
    outcome = F.when(folded.rlike("draft|superseded|archive"), "draft").when(u.rlike("lang=es"), "excluded").when(~relevant, "irrelevant").when(urls.extension_of(u).isin(".jpg", ".jpeg", ".png", ".gif", ".mp4", ".zip", ".exe"), "unsupported").otherwise("kept")
    return t.digger_artifacts.where("url is not null").select("artifact_id", outcome.alias("outcome"))


@R.add(f"""
with j as (select a.artifact_id, {_FOLD.replace('url', 'a.url')} as folded, regexp_replace(lower(t.name), '^(city|village) of | (county|township|parish)$', '', 'g') as term from digger_artifacts a join targets t using (target_id) where a.url is not null)
select artifact_id, contains(folded, term) or contains(regexp_replace(folded, '[^a-z0-9]', '', 'g'), regexp_replace(term, '[^a-z0-9]', '', 'g')) as named from j""")
def flt_target_identity(t: Tables) -> DataFrame:
    """FLT4: whether an address names its target, with or without punctuation."""
    j = t.digger_artifacts.where("url is not null").select("artifact_id", "target_id", "url").join(t.targets.select("target_id", "name"), "target_id")
    term, folded = F.regexp_replace(F.lower("name"), "^(city|village) of | (county|township|parish)$", ""), urls.folded_text(F.col("url"))
    bare = lambda c: F.regexp_replace(c, "[^a-z0-9]", "")
    return j.select("artifact_id", (folded.contains(term) | bare(folded).contains(bare(term))).alias("named"))


@R.add("""
with c as (select artifact_id, target_id, case when status = 'captured' then 'accepted' when status = 'empty' then 'rejected' else 'review' end as cls, source from digger_artifacts where target_id is not null)
select artifact_id, target_id, cls from c qualify cls <> 'rejected' or source = 'roster_url' or not bool_or(cls <> 'rejected') over (partition by target_id)""")
def flt_viability(t: Tables) -> DataFrame:
    """FLT6: rejected candidates stay only where the target has nothing else; configured ones always do."""
    c = t.digger_artifacts.where("target_id is not null").select("artifact_id", "target_id", F.when(F.col("status") == "captured", "accepted").when(F.col("status") == "empty", "rejected").otherwise("review").alias("cls"), "source")
    any_ = F.bool_or(F.col("cls") != "rejected").over(Window.partitionBy("target_id"))
    return c.withColumn("_any", any_).where("cls != 'rejected' or source = 'roster_url' or not _any").select("artifact_id", "target_id", "cls")


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"


@R.add(f"select artifact_id, ends_with({_HOST}, '.example') as in_suffix, ({_HOST} = 'skellelfellcounty-mo.example' or ends_with({_HOST}, '.skellelfellcounty-mo.example')) as in_host from digger_artifacts where url is not null")
def flt_domain_scope(t: Tables) -> DataFrame:
    """FLT7: host and suffix scope."""
    host = urls.host_of(F.col("url"))
    return t.digger_artifacts.where("url is not null").select("artifact_id", urls.in_domain(host, ".example").alias("in_suffix"), urls.in_domain(host, "skellelfellcounty-mo.example").alias("in_host"))


@R.add(f"""
with d as (select artifact_id, url, url_decode(url) as plain from digger_artifacts where url is not null)
select artifact_id, case when not ends_with({_HOST}, '.example') then 'outside_allowed_domains' when not (regexp_matches(url, '/(code|building|planning|documents|files)/') or regexp_matches(plain, '/(code|building|planning|documents|files)/')) then 'outside_include_patterns'
  when regexp_matches(url, '[?&]lang=es') or regexp_matches(plain, '[?&]lang=es') then 'matches_excluded_pattern' when contains({_FOLD.replace('url', 'plain')}, 'minutes') then 'matches_excluded_term' end as reason from d""")
def flt_final_url_guard(t: Tables) -> DataFrame:
    """FLT8: why a final address is refused, as written or with its percent escapes resolved."""
    a = t.digger_artifacts.where("url is not null")
    return a.select("artifact_id", urls.guard(F.col("url"), [".example"], ["/(code|building|planning|documents|files)/"], ["[?&]lang=es"], ["minutes"]).alias("reason"))


@R.add("""
with m as (select unnest(['ignore', 'warn', 'enforce']) as mode), k as (select unnest([true, false]) as acked), r as (select unnest(['allowed', 'disallowed', 'unknown']) as robots)
select mode, acked, robots, mode <> 'enforce' or robots = 'allowed' or (robots = 'unknown' and acked) as allowed,
  case when mode = 'enforce' and robots = 'disallowed' then 'robots_disallowed' when mode = 'enforce' and robots = 'unknown' and not acked then 'robots_unknown' end as code, mode = 'warn' and robots <> 'allowed' as warned from m, k, r""")
def flt_policy(t: Tables) -> DataFrame:
    """FLT9: the policy decision table."""
    from docketlake.operators.policy import robots_decisions

    return robots_decisions(t._spark)


@R.add("""
with s as (select doc_id, lower(substr(text, 1, 10000)) as s, length(text) as n from documents where text is not null),
h as (select *, (contains(s, 'permit')::int + contains(s, 'solar')::int) as required, (contains(s, 'setback')::int + contains(s, 'fee')::int + contains(s, 'inspect')::int + contains(s, 'zoning')::int) as nice from s)
select doc_id, n >= 50 and required >= 1 as passes, case when n < 50 then 0.0 else cast(round(cast(0.7::double * required / 2 + 0.3::double * nice / 4 as decimal(38,12)), 4) as double) end as score from h""")
def flt_keyword_classifier(t: Tables) -> DataFrame:
    """FLT11: documents by required and welcome keywords; the rule itself looks at the first 10,000 characters."""
    from docketlake.operators.policy import keyword_classifier

    return keyword_classifier(t.documents.where("text is not null"), "doc_id", "text", ["permit", "solar"], ["setback", "fee", "inspect", "zoning"], 1)


@R.add("""
with a as (select artifact_id, case when source = 'roster_url' and status = 'empty' then 'reject' when source = 'roster_url' then 'keep' end as human, status = 'failed' as failed, status is null as held, mime_type = 'application/pdf' as automatic from digger_artifacts)
select artifact_id, case when human is not null then human when failed then 'failed' when held then 'held' else 'automatic' end as decision, case when human is not null then human = 'keep' when failed or held then false else coalesce(automatic, false) end as curated from a""")
def flt_human_override(t: Tables) -> DataFrame:
    """FLT14, FLT15: a person's decision before the automatic one; held ones wait (addresses of the roster stand in for people's decisions)."""
    from docketlake.operators.policy import curation

    human = F.when((F.col("source") == "roster_url") & (F.col("status") == "empty"), "reject").when(F.col("source") == "roster_url", "keep")
    decision, curated = curation(human, F.col("status") == "failed", F.col("status").isNull(), F.col("mime_type") == "application/pdf")
    return t.digger_artifacts.select("artifact_id", decision.alias("decision"), curated.alias("curated"))


@R.add("""
with s as (select event_id, cast(event_id % 5 as int) * 100 + 200 + case when event_id % 7 = 0 then 29 else 0 end as code, event_type from events)
select event_id, code in (408, 425, 429) or code >= 500 as retryable, least(60.0, 1.0 * pow(2.0, (event_id % 8)))::double as wait from s""")
def flt_retryable(t: Tables) -> DataFrame:
    """FLT16, MTH3: which status codes deserve another try, and how long to wait."""
    code = (F.col("event_id") % 5).cast("int") * 100 + 200 + F.when(F.col("event_id") % 7 == 0, 29).otherwise(0)
    return t.events.select("event_id", measures.retryable(code, F.lit(None).cast("string")).alias("retryable"), measures.backoff(F.col("event_id") % 8 + 1).alias("wait"))


@R.add(f"""
with {CLAIMS_SQL}, q as (select obs_id, field, trim(regexp_replace(strip_accents(lower(quote)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as q, trim(regexp_replace(strip_accents(lower(value)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as v from claims where quote is not null)
select obs_id, field, contains(' ' || q || ' ', ' ' || v || ' ') as supported from q where v <> ''""")
def flt_quote_verified(t: Tables) -> DataFrame:
    """FLT17, STR2: values that stand in their quotes as whole words."""
    q = claims(t).where(F.col("quote").isNotNull())
    form = q.select("obs_id", "field", text.evidence_form(F.col("value")).alias("v"), text.evidence_form(F.col("quote")).alias("q")).where("v != ''")
    return form.select("obs_id", "field", text.contains_quote(F.col("v"), F.col("q")).alias("supported"))


@R.add("""
select r.item_id, r.roster from roster_items r semi join targets t on t.roster = r.roster and lower(trim(t.name)) = lower(trim(r.name))""")
def flt_on_roster(t: Tables) -> DataFrame:
    """FLT18: items whose name is on the roster as it stands."""
    from docketlake.operators.joins import on_roster

    items = t.roster_items.select("item_id", "roster", F.lower(F.trim("name")).alias("key"))
    return on_roster(items, t.targets.select("roster", F.lower(F.trim("name")).alias("key")), ["roster", "key"]).select("item_id", "roster")


@R.add("select doc_id, cast(ceil(strlen(text) / 3.0) as bigint) + 16 as tokens, cast(ceil(strlen(text) / 3.0) as bigint) + 16 <= 500 as admitted from documents where text is not null")
def flt_request_admission(t: Tables) -> DataFrame:
    """FLT20: requests whose estimated tokens fit."""
    tokens = F.ceil(F.octet_length("text") / 3).cast("bigint") + 16
    return t.documents.where("text is not null").select("doc_id", tokens.alias("tokens"), (tokens <= 500).alias("admitted"))


@R.add("""
with r as (select distinct record_id, source_id, status, unverified_quotes from extraction_results)
select r.record_id from r join captured_sources s using (source_id) where r.status <> 'partial' and r.unverified_quotes = 0 and s.size > 0 and regexp_matches(s.sha256, '^[0-9a-f]{64}$')""")
def flt_reusable(t: Tables) -> DataFrame:
    """FLT21: records that may be used again: whole, quotes verified, file and digest in order."""
    r = t.extraction_results.select("record_id", "source_id", "status", "unverified_quotes").distinct().where("status != 'partial' and unverified_quotes = 0")
    return r.join(t.captured_sources.where("size > 0").where(F.col("sha256").rlike("^[0-9a-f]{64}$")).select("source_id"), "source_id").select("record_id")


@R.add("select roster, count(*) as n, count(*) - count(distinct (coalesce(state, ''), name)) as repeated, count_if(name is null or trim(name) = '') as unnamed from targets group by roster")
def flt_identity_checks(t: Tables) -> DataFrame:
    """FLT24: repeated and missing identities of the roster."""
    return t.targets.groupBy("roster").agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct(F.coalesce("state", F.lit("")), "name")).alias("repeated"), F.count_if(F.col("name").isNull() | (F.trim("name") == "")).alias("unnamed"))


@R.add("select item_id, trim(regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9_\\s]|_', ' ', 'g'), '\\s+', ' ', 'g')) as form from roster_items where name is not null")
def str_evidence_form(t: Tables) -> DataFrame:
    """STR1: names without accents, case and punctuation."""
    return t.roster_items.where("name is not null").select("item_id", text.evidence_form(F.col("name")).alias("form"))


@R.add("""
select target_id, array_to_string(list_transform(list_filter(string_split_regex(lower(trim(name)), '\\s+'), lambda w: w not in ('a','an','the','of','in','at','by','for','to','from','hours') and w <> ''), lambda w: regexp_replace(w, 's+$', '')), ' ') as words from targets""")
def str_fuzzy_words(t: Tables) -> DataFrame:
    """STR4: words without stop words and plural s."""
    return t.targets.select("target_id", text.fuzzy_words(F.col("name")).alias("words"))


@R.add(f"with {CLAIMS_SQL} select value_key, count(*) as n, count(distinct value) as written from claims group by value_key")
def str_value_key(t: Tables) -> DataFrame:
    """STR5: values that count as one."""
    return claims(t).groupBy("value_key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("written"))


_STATES = "map {" + ", ".join(f"'{n}': '{c}'" for n, c in text.STATE_CODES.items()) + ", " + ", ".join(f"'{c.lower()}': '{c}'" for c in text.STATE_CODES.values()) + "}"


@R.add(f"select item_id, coalesce({_STATES}[lower(trim(state))], state) as state from roster_items where state is not null")
def str_state_code(t: Tables) -> DataFrame:
    """STR6: typed states as codes; anything else stays."""
    return t.roster_items.where("state is not null").select("item_id", text.state_code(F.col("state")).alias("state"))


@R.add("select target_id, regexp_replace(trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), ' (city and borough|census area|municipality|county|parish|borough|city)$', '') as key from targets")
def str_county_key(t: Tables) -> DataFrame:
    """STR7: names without their generic ending."""
    return t.targets.select("target_id", text.county_key(F.col("name")).alias("key"))


@R.add("select p_partkey, case p_type when 'PROMO' then 'promotional' when 'STANDARD' then 'regular' else p_type end as p_type from part")
def str_units(t: Tables) -> DataFrame:
    """STR8: exact values exchanged."""
    return t.part.select("p_partkey", text.replace_values(F.col("p_type"), {"PROMO": "promotional", "STANDARD": "regular"}).alias("p_type"))


@R.add("select target_id, trim(regexp_replace(lower(trim(name)), '[^a-z0-9]+', '_', 'g'), '_') as slug from targets")
def str_slug(t: Tables) -> DataFrame:
    """STR14: names fit for folders."""
    return t.targets.select("target_id", text.slug(F.col("name")).alias("slug"))


@R.add("""
with q as (select item_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as t from benchmark where text is not null)
select item_id, len(list_distinct(list_transform(range(1, length(t) - 2), lambda i: substr(t, i, 4)))) as grams from q where length(t) >= 12""")
def str_char_grams(t: Tables) -> DataFrame:
    """STR15: different character 4-grams of each passage."""
    return t.benchmark.where(F.col("text").isNotNull()).where(F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) >= 12).select("item_id", F.size(text.char_grams(F.col("text"))).cast("bigint").alias("grams"))


@R.add(r"""
select doc_id, case when regexp_matches(text, '^[\t\r\n]') or regexp_matches(text, '^\s*[=+\-@]') then '''' || text else text end as cell, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') as printable from documents where text is not null""")
def str_spreadsheet(t: Tables) -> DataFrame:
    """STR23, SNK1: cells no spreadsheet takes for formulas; no control characters."""
    return t.documents.where("text is not null").select("doc_id", text.spreadsheet_literal(F.col("text")).alias("cell"), text.printable(F.col("text")).alias("printable"))


@R.add(r"""
with w as (select item_id, regexp_extract_all(lower(text), '([a-z]{3,})', 1) as w from benchmark where text is not null), d as (select item_id, unnest(w) as k from w)
select item_id, count(distinct k) as keywords from d where k not in ('a','an','the','of','in','at','by','for','to','from','hours') group by item_id""")
def str_keywords(t: Tables) -> DataFrame:
    """STR19: keywords of each passage."""
    return t.benchmark.where("text is not null").select("item_id", F.size(text.keywords_of(F.col("text"))).cast("bigint").alias("keywords"))


@R.add(r"""
select source_id, regexp_replace(regexp_replace(text, '([a-z])0([a-z])', '\1o\2', 'g'), '([a-z])1([a-z])', '\1l\2', 'g') as text from captured_texts""")
def str_ocr_rules(t: Tables) -> DataFrame:
    """STR18: ordered correction rules."""
    return t.captured_texts.select("source_id", text.corrected(F.col("text"), [("([a-z])0([a-z])", "$1o$2"), ("([a-z])1([a-z])", "$1l$2")]).alias("text"))


@R.add("select doc_id, case when length(text) <= 400 then text else substr(text, 1, 197) || chr(10) || '...' || chr(10) || right(text, 197) end as sample from documents where text is not null")
def str_review_sample(t: Tables) -> DataFrame:
    """STR17: head and tail of long texts for a reviewer."""
    return t.documents.where("text is not null").select("doc_id", text.head_and_tail(F.col("text"), 400).alias("sample"))


@R.add("select event_id, format('[{:02d}:{:02d}:{:02d}]', cast(event_id // 3600 as int), cast((event_id % 3600) // 60 as int), cast(event_id % 60 as int)) as stamp from events")
def dat_clock(t: Tables) -> DataFrame:
    """DAT5: seconds as a clock."""
    return t.events.select("event_id", text.clock(F.col("event_id")).alias("stamp"))


@R.add(r"""
with n as (select o_orderkey, case o_orderkey % 4 when 0 then 'notice_' || strftime(o_orderdate, '%m.%d.%Y') || '.pdf' when 1 then 'plan-' || strftime(o_orderdate + interval 20 year, '%Y-%m-%d') || '.pdf' when 2 then 'fees_' || strftime(o_orderdate + interval 20 year, '%B_%Y') || '.html' else 'code_' || strftime(o_orderdate + interval 20 year, '%Y') end as name from orders),
l as (select *, lower(name) as n from n),
u as (select o_orderkey, name, case when regexp_matches(n, '(?:^|[^0-9])(\d{1,2})[.\-_/](\d{1,2})[.\-_/](20\d{2})') then try_cast(regexp_extract(n, '(?:^|[^0-9])(\d{1,2})[.\-_/](\d{1,2})[.\-_/](20\d{2})', 3) || '-' || lpad(regexp_extract(n, '(?:^|[^0-9])(\d{1,2})[.\-_/](\d{1,2})[.\-_/](20\d{2})', 1), 2, '0') || '-' || lpad(regexp_extract(n, '(?:^|[^0-9])(\d{1,2})[.\-_/](\d{1,2})[.\-_/](20\d{2})', 2), 2, '0') as date) end as us,
  case when regexp_matches(n, '(20\d{2})[_\-](\d{2})[_\-](\d{2})') then try_cast(replace(regexp_extract(n, '(20\d{2}[_\-]\d{2}[_\-]\d{2})', 1), '_', '-') as date) end as iso,
  case when regexp_matches(n, '(?:^|[^a-z])(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[_\-. ]*(20\d{2})') then try_cast(regexp_extract(n, '(?:^|[^a-z])(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[_\-. ]*(20\d{2})', 1) || '-' || lpad(cast(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], regexp_extract(n, '(?:^|[^a-z])(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[_\-. ]*20\d{2}', 1)) as varchar), 2, '0') || '-01' as date) end as mon,
  case when regexp_matches(n, '(20\d{2})') then try_cast(regexp_extract(n, '(20\d{2})', 1) || '-01-01' as date) end as yr from l)
select o_orderkey, name, strftime(coalesce(us, iso, mon, yr), '%Y-%m-%d') as dated from u""")
def dat_name_date(t: Tables) -> DataFrame:
    """DAT1: dates in file names, in four ways of writing."""
    d = F.col("o_orderdate")
    later = d + F.expr("interval 20 years")
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(F.lit("notice_"), F.date_format(d, "MM.dd.yyyy"), F.lit(".pdf"))).when(k == 1, F.concat(F.lit("plan-"), F.date_format(later, "yyyy-MM-dd"), F.lit(".pdf"))).when(k == 2, F.concat(F.lit("fees_"), F.date_format(later, "MMMM_yyyy"), F.lit(".html"))).otherwise(F.concat(F.lit("code_"), F.date_format(later, "yyyy")))
    named = t.orders.select("o_orderkey", name.alias("name"))
    return named.select("o_orderkey", "name", F.date_format(measures.name_date(F.col("name")), "yyyy-MM-dd").alias("dated"))


@R.add(r"""
with d as (select obs_id, regexp_extract(data->>'source_date', '^(\d{4}(-\d{2}(-\d{2})?)?)', 1) as v from observations)
select obs_id, case length(v) when 4 then v || '-01-01' when 7 then v || '-01' else v end as first_day, case length(v) when 4 then v || '-12-31' when 7 then v || '-31' else v end as last_day from d where v <> ''""")
def dat_bounds(t: Tables) -> DataFrame:
    """DAT2, DAT3: first and last day of dates known to a year, month or day."""
    v = F.regexp_extract(F.get_json_object("data", "$.source_date"), r"^(\d{4}(-\d{2}(-\d{2})?)?)", 1)
    d = t.observations.select("obs_id", v.alias("v")).where("v != ''")
    low, high = measures.date_bounds(F.col("v"))
    return d.select("obs_id", low.alias("first_day"), high.alias("last_day"))


@R.add("""
select r.record_id, date_diff('second', max(a.discovered_at), max(r.extracted_at)) // 3600 > 24 as stale from extraction_results r join captured_sources s using (source_id) join digger_artifacts a using (artifact_id) group by r.record_id""")
def dat_stale(t: Tables) -> DataFrame:
    """DAT4: records extracted more than a day after discovery."""
    j = t.extraction_results.select("record_id", "source_id", "extracted_at").join(t.captured_sources.select("source_id", "artifact_id"), "source_id").join(t.digger_artifacts.select("artifact_id", "discovered_at"), "artifact_id")
    return j.groupBy("record_id").agg((F.floor(F.timestamp_diff("SECOND", F.max("discovered_at"), F.max("extracted_at")) / 3600) > 24).alias("stale"))


@R.add(f"""
with s as (select artifact_id, case when status = 'captured' then 1.0 else 0.3 end as a, case when mime_type = 'application/pdf' then 0.9 else 0.4 end as b, case when source = 'roster_url' then 1.0 else 0.5 end as c from digger_artifacts),
w as (select artifact_id, least(1.0, greatest(0.0, (a::double * 0.5::double + b::double * 0.3::double + c::double * 0.2::double) / 1.0::double)) as score from s)
select artifact_id, cast(round(cast(score as decimal(38,12)), 6) as double) as score, case when score >= 0.75 then 'accepted' when score >= 0.45 then 'review' else 'rejected' end as cls from w""")
def mth_score_class(t: Tables) -> DataFrame:
    """MTH1: weighted signals and the class they make."""
    signals = {"a": F.when(F.col("status") == "captured", 1.0).otherwise(0.3), "b": F.when(F.col("mime_type") == "application/pdf", 0.9).otherwise(0.4), "c": F.when(F.col("source") == "roster_url", 1.0).otherwise(0.5)}
    score = measures.weighted_score(signals, {"a": 0.5, "b": 0.3, "c": 0.2})
    return t.digger_artifacts.select("artifact_id", measures.exact(score).alias("score"), measures.acceptance_class(score).alias("cls"))


@R.add("select source_id, page_count, list_sum(list_transform(coalesce(map_keys(ocr_pages), []), lambda p: 1)) as ocr_count from captured_sources join captured_texts using (source_id) where len(map_keys(ocr_pages)) > 0")
def map_ocr_pages(t: Tables) -> DataFrame:
    """MAP2: pages listed in a map."""
    j = t.captured_sources.select("source_id", "ocr_pages").join(t.captured_texts.select("source_id", "page_count"), "source_id")
    return j.where(F.size("ocr_pages") > 0).select("source_id", "page_count", F.size("ocr_pages").cast("bigint").alias("ocr_count"))


@R.add("""
with r as (select selection_id, unnest(ranges) as r from page_selections), p as (select distinct selection_id, unnest(range(r.start, r."end" + 1)) as page from r where r.start <= r."end"),
i as (select selection_id, page, page - row_number() over (partition by selection_id order by page) as g from p), s as (select selection_id, min(page) as a, max(page) as b from i group by selection_id, g)
select selection_id, string_agg(case when a = b then cast(a as varchar) else a || '-' || b end, ',' order by a) as pages, cast(sum(b - a + 1) as bigint) as n from s group by selection_id""")
def arr_page_ranges(t: Tables) -> DataFrame:
    """ARR1, STR24, SRC22: unordered, overlapping ranges as disjoint ones, written out and counted."""
    from docketlake.functions.ranges import formatted, merged, page_total

    m = t.page_selections.select("selection_id", merged(F.col("ranges")).alias("m")).where(F.size("m") > 0)
    return m.select("selection_id", formatted(F.col("m")).alias("pages"), page_total(F.col("m")).alias("n"))


@R.add("select obs_id, sha256(coalesce(target, '') || chr(31) || coalesce(record_id, '') || chr(31) || coalesce(source, '')) as digest from observations")
def jsn_digest(t: Tables) -> DataFrame:
    """JSN1, HSH1: digests over named parts in one order."""
    parts = F.concat_ws("\x1f", *(F.coalesce(c, F.lit("")) for c in ("target", "record_id", "source")))
    return t.observations.select("obs_id", measures.content_hash(parts).alias("digest"))


@R.add("""
select status, count(*) as n, case when status = 'captured' then 0 when status = 'empty' then 3 when status is null then 4 else 2 end as exit_code from digger_artifacts group by status""")
def cat_exit_code(t: Tables) -> DataFrame:
    """CAT3: outcomes as exit codes."""
    code = F.when(F.col("status") == "captured", 0).when(F.col("status") == "empty", 3).when(F.col("status").isNull(), 4).otherwise(2)
    return t.digger_artifacts.groupBy("status").agg(F.count("*").alias("n")).select("status", "n", code.alias("exit_code"))
