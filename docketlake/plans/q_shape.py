"""Queries: scans and projections."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions import text, urls
from docketlake.functions.measures import short_id
from docketlake.operators import shape
from docketlake.plans.registry import Registry, Tables

R = Registry()
_ITEM = "struct<state:string,ahj:string,permit_type:string,section:string,online_permitting:struct<value:string,quote:string>,setback_ft:struct<value:string,quote:string>,contact_office:string>"


@R.add("""
select target_id, roster, state, name, len(list_filter(coalesce(urls, []), lambda u: regexp_matches(u, '^https?://'))) as n_urls,
  list_filter(coalesce(urls, []), lambda u: regexp_matches(u, '^https?://'))[1] as first_url, nullif(trim(query), '') as query
from targets""")
def src_targets(t: Tables) -> DataFrame:
    """SRC1, SRC3: the roster with its web addresses checked."""
    from docketlake.sources.targets import normalised

    return normalised(t.targets).select("target_id", "roster", "state", "name", F.size("urls").alias("n_urls"), F.try_element_at("urls", F.lit(1)).alias("first_url"), "query")


@R.add("select r_name, role, n_name from region, (select distinct role from sources) s, nation")
def src_cross_product(t: Tables) -> DataFrame:
    """SRC2, JN8: a cross product of small dimensions, by index arithmetic."""
    from docketlake.operators.joins import cross_product

    return cross_product([t.region.select("r_name"), t.sources.select("role").distinct(), t.nation.select("n_name")]).select("r_name", "role", "n_name")


@R.add("""
with p as (select source_id, unnest(string_split(text, chr(10) || chr(12) || chr(10))) as page_text, generate_subscripts(string_split(text, chr(10) || chr(12) || chr(10)), 1) as page from captured_texts)
select source_id, cast(page as int) as page, length(page_text) as chars, case when trim(page_text) = '' then 'blank' else 'text' end as state from p""")
def src_pages(t: Tables) -> DataFrame:
    """M17: texts cut into pages at form feeds."""
    from docketlake.sources.documents import pages

    return pages(t.captured_texts, "source_id", "text").select("source_id", "page", F.length("page_text").alias("chars"), F.when(F.trim("page_text") == "", "blank").otherwise("text").alias("state"))


@R.add("""
with e as (select source_id, original as key from captured_sources union all select source_id, regexp_extract(original, '[^/]*$') from captured_sources union all select source_id, regexp_replace(original, '^landing/', '') from captured_sources)
select key, min(source_id) as source_id from e where key is not null and key <> '' group by key having count(distinct source_id) = 1""")
def src_provenance_keys(t: Tables) -> DataFrame:
    """SRC24: lookup keys of captured files that name one source."""
    from docketlake.sources.records import provenance_keys

    return provenance_keys(t.captured_sources, "original", "source_id", "landing/")


@R.add("""
select r.record_id, r.source_id, r.extracted_at::varchar as extracted_at from (select distinct * from extraction_results) r
join captured_sources s using (source_id) where r.status in ('extracted', 'cached') and s.size > 0""")
def src_admitted_records(t: Tables) -> DataFrame:
    """SRC19, SRC20: records whose status admits them and whose file is there."""
    admitted = t.extraction_results.distinct().where(F.col("status").isin("extracted", "cached"))
    return admitted.join(t.captured_sources.where("size > 0").select("source_id"), "source_id").select("record_id", "source_id", F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss").alias("extracted_at"))


@R.add("""
with n as (select record_id, min(extracted_at) as e, any_value(validation_notes) as notes from extraction_results group by record_id)
select record_id, cast(pos - 1 as int) as child_pos, child from (
  select record_id, unnest(notes) as child, generate_subscripts(notes, 1) as pos from n where len(notes) > 0
  union all select record_id, null, null from n where coalesce(len(notes), 0) = 0)""")
def prj_item_rows(t: Tables) -> DataFrame:
    """PRJ3, ARR4: a row per child; childless parents stay."""
    one = t.extraction_results.groupBy("record_id").agg(F.first("validation_notes").alias("notes"))
    return shape.item_rows(one, "notes")


@R.add("""
select obs_id, coalesce(case when trim(data->'item'->>'state') = '' then '' else data->'item'->>'state' end, '') as state,
  coalesce(case when trim(data->'item'->>'permit_type') = '' then '' else data->'item'->>'permit_type' end, '') as permit_type,
  case when json_type(data, '$.item.online_permitting') = 'OBJECT' then data->'item'->'online_permitting'->>'value' end as online_permitting_value,
  case when json_type(data, '$.item.online_permitting') = 'OBJECT' then data->'item'->'online_permitting'->>'quote' end as online_permitting_quote
from observations""")
def prj_flatten_item(t: Tables) -> DataFrame:
    """PRJ1, PRJ2: items flattened one level; blanks become empty cells."""
    item = "struct<state:string,permit_type:string,online_permitting:struct<value:string,quote:string>>"
    parsed = t.observations.select("obs_id", F.from_json("data", f"struct<item:{item}>")["item"].alias("item"))
    return shape.flatten_item(parsed, "item")


@R.add("""
with n as (select record_id, any_value(validation_notes) as notes from extraction_results group by record_id)
select record_id, coalesce(len(notes), 0) as error_count, array_to_string(coalesce(notes, []), ' | ') as error_text,
  array_to_string(list_sort(list_distinct(list_transform(coalesce(notes, []), lambda m: case when regexp_matches(lower(m), 'timed? ?out|deadline') then 'timeout'
    when regexp_matches(lower(m), 'rate.?limit|too many requests|429') then 'rate_limit' when regexp_matches(lower(m), 'connection|network|dns|reset') then 'network'
    when regexp_matches(lower(m), 'not found|404') then 'not_found' when regexp_matches(lower(m), 'forbidden|unauthorized|40[13]') then 'denied'
    when regexp_matches(lower(m), 'parse|decode|json|schema') then 'parse' else 'other' end))), '; ') as error_kinds from n""")
def prj_error_lineage(t: Tables) -> DataFrame:
    """PRJ4: error count, kinds and text of each record."""
    one = t.extraction_results.groupBy("record_id").agg(F.first("validation_notes").alias("notes"))
    return shape.error_lineage(one, "notes").select("record_id", "error_count", "error_kinds", "error_text")


@R.add("""
with v as (select obs_id, case when json_type(data, '$.item.review_days') = 'OBJECT' then data->'item'->'review_days'->>'value' else data->'item'->>'review_days' end as d,
  case when json_type(data, '$.item.permit_fee') = 'OBJECT' then data->'item'->'permit_fee'->>'value' else data->'item'->>'permit_fee' end as f from observations)
select obs_id, cast(try_cast(nullif(trim(d), '') as double) as bigint) as review_days, try_cast(nullif(trim(f), '') as double) as permit_fee from v""")
def prj_coerce_types(t: Tables) -> DataFrame:
    """PRJ6: text cells to numbers; a column of whole numbers becomes integer."""
    from docketlake.sources.records import field_value

    raw = t.observations.select("obs_id", F.from_json("data", "struct<item:struct<review_days:string,permit_fee:string>>")["item"].alias("i"))
    cells = raw.select("obs_id", field_value(F.col("i.review_days")).alias("review_days"), field_value(F.col("i.permit_fee")).alias("permit_fee"))
    return shape.coerced(cells, ["review_days", "permit_fee"])


@R.add("select target_id as \"Target\", roster as \"Roster\", name as \"Name\", null::varchar as \"County\", coalesce(state, 'NA') as \"State\", coalesce(geo_id, 'NA') as \"FIPS\" from targets")
def prj_titles(t: Tables) -> DataFrame:
    """PRJ5, PRJ7, PRJ8: declared columns, titles, and NA for what is missing."""
    shaped = shape.conform(t.targets.select("target_id", "roster", "state", "name", "geo_id").fillna("NA", ["state", "geo_id"]), ["target_id", "roster", "name", "county", "state", "geo_id"])
    return shape.titled(shaped, {"target_id": "Target", "roster": "Roster", "name": "Name", "county": "County", "state": "State", "geo_id": "FIPS"})


@R.add(r"select doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) as text from documents where text is not null")
def prj_collapse_text(t: Tables) -> DataFrame:
    """PRJ10: white space collapsed."""
    return t.documents.where("text is not null").select("doc_id", text.collapse(F.col("text")).alias("text"))


@R.add("""
select a.artifact_id, case when a.source = 'search' then '_shared' when t.state is not null and t.name is not null
  then 'by_state_name/' || trim(regexp_replace(lower(trim(t.state)), '[^a-z0-9]+', '_', 'g'), '_') || '/' || trim(regexp_replace(lower(trim(t.name)), '[^a-z0-9]+', '_', 'g'), '_')
  else '_targets/' || a.target_id end as folder from digger_artifacts a left join targets t using (target_id)""")
def prj_partition_path(t: Tables) -> DataFrame:
    """PRJ15: the folder of each artifact."""
    joined = t.digger_artifacts.select("artifact_id", "source", "target_id").join(t.targets.select("target_id", "state", "name"), "target_id", "left")
    scope = F.when(F.col("source") == "search", "shared").otherwise("target")
    return joined.select("artifact_id", shape.partition_path(scope, {"state": F.col("state"), "name": F.col("name")}, F.col("target_id")).alias("folder"))


@R.add("""
with p as (select artifact_id, url, trim(regexp_replace(lower(trim(regexp_extract(url, '([^/?#]*)([?#].*)?$', 1))), '[^a-z0-9]+', '_', 'g'), '_') as plain_name from digger_artifacts where url is not null),
n as (select *, row_number() over (partition by plain_name order by artifact_id) as rn from p)
select artifact_id, plain_name, case when rn = 1 then plain_name else plain_name || '_' || substr(sha256(url), 1, 8) end as name from n""")
def prj_document_names(t: Tables) -> DataFrame:
    """PRJ16: readable names; later claimants carry a hash of their owner."""
    a = t.digger_artifacts.where("url is not null").select("artifact_id", "url")
    plain = text.slug(F.regexp_extract("url", r"([^/?#]*)([?#].*)?$", 1))
    return shape.document_names(a, plain, F.col("url"), [F.col("artifact_id")]).select("artifact_id", "plain_name", "name")


@R.add("""
select target_id, trim(regexp_replace('Solar permits ' || trim(name) || ' ' || coalesce(trim(state), ''), '[ \\t\\n]+', ' ', 'g')) as query,
  case when nullif(trim(geo_id), '') is not null then 'FIPS ' || trim(geo_id) end as code from targets where nullif(trim(name), '') is not null""".replace("\\\\", "\\"))
def str_templates(t: Tables) -> DataFrame:
    """STR9-STR11: templates with required and optional fields."""
    f = {"name": F.col("name"), "state": F.col("state"), "geo_id": F.col("geo_id")}
    return t.targets.select("target_id", text.render("Solar permits {name} {state?}", f).alias("query"), text.render("FIPS {geo_id}", f).alias("code")).where("query is not null")


@R.add("""
select target_id, substr(md5(coalesce(roster, chr(0)) || chr(31) || coalesce(state, chr(0)) || chr(31) || coalesce(name, chr(0))), 1, 12) as identity from targets where state is not null""")
def hsh_identity(t: Tables) -> DataFrame:
    """M2, HSH1: stable ids of identity fields."""
    return t.targets.where("state is not null").select("target_id", short_id(F.col("roster"), F.col("state"), F.col("name")).alias("identity"))


@R.add("""
select artifact_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) as host,
  lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/[^/]*(\\.[A-Za-z0-9]{1,5})$', 1)) as extension,
  regexp_matches(url, '^(?i)https?://[^/?#\\s]+') as is_http from digger_artifacts where url is not null""")
def str_url_parts(t: Tables) -> DataFrame:
    """STR12: host, extension and scheme of addresses."""
    u = F.col("url")
    return t.digger_artifacts.where("url is not null").select("artifact_id", urls.host_of(u).alias("host"), urls.extension_of(u).alias("extension"), urls.is_http(u).alias("is_http"))


@R.add("""
with u as (select artifact_id, url, string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&') as q from digger_artifacts where url is not null),
k as (select *, array_to_string(list_filter(q, lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_[a-z_]+|fbclid|gclid|dclid|msclkid|yclid|mc_cid|mc_eid|igshid|_ga|_gl|ref_src|spm|vero_id|wickedid)(=|$)')), '&') as kept from u)
select artifact_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) || case when kept <> '' then '?' || kept else '' end as url from k""")
def str_url_canonical(t: Tables) -> DataFrame:
    """STR12: one written form, without tracking parameters."""
    return t.digger_artifacts.where("url is not null").select("artifact_id", urls.canonical(F.col("url")).alias("url"))
