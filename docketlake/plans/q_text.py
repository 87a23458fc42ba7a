"""Queries: sections, segments, markup, link tests, evidence paths and review samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions import markup, text, urls
from docketlake.operators import sections, shape
from docketlake.plans.common import CLAIMS_SQL, claims
from docketlake.plans.registry import Registry, Tables

R = Registry()
_STRIP = "regexp_replace({0}, '^[ \\t\\n\\f\\r]+|[ \\t\\n\\f\\r]+$', '', 'g')"
_FORM = "trim(regexp_replace(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


@R.add(f"""
with recursive t as (select doc_id, text, string_split(regexp_replace(text, '(?im)^(§\\s*\\d[\\d.]*|Sec(tion)?\\s+\\d[\\d.]*|Article\\s+[A-Z0-9]+|Chapter\\s+\\d[\\d.]*)', chr(1) || '\\1', 'g'), chr(1)) as m,
  list_filter(list_transform(string_split_regex(text, '\\n[ \\t\\n\\f\\r]*\\n'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') as p from documents where text is not null),
f as (select doc_id, p, 0 as i, 0 as n, 1 as part from t where len(m) <= 2 and len(p) > 1 union all
  select doc_id, p, i + 1, case when n + length(p[i + 1]) >= 2000 then 0 else n + length(p[i + 1]) end, case when n + length(p[i + 1]) >= 2000 then part + 1 else part end from f where i < len(p)),
g as (select doc_id, i as pos, lag(part) over (partition by doc_id order by i) as part, p[i] as x from f), parts as (select doc_id, part as section_no, 'Part ' || part as heading, string_agg(x, chr(10) || chr(10) order by pos) as body from g where pos > 0 group by 1, 2, 3),
u as (select doc_id, unnest(m) as x, generate_subscripts(m, 1) as k from t where len(m) > 2),
v as (select doc_id, k, case when k = 1 then '' else {_STRIP.format("split_part(x, chr(10), 1)")} end as heading, case when k = 1 then {_STRIP.format('x')} when contains(x, chr(10)) then {_STRIP.format("substr(x, strpos(x, chr(10)) + 1)")} else '' end as body from u),
r as (select doc_id, section_no, heading, body from parts union all select doc_id, row_number() over (partition by doc_id order by k), heading, body from v where body <> '' union all select doc_id, 1, '', p[1] from t where len(m) <= 2 and len(p) = 1)
select doc_id, section_no, heading, length(body) as chars, md5(body) as digest from r""")
def str_sections(t: Tables) -> DataFrame:
    """STR16, WIN11: texts cut at section marks, else paragraphs gathered into parts of about 2,000 characters."""
    s = sections.text_sections(t.documents, "doc_id", "text")
    return s.select("doc_id", "section_no", "heading", F.length("body").alias("chars"), F.md5("body").alias("digest"))


@R.add(f"""
with {CLAIMS_SQL}, q as (select obs_id, field, {_FORM.format('value')} as v, length(quote) // 2 as h, quote from claims where quote is not null),
s as (select *, {_FORM.format('substr(quote, 1, h)')} as a, {_FORM.format('substr(quote, h + 1)')} as b from q where v <> '')
select obs_id, field, contains(' ' || a || ' ', ' ' || v || ' ') or contains(' ' || b || ' ', ' ' || v || ' ') as present from s""")
def str_segment_quotes(t: Tables) -> DataFrame:
    """STR3: values that stand within one half of their quote; a value never bridges the cut."""
    q = claims(t).where("quote is not null").withColumn("h", F.floor(F.length("quote") / 2).cast("int"))
    form = q.select("obs_id", "field", text.evidence_form(F.col("value")).alias("v"), text.evidence_form(F.substring(F.col("quote"), F.lit(1), F.col("h"))).alias("a"), text.evidence_form(F.substring(F.col("quote"), F.col("h") + 1, F.length("quote"))).alias("b")).where("v != ''")
    return form.select("obs_id", "field", sections.quote_in_segments(F.col("v"), F.array("a", "b")).alias("present"))


@R.add("select obs_id, data as body from observations where data like '{%}'")
def str_model_json(t: Tables) -> DataFrame:
    """STR22: the JSON of a model's reply out of its fence and the prose around it."""
    reply = F.concat(F.lit("```json\n"), "data", F.lit("\n```"))
    chatty = F.concat(F.lit("Here it is: "), "data", F.lit("\nHope it helps."))
    return t.observations.where("data like '{%}'").select("obs_id", text.json_body(F.when(F.length("data") % 2 == 0, reply).otherwise(chatty)).alias("body"))


@R.add("select target_id, regexp_replace(trim(name), ' +', ' ', 'g') || ' & Co <' || coalesce(state, '') || '>' as label from targets where name is not null")
def str_html_fragment(t: Tables) -> DataFrame:
    """STR13: a small fragment of HTML as text, entities resolved."""
    html = F.concat(F.lit("<p><b>"), "name", F.lit("</b>&nbsp;&amp;\n<i>Co</i> &lt;"), F.coalesce("state", F.lit("")), F.lit("&gt;</p>"))
    return t.targets.where("name is not null").select("target_id", text.stripped_html(html).alias("label"))


def _page(t: Tables) -> DataFrame:
    """A small page made from each target."""
    cell = lambda c: F.concat(F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>"))
    link = F.concat(F.lit('<a href="/p/'), "target_id", F.lit('?a=1&amp;b=2">Go to <b>'), "name", F.lit("</b></a>"))
    html = F.concat(F.lit("<html><head><style>p {}</style></head><body><nav><a href='#top'>Menu</a></nav><h1>"), "name", F.lit("</h1><p>Rules   of the\nplace</p><table><tr>"), cell(F.col("roster")), cell(F.col("geo_id")), F.lit("</tr></table><script>var x = 1;</script><div>"), link, F.lit("<a href='mailto:x@y'>mail</a></div></body></html>"))
    return t.targets.where("name is not null").select("target_id", html.alias("html"))


@R.add("select target_id, regexp_replace(trim(name), ' +', ' ', 'g') || chr(10) || 'Rules of the place' || chr(10) || roster || case when geo_id is null then '' else chr(9) || geo_id end || chr(10) || 'Go to ' || regexp_replace(trim(name), ' +', ' ', 'g') || 'mail' as text from targets where name is not null")
def src_html_text(t: Tables) -> DataFrame:
    """SRC13: visible text of pages: blocks on lines, cells parted by tabs, scripts, styles and navigation left out."""
    from docketlake.sources.documents import html_to_text

    return _page(t).select("target_id", html_to_text(F.col("html")).alias("text"))


@R.add("select target_id, 'https://x.example/p/' || target_id || '?a=1&b=2' as address, 'Go to ' || regexp_replace(trim(name), ' +', ' ', 'g') as label from targets where name is not null")
def src_html_links(t: Tables) -> DataFrame:
    """SRC8: anchors of pages with their addresses made absolute and their texts."""
    from docketlake.sources.documents import links_of

    return links_of(_page(t), "target_id", "html", F.lit("https://x.example/start"))


@R.add("""
with c as (select target_id, 'Name: ' || trim(name) || case when coalesce(trim(state), '') <> '' then ' | State: ' || trim(state) else '' end || case when coalesce(trim(geo_id), '') <> '' then ' | FIPS: ' || trim(geo_id) else '' end as line from targets where trim(name) <> '')
select target_id, line from c""")
def src_table_lines(t: Tables) -> DataFrame:
    """SRC14: table rows as labelled lines below a header."""
    rows = F.array(F.array(F.lit("Name"), F.lit("State"), F.lit("FIPS")), F.array("name", "state", "geo_id"), F.array(F.lit(" "), F.lit(None), F.lit("")))
    return t.targets.where("trim(name) != ''").select("target_id", F.explode(sections.labelled_lines(rows)).alias("line"))


@R.add("select target_id, '| ' || coalesce(name, '') || ' | ' || coalesce(state, '') || ' | ' || coalesce(geo_id, '') || ' |' as line from targets")
def src_pipe_rows(t: Tables) -> DataFrame:
    """CMP27: cells as bordered rows, empty cells kept."""
    return t.targets.select("target_id", sections.pipe_row(F.array("name", "state", "geo_id")).alias("line"))


@R.add("""
with d as (select obs_id, json_extract(data, '$.item.required_documents') as v from observations where json_type(data, '$.item.required_documents') = 'ARRAY'), u as (select obs_id, unnest(from_json(v, '["json"]')) as x, generate_subscripts(from_json(v, '["json"]'), 1) as i from d)
select obs_id, 'item.required_documents[' || (i - 1) || ']' as location, x->>'$' as value from u
union all select obs_id, 'item.permit_fee.quote', json_extract_string(data, '$.item.permit_fee.quote') from observations where json_type(data, '$.item.permit_fee') = 'OBJECT' and json_exists(data, '$.item.permit_fee.quote')""")
def arr_evidence_nodes(t: Tables) -> DataFrame:
    """ARR2: every node that an evidence path reaches, with its location."""
    o = t.observations
    listed = sections.evidence_nodes(o, "obs_id", "data", ["item", "required_documents", "*"])
    return listed.union(sections.evidence_nodes(o, "obs_id", "data", ["item", "permit_fee", "quote"]))


@R.add("""
select obs_id, 'required_documents' as field, cast(json_array_length(data, '$.item.required_documents') as int) as entries from observations where json_type(data, '$.item.required_documents') = 'ARRAY' and json_array_length(data, '$.item.required_documents') > 0""")
def arr_data_arrays(t: Tables) -> DataFrame:
    """ARR3: fields of a payload that hold a list with entries."""
    return sections.data_arrays(t.observations.select("obs_id", F.get_json_object("data", "$.item").alias("item")), "obs_id", "item")


@R.add("""
with i as (select obs_id, json_extract_string(data, '$.item.permit_fee') as v, json_type(data, '$.item.permit_fee') as k, json_extract(data, '$.item.permit_fee') as o from observations where data like '{%')
select obs_id, v is null or trim(v) = '' or (k = 'OBJECT' and coalesce(json_extract_string(o, '$.value'), '') = '' and coalesce(json_extract_string(o, '$.quote'), '') = '') as blank from i""")
def arr_empty_values(t: Tables) -> DataFrame:
    """ARR3: field values of which nothing is filled."""
    return t.observations.where("data like '{%'").select("obs_id", sections.is_empty_json(F.get_json_object("data", "$.item.permit_fee")).alias("blank"))


@R.add("select * from (values ('jurisdiction.state', 'State'), ('target_id', 'Target ID'), ('geoId', 'geo_id'), ('FIPSCode', 'FIPS-code'), ('missing', null)) v(key, \"column\")")
def jn_field_columns(t: Tables) -> DataFrame:
    """JN21: declared key fields to the columns that bear their names in another word form."""
    found = sections.field_columns(["State", "Target ID", "geo_id", "FIPS-code", "name"], ["jurisdiction.state", "target_id", "geoId", "FIPSCode", "missing"])
    return t._spark.createDataFrame(found, "key string, column string")


@R.add("select * from (values ('permit_fee', 'high'), ('fee_note', 'high'), ('kind', 'medium'), ('contact_office', 'medium'), ('comment', null)) v(field, severity)")
def jsn_severity(t: Tables) -> DataFrame:
    """JSN3: severity of conflicts from the declared types, choices and names of the fields."""
    declared = [("permit_fee", ["number", "null"], False), ("fee_note", ["string"], False), ("kind", ["string"], True), ("contact_office", ["string"], False), ("comment", ["string"], False)]
    return t._spark.createDataFrame([(n, sections.severity_of(n, k, c, ["fee"], ["contact"])) for n, k, c in declared], "field string, severity string")


_SHELL = "case when status = 'empty' then '<html><div id=\"root\"></div><script>let a = 1</script></html>' when status = 'discovered' then '<html ng-app=\"x\">' || repeat('<a href=\"/p\">permit guide</a> ', 30) || '</html>' else '<html><p>' || coalesce(url, '') || '</p></html>' end"


@R.add(f"""
with h as (select artifact_id, status, {_SHELL} as html from digger_artifacts)
select artifact_id, coalesce(status = 'empty', false) as shell, coalesce(status = 'empty', false) as crawl_shell from h""")
def flt_shells(t: Tables) -> DataFrame:
    """FLT12: pages that a framework draws in the browser, by text and by anchors."""
    h = t.digger_artifacts.select("artifact_id", F.expr(_SHELL).alias("html"))
    return h.select("artifact_id", markup.is_shell(F.col("html")).alias("shell"), markup.is_crawl_shell(F.col("html")).alias("crawl_shell"))


@R.add("""
with a as (select artifact_id, url, replace(regexp_extract(url, '([^/?#]*)/?([?#].*)?$', 1), '-', ' ') as label from digger_artifacts where url is not null)
select artifact_id, lower(trim(label)) in ('home', 'search', 'contact', 'help', 'faq', 'about', 'privacy', 'terms', 'print', 'menu') as navigation, regexp_matches(lower(url), 'permit|zoning') as included,
  lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/[^/]*(\\.[A-Za-z0-9]{1,5})$', 1)) in ('.pdf', '.doc', '.docx', '.xls', '.xlsx', '.csv', '.txt', '.json', '.mp3', '.mp4', '.wav', '.m4a') or regexp_matches(lower(url), 'permit|zoning') as document from a""")
def flt_links(t: Tables) -> DataFrame:
    """FLT13: links that lead around a site, that the include patterns take, and that are documents."""
    label = F.translate(F.regexp_extract("url", r"([^/?#]*)/?([?#].*)?$", 1), "-", " ")
    return t.digger_artifacts.where("url is not null").select("artifact_id", markup.is_navigation(label).alias("navigation"), markup.matches_any(F.col("url"), ["permit", "zoning"]).alias("included"), markup.is_document_link(F.col("url"), ["permit", "zoning"]).alias("document"))


@R.add("""
with a as (select c_custkey, c_custkey % 256 as a, c_nationkey * 10 as b, c_custkey // 256 % 256 as c from customer)
select c_custkey, not (a in (0, 10, 127) or a >= 224 or (a = 100 and b between 64 and 127) or (a = 169 and b = 254) or (a = 172 and b between 16 and 31) or (a = 192 and b = 168) or (a = 192 and b = 0 and c in (0, 2)) or (a = 192 and b = 88 and c = 99) or (a = 198 and b in (18, 19)) or (a = 198 and b = 51 and c = 100) or (a = 203 and b = 0 and c = 113)) as public from a
union all select * from (values (-1, false), (-2, false), (-3, true), (-4, true), (-5, false), (-6, false)) v""")
def flt_public_addresses(t: Tables) -> DataFrame:
    """FLT10: hosts that may be fetched from, by address block (IPv4, IPv6) and name."""
    host = F.concat_ws(".", (F.col("c_custkey") % 256).cast("string"), (F.col("c_nationkey") * 10).cast("string"), (F.floor(F.col("c_custkey") / 256) % 256).cast("string"), F.lit("7"))
    made = t.customer.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), host.alias("host"))
    named = t._spark.createDataFrame([(-1, "localhost"), (-2, "[::1]"), (-3, "www.x.example"), (-4, "[2a00:1450::5]"), (-5, "fe80::1"), (-6, "db.internal")], "c_custkey bigint, host string")
    return made.union(named).select("c_custkey", markup.is_public_address(F.col("host")).alias("public"))


@R.add("select obs_id, list_transform(from_json(json_extract(data, '$.item.required_documents'), '[\"varchar\"]'), lambda x: x) as documents from observations where json_type(data, '$.item.required_documents') = 'ARRAY' and json_array_length(data, '$.item.required_documents') > 0")
def prj_numbered_list(t: Tables) -> DataFrame:
    """PRJ11: a map with numeric keys as a list in the order of the numbers."""
    listed = F.from_json(F.get_json_object("data", "$.item.required_documents"), "array<string>")
    o = t.observations.where(F.get_json_object("data", "$.item.required_documents").startswith("[")).select("obs_id", listed.alias("l")).where(F.size("l") > 0)
    turned = F.map_from_entries(F.reverse(F.transform("l", lambda x, i: F.struct(i.cast("string").alias("k"), x.alias("v")))))
    return o.select("obs_id", shape.numbered_list(turned).alias("documents"))


@R.add("""
with r as (select selection_id, unnest(ranges) as r from page_selections where ranges is not null)
select s.selection_id, case when s.ranges is null then 'whole' when count_if(r.r.start is null or r.r."end" is null) = 0 then 'ranges' when count_if(r.r.start is not null or r.r."end" is not null) = 0 then 'whole' else 'mixed' end as scope
from page_selections s left join r using (selection_id) group by s.selection_id, s.ranges is null""")
def src_range_scope(t: Tables) -> DataFrame:
    """SRC22: blank bounds mean the whole document and may not be mixed with ranges."""
    blank = F.size(F.filter("ranges", lambda r: r["start"].isNull() | r["end"].isNull()))
    filled = F.size(F.filter("ranges", lambda r: r["start"].isNotNull() | r["end"].isNotNull()))
    scope = F.when(F.col("ranges").isNull(), "whole").when(blank == 0, "ranges").when(filled == 0, "whole").otherwise("mixed")
    return t.page_selections.select("selection_id", scope.alias("scope"))


@R.add("""
select roster, 'Emit items only for these:' || chr(10) || string_agg('{"state":' || coalesce('"' || state || '"', 'null') || ',"name":"' || name || '"}', chr(10) order by target_id) || chr(10) || 'END' as block from targets where name is not null and state = 'VT' or name is not null and state is null group by roster""")
def prj_candidate_block(t: Tables) -> DataFrame:
    """PRJ14: the candidates of a roster as a block of lines for a model (identities of one state, and of no state)."""
    return sections.candidate_block(t.targets.where("name is not null and (state = 'VT' or state is null)"), "roster", ["state", "name"], "target_id", "Emit items only for these:", "END")


@R.add("""
select o_orderkey, cast(ceil((o_orderkey % 4000) * (o_custkey % 3000) / 750.0) as bigint) + 85 as tokens from orders""")
def mth_image_tokens(t: Tables) -> DataFrame:
    """MTH7: tokens of images by the size in their header."""
    four = lambda n: F.unhex(F.lpad(F.hex(n), 8, "0"))
    header = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), four(F.col("o_orderkey") % 4000), four(F.col("o_custkey") % 3000))
    return t.orders.select("o_orderkey", markup.png_tokens(header, 750, 85).alias("tokens"))


@R.add()
def str_state_evidence(t: Tables) -> DataFrame:
    """STR20: states that documents tell of: codes in addresses and labelled cells, cards, full names outside roster
    names (look-behind and name spans, so no SQL; tested on made cases)."""
    return sections.state_evidence(t.documents, "doc_id", "text", t.targets.where("name is not null"), "name")


__all__ = ["R", "urls"]
