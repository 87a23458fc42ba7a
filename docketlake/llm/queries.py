"""Queries of the training-data operators over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.survivors import survivors

    return survivors(table(spark, sf_dir, "observations"), table(spark, sf_dir, "extraction_results")).select("group_id", "field", "obs_id")


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.survivors import surviving_records

    return surviving_records(table(spark, sf_dir, "observations"), table(spark, sf_dir, "extraction_results"))


def p1_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values elected by graded weights, where many members may overrule the best-founded one."""
    from docketlake.llm.survivors import consensus_values

    return consensus_values(table(spark, sf_dir, "observations"), table(spark, sf_dir, "extraction_results"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.scans import noisy_lines

    return noisy_lines(table(spark, sf_dir, "captured_texts"), table(spark, sf_dir, "captured_sources"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.scans import repaired_paragraphs

    return repaired_paragraphs(table(spark, sf_dir, "captured_texts"), table(spark, sf_dir, "captured_sources"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.history import repeated_in_history

    return repeated_in_history(table(spark, sf_dir, "digger_artifacts"), table(spark, sf_dir, "captured_sources"))


def _web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.boilerplate import web_pages

    return web_pages(table(spark, sf_dir, "captured_texts"), table(spark, sf_dir, "captured_sources"), table(spark, sf_dir, "digger_artifacts"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.boilerplate import label_lines, train

    pages = _web_pages(spark, sf_dir)
    return label_lines(pages, train(pages)).where("not body").select("source_id", "line_no")


def p4_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.boilerplate import main_text, train

    pages = _web_pages(spark, sf_dir)
    return main_text(pages, train(pages))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.pieces import oversized

    return oversized(table(spark, sf_dir, "page_selections"), table(spark, sf_dir, "captured_texts"))


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.pieces import split_selections

    return split_selections(table(spark, sf_dir, "page_selections"), table(spark, sf_dir, "captured_texts"))


def p5_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source_id, piece_no, start, stop, piece)``: the captured texts, written out as files, cut by byte ranges."""
    from uuid import uuid4

    from docketlake.llm.pieces import split_files, written_files
    from docketlake.session import checkpoint_dir

    folder = f"{checkpoint_dir(spark).removeprefix('file:')}/files-{uuid4().hex}"
    pieces = split_files(written_files(table(spark, sf_dir, "captured_texts"), folder), max_bytes=4000, overlap_bytes=200)
    return pieces.select(F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("long").alias("source_id"), "piece_no", "start", "stop", "piece")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.consensus import label_consensus

    return label_consensus(table(spark, sf_dir, "cells")).select("cluster_id", "field", "value")


def p6_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.consensus import label_consensus

    return label_consensus(table(spark, sf_dir, "cells"))


def p6_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.consensus import annotator_reliability

    return annotator_reliability(table(spark, sf_dir, "cells"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_matches(spark, sf_dir).select("item_id", "target_id")


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.canonical import match_items

    return match_items(table(spark, sf_dir, "roster_items"), table(spark, sf_dir, "targets"), table(spark, sf_dir, "rosters"))


def p7_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values that meet no single target, by roster and reason."""
    from docketlake.llm.canonical import UNMATCHED

    items = table(spark, sf_dir, "roster_items").select("item_id", "roster")
    open_ = p7_matches(spark, sf_dir).where(F.col("target_id") == UNMATCHED)
    reason = F.when(F.col("candidates") == 0, "none near").otherwise("several")
    return open_.join(items, "item_id").groupBy("roster", reason.alias("reason")).agg(F.count("*").alias("items"))


def p7_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest entries of each typed value that meets no single one, by distance and reference frequency."""
    from docketlake.llm.canonical import ranked_candidates

    return ranked_candidates(table(spark, sf_dir, "roster_items"), table(spark, sf_dir, "targets"), table(spark, sf_dir, "rosters"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.encode import encode_corpus

    return encode_corpus(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.leakage import leaked_items

    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.leakage import leaked_items

    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=True)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.quality import not_prose

    return not_prose(table(spark, sf_dir, "documents"))


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketlake.llm.quality import text_statistics

    return text_statistics(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_records, p1_consensus, p2_found, p2_paragraphs, p3_found, p4_found, p4_body, p5_found, p5_pieces, p5_files, p6_found, p6_agreement, p6_reliability, p7_found, p7_matches, p7_unmatched, p7_candidates, p8_ids, p9_found, p9_spans, p10_found, p10_statistics)}

_ADDRESS = r"""
u as (select artifact_id, batch_no, regexp_replace(regexp_replace(regexp_replace(trim(url), '\s+', '', 'g'), '#.*$', ''), '^(?i)[a-z][a-z0-9+.-]*://', '') as u from digger_artifacts where url is not null and artifact_id is not null),
s as (select artifact_id, batch_no, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?#]*)', 1)), '^[^@]*@', ''), ':(80|443)?$', ''), '^www\d?\.', '') as host,
  url_decode(regexp_extract(u, '^[^/?]*(/[^?]*)', 1)) as path, list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda p: p <> '' and not regexp_matches(p, '^(?i)(utm_[a-z_]+|fbclid|gclid|msclkid|dclid|yclid|mc_cid|mc_eid|igshid|_ga|sessionid|session_id|session|sid|phpsessid|jsessionid|ref|ref_src)(=|$)'))) as q from u),
a as (select artifact_id, batch_no, host || regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '(/\.)+(/|$)', '\2', 'g'), '/(?i)(index|default)\.(html?|php|aspx?|jsp)$', '/'), '/{2,}', '/', 'g'), '/$', '') || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as address from s)"""

SQL: dict[str, str] = {
    "p3_found": f"""
with {_ADDRESS},
f as (select s.artifact_id, d.batch_no, lower(regexp_extract(s.sha256, '([0-9A-Fa-f]{{64}})', 1)) as digest from captured_sources s join digger_artifacts d using (artifact_id) where (s.size is null or s.size > 0)),
m as (select x.artifact_id, min(y.artifact_id) as first_id from a x join a y using (address) where x.batch_no >= 1 group by 1 union all select x.artifact_id, min(y.artifact_id) from f x join f y using (digest) where x.batch_no >= 1 and x.digest <> '' group by 1)
select min(first_id) as first_artifact_id, artifact_id from m where first_id < artifact_id group by artifact_id""",
    "p5_found": """
with p as (select source_id, unnest(string_split(text, chr(10) || chr(12) || chr(10))) as x, generate_subscripts(string_split(text, chr(10) || chr(12) || chr(10)), 1) as page from captured_texts)
select selection_id from page_selections s join p using (source_id) where s.ranges is null or len(list_filter(s.ranges, lambda r: p.page between r.start and r."end")) > 0 group by selection_id, max_chars having sum(length(x)) > max_chars""",
}
