"""Composite plans: compile, select candidates, validate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions import urls
from docketlake.operators import dedup, joins, ranking, shape, votes
from docketlake.plans.schema_plan import SchemaPlan


def compile_rows(records: DataFrame, plan: SchemaPlan, payload: str, position: str) -> DataFrame:
    """Rows mode: payload JSON to typed, deduplicated, titled rows.

    Context and items are exploded, childless items stay, declared columns come
    in order, text numbers are typed, rows of one identity fold to the most
    complete, with a note.
    """
    parsed = records.select(position, F.from_json(payload, plan.payload).alias("_p"))
    items = parsed.select(position, *(F.col("_p")[c].alias(f"c_{c}") for c in plan.context), F.posexplode(F.col("_p")[plan.main]).alias("_i", "_item"))
    kept = [position, "_i", *(f"c_{c}" for c in plan.context)]
    if plan.row_array:
        rows = items.select(*kept, "_item", F.posexplode_outer(F.col("_item")[plan.row_array]).alias("_j", "_child"))
    else:
        rows = items.select(*kept, "_item", F.lit(0).alias("_j"))
    names = {**{c: F.col(f"c_{c}") for c in plan.context}, **{c: F.col("_item")[c] for c in plan.item}, **({c: F.col("_child")[c] for c in plan.child} if plan.row_array else {})}
    cells = []
    for c in plan.columns:
        kind = plan.payload
        kind = (kind[c].dataType if c in plan.context and c not in plan.item else kind[plan.main].dataType.elementType[c].dataType) if c not in plan.child else kind[plan.main].dataType.elementType[plan.row_array].dataType.elementType[c].dataType
        cells.append((names[c]["value"] if c in plan.evidence else shape.cell(names[c], kind)).alias(c))
    flat = rows.select(F.struct(position, "_i", "_j").alias("_at"), *cells)
    placed = flat.withColumn("pos", F.xxhash64("_at")).drop("_at") if not plan.keys else ranking.with_place(flat, [F.col("_at")], "pos").drop("_at")
    if not plan.keys:
        return shape.titled(placed.drop("pos"), plan.titles)
    out = dedup.exact_duplicates(placed, [*plan.partition, *plan.keys], "pos", plan.uris)
    noted = out.withColumn("merge_note", dedup.merge_note(plan.keys, F.col("duplicates"))).drop("duplicates", "pos")
    return shape.titled(noted, plan.titles)


def roster_table(targets: DataFrame, cells: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Roster mode: one row per target with the voted value of each field, ``NA`` where there is none.

    ``cells`` is the outcome of ``votes.url_vote`` by (target_id, field).
    """
    wide = cells.groupBy("target_id").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields), votes.weakest(F.col("confidence")).alias("confidence"), F.count("*").alias("answered"))
    table = targets.join(wide, "target_id", "left")
    return table.withColumns({f: F.coalesce(f, F.lit("NA")) for f in fields} | {"confidence": F.coalesce("confidence", F.lit("none")), "answered": F.coalesce("answered", F.lit(0))})


def select_candidates(candidates: DataFrame, target: str, url: str, gates: Sequence[tuple[str, Column]], order: Sequence[Column], top: int, cap: int) -> DataFrame:
    """Candidates through gates in order, then the capped best of each target.

    ``gates`` are (name, kept) pairs.  Adds ``outcome``: the gate that stopped a
    candidate, ``outranked`` or ``selected``.
    """
    stopped = F.lit(None).cast("string")
    for name, keep in reversed(list(gates)):
        stopped = F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)).otherwise(stopped)
    marked = candidates.withColumns({"_stop": stopped, "_host": urls.host_of(F.col(url))})
    chosen = ranking.capped_top(marked.where("_stop is null"), [target], "_host", order, cap, top).select(target, url, F.lit("selected").alias("_sel")).distinct()
    joined = marked.join(chosen, [target, url], "left")
    return joined.withColumn("outcome", F.coalesce("_stop", "_sel", F.lit("outranked"))).drop("_stop", "_sel", "_host")


def target_outcomes(selected: DataFrame, target: str, gates: Sequence[str]) -> DataFrame:
    """``(target, outcome)``: selected, or the last gate that a target's candidates reached."""
    rank = F.array_position(F.array(*(F.lit(g) for g in (*gates, "outranked", "selected"))), F.col("outcome"))
    return selected.groupBy(target).agg(F.max_by("outcome", rank).alias("outcome"))


def validation_lines(answers: DataFrame, keys: Sequence[str], label: str, role: str, value: str) -> DataFrame:
    """One line per item: status, majority, what the reference says and how urgent a look is."""
    status = votes.cell_status(answers, keys, value, role)
    majority = votes.strict_majority(answers.where(F.col(role) != "reference"), keys, value).select(*keys, F.col(value).alias("majority"), "votes", "voters")
    reference = answers.where(F.col(role) == "reference").groupBy(*keys).agg(F.count_distinct(value).alias("reference_kinds"), F.min(value).alias("reference"))
    lines = status.join(majority, list(keys), "left").join(reference, list(keys), "left")
    wrong = F.col("majority").isNotNull() & F.col("reference").isNotNull() & (F.col("majority") != F.col("reference"))
    urgent = F.when(wrong | (F.col("reference_kinds") > 1), "high").when(F.col("status") == "disputed", "medium").when(F.col("status").isin("partial", "reference_only"), "low").otherwise("none")
    return lines.withColumn("priority", urgent)


def donated(copies: DataFrame, caches: DataFrame, digest: str, key: str) -> DataFrame:
    """New copies of known bytes inherit the cached text of the smallest donor with the same digest."""
    donors = caches.groupBy(digest).agg(F.min(key).alias("donor"))
    return copies.join(caches.select(key), key, "left_anti").join(donors, digest).select(key, "donor")


def fresh(manifests: DataFrame, table: str, finished: str, digest: str, fingerprint: str, now: DataFrame) -> DataFrame:
    """Tables whose newest manifest succeeded with the digest and fingerprint of ``now``."""
    last = joins.latest(manifests, [table], finished, digest)
    return last.join(now, [table, digest, fingerprint], "left_semi").where("status = 'success'").select(table)
