"""Ranking, caps, fair staging, budgets and packing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.operators.joins import first_of


def interleaved(df: DataFrame, key: str, rank: str, list_position: str) -> DataFrame:
    """Several ranked lists as one: by rank, then by list; the first place of each key counts.  Adds ``place``."""
    kept = first_of(df, [key], [F.col(rank), F.col(list_position)])
    return with_place(kept, [F.col(rank), F.col(list_position)])


def with_place(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Adds the global place of each row.

    A global order needs no single task: rows are range-partitioned and sorted,
    counted per partition, and the counts before a partition are added.
    """
    from docketlake.session import cut

    spread = cut(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()))
    w = Window.partitionBy("_part").orderBy("_in")
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return spread.withColumn("_row", F.row_number().over(w)).join(F.broadcast(before), "_part").withColumn(name, F.col("_row") + F.col("_before")).drop("_part", "_in", "_row", "_before")


def place_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "place") -> DataFrame:
    """Adds the place of each row within its group, for groups that are few and long.

    A window would sort each group in one task; here the groups lie one after the
    other in a global order, and the places before a group are taken off.
    """
    placed = with_place(df, [*(F.col(g) for g in group), *order], "_place")
    names = [f"_g{i}" for i in range(len(group))]
    first = placed.groupBy(*(F.col(g).alias(n) for g, n in zip(group, names))).agg((F.min("_place") - 1).alias("_before"))
    same = F.lit(True)
    for g, n in zip(group, names):
        same = same & F.col(g).eqNullSafe(F.col(n))
    from docketlake.session import broadcast_if_small

    return placed.join(broadcast_if_small(first), same).withColumn(name, F.col("_place") - F.col("_before")).drop("_place", "_before", *names)


def top_links(df: DataFrame, group: Sequence[str], score: str, position: str, top: int | None = None) -> DataFrame:
    """Candidates of each group by score, ties in their own order; adds ``rank`` and ``original_rank``, the place they had."""
    own = df.withColumn("original_rank", F.row_number().over(Window.partitionBy(*group).orderBy(position)))
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.col(score).desc(), position)))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def reach_around(lines: DataFrame, document: str, number: str, line: str, hits: DataFrame, most: int) -> DataFrame:
    """``(document, hit, number)``: lines on either side of a hit whose non-blank text adds up to ``most`` characters, the nearest always.

    ``hits`` (document, hit).  The text before a line is a prefix sum, so reach is
    a difference of two sums; the join is bounded by the lines that ``most`` characters may span.
    """
    w = Window.partitionBy(document).orderBy(number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = lines.select(document, number, F.length(F.trim(line)).alias("_n")).where("_n > 0").withColumn("_upto", F.sum("_n").over(w)).withColumn("_order", F.row_number().over(Window.partitionBy(document).orderBy(number)))
    at = hits.join(summed, (hits[document] == summed[document]) & (hits["hit"] == summed[number])).select(hits[document], "hit", F.col("_upto").alias("_at"), F.col("_n").alias("_own"), F.col("_order").alias("_mid"))
    near = summed.join(at, document).where(F.col(number) != F.col("hit"))
    after = (F.col(number) > F.col("hit")) & ((F.col("_upto") - F.col("_at") <= most) | (F.col("_order") == F.col("_mid") + 1))
    before = (F.col(number) < F.col("hit")) & ((F.col("_at") - F.col("_own") - F.col("_upto") + F.col("_n") <= most) | (F.col("_order") == F.col("_mid") - 1))
    return near.where(after | before).select(document, "hit", number)


def capped_top(df: DataFrame, group: Sequence[str], host: str, order: Sequence[Column], cap: int, top: int) -> DataFrame:
    """The best ``top`` rows of each group with at most ``cap`` of one host.

    Skipping a full host does not touch others, so two ranks give the greedy
    result exactly; both filters prune before the shuffle.
    """
    a = df.withColumn("_h", F.row_number().over(Window.partitionBy(*group, host).orderBy(*order))).where(F.col("_h") <= cap)
    b = a.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)
    return b.drop("_h")


def round_robin(df: DataFrame, owner: str, owner_order: str, order: Sequence[Column], most: int) -> DataFrame:
    """The first ``most`` rows when owners take turns, one row each per round.

    At most ``most`` rounds can matter, so longer owners are cut to that first.
    """
    turn = df.withColumn("round", F.row_number().over(Window.partitionBy(owner).orderBy(*order))).where(F.col("round") <= most)
    return turn.orderBy("round", owner_order).limit(most)


def within_budget(df: DataFrame, group: Sequence[str], amount: str, order: Sequence[Column], budget: float) -> DataFrame:
    """Rows of each group, in order, until the running amount would pass the budget (amounts are positive)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("spent", F.sum(amount).over(w)).where(F.col("spent") <= budget)


def packed(df: DataFrame, group: str, size: str, position: str, most_items: int, most_size: int) -> DataFrame:
    """Adds ``batch`` (from 1): a new batch starts at ``most_items`` items or where ``most_size`` would be passed.

    Sequential within a group; rows stream through in order with the running
    state only, so a group of any size is never held.
    """
    ordered = df.repartition(F.col(group)).sortWithinPartitions(group, position)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, batch, items, total = None, 0, 0, 0
        for pdf in frames:
            out = []
            for g, n in zip(pdf[group], pdf[size]):
                n = int(n) + 1
                if g != now:
                    now, batch, items, total = g, 1, 0, 0
                elif items >= most_items or total + n > most_size:
                    batch, items, total = batch + 1, 0, 0
                items, total = items + 1, total + n
                out.append(batch)
            yield pdf.assign(batch=out)

    return ordered.mapInPandas(run, f"{fields}, batch int")


def set_cover(df: DataFrame, group: str, labels: str, relevance: str, host: str, tie: str, top: int, cap: int) -> DataFrame:
    """Documents chosen one by one, each time the one with most new labels, then relevance, then ``tie``.

    ``cap`` bounds a host's documents.  Candidates that can never be chosen, those
    beyond the best ``cap * top`` of one (host, label set), are left out before
    the groups are formed, which keeps a group to its different label sets.
    Result: (group, tie, pick).
    """
    labelled = df.withColumn("_labels", F.array_join(F.array_sort(F.array_distinct(labels)), "\x1f"))
    w = Window.partitionBy(group, host, "_labels").orderBy(F.col(relevance).desc(), F.col(tie))
    slim = labelled.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).select(group, host, "_labels", relevance, tie)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        left = [(set(filter(None, s.split("\x1f"))), r, t, h) for s, r, t, h in zip(pdf["_labels"], pdf[relevance], pdf[tie], pdf[host])]
        covered: set[str] = set()
        used: dict = {}
        picks = []
        while left and len(picks) < top:
            able = [x for x in left if used.get(x[3], 0) < cap]
            if not able:
                break
            best = min(able, key=lambda x: (-len(x[0] - covered), -x[1], x[2]))
            left.remove(best)
            covered |= best[0]
            used[best[3]] = used.get(best[3], 0) + 1
            picks.append(best[2])
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(picks), tie: picks, "pick": range(1, len(picks) + 1)})

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return slim.groupBy(group).applyInPandas(choose, f"`{group}` {kinds[group]}, `{tie}` {kinds[tie]}, pick int")


def dense_pages(pages: DataFrame, document: str, score: str, share: float = 0.4) -> DataFrame:
    """Pages whose score reaches max(1, int(share * best)) of their document."""
    best = F.max(score).over(Window.partitionBy(document))
    return pages.withColumn("_least", F.greatest(F.lit(1), F.floor(best * share))).where(F.col(score) >= F.col("_least")).drop("_least")


def running_lines(lines: DataFrame, document: str, page: str, line: str) -> DataFrame:
    """``(document, line, pages)``: lines that stand on more than half of a document's pages, and on more than one."""
    pages = lines.groupBy(document).agg(F.count_distinct(page).alias("_pages"))
    counts = lines.groupBy(document, line).agg(F.count_distinct(page).alias("pages"))
    return counts.join(pages, document).where("pages > greatest(1, _pages / 2)").drop("_pages")
