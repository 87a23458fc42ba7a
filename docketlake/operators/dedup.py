"""Duplicates of compiled rows: exact and wildcard keys, notes, conflicts, redundancy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_of(df: DataFrame, column: str, raw: Iterable[str] = ()) -> Column:
    """Comparison form: text trimmed and in lower case with null as blank (case kept for ``raw``); other types as they are."""
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, T.StringType):
        return c
    return F.coalesce(F.trim(c) if column in raw else F.lower(F.trim(c)), F.lit(""))


def filled(df: DataFrame, columns: Sequence[str]) -> Column:
    """How many of the columns hold something."""
    full = lambda c: (F.trim(F.col(c)) != "") if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).isNotNull()
    return sum((F.coalesce(full(c), F.lit(False)).cast("int") for c in columns), F.lit(0))


def exact_duplicates(df: DataFrame, keys: Sequence[str], position: str, raw: Iterable[str] = ()) -> DataFrame:
    """One row per key: the most complete, then the earliest; adds ``duplicates`` (how many it stands for besides itself).

    Without keys nothing is a duplicate.
    """
    if not keys:
        return df.withColumn("duplicates", F.lit(0).cast("bigint"))
    names = [f"_k{i}" for i in range(len(keys))]
    k = df.withColumns({n: key_of(df, c, raw) for n, c in zip(names, keys)})
    # folded before the shuffle: only the best row of each key travels
    rows = k.groupBy(*names).agg(F.max_by(F.struct(*df.columns), F.struct(filled(df, df.columns), -F.col(position))).alias("_r"), (F.count("*") - 1).alias("duplicates"))
    return rows.select("_r.*", "duplicates")


def merge_note(keys: Sequence[str], duplicates: Column, width: int = 30) -> Column:
    """What a survivor stands for, with up to two key values, long ones cut."""
    part = lambda c: F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) != "", F.when(F.length(c.cast("string")) > width, F.concat(F.substring(c.cast("string"), 1, width - 3), F.lit("..."))).otherwise(c.cast("string")))
    shown = F.array_compact(F.array(*(F.when(part(F.col(k)).isNotNull(), F.concat(F.lit(f"{k}='"), part(F.col(k)), F.lit("'"))) for k in keys)))
    where = F.when(F.size(shown) == 0, F.lit("all key fields")).otherwise(F.array_join(F.slice(shown, 1, 2), ", "))
    return F.when(duplicates > 0, F.concat(F.lit("Merged "), duplicates.cast("string"), F.lit(" duplicate(s) on: "), where))


def wildcard_duplicates(df: DataFrame, required: Sequence[str], fuzzy: Sequence[str], position: str) -> DataFrame:
    """One row per group of rows with equal required keys and fuzzy keys where null matches anything.

    Rows are folded to distinct key tuples before the shuffle.  Walking tuples
    by first position, an anchor takes every free tuple that equals it or is null
    wherever the anchor is filled; the survivor is the most complete row, then
    the earliest.  Adds ``group_pos``, the anchor's position, and ``members``.
    """
    if not required:
        raise ValueError("wildcard keys need at least one required key")
    req, fuz = [f"_r{i}" for i in range(len(required))], [f"_f{i}" for i in range(len(fuzzy))]
    rows = df.withColumns({n: key_of(df, c) for n, c in zip(req, required)} | {n: F.nullif(key_of(df, c), F.lit("")) for n, c in zip(fuz, fuzzy)}).withColumn("_full", filled(df, df.columns))
    tuples = rows.groupBy(*req, *fuz).agg(F.min(position).alias("_first"), F.count("*").alias("_n"), F.max_by(position, F.struct("_full", -F.col(position))).alias("_best"), F.max("_full").alias("_most"))

    def groups_of(tuples: list[tuple]) -> list[tuple]:
        """Tuples (values, first, n, best, most) of one required key, in order, with the anchor each goes to.

        Free tuples are listed by the value of each column; an anchor looks only at
        those that equal it, or are null, in its rarest filled column.
        """
        listed: list[dict] = [{} for _ in fuz]
        for i, t in enumerate(tuples):
            for k, v in enumerate(t[0]):
                listed[k].setdefault(v, []).append(i)
        free, out = [True] * len(tuples), []

        def still(k: int, v) -> list[int]:
            left = listed[k][v] = [i for i in listed[k].get(v, ()) if free[i]]
            return left

        for i, anchor in enumerate(tuples):
            if not free[i]:
                continue
            filled_in = [k for k, v in enumerate(anchor[0]) if v is not None]
            if filled_in:
                k = min(filled_in, key=lambda k: len(listed[k].get(anchor[0][k], ())) + len(listed[k].get(None, ())))
                near = sorted([*still(k, anchor[0][k]), *still(k, None)])
            else:
                near = range(i, len(tuples))
            taken = [j for j in near if free[j] and all(a is None or b is None or a == b for a, b in zip(anchor[0], tuples[j][0]))]
            for j in taken:
                free[j] = False
            out += [(anchor[1], *tuples[j][2:]) for j in taken]
        return out

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # partitions are sorted by key and position, so that one key's tuples are held at a time
        now, held = None, []
        for pdf in frames:
            out: list[tuple] = []
            columns = [pdf[c].astype(object).where(pdf[c].notna(), None) for c in (*req, *fuz)]
            for row in zip(*columns, pdf["_first"], pdf["_n"], pdf["_best"], pdf["_most"]):
                key = row[: len(req)]
                if key != now:
                    out += groups_of(held)
                    now, held = key, []
                held.append((row[len(req) : len(req) + len(fuz)], *row[len(req) + len(fuz) :]))
            yield pd.DataFrame(out, columns=["group_pos", "_n", "_best", "_most"])
        yield pd.DataFrame(groups_of(held), columns=["group_pos", "_n", "_best", "_most"])

    placed = tuples.repartition(*req).sortWithinPartitions(*req, "_first")
    grouped = placed.mapInPandas(walk, "group_pos bigint, _n bigint, _best bigint, _most int")
    best = grouped.groupBy("group_pos").agg(F.max_by("_best", F.struct("_most", -F.col("_best"))).alias(position), F.sum("_n").alias("members"))
    return df.join(best, position)


def conflicts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], position: str) -> DataFrame:
    """``(keys, column, n_values, examples)``: columns with different filled values within one key; the first three are shown."""
    names = [f"_k{i}" for i in range(len(keys))]
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias("value")) for c in columns))
    long = df.select(*(key_of(df, c).alias(n) for n, c in zip(names, keys)), position, F.explode(pairs).alias("p")).select(*names, position, "p.column", "p.value").where("value is not null")
    first = long.groupBy(*names, "column", "value").agg(F.min(position).alias("pos"))
    w = Window.partitionBy(*names, "column").orderBy("pos", "value")
    ranked = first.withColumn("n", F.row_number().over(w))
    out = ranked.groupBy(*names, "column").agg(F.max("n").alias("n_values"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n") <= 3, F.struct("n", "value")))), lambda x: x["value"]), " | ").alias("examples")).where("n_values > 1")
    return out.withColumnsRenamed(dict(zip(names, keys)))


def redundant_features(df: DataFrame, bucket: Sequence[str], feature: str, ranking: Sequence[str]) -> DataFrame:
    """Rows that survive when a bucket with two or more ranked features keeps only the most authoritative one."""
    rank = F.array_position(F.array(*(F.lit(r) for r in ranking)), F.col(feature))
    ranked = df.withColumn("_rank", F.when(rank > 0, rank))
    names = [f"_b{i}" for i in range(len(bucket))]
    top = ranked.groupBy(*(F.col(c).alias(n) for n, c in zip(names, bucket))).agg(F.min("_rank").alias("_top"), F.size(F.collect_set("_rank")).alias("_kinds"))
    condition = F.lit(True)
    for n, c in zip(names, bucket):
        condition = condition & F.col(c).eqNullSafe(F.col(n))
    return ranked.join(top, condition).where("_rank is null or _kinds < 2 or _rank = _top").select(*df.columns)


def identical_copies(df: DataFrame, digest: str, order: Sequence[Column]) -> DataFrame:
    """Every row with ``kept``: whether it is the best of the rows with the same digest (a null digest has no copies)."""
    w = Window.partitionBy(digest).orderBy(*order)
    return df.withColumn("kept", F.col(digest).isNull() | (F.row_number().over(w) == 1))


def covered_documents(df: DataFrame, group: Sequence[str], labels: str, rank: str, id_col: str) -> DataFrame:
    """``(id, by)``: documents whose label set lies within that of a larger or equal but better ranked one.

    Equal sets fold to their best document first, so that only different sets are compared.
    """
    sets = df.select(*group, F.array_sort(F.array_distinct(labels)).alias("_s"), F.col(rank).alias("_rank"), F.col(id_col).alias("_id"))
    w = Window.partitionBy(*group, "_s").orderBy("_rank", "_id")
    marked = sets.withColumn("_best", F.first("_id").over(w))
    equal = marked.where("_id != _best").select(F.col("_id").alias(id_col), F.col("_best").alias("by"))
    kinds = marked.where("_id = _best").select(*group, "_s", "_rank", "_id")
    each = kinds.select(*group, F.explode("_s").alias("label"), F.col("_s").alias("large"), F.col("_id").alias("by"), F.size("_s").alias("m"), F.col("_rank").alias("by_rank"))
    often = each.groupBy(*group, "label").agg(F.count("*").alias("_often"))
    # a larger set has the rarest label of a smaller one too: only there they meet
    rare = each.join(often, [*group, "label"]).groupBy(*group, F.col("by").alias(id_col)).agg(F.min_by("label", F.struct("_often", "label")).alias("label"), F.first("large").alias("small"))
    met = rare.join(each, [*group, "label"]).where((F.size("small") < F.col("m")) & (F.size(F.array_except("small", "large")) == 0))
    inside = met.groupBy(id_col).agg(F.min_by("by", F.struct(-F.col("m"), "by_rank", "by")).alias("by"))
    return equal.unionByName(inside)


def two_key_survivors(df: DataFrame, group: Sequence[str], first_key: str, second_key: str, position: str) -> DataFrame:
    """Rows whose two keys were both unseen by any earlier row of the group (duplicates still count as seen).

    A row is out if an earlier row has its first or its second key, so two
    minima tell it without walking the group.
    """
    w1, w2 = Window.partitionBy(*group, first_key), Window.partitionBy(*group, second_key)
    seen = df.withColumns({"_a": F.min(position).over(w1), "_b": F.min(position).over(w2)})
    fresh = (F.col(first_key).isNull() | (F.col("_a") == F.col(position))) & (F.col(second_key).isNull() | (F.col("_b") == F.col(position)))
    return seen.where(fresh).drop("_a", "_b")
