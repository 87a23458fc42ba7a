"""Joins of the evidence pipeline: lookups, lockstep, n-gram dictionary and similarity joins, merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.session import broadcast_if_small, cut


def lookup(items: DataFrame, roster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every item with its roster entry, null where there is none; the roster is broadcast only if it is small."""
    return items.join(broadcast_if_small(roster), list(keys), "left")


def on_roster(items: DataFrame, roster: DataFrame, keys: Sequence[str]) -> DataFrame:
    return items.join(broadcast_if_small(roster.select(*keys).distinct()), list(keys), "left_semi")


def first_of(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; the filter on the rank lets tasks drop rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def lockstep(left: DataFrame, right: DataFrame, position: str, key: str) -> DataFrame:
    """Two tables row by row, with ``matches`` false where a side is missing or the keys differ."""
    a = left.select(F.col(position), F.col(key).alias("left_key"))
    b = right.select(F.col(position), F.col(key).alias("right_key"))
    return a.join(b, position, "full").withColumn("matches", F.coalesce(F.col("left_key") == F.col("right_key"), F.lit(False)))


def cross_product(dimensions: Sequence[DataFrame], limit: int | None = None) -> DataFrame:
    """All combinations of small dimensions, in their order.

    Combinations are counted by index arithmetic and looked up by equi-joins, so
    no cartesian operator runs and a limit stops early.
    """
    sizes = [d.count() for d in dimensions]
    total = 1
    for n in sizes:
        total *= n
    if limit is not None:
        total = min(total, limit)
    spark = dimensions[0].sparkSession
    out = spark.range(total).withColumnRenamed("id", "pos")
    step = 1
    for d, n in list(zip(dimensions, sizes))[::-1]:
        indexed = d.withColumn("_i", F.row_number().over(Window.orderBy(*d.columns)) - 1)
        out = out.withColumn("_i", F.expr(f"cast(pos div {step} % {max(n, 1)} as int)")).join(broadcast_if_small(indexed), "_i").drop("_i")
        step *= n
    return out


def roster_names(targets: DataFrame, id_col: str, name_col: str, identity: Sequence[str]) -> DataFrame:
    """``(id, form, head, words, namesakes, told_by)``: the dimension by which texts are scanned for targets.

    ``form`` is the name as words in lower case and ``head`` its first; ``namesakes``
    counts the other targets of the same form, and ``told_by`` names the identity
    fields whose values differ among them, which a text must then tell.  Names
    without a word are left out.
    """
    words = F.filter(F.split(F.lower(F.col(name_col)), r"[^a-z0-9]+"), lambda w: w != "")
    t = targets.where(F.size(words) > 0).select(id_col, *identity, words.alias("_w")).withColumn("form", F.array_join("_w", " "))
    kinds = t.groupBy("form").agg(F.count_distinct(id_col).alias("_n"), *(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"_k_{c}") for c in identity))
    told = F.concat_ws(",", *(F.when(F.col(f"_k_{c}") > 1, F.lit(c)) for c in identity))
    return t.join(broadcast_if_small(kinds), "form").select(id_col, "form", F.get("_w", F.lit(0)).alias("head"), F.size("_w").alias("words"), (F.col("_n") - 1).alias("namesakes"), told.alias("told_by"))


def dictionary_hits(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, name_id: str, name_col: str) -> DataFrame:
    """``(id, name_id, hits)``: how often each name stands in each text, as whole words.

    Texts become word n-grams, only as long as names are, and only those whose
    first word begins some name; they meet the names by an equi-join.
    """
    words = lambda c: F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != "")
    named = names.select(F.col(name_id).alias("_name"), F.array_join(words(F.col(name_col)), " ").alias("_gram"), F.size(words(F.col(name_col))).alias("_size")).where("_gram != ''").distinct()
    longest = named.agg(F.max("_size")).first()[0] or 0
    if not longest:
        return texts.select(id_col).limit(0).withColumns({name_id: F.lit(None).cast(names.schema[name_id].dataType), "hits": F.lit(0).cast("bigint")})
    first = named.select(F.substring_index("_gram", " ", 1).alias("_word")).distinct()
    tokens = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), words(F.col(text_col)).alias("_w"))
    # a word with the words that may follow it in a name; the array itself stays behind
    at = F.transform(F.sequence(F.lit(1), F.size("_w")), lambda i: F.struct(F.get("_w", i - 1).alias("word"), F.slice("_w", i, F.lit(longest)).alias("rest")))
    starts = tokens.where(F.size("_w") > 0).select("_id", F.explode(at).alias("_s")).select("_id", F.col("_s.word").alias("_word"), F.col("_s.rest").alias("_rest")).join(broadcast_if_small(first), "_word")
    grams = starts.select("_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("_rest")), lambda n: F.array_join(F.slice("_rest", F.lit(1), n), " "))).alias("_gram"))
    hits = grams.join(broadcast_if_small(named.drop("_size")), "_gram").groupBy("_id", "_name").agg(F.count("*").alias("hits"))
    return hits.select(F.col("_id").alias(id_col), F.col("_name").alias(name_id), "hits")


def gram_pairs(df: DataFrame, id_col: str, grams: str, least: float, scope: Sequence[str] = ()) -> DataFrame:
    """``(left_id, right_id, score, kind)`` of rows whose gram sets overlap by at least ``least`` of the smaller set.

    Rows with the same grams are one class: its smallest id stands for it, and the
    others come out as ``copy`` of it.  Pairs of classes are ``near``.  Prefix filter:
    grams are numbered from rare to common, and of a set of n only the first
    n - ceil(least * n) + 1 are joined, which no overlapping pair can miss; the
    whole sets are then compared.  Common grams thus make no bucket.

    Classes and grams travel as numbers.  No side is ever broadcast: its shuffled
    size, by which the planner would decide, is that of packed rows, and unpacked
    they fill the driver.  Runs its jobs when called.
    """
    from docketlake.operators.ranking import with_place

    base = df.where(F.size(grams) > 0).select(*scope, F.col(id_col).alias("_id"), F.array_sort(F.array_distinct(grams)).alias("_set"))
    rows = base.select(*scope, "_id", "_set", F.xxhash64("_set").alias("_h1"), F.xxhash64(F.lit(1), "_set").alias("_h2"))
    sets = cut(rows.groupBy(*scope, "_h1", "_h2").agg(F.min("_id").alias("_id"), F.first("_set").alias("_set"), F.count("*").alias("_rows")).withColumn("_no", F.monotonically_increasing_id()))
    members = rows.select(*scope, "_h1", "_h2", F.col("_id").alias("_member")).join(sets.where("_rows > 1").select(*scope, "_h1", "_h2", "_id").hint("merge"), [*scope, "_h1", "_h2"]).where("_id != _member")
    copies = members.select(*scope, F.col("_id").alias("left_id"), F.col("_member").alias("right_id"), F.lit(1.0).alias("score"), F.lit("copy").alias("kind"))
    each = sets.select(*scope, "_no", F.size("_set").alias("_n"), F.explode("_set").alias("gram"))
    counts = each.groupBy(*scope, "gram").agg(F.count("*").alias("times")).where("times > 1")
    numbered = with_place(counts, [F.col("times"), F.col("gram"), *(F.col(c) for c in scope)], "_gram").drop("times")
    # a gram that no other class has joins nothing, but takes its place in the prefix
    ordered = cut(each.join(numbered.hint("merge"), [*scope, "gram"]).groupBy("_no", "_n").agg(F.array_sort(F.collect_list("_gram")).alias("o")))
    own = F.col("_n") - F.size("o")
    prefix = F.slice("o", F.lit(1), F.greatest(F.lit(0), (F.col("_n") - F.ceil(F.col("_n") * least) + 1 - own).cast("int")))
    # containment is by the smaller set, so its prefix meets all grams of the larger one; equal sizes go by number
    a = ordered.select(F.explode(prefix).alias("_gram"), F.col("_no").alias("_small"), "_n")
    b = ordered.select(F.explode("o").alias("_gram"), F.col("_no").alias("_large"), F.col("_n").alias("_m"))
    met = a.join(b.hint("merge"), "_gram").where("_n < _m or (_n = _m and _small < _large)").select("_small", "_large").distinct()
    whole = lambda no, n, o: ordered.select(F.col("_no").alias(no), F.col("_n").alias(n), F.col("o").alias(o)).hint("merge")
    pairs = met.join(whole("_small", "_n", "_a"), "_small").join(whole("_large", "_m", "_b"), "_large")
    score = F.size(F.array_intersect("_a", "_b")) / F.col("_n")
    scored = pairs.select("_small", "_large", score.alias("score")).where(F.col("score") >= least)
    named = sets.select(*scope, "_no", "_id")
    left = named.withColumnsRenamed({"_no": "_small", "_id": "_x"}).hint("merge")
    right = named.select(F.col("_no").alias("_large"), F.col("_id").alias("_y")).hint("merge")
    near = scored.join(left, "_small").join(right, "_large").select(*scope, F.least("_x", "_y").alias("left_id"), F.greatest("_x", "_y").alias("right_id"), "score", F.lit("near").alias("kind"))
    return near.unionByName(copies)


def upsert(existing: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fresh rows and the existing rows whose key is not fresh."""
    return existing.join(fresh.select(*keys).distinct(), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def merge_index(existing: DataFrame, promoted: DataFrame, withdrawn: DataFrame, owner: str) -> DataFrame:
    """An index without withdrawn owners, with promoted owners' rows in place of their earlier ones."""
    gone = withdrawn.select(owner).union(promoted.select(owner)).distinct()
    return existing.join(gone, owner, "left_anti").unionByName(promoted)


def ledger_merge(records: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Human decisions beside the records, by a key that is unique on both sides (else an error when run)."""
    unique = lambda df, name: df.withColumn("_n", F.count("*").over(Window.partitionBy(key))).where(F.assert_true(F.col("_n") == 1, F.lit(f"{name} repeats a key")).isNull()).drop("_n")
    return unique(records, "records").join(unique(decisions, "decisions"), key, "left")


def neighbours_of(hits: DataFrame, group: str, position: str, before: int, after: int, length: DataFrame | None = None) -> DataFrame:
    """Positions within reach of a hit, each once; with ``length`` (group, last) not beyond the end."""
    near = hits.select(group, F.explode(F.sequence(F.greatest(F.lit(1), F.col(position) - before), F.col(position) + after)).alias(position)).distinct()
    return near if length is None else near.join(length, group).where(F.col(position) <= F.col("last")).drop("last")


def islands(df: DataFrame, group: str, position: str) -> DataFrame:
    """``(group, first, last)``: runs of successive numbers."""
    w = Window.partitionBy(group).orderBy(position)
    return df.select(group, position).distinct().withColumn("_run", F.col(position) - F.row_number().over(w)).groupBy(group, "_run").agg(F.min(position).alias("first"), F.max(position).alias("last")).drop("_run")


def latest(df: DataFrame, keys: Sequence[str], order: str, tie: str) -> DataFrame:
    """The newest row of each key; ties go to the larger ``tie``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, tie)).alias("_r")).select(*keys, "_r.*")


def path_prefixes(path: Column) -> Column:
    """A path and all folders above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def overlapping_paths(paths: DataFrame, blocked: DataFrame, path: str) -> DataFrame:
    """Paths that equal, lie in or hold a blocked path: equi-joins on exploded prefixes both ways."""
    b = blocked.select(F.col(path).alias("_b")).distinct()
    inside = paths.select(path, F.explode(path_prefixes(F.col(path))).alias("_b")).join(b, "_b", "left_semi").select(path)
    above = b.select(F.explode(path_prefixes(F.col("_b"))).alias(path)).distinct()
    return paths.join(inside.union(above).distinct(), path, "left_semi")


def minimal_paths(paths: DataFrame, path: str) -> DataFrame:
    """Paths without one that lies in another path of the set."""
    p = paths.select(path).distinct()
    above = p.select(path, F.explode(path_prefixes(F.col(path))).alias("_a")).where(F.col("_a") != F.col(path))
    return p.join(above.join(p.select(F.col(path).alias("_a")), "_a", "left_semi").select(path), path, "left_anti")


def reachable(links: DataFrame, seeds: DataFrame, depth: int, cap: int | None = None) -> DataFrame:
    """``(page, depth)``: pages within ``depth`` links of the seeds, at their smallest depth.

    Breadth first with one join a level; each level keeps new pages only.  With
    ``cap`` the crawl keeps the first pages by (depth, page), a stated budget.
    """
    found = seeds.select(F.col("page")).distinct().withColumn("depth", F.lit(0))
    edge = found
    for level in range(1, depth + 1):
        edge = links.join(edge.select(F.col("page").alias("src")), "src").select(F.col("dst").alias("page")).distinct().join(found, "page", "left_anti").withColumn("depth", F.lit(level))
        found = cut(found.unionByName(edge))
        edge = found.where(F.col("depth") == level)
    return found if cap is None else found.orderBy("depth", "page").limit(cap)
