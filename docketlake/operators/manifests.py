"""Manifests of runs: tolerant scans, cumulative accounting, reachability of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_manifests(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Manifest files below a folder and warnings for those that cannot be read.

    A broken file, and one without a run_id, is a warning (path, problem); of
    several manifests of one run the first by path counts.
    """
    raw = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    rows = raw.select("*", F.col("_metadata.file_path").alias("path")).cache()
    problem = F.when(F.col("_corrupt").isNotNull(), "no JSON").when(F.col("run_id").isNull(), "no run_id")
    good = rows.where(problem.isNull()).drop("_corrupt")
    first = good.groupBy("run_id").agg(F.min_by(F.struct(*(c for c in good.columns if c != "run_id")), "path").alias("_m")).select("run_id", "_m.*")
    return first, rows.where(problem.isNotNull()).select("path", problem.alias("problem"))


def pipeline_accounting(manifests: DataFrame, receipts: DataFrame) -> DataFrame:
    """``(stage, runs, calls, tokens, cost, from_receipts)``: cumulative usage over all runs, by stage and in all (``*``).

    ``manifests`` (stage, run_id, path, calls, tokens, cost), ``receipts`` (stage,
    run_id, attempt_id, tokens, cost).  A run counts once, by its first manifest;
    an attempt counts once.  Where a run left receipts these are its usage, also
    if it never wrote a manifest; the manifest's own figures are the fallback.
    Sums are decimal, so that their order does not matter.
    """
    money = lambda c: F.col(c).cast("decimal(18,6)")
    runs = manifests.groupBy("stage", "run_id").agg(F.min_by(F.struct("calls", "tokens", "cost"), F.struct("path", "cost")).alias("_m")).select("stage", "run_id", "_m.*")
    spent = receipts.groupBy("stage", "run_id", "attempt_id").agg(F.max(F.struct("tokens", "cost")).alias("_r")).select("stage", "run_id", "_r.*")
    spent = spent.groupBy("stage", "run_id").agg(F.count("*").alias("r_calls"), F.sum(F.coalesce("tokens", F.lit(0))).alias("r_tokens"), F.sum(F.coalesce(money("cost"), F.lit(0))).alias("r_cost"))
    both = runs.join(spent, ["stage", "run_id"], "full")
    use = both.select("stage", "run_id", F.col("r_calls").isNotNull().alias("_by"), F.coalesce("r_calls", "calls", F.lit(0)).cast("bigint").alias("calls"), F.coalesce("r_tokens", "tokens", F.lit(0)).cast("bigint").alias("tokens"), F.coalesce(F.col("r_cost").cast("decimal(18,6)"), money("cost"), F.lit(0)).cast("decimal(18,6)").alias("cost"))
    return use.rollup("stage").agg(F.count("*").alias("runs"), F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens"), F.sum("cost").cast("double").alias("cost"), F.count_if("_by").alias("from_receipts")).withColumn("stage", F.coalesce("stage", F.lit("*")))


def reachable_runs(entries: DataFrame) -> DataFrame:
    """``(run_id)`` of the runs that an entry of the checkpoint, complete or not, refers to."""
    return entries.where("run_id is not null").select("run_id").distinct()


def reachable_paths(entries: DataFrame) -> DataFrame:
    """``(path, incomplete)``: files that entries refer to: artifacts and curated files of complete owners, outcomes of incomplete ones.

    ``entries`` (owner, incomplete, run_id, artifacts, curated, outcomes), the last three arrays of paths.
    """
    kept = F.when(F.col("incomplete"), F.col("outcomes")).otherwise(F.concat(F.coalesce("artifacts", F.array().cast("array<string>")), F.coalesce("curated", F.array().cast("array<string>"))))
    return entries.select(F.coalesce("incomplete", F.lit(False)).alias("incomplete"), F.explode(kept).alias("path")).where("path is not null").groupBy("path").agg(F.bool_or("incomplete").alias("incomplete"))


def orphaned(files: DataFrame, entries: DataFrame) -> DataFrame:
    """``(run_id, files, bytes)``: runs that no entry refers to, with what deleting them all would free.

    ``files`` (run_id, path, inode, size).  Hard links to one inode hold its bytes
    once: they count at the first path among the orphaned files, and not at all
    while a file that stays links to them.
    """
    kept = reachable_runs(entries)
    gone = files.join(kept, "run_id", "left_anti")
    held = files.join(kept, "run_id", "left_semi").select("inode").distinct()
    first = gone.where("inode is not null").groupBy("inode").agg(F.min(F.struct("path", "run_id")).alias("_f")).join(held, "inode", "left_anti").select("inode", "_f.path", "_f.run_id", F.lit(True).alias("_counts"))
    marked = gone.join(first, ["inode", "path", "run_id"], "left")
    return marked.groupBy("run_id").agg(F.count("*").alias("files"), F.coalesce(F.sum(F.when(F.coalesce("_counts", F.lit(False)) | F.col("inode").isNull(), F.col("size"))), F.lit(0)).alias("bytes"))


def retained(df: DataFrame, owner: str, finished: str, run: str, most: int) -> DataFrame:
    """Runs of each owner beyond its ``most`` newest ones."""
    from pyspark.sql import Window

    w = Window.partitionBy(owner).orderBy(F.col(finished).desc_nulls_last(), F.col(run).desc())
    return df.select(owner, run, finished).distinct().withColumn("_n", F.row_number().over(w)).where(F.col("_n") > most).select(owner, run)


def run_manifest(tables: dict[str, DataFrame], run_id: str, stage: str) -> DataFrame:
    """``(run_id, stage, table, rows, digest)``: one row per table of a run, to be appended to a fact table.

    The digest sums the hashes of the rows, so it does not depend on their order.
    """
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(F.to_json(F.struct(*df.columns))).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))
        one = one.select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit(name).alias("table"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out
