"""Extraction records, observations and their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(path, sha256, content)`` of all JSON records below a folder, internal folders (``_`` and ``.``) left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    return files.where(~F.col("path").rlike(r"/[._][^/]*/")).select("path", F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("content"))


def verified(records: DataFrame, admission: DataFrame) -> DataFrame:
    """Records that the admission view (path, sha256, disposition) admits with their very digest."""
    return records.join(admission.where(F.col("disposition").isin("new", "reused")), ["path", "sha256"], "left_semi")


def provenance_keys(files: DataFrame, path: str, owner: str, root: str = "") -> DataFrame:
    """``(key, owner)``: full path, path below ``root`` and base name, where the key names one owner only."""
    p = F.col(path)
    keys = F.array(p, F.regexp_replace(p, f"^{root}", ""), F.regexp_extract(p, r"([^/]*)$", 1))
    each = files.select(F.explode(keys).alias("key"), owner).where("key != ''")
    return each.groupBy("key").agg(F.min(owner).alias(owner), F.max(owner).alias("_last")).where(F.col(owner) == F.col("_last")).drop("_last")


def field_value(raw: Column) -> Column:
    """The value of a field written plain or as {value, quote} (text of a JSON value)."""
    return F.when(raw.startswith("{"), F.get_json_object(raw, "$.value")).otherwise(raw)


def field_quote(raw: Column) -> Column:
    return F.when(raw.startswith("{"), F.get_json_object(raw, "$.quote"))


def distinct_observations(observations: DataFrame, order: str) -> DataFrame:
    """One observation per (target, source): the first by ``order``; an equal id implies an equal source."""
    return observations.groupBy("target", "source").agg(F.min_by(F.struct(*(c for c in observations.columns if c not in ("target", "source"))), order).alias("_r")).select("target", "source", "_r.*")
