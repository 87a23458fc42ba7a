"""Target rosters: CSV, JSON, inline lists and cross products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.urls import is_http


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a ``.csv`` (header, byte-order mark tolerated, empty cell null, malformed row an error) or ``.json`` list."""
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    df = spark.read.csv(path, header=True, mode="FAILFAST", multiLine=True, escape='"')
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def inline(spark: SparkSession, rows: Sequence[Mapping[str, str]]) -> DataFrame:
    """Rows given in the configuration; all values are text."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


def normalised(targets: DataFrame) -> DataFrame:
    """``urls`` as a list of web addresses (text is split at ``|``; other schemes go), ``query`` null if blank."""
    kind = targets.schema["urls"].dataType.simpleString() if "urls" in targets.columns else "void"
    if kind == "string":
        listed = F.filter(F.transform(F.split("urls", r"\|"), lambda u: F.trim(u)), is_http)
    elif kind == "void":
        listed = F.array().cast("array<string>")
    else:
        listed = F.filter("urls", is_http)
    out = targets.withColumn("urls", F.coalesce(listed, F.array().cast("array<string>")))
    return out.withColumn("query", F.nullif(F.trim("query"), F.lit(""))) if "query" in targets.columns else out
