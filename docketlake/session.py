"""Session helpers shared by operators: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sides of at most this many rows and bytes may be broadcast by ``broadcast_if_small``.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local session without it (tests, a laptop) gets a temporary folder of
    its own; on a cluster that would be a folder the workers do not share, and is refused.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if sc._jsc.sc().getCheckpointDir().isDefined():
            return sc._jsc.sc().getCheckpointDir().get()
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all workers share")
        named = tempfile.mkdtemp(prefix="docketlake-checkpoint-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, so that later uses read it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for ``df`` when it has at most ``limit`` rows and, written out, ``most_bytes``; otherwise ``df`` as it is.

    The check reads ``limit + 1`` rows at most; beyond it the planner's own
    shuffled join is the other way.
    """
    width = F.length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))) if df.columns else F.lit(0)
    n, size = df.limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and size <= most_bytes else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per session, as a zip beside their Python path."""
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_docketlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="docketlake-"), "docketlake.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("docketlake", os.path.relpath(path, root)))
    sc.addPyFile(target)
    sc._docketlake_shipped = True
