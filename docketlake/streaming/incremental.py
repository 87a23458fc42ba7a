"""Incremental mode: documents and events as streams (an extension beside the batch operators)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def landing(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """Files as they land in a folder, so many per trigger (the bounded window of work)."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


def latest_by_key(stream: DataFrame, key: str, time: str, lateness: str) -> DataFrame:
    """Rows whose key was not seen within the watermark: redelivered rows are dropped, state is bounded by time."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, size: str, lateness: str, *by: str) -> DataFrame:
    """Counts per time window and key; a window closes once the watermark has passed it."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, size).alias("window"), *by).agg(F.count("*").alias("n"))


def upsert_sink(stream: DataFrame, target: str, keys: list[str], checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Keyed upsert of every micro-batch into versions of a table below ``target``.

    Each batch writes version ``v=<batch id>`` from the version before it and the
    batch; a batch that is run again overwrites its own version, so a restart
    gives the same table.
    """
    from docketlake.operators.joins import upsert

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys)
        before = f"{target}/v={number - 1}"
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(before)
        exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        out = fresh if not exists else (merge or (lambda a, b: upsert(a, b, keys)))(spark.read.parquet(before), fresh)
        out.write.mode("overwrite").parquet(f"{target}/v={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending_documents(batch: DataFrame, proofs: DataFrame, key: str) -> DataFrame:
    """Documents of a batch without a valid proof of an earlier extraction."""
    return batch.join(proofs.select(key).distinct(), key, "left_anti")


def attempts_left(stream: DataFrame, key: str, budget: int) -> DataFrame:
    """``(key, used, allowed)`` per micro-batch: a running count of attempts per key against a budget, kept as state."""
    kind = stream.schema[key].dataType.simpleString()

    def count(k, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        used = (state.get[0] if state.exists else 0) + sum(len(f) for f in frames)
        state.update((used,))
        yield pd.DataFrame({key: [k[0]], "used": [used], "allowed": [used <= budget]})

    return stream.groupBy(key).applyInPandasWithState(count, f"`{key}` {kind}, used bigint, allowed boolean", "used bigint", "update", "NoTimeout")
