"""An incremental history as a table: every listing that a stream announces is merged into it once.

A listing is a folder of Parquet, however many files it has; the stream carries only its time and name. Each micro-batch
writes the whole new table beside the old one and renames it in; the name says which listing it ends with, so a batch that is run again, after a
crash or with a lost checkpoint and cut otherwise, finds its listings merged and leaves the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import merge_snapshot
from ..session import materialize

KEPT = 2


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(number, microseconds of its last listing, folder) of the finished tables below `path`, oldest first."""
    fs, at = _files(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted((int(n.split("-")[1]), int(n.split("-")[2]), f"{path}/{n}") for n in names if n.startswith("v-"))


def current_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest table, or None before the first listing."""
    found = versions(spark, path)
    return spark.read.parquet(found[-1][2]) if found else None


def merge_batch(path: str, key: str, tracked: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """The step for foreachBatch: (listed_at, folder) rows of a batch into the table below `path`."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = versions(spark, path)
        newest = done[-1][1] if done else -1
        # names of listings, as many as came in since the last trigger; those told before, or older than what the table already says, change nothing
        told = batch.select(F.unix_micros("listed_at").alias("micros"), "folder").distinct().collect()
        arrived = sorted((r.micros, r.folder) for r in told if r.micros > newest)
        if not arrived:
            return
        history = current_history(spark, path)
        for at, folder in arrived:
            listed_at = F.timestamp_micros(F.lit(at))
            listing = spark.read.parquet(folder).where(F.col(key).isNotNull()).withColumn("_listed_at", listed_at)
            if history is None:
                history = listing.limit(0).select(key, *tracked, F.col("_listed_at").alias("valid_from"), F.col("_listed_at").alias("valid_to"))
            history = materialize(merge_snapshot(history, listing, key, tracked, run_at=listed_at, updated_at="_listed_at"))
        number = max([batch_id, *[b + 1 for b, _, _ in done[-1:]]])
        aside, target = f"{path}/_next-{uuid.uuid4().hex}", f"{path}/v-{number:019d}-{arrived[-1][0]}"
        history.write.parquet(aside)
        fs, source = _files(spark, aside)
        if not fs.rename(source, _files(spark, target)[1]):
            raise RuntimeError(f"cannot rename {aside} to {target}")
        for _, _, old in versions(spark, path)[:-KEPT]:            # readers of the table before this one may still be running
            fs.delete(_files(spark, old)[1], True)
    return step


def follow_listings(spark: SparkSession, index: str, path: str, checkpoint: str, key: str, tracked: Sequence[str], files_per_batch: int = 1) -> DataFrame | None:
    """Merge every listing that `index` (JSON lines: listed_at, folder) names and the table below `path` does not hold yet; returns the table.

    Listings must come in the order of their times; a later file with an earlier time changes nothing. Keys that a listing lacks close at
    its time, changed ones close and open there. A listing is taken as complete, and a key must not appear in it twice.
    """
    arrivals = spark.readStream.schema("listed_at timestamp, folder string").option("maxFilesPerTrigger", files_per_batch).json(index)
    query = arrivals.writeStream.foreachBatch(merge_batch(path, key, tracked)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return current_history(spark, path)
