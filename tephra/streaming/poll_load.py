"""Load each snapshot document once: a file stream whose checkpoint is the load history."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.readers import below


class Loaded(StreamingQueryListener):
    """Input rows of all micro-batches of the query named `name`; a query itself remembers only its last ones."""

    def __init__(self, name: str):
        self.name, self.rows, self.run, self.ended = name, 0, None, threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event):
        if event.progress.name == self.name:
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()


def load_polls(spark: SparkSession, folder: str, table: str, checkpoint: str, run_label: str, files_per_batch: int | None = None) -> int:
    """Append documents not loaded before to the raw poll table and return how many there were, over all micro-batches.

    `Trigger.AvailableNow` takes what is there and stops, so it runs like a batch; the checkpoint remembers
    every file seen, so nothing is collected or compared. A changed file under an old name is not re-read.
    """
    limit = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    docs = (spark.readStream.format("text").options(wholetext="true", recursiveFileLookup="true", pathGlobFilter="*.json", **limit).load(folder)
            .select(F.col("value").alias("doc"), below(folder).alias("source_file")))
    rows = docs.select("doc", "source_file", F.sha2("doc", 256).alias("source_sha256"), F.current_timestamp().alias("ingested_at"),
                       F.lit(run_label).alias("run_label"))
    loaded = Loaded(f"polls-{uuid.uuid4().hex}")
    spark.streams.addListener(loaded)
    try:
        query = rows.writeStream.queryName(loaded.name).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table)
        query.awaitTermination()
        if not loaded.ended.wait(60):                              # events come in order: all progress is in when the end is
            raise RuntimeError("no word of the end of the load")
    finally:
        spark.streams.removeListener(loaded)
    return loaded.rows


def raw_polls(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table)
