"""An extension: verdict files as a stream, merged batch by batch into a state that remembers which batches it has.

The state is a folder of versions, each with the registry, the queue and the counters after a batch. A version counts once its mark is there,
which is written last, so a batch that failed halfway leaves nothing; and a batch whose mark is there is passed over, so one that the stream
repeats after a failure is merged once. Batches are told apart by the stream's id, which its checkpoint keeps, and their number.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge, with_keys
from ..operators.payload import flatten_verdicts, in_order
from ..schema import DEFERRED, ENTRY
from ..sources.storage import Store, work_folder, written
from ..sources.yaml_catalog import REST

PARTS = ("registry", "queue", "counters")


class CatalogueState:
    """Versions of a catalogue below a folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), Store(spark, folder)

    def ledger(self) -> list[dict]:
        """Batches that are merged: version, stream and batch, in order."""
        if not self.store.exists(f"{self.folder}/marks"):
            return []
        return [json.loads(self.store.read(f)) for f in self.store.files(f"{self.folder}/marks", ".json")]

    def load(self) -> tuple[DataFrame, DataFrame]:
        """Registry and queue of the last version; empty ones without any."""
        done = self.ledger()
        if not done:
            return tuple(self.spark.createDataFrame([], T.StructType([*s.fields, REST])) for s in (ENTRY, with_keys(DEFERRED)))
        return self.part("registry"), self.part("queue")

    def part(self, name: str, version: int | None = None) -> DataFrame:
        version = self.ledger()[-1]["version"] if version is None else version
        return self.spark.read.parquet(self.store.uri(f"{self.folder}/v{version}/{name}"))

    def start(self, registry: DataFrame, queue: DataFrame) -> None:
        """The first version, before any batch."""
        self.save(registry, queue, self.spark.range(1).select(*(F.lit(0).cast("long").alias(c) for c in ("added", "refreshed", "deferred", "rejected"))), "start", -1)

    def has(self, stream: str, batch: int) -> bool:
        return any(d["stream"] == stream and d["batch"] == batch for d in self.ledger())

    def save(self, registry: DataFrame, queue: DataFrame, counters: DataFrame, stream: str, batch: int) -> None:
        done = self.ledger()
        version = done[-1]["version"] + 1 if done else 0
        for name, rows in zip(PARTS, (registry, queue, counters), strict=True):
            rows.write.mode("overwrite").parquet(self.store.uri(f"{self.folder}/v{version}/{name}"))
        self.store.write(f"{self.folder}/marks/{version:012d}.json", json.dumps({"version": version, "stream": stream, "batch": batch}), new=True)


def merge_stream(spark: SparkSession, folder: str, checkpoint: str, state: CatalogueState, run_date: str, mode: str = "strict") -> StreamingQuery:
    """Starts a query that merges all verdict files now in the folder into the state; of several files in a batch the order is that of their
    paths. A file that is no list of verdicts, or a verdict that a merge refuses, stops the query before the state changes."""

    def apply(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if state.has(stream, number):
            return
        registry, queue = state.load()
        folder = work_folder(batch.sparkSession)
        try:
            # A merge goes over the verdicts many times, over the files once.
            verdicts = written(flatten_verdicts(in_order(batch), order_col="_file"), folder, "verdicts")
            entries, queued, counts = merge(registry, queue, verdicts, run_date, mode)
            state.save(renumbered(entries, "name"), renumbered(queued, "part").drop("part"), counts, stream, number)
        finally:
            state.store.delete(folder)

    files = spark.readStream.format("text").option("wholetext", True).load(folder).select("value", F.col("_metadata.file_path").alias("path"))
    return files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def renumbered(rows: DataFrame, first: str) -> DataFrame:
    """rows with places that keep their order, by the column `first` and then their place, for the next batch."""
    return rows.orderBy(first, "_pos").withColumn("_pos", F.monotonically_increasing_id())
