"""Whole documents: a registry and its queue after verdicts, written together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import merge, report
from ..schema import DEFERRED, ENTRY
from ..sources import yaml_catalog
from ..sources.storage import Replacement


def recovered(spark: SparkSession, registry: str) -> str:
    """The path of a registry, after what an interrupted merge has left there is undone."""
    Replacement(spark, registry, yaml_catalog.queue_path(registry)).recover()
    return registry


def read_registry(spark: SparkSession, path: str, missing: str = "fail") -> DataFrame:
    return yaml_catalog.read(spark, recovered(spark, path), ENTRY, missing=missing)


def read_queue(spark: SparkSession, registry: str) -> DataFrame:
    """The queue beside a registry, empty if there is none."""
    return yaml_catalog.read(spark, yaml_catalog.queue_path(registry), merge.with_keys(DEFERRED), missing="empty")


def merge_documents(spark: SparkSession, registry: str, verdicts: DataFrame, run_date: str, mode: str = "strict") -> str:
    """Applies verdicts (see payload.flatten_verdicts) to a registry document and the queue beside it, either of which may be missing, and
    gives the line of counters. Both documents change together or, if a verdict is refused or the run is interrupted, not at all."""
    queue_file = yaml_catalog.queue_path(registry)
    both = Replacement(spark, registry, queue_file)
    entries, envelope = yaml_catalog.parsed(spark, recovered(spark, registry), missing="empty")
    queue, queue_envelope = yaml_catalog.parsed(spark, queue_file, merge.with_keys(DEFERRED), missing="empty")
    merge.assert_usable(entries, "name", "url")
    merge.assert_usable(queue, "url")
    merged, queued, counts = merge.merge(entries, queue, verdicts, run_date, mode)
    line = report.summary_line(counts).first()["line"]
    head = lambda found: yaml_catalog.dated(yaml_catalog.head_of(found.first()), run_date)
    staged = [
        yaml_catalog.stage(yaml_catalog.dealt(merged, "name", "_pos"), registry, head(envelope)),
        yaml_catalog.stage(yaml_catalog.dealt(queued, "part", "_pos").drop("part"), queue_file, head(queue_envelope)),
    ]
    both.replace(staged)
    return line


def new_head(run_date: str, name: str = yaml_catalog.ENTRIES) -> dict:
    """The envelope of a document that is written anew."""
    return {"version": yaml_catalog.VERSION, yaml_catalog.DATED: run_date, name: None}


def saved(rows: DataFrame, path: str, run_date: str) -> str:
    """Writes rows, in the order of `_pos`, as a new document and gives its path."""
    yaml_catalog.save(yaml_catalog.dealt(rows, "_pos"), path, new_head(run_date))
    return path
