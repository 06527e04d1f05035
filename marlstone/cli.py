"""Commands over catalogue files: `python -m marlstone.cli validate | manifest | seed | dedupe | merge ...`.

Documents go to standard output; errors are a line on standard error and exit code 1. Every command that reads a registry first undoes what
an interrupted merge has left.
"""

from __future__ import annotations

import argparse
import datetime
import json
import re
import sys

from pyspark.errors import PythonException
from pyspark.sql import SparkSession

from .operators import dedupe, manifest, payload, seed, validate
from .plans.documents import merge_documents, new_head, read_registry, recovered
from .sources import yaml_catalog
from .sources.text import whole_texts


def session() -> SparkSession:
    spark = SparkSession.builder.appName("catalogue").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def validate_command(spark: SparkSession, args) -> None:
    rows, envelope = yaml_catalog.parsed(spark, recovered(spark, args.registry))
    n = validate.assert_document(envelope, rows)
    print(f"OK: {n} entries valid in {args.registry}")


def manifest_command(spark: SparkSession, args) -> None:
    name = yaml_catalog.TARGETS
    yaml_catalog.dump(manifest.with_source_keys(read_registry(spark, args.registry)).orderBy("_pos"), sys.stdout, new_head(args.run_date, name), name)


def seed_command(spark: SparkSession, args) -> None:
    rows = seed.seed_entries(whole_texts(spark, args.document), args.run_date).orderBy("name", "_pos")
    yaml_catalog.dump(rows, sys.stdout, new_head(args.run_date))


def dedupe_command(spark: SparkSession, args) -> None:
    text = sys.stdin.read() if args.candidates == "-" else None
    payloads = spark.createDataFrame([(text,)], "value string") if text is not None else whole_texts(spark, args.candidates)
    flat = payload.flatten_candidates(payloads)
    # One document is one row, so its places are those of the flattened rows.
    placed = flat.selectExpr("cast(_outer as long) * 2147483648 + _inner as _pos", "url", "name", "_fields")
    survivors = dedupe.as_json(dedupe.new_candidates(placed, read_registry(spark, args.registry))).orderBy("_pos")
    total, new = placed.count(), 0
    print('{\n  "new_candidates": [', end="")
    for row in survivors.toLocalIterator():  # rows come part by part, in order
        lines = json.dumps(json.loads(row["value"]), indent=2).splitlines()
        print("," if new else "", *(f"    {line}" for line in lines), sep="\n", end="")
        new += 1
    print("\n  " if new else "", f'],\n  "skipped": {total - new}\n}}', sep="")


def merge_command(spark: SparkSession, args) -> None:
    print(merge_documents(spark, args.registry, payload.flatten_verdicts(whole_texts(spark, args.verdicts)), args.run_date, args.mode))


def told(error: Exception) -> str:
    """One line of an error; of one in a worker, what the worker said."""
    lines = str(error).splitlines()
    said = [m[1] for line in lines if (m := re.match(r"(?:\w+\.)*\w*Error: (.+)", line))] if isinstance(error, PythonException) else []
    return (said or lines or [type(error).__name__])[-1 if said else 0]


def main(words: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marlstone")
    commands = parser.add_subparsers(required=True)
    for name, run, files in (
        ("validate", validate_command, ["registry"]), ("manifest", manifest_command, ["registry"]), ("seed", seed_command, ["document"]),
        ("dedupe", dedupe_command, ["candidates", "registry"]), ("merge", merge_command, ["registry", "verdicts"]),
    ):
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--run-date", default=datetime.date.today().isoformat())
        for file in files:
            command.add_argument(file)
        if run is merge_command:
            command.add_argument("--mode", choices=("strict", "compat"), default="strict")
    args = parser.parse_args(words)
    try:
        args.run(session(), args)
    except Exception as error:
        print(f"ERROR: {told(error)}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
