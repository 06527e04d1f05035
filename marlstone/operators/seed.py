"""Entries from the fenced blocks of Markdown documents."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENTRY
from ..sources.storage import ship_package
from ..sources.yaml_catalog import EXTRA, laid_out

#: Fixed value: the opening fence is exactly the tagged line; a block runs to the next closing fence.
BLOCK = r"(?s)```yaml seed\n(.*?)\n```"


def seed_blocks(documents: DataFrame, text_col: str = "value", pattern: str = BLOCK) -> DataFrame:
    """(other columns, `_pos`, place, block): the blocks of each document in order, and the character from 1 at which a block's text begins."""
    others = [c for c in documents.columns if c != text_col]
    found = documents.select(*others, text_col, F.regexp_extract_all(text_col, F.lit(pattern), 1).alias("_blocks"))
    # A block's text begins behind what stands before it: texts between blocks are what a split leaves.
    whole = F.regexp_extract_all(text_col, F.lit(pattern), 0)
    opening = F.length(F.lit("```yaml seed\n"))
    between = F.transform(F.split(F.col(text_col), pattern), lambda x: F.length(x))
    sizes = F.transform(whole, lambda x: F.length(x))
    upto = lambda a, n: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda s, x: s + x)
    places = F.transform("_blocks", lambda _, i: upto(between, i + 1) + upto(sizes, i) + opening + 1)
    each = found.select(*others, F.posexplode(F.arrays_zip(F.col("_blocks").alias("block"), places.alias("place"))).alias("_pos", "_b"))
    return each.select(*others, F.col("_pos").cast("long").alias("_pos"), F.col("_b.place").alias("place"), F.col("_b.block").alias("block"))


def seed_entries(documents: DataFrame, run_date: str, text_col: str = "value", pattern: str = BLOCK) -> DataFrame:
    """One entry for each block, with the document's other columns; last_verified is the run date unless given. A block that is no mapping, or
    has no name to sort by, is an error. Keys that no field holds are in `_rest`. Sort by name, then `_pos`."""
    ship_package(documents.sparkSession)
    blocks = seed_blocks(documents, text_col, pattern).drop("place")
    others = [c for c in blocks.columns if c not in ("_pos", "block")]
    schema = T.StructType([*blocks.schema.fields[: len(others)], *ENTRY.fields, *EXTRA])

    def parse(frames):
        import yaml

        for frame in frames:
            rows = []
            for place, block in zip(frame["_pos"], frame["block"], strict=True):
                entry = yaml.safe_load(block)
                if not isinstance(entry, dict):
                    raise ValueError(f"a seed block is no mapping: {block[:80]}")
                if "name" not in entry:
                    raise ValueError(f"a seed block has no name: {block[:80]}")
                entry.setdefault("last_verified", run_date)
                rows.append(laid_out(entry, int(place), ENTRY))
            told = pd.DataFrame(rows, columns=[f.name for f in schema.fields[len(others) :]], dtype=object)
            yield pd.concat([frame[others].reset_index(drop=True), told], axis=1)

    return blocks.mapInPandas(parse, schema)
