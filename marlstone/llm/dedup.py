"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries find the frequent digests; their exact groups are counted with map-side combination only, and the verified winners
are broadcast (at most `counters` rows), so that copies of a hot text are resolved without a shuffle. All other digests, none of which
can make up more than about 2/counters of the rows, are shuffled in the ordinary way.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, shared_folder, ship_code, written

#: Counters of a Misra-Gries summary; bounds the broadcast side too (32 bytes of digest and about 40 of payload a row).
COUNTERS = 1024


def misra_gries(batches, counters: int = COUNTERS):
    """Arrow batches of (digest) to one batch of (digest, seen) per partition; a digest of more than rows/(counters+1) rows is in it."""
    held: dict = {}
    kind = pa.binary()
    for batch in batches:
        kind = batch.column(0).type
        for pair in batch.column(0).value_counts().to_pylist():
            held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: v - cut for k, v in held.items() if v > cut}
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], ["digest", "seen"])


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, among them every one of more than 2 * rows / (counters + 1) rows. Summaries are added digest by digest."""
    kind = digests.schema["digest"].dataType.simpleString()
    parts = digests.select("digest").mapInArrow(lambda x: misra_gries(x, counters), f"digest {kind}, seen long")
    return parts.groupBy("digest").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "digest").limit(counters).select("digest")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """A decision for every row of df: its id, keep_id, group_size, kept and the SHA-256 of the normalised text.

    Texts are equal if they are identical without the characters of [\\x20\\x09-\\x0D]. Of equal texts the one with the most code points
    stays, then the one with the smallest id (null last). Null text counts as empty; all empty texts are one group. Of rows that repeat
    an id and a text exactly one is kept. Other columns are not read. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_code(spark)
    text = F.coalesce(df[text_col], F.lit(""))
    base = df.select(
        df[id_col].alias("doc_id"),
        F.length(text).cast("long").alias("n"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("uid"),
    )
    base = written(base, shared_folder(spark), "digests")
    best = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))

    frequent = F.broadcast(heavy_digests(base, counters))
    winners = base.join(frequent, "digest").groupBy("digest").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    split = base.join(F.broadcast(winners), "digest", "left")
    light = split.where(F.col("best").isNull()).drop("best", "group_size")
    group = Window.partitionBy("digest")
    light = light.withColumns({"best": F.min(best).over(group), "group_size": F.count(F.lit(1)).over(group)})
    return split.where(F.col("best").isNotNull()).unionByName(light).select(
        F.col("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("best.uid") == F.col("uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
