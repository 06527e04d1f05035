"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Within a source the documents are laid out in a fixed order; each takes up its expected number of copies on a line, one random offset is
added, and a document is emitted once for every integer boundary that its stretch crosses. The order goes by size class, so the words
taken stay near the target. Prefix sums are two-level: totals of small cells (source, size class, slot), whose number in a source is
bounded, then ranks within a cell; so a source with a third of all rows is spread over thousands of cells.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, quoted, shared_folder, written

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix for each word of the input.
SHARE = 1.5
#: No source is taken more often than this.
MOST = 2
#: Seed of the random offset, so that reruns agree.
SEED = 1
#: Keys of repeated rows that are broadcast: those with the most rows.
OFTEN = 512
#: Copies of one repeated row that one task emits together.
EMITTED = 1000


def drawn_offset(seed: int = SEED) -> float:
    """The random offset of systematic sampling for a seed, from 0 to below 1."""
    return int.from_bytes(hashlib.sha256(f"offset {seed}".encode()).digest()[:6], "big") / (1 << 48)


def size_class(size: Column) -> Column:
    """Sorts as the size does, in steps of at most 1/8; at most 8 * 64 values."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Words are dealt by weight; what goes beyond most * source_size is dealt to the others by weight again, until none is above. That
    fixed point is min(most * size, level * weight) with one level for all, found from prefix sums over sources ordered by
    most * size / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(by_level), F.lit(0))
    ranked = ranked.withColumns({
        "left_words": F.sum("source_size").over(everyone) * F.lit(share) - before("cap"),
        "left_weight": F.sum("w").over(everyone) - before("w"),
    })
    # A source is full if the level that is left at its place lies above its own; those after the first that is not share what is left.
    open_ = F.col("cap") * F.col("left_weight") > F.col("left_words") * F.col("w")
    ranked = ranked.withColumns({"open_words": F.when(open_, F.col("left_words")), "open_weight": F.when(open_, F.col("left_weight"))})
    level = ranked.withColumns({"words": F.max("open_words").over(everyone), "weight": F.max("open_weight").over(everyone)})
    target = F.when(open_, F.col("w") * F.col("words") / F.col("weight")).otherwise(F.col("cap").cast("double"))
    return level.select("source", "source_size", target.cast("double").alias("target"))


def mix_decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST, key: Column | None = None) -> DataFrame:
    """For every row of df: doc_id, source, size, source_size, target and copies; with key, that column too.

    The size is the number of words of a text (null or empty: 0). A null source is a source of its own, ordered last. A source without
    words has target 0 and gives no copies. Rows that repeat are separate rows; the result does not depend on their order. An empty
    table gives an empty result; other columns are not read.
    """
    offset = drawn_offset(seed)
    also = [] if key is None else [key.alias("_key")]
    rows = df.select(df[id_col].alias("doc_id"), df[source_col].alias("source"), count_words(df[text_col]).alias("size"), *also)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # joins and partitions alike for null
    rows = rows.withColumns({"named": named, "class": size_class(F.col("size")), "slot": F.substring(key, 1, 2), "key": key})
    rows = written(rows, shared_folder(df.sparkSession), "sizes")  # read three times; texts are read once
    cells = rows.groupBy("named", "class", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("words"), F.first("source").alias("source"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    targets = targets.select(named.alias("named"), "source_size", "target")
    within = Window.partitionBy("named").orderBy("class", "slot")
    plan = cells.withColumn("before", F.sum("n").over(within) - F.col("n")).select("named", "class", "slot", "before").join(targets, "named")
    in_cell = Window.partitionBy("named", "class", "slot").orderBy("key", "doc_id", "size")
    placed = rows.withColumn("rank", F.row_number().over(in_cell)).join(plan, ["named", "class", "slot"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    end = F.col("before") + F.col("rank")
    copies = F.floor(rate * end + F.lit(offset)) - F.floor(rate * (end - 1) + F.lit(offset))
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), *(["_key"] if also else []))


def row_key(df: DataFrame, id_col: str) -> Column:
    """Tells rows apart by their id and a hash of all columns (but maps) and of which of them are null."""
    plain = [df[quoted(f.name)] for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.concat_ws("|", F.hex(F.xxhash64(*plain, *(c.isNull() for c in plain))), df[id_col].cast("string"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of df with all their columns, each as often as it was drawn.

    Rows are matched to their draws by a hash of the row. The texts are dealt out once and stream past the draws of their partition; they
    are never sorted. Rows that repeat in all columns are one row with the draws of all, which are emitted in parts of EMITTED copies.
    """
    drawn = mix_decisions(df, id_col, text_col, source_col, key=row_key(df, id_col), **options)
    drawn = drawn.groupBy("_key").agg(F.count("*").alias("_rows"), F.sum("copies").alias("_copies")).where("_copies > 0")
    drawn = written(drawn, shared_folder(df.sparkSession), "drawn")
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.select(*(df[quoted(c)].alias(n) for c, n in zip(df.columns, names, strict=True)), row_key(df, id_col).alias("_key"))
    copies = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("_copy")
    mixed = rows.join(drawn.where("_rows = 1").hint("shuffle_hash"), "_key").select(*names, copies(F.col("_copies")))
    repeated = drawn.where("_rows > 1")
    if not repeated.isEmpty():
        # The rows of the most frequent keys meet them where they are; only one row of each key is shuffled for these.
        often = F.broadcast(repeated.orderBy(F.desc("_rows"), "_key").limit(OFTEN))
        seldom = repeated.join(often.select("_key"), "_key", "left_anti")
        one = rows.join(often, "_key").unionByName(rows.join(seldom, "_key")).groupBy("_key").agg(*(F.first(n).alias(n) for n in names), F.first("_copies").alias("_copies"))
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / EMITTED)))
        parts = one.withColumn("_part", part).repartition("_key", "_part")
        mixed = mixed.unionByName(parts.select(*names, copies(F.least(F.lit(EMITTED), F.col("_copies") - F.col("_part") * EMITTED))))
    return mixed.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)))
