"""Source divergence audit: how differently the sources of a language use its terms.

Arrow batches count the terms of their documents by language and source, so the first shuffle sees a row for a term and source of a batch,
not for a word. Each term that a language keeps becomes one wide row, an array of its counts by source; higher-order functions turn
the counts into shares and emit the contributions of all pairs of sources, which are added up in the tasks that make them. All shares are
whole numbers: parts of a thousand million.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, looked_up, quoted, shared_folder, ship_code, written

#: A language keeps the terms that so many of its documents have.
LEAST = 30
#: Bytes of text that are counted at a time.
BYTES = 8_000_000
#: Added to every count; shares are parts of this; terms are listed to this rank.
ADDED, WHOLE, TOP = 5, 1_000_000_000, 50
#: bytes.translate table: A-Z lower-cased, what is no letter of `[^\x00-\x40\x5B-\x60\x7B-\x7F]` to a blank.
LETTER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a batch (lang, source, t): occurrences, and documents that have the term."""
    size = batch.num_rows
    if not size:
        return pa.RecordBatch.from_pydict({"lang": [], "source": [], "term": [], "n": [], "docs": []}, schema=COUNTS)
    texts = batch.column("t")
    raw = texts.cast(pa.large_binary())
    # One translation for all texts of the batch.
    joined = raw.buffers()[2].to_pybytes() if raw.buffers()[2] else b""
    offsets = np.frombuffer(raw.buffers()[1], "<i8")[raw.offset : raw.offset + size + 1]
    plain = joined[offsets[0] : offsets[-1]].translate(LETTER_TABLE)
    clean = pa.Array.from_buffers(pa.large_string(), size, [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(plain)])
    lists = pc.ascii_split_whitespace(clean)
    coded = lists.flatten().dictionary_encode()
    lengths = lists.value_lengths().to_numpy().astype(np.int64)
    code = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(size, dtype=np.int64), lengths)
    full = np.fromiter((len(x) > 0 for x in coded.dictionary.to_pylist()), bool, len(coded.dictionary))  # texts end in empty strings
    doc, code = doc[full[code]], code[full[code]]
    langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    terms = max(len(coded.dictionary), 1)
    # Documents by group, so that one sort serves both counts.
    ranked = np.argsort(group, kind="stable")
    place = np.empty(size, np.int64)
    place[ranked] = np.arange(size)
    pairs, times = np.unique(place[doc] * terms + code, return_counts=True)
    keys = group[ranked][pairs // terms] * terms + pairs % terms
    keys, back = np.unique(keys, return_inverse=True)
    n, docs = np.bincount(back, weights=times, minlength=len(keys)).astype(np.int64), np.bincount(back, minlength=len(keys))
    of = keys // terms
    columns = [langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))), coded.dictionary.take(pa.array(keys % terms)).cast(pa.string()), pa.array(n), pa.array(docs.astype(np.int64))]
    # A row without a term for every group, since a group counts even without terms.
    seen = np.unique(group)
    bare = [langs.dictionary.take(pa.array(seen // len(sources.dictionary))), sources.dictionary.take(pa.array(seen % len(sources.dictionary))), pa.array([""] * len(seen)), pa.array(np.zeros(len(seen), np.int64)), pa.array(np.zeros(len(seen), np.int64))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(columns, bare, strict=True)], schema=COUNTS)


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs), and a row with an empty term and zeros for every language and source."""
    ship_code(df.sparkSession)
    read = lambda c, name: F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(name)

    def run(batches):
        for batch in chunks(batches, "t", BYTES):
            yield counted(batch)

    rows = df.select(read(lang_col, "lang"), read(source_col, "source"), read(text_col, "t"))
    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, added: int = ADDED) -> Column:
    """1 + floor(WHOLE * (count + added) / (total + added * terms)), exact; null without terms."""
    above = (count + added).cast("decimal(28,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return F.call_function("div", above, (total + added * terms).cast("decimal(28,0)")) + 1


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, added: int = ADDED, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for every language and source its differences from the language's other sources (`pair`, all
    of them), and the terms whose share is above the language's (`term`, to rank `top`).

    Null text, language and source are empty strings, which are a language and a source like others. Texts are taken whole; rows that
    repeat are documents of their own. A language keeps the terms of at least `least` of its rows; without any its pairs have the value 0.
    Ties rank by item, as UTF-8. An empty table gives an empty result; other columns are not read."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    counts = written(term_counts(df, text_col, lang_col, source_col), folder, "counts")
    # Few rows: one for a language and source.
    groups = counts.where("term = ''").select("lang", "source")
    listed = groups.groupBy("lang").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    wide = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("of"))
    # One wide row for a term: its count in every source of the language, in the order of the list.
    wide = written(wide.where(F.col("docs") >= least).drop("docs"), folder, "wide")
    kept = looked_up(wide, listed, "lang")
    terms = written(kept.select("lang", "term", F.transform("sources", lambda s: F.coalesce(F.col("of")[s], F.lit(0).cast("long"))).alias("n")), folder, "terms")

    placed = terms.select("lang", F.posexplode("n").alias("at", "n"))
    totals = placed.groupBy("lang", "at").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    per_lang = totals.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "total"))), lambda x: x["total"]).alias("totals"), F.max("terms").alias("terms"), F.sum("total").alias("whole"))
    shares = looked_up(terms, per_lang.join(listed, "lang"), "lang")
    shares = shares.withColumn("p", F.transform(F.arrays_zip("n", "totals"), lambda x: share(x["n"], x["totals"], F.col("terms"), added)))
    shares = shares.withColumn("q", share(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x), F.col("whole"), F.col("terms"), added))

    # Contributions of a term to all pairs of sources, first one before second.
    pairs = F.flatten(F.transform("p", lambda x, i: F.transform(F.slice("p", i + 2, F.size("p")), lambda y, j: F.struct(i.alias("a"), (i + j + 1).alias("b"), F.abs(x - y).alias("f")))))
    sums = shares.select("lang", F.inline(pairs)).groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    every = listed.select("lang", "sources", F.posexplode("sources").alias("at", "source"))
    sides = every.select("lang", "at", "source", F.posexplode("sources").alias("other", "item")).where("at <> other")
    both = sides.withColumns({"a": F.least("at", "other"), "b": F.greatest("at", "other")}).join(sums, ["lang", "a", "b"], "left")
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    # Of the terms of a group only the first ones leave the task that finds them.
    above = F.filter(F.transform(F.arrays_zip("n", "p", "sources"), lambda x: F.struct(x["sources"].alias("source"), x["n"].alias("n"), (x["p"] - F.col("q")).alias("value"))), lambda x: (x["n"] > 0) & (x["value"] > 0))
    found = shares.select("lang", "term", F.inline(above)).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(first)
