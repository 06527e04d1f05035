"""From raw documents to files of token ids: quality, near duplicates, benchmark passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import decontam, jaccard, mixing, quality, tokens
from marlstone.llm.common import remainder, shared_folder, table, written
from marlstone.llm.queries import TOKENIZER

#: Some stages have no form in SQL; tests hold them against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; the classifier learns from the labelled ones among them, as its query does.

    Null and empty texts are scored as empty ones; rows that repeat have one score; without labels all have the same. An empty table
    stays empty; columns of any name pass through."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), condition=remainder(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (five words, similarity 0.8) the document with the smallest id, null last.

    Texts without words are nobody's copies and stay, also if they repeat; of rows that repeat an id and a text one stays; different
    texts under one id, or without any, are different documents. An empty table stays empty; columns of any name pass through."""
    return jaccard.first_of_groups(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the test set: at most one word in twenty, or none, is in a window of an item.

    Null and empty texts have no words and stay; rows that repeat share their fate; an empty test set or table removes nothing; columns
    of any name pass through."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix draws them, sources by their target weights.

    A null source is one of its own. Texts without words are drawn at the rate of their source, and not at all in a source without words;
    rows that repeat in all columns have the draws of all. An empty table stays empty; columns of any name pass through."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the files of token ids below spark.checkpoint.dir, where they stay, and returns what is read back from them, a row a document.

    Null and empty texts have the end id only; rows that repeat are repeated; null ids come last; an empty table gives no file and no row."""
    return tokens.token_table(docs, TOKENIZER, shared_folder(spark, keep=True))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written in the shared folder and read again."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
