"""License scans by diagonal voting, with DataFrame functions only.

Every rolling k-gram of a text's words is hashed, pairs for short templates and five words for whole licence texts; hashes that occur in a
template are joined with the places they have there. A hit votes for the diagonal (place in the text minus place in the template). A
diagonal with all of a phrase's votes is a place where the phrase stands word for word. Around each diagonal that has the most votes of its
neighbourhood the diagonals within a template's drift are merged, which bridges dropped or added words. A merged span is verified by the
share of the template's grams that it has; its hits lie within the drift of one diagonal, so they are in order and the span is no longer
than the template and twice the drift. Hits are kept with their words, so votes are exact, not by hash alone.

Licences are told apart in two ways. A span must also have what its template has and a relative, a template of another label that shares
half of its grams, has not: all such grams of a short template, most of a long one. So words that a whole family has say nothing about
its members, and a version number or a word such as lesser must stand there. And of verified spans of relatives that overlap the one with
the most grams stays.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii
from .license_texts import TEXTS

#: Phrases whose places are counted, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Usual short notices, and the labels that the method adds for them.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the apache license version 1 1", "apache-1.1"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nd", "cc-by-nd"),
    ("licensed under cc by nc sa", "cc-by-nc-sa"),
    ("licensed under cc by nc nd", "cc-by-nc-nd"),
    ("licensed under a creative commons attribution license", "cc-by"),
    ("released under the mit license", "mit"),
    ("all rights reserved", "all-rights-reserved"),
)

#: Words of a gram: of phrases and notices, and of licence texts.
SHORT, LONG = 2, 5
#: A span's diagonals lie within so many words of one, or this share of the template's words.
DRIFT, DRIFT_SHARE = 2, 0.1
#: A span needs this share of the template's grams, and of those that a relative lacks.
COVERAGE = 0.6
#: Templates of different labels are relatives if one shares this part of its grams with the other.
RELATED = 0.5

#: What separates words: before A-Z is lower-cased, so A-Z is no part of it.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_rows(phrases=PHRASES, notices=NOTICES, texts=TEXTS) -> list[tuple]:
    """(template, base, label, k, grams, drift, at, gram): one row for each gram of each template; small and fixed."""
    rows = []
    templates = [*((t, label, True, SHORT) for t, label in phrases), *((t, label, False, SHORT) for t, label in notices), *((t, label, False, LONG) for label, t in texts.items())]
    for number, (text, label, base, k) in enumerate(templates):
        words = [w for w in re.split(NO_WORD, text.lower()) if w]
        grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        drift = max(DRIFT, int(DRIFT_SHARE * len(words)))
        rows += [(number, base, label, k, len(grams), drift, at, gram) for at, gram in enumerate(grams)]
    return rows


def template_facts(rows: list[tuple]) -> list[tuple]:
    """(template, family, tests): templates that are relatives, directly or by others, are one family; tests are (spots, need), one for each
    relative, how many of the places a span needs whose grams the relative lacks. Phrases have neither."""
    of: dict[int, list[tuple]] = {}
    for r in rows:
        of.setdefault(r[0], []).append(r)
    grams = {t: {r[7] for r in own} for t, own in of.items()}
    family, tests = {t: t for t in of}, {t: [] for t in of}
    for t, own in of.items():
        for other, theirs in of.items():
            if own[0][1] or theirs[0][1] or own[0][2] == theirs[0][2] or own[0][3] != theirs[0][3]:
                continue
            if len(grams[t] & grams[other]) >= RELATED * min(len(grams[t]), len(grams[other])):
                old, new = sorted((family[t], family[other]), reverse=True)
                family = {x: new if f == old else f for x, f in family.items()}
                if spots := [r[6] for r in own if r[7] not in grams[other]]:
                    tests[t].append((spots, len(spots) if own[0][3] == SHORT else math.ceil(COVERAGE * len(spots))))
    return [(t, family[t], tests[t]) for t in of]


TEMPLATE_COLUMNS = "template int, base boolean, label string, k int, grams int, drift int, at int, gram string"
FACT_COLUMNS = "template int, family int, tests array<struct<spots array<int>, need int>>"


def word_hash(word: Column) -> Column:
    """Of the word in lower case; words that are not ASCII may be lowered further than a scan does, so equal hashes are only candidates."""
    return F.xxhash64(F.lower(word))


def gram_hash(hashes, at, size: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(size)))


def template_hashes(spark: SparkSession, rows: list[tuple]) -> tuple[list[int], list[int], list[int]]:
    """Hashes of the pairs of short templates, of the first pairs of long ones' grams, and of these grams; small and fixed."""
    grams = spark.createDataFrame([(r[3], r[7].split(" ")) for r in rows], "k int, words array<string>").withColumn("h", F.transform("words", word_hash))
    of = lambda size, k: F.collect_set(F.when(F.col("k") == k, gram_hash("h", F.lit(0), size)))
    return tuple(grams.select(of(SHORT, SHORT), of(SHORT, LONG), of(LONG, LONG)).first())


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES, texts=TEXTS, coverage: float = COVERAGE) -> DataFrame:
    """For every row of df: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the verified spans.

    A-Z is lower-cased; words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. n_base counts the places of the phrases; first_word and last_word
    are the smallest and the largest of their starts (null without any). Labels are distinct, sorted and joined by commas, empty without
    any. The score is the largest share of a template's grams that a verified span has, 1 for a phrase. Null counts as empty: no words, no
    places, score 0. Phrases have two words at least. Rows that repeat each get a result; other columns are not read; an empty table gives
    an empty result.
    """
    spark = df.sparkSession
    rows = template_rows(phrases, notices, texts)
    places = spark.createDataFrame(rows, TEMPLATE_COLUMNS).withColumnRenamed("gram", "template_gram").withColumn("hash", F.xxhash64("template_gram")).drop("k")
    facts = spark.createDataFrame(template_facts(rows), FACT_COLUMNS)
    pairs, starts, grams = (x or [0] for x in template_hashes(spark, rows))
    words = F.array_remove(F.split(F.coalesce(df[text_col], F.lit("")), NO_WORD), "")
    docs = df.select(df[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("uid"), words.alias("words"))
    docs = docs.withColumn("hashes", F.transform("words", word_hash))
    # Every place is tried with one pair of hashes; few go on to be tried with five, and only hits are joined as words.
    pair = lambda i: gram_hash("hashes", i, SHORT)
    docs = docs.withColumn("likely", F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), lambda i: pair(i).isin(pairs + starts)))

    def hits(k: int, test):
        gram = lambda i: lower_ascii(F.array_join(F.slice("words", i + 1, F.lit(k)), " "))
        return F.transform(F.filter("likely", test), lambda i: F.struct(i.alias("place"), F.lit(k).alias("k"), gram(i).alias("gram")))

    found = F.concat(hits(SHORT, lambda i: pair(i).isin(pairs)), hits(LONG, lambda i: gram_hash("hashes", i, LONG).isin(grams)))
    votes = docs.select("uid", "doc_id", F.size("words").cast("long").alias("n_words"), F.inline_outer(found))
    # Equal hashes of other words, if ever, give no vote; the row stays for the document's sake.
    voted = votes.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(places), "hash", "left")
    voted = voted.withColumn("template", F.when(F.col("gram") == F.col("template_gram"), F.col("template"))).repartition("uid")

    diagonal = F.when(F.col("template").isNotNull(), F.col("place") - F.col("at")).alias("diagonal")
    lines = voted.groupBy("uid", "template", diagonal).agg(
        *(F.first(c).alias(c) for c in ("doc_id", "n_words", "base", "label", "grams", "drift")), F.collect_set("at").alias("at"), F.min("place").alias("from"), F.max(F.col("place") + F.col("k")).alias("to")
    )
    # Diagonals in millionths of the template's drift, so that one range serves all templates.
    lines = lines.withColumns({"votes": F.size("at"), "offset": F.expr("diagonal * 1000000L div drift")})
    near = Window.partitionBy("uid", "template").orderBy("offset").rangeBetween(-1_000_000, 1_000_000)
    # Of diagonals with equal votes the first one is the centre.
    first = F.max(F.when(F.col("template").isNotNull(), F.struct("votes", (-F.col("diagonal")).alias("d"))))
    spans = lines.withColumns({"merged": F.array_distinct(F.flatten(F.collect_list("at").over(near))), "best": first.over(near), "start": F.min("from").over(near), "end": F.max("to").over(near)})
    spans = spans.join(F.broadcast(facts), "template", "left").withColumns({"hits": F.size("merged"), "share": F.size("merged") / F.col("grams")})
    exact = F.col("base") & (F.col("votes") == F.col("grams"))
    centre = (F.col("best.votes") == F.col("votes")) & (F.col("best.d") == -F.col("diagonal"))
    # What a relative has as well proves nothing.
    own = F.forall("tests", lambda t: F.size(F.array_intersect(t["spots"], F.col("merged"))) >= t["need"])
    spans = spans.withColumn("passed", F.coalesce(~F.col("base") & centre & (F.col("share") >= coverage) & own, F.lit(False)))
    # Of relatives that overlap the one with the most grams stays. Spans are no longer than the reach, so few meet in a range.
    reach = max((int(r[4]) + r[3] + 2 * r[5] for r in rows), default=1)
    around = Window.partitionBy("uid", "family").orderBy("start").rangeBetween(-reach, reach)
    rival = F.collect_list(F.when(F.col("passed"), F.struct("start", "end", "hits", "template", "label"))).over(around)
    stronger = lambda r: (r["hits"] > F.col("hits")) | ((r["hits"] == F.col("hits")) & (r["template"] < F.col("template")))
    beaten = F.exists("rivals", lambda r: (r["label"] != F.col("label")) & (r["start"] < F.col("end")) & (F.col("start") < r["end"]) & stronger(r))
    spans = spans.withColumn("rivals", rival).withColumn("won", F.col("passed") & ~beaten)
    verified = F.col("template").isNotNull() & F.when(F.col("base"), exact).otherwise(F.col("won"))
    share = F.when(F.col("base"), F.lit(1.0)).otherwise(F.col("share"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count_if(exact).alias("n_base"),
        F.min(F.when(exact, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("diagonal"))).cast("long").alias("last_word"),
        joined(F.when(exact, F.col("label"))).alias("base_labels"),
        joined(F.when(verified, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(verified, share)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(verified, F.struct(F.when(F.col("base"), F.col("from")).otherwise(F.col("start")).alias("from"), F.when(F.col("base"), F.col("to")).otherwise(F.col("end")).alias("to"), "label", share.alias("share"))))).alias("spans"),
    ).drop("uid")
