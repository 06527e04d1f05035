"""Candidates that the registry has under another address, found along chains of mirrors and redirects.

Addresses are nodes, "mirror of" and "redirects to" are links, and entries of the registry end a chain. Most addresses have one link, so
chains of those are shortened by pointer jumping: each round every address takes over its target's target, and a chain of n links needs
log2(n) rounds. What is left are addresses with several links; between them, entries and dead ends the shortest way is found by rounds of
improvement, as many as the longest chain has such addresses. Chains that run in a circle lead nowhere.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import canonical_url
from ..sources.storage import work_folder, written


def links(candidates: DataFrame, *columns: str) -> DataFrame:
    """(url, target): the canonical address of each candidate and of what its columns, such as mirror_of and redirects_to, name."""
    targets = F.array(*(canonical_url(F.col(c)) for c in columns))
    pairs = candidates.select(canonical_url(F.col("url")).alias("url"), F.explode(targets).alias("target"))
    return pairs.where("url is not null and target is not null and target <> '' and url <> target").distinct()


def known_entries(registry: DataFrame) -> DataFrame:
    """(url, entry): for each canonical address of the registry its first entry (hops 0, name, url as written)."""
    entry = F.struct(F.lit(0).cast("long").alias("hops"), F.col("name"), F.col("url").alias("url"))
    return registry.groupBy(canonical_url(F.col("url")).alias("at")).agg(F.min_by(entry, "_pos").alias("entry")).where("at is not null").withColumnRenamed("at", "url")


def jumped(single: DataFrame, folder: str) -> DataFrame:
    """(url, target, hops) of addresses with one link, the target being the end of their chain: an address without a single link of its
    own. Chains that run in a circle are not there."""
    steps = written(single.select("url", "target", F.lit(1).cast("long").alias("hops")), folder, "jump-0")
    rounds = max(steps.count(), 1).bit_length()
    for n in range(1, rounds + 1):
        on = steps.select(F.col("url").alias("target"), F.col("target").alias("further"), F.col("hops").alias("more"))
        joined = steps.join(on, "target", "left")
        steps = written(joined.select("url", F.coalesce("further", "target").alias("target"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("further").isNotNull().alias("open")), folder, f"jump-{n}")
        if steps.where("open").isEmpty():
            return steps.drop("open")
        steps = steps.drop("open")
    # After so many rounds a target that still has a link is in a circle.
    return steps.join(steps.select(F.col("url").alias("target")), "target", "left_anti").select("url", "target", "hops")


def further(entry: Column, hops: Column) -> Column:
    return F.struct((entry["hops"] + hops).alias("hops"), entry["name"].alias("name"), entry["url"].alias("url"))


def reached(edges: DataFrame, registry: DataFrame) -> DataFrame:
    """(url, entry): for every address from which an entry can be reached the nearest one; of equally near ones that with the smaller name,
    then address. entry is (hops, name, url)."""
    folder = work_folder(edges.sparkSession)
    known = written(known_entries(registry), folder, "known")
    open_ = written(edges.join(known.select("url"), "url", "left_anti"), folder, "links")  # an entry ends a chain
    many = open_.groupBy("url").agg(F.count("*").alias("n")).where("n > 1").select("url")
    ends = jumped(open_.join(many, "url", "left_anti"), folder)
    ends = written(ends, folder, "ends")

    # Links of addresses with several, each to the end of the chain behind it.
    behind = ends.select(F.col("url").alias("target"), F.col("target").alias("end"), "hops")
    forks = open_.join(many, "url").join(behind, "target", "left")
    forks = written(forks.select("url", F.coalesce("end", "target").alias("target"), (F.coalesce("hops", F.lit(0)) + 1).alias("hops")), folder, "forks")
    found, n = known, 0
    while not forks.isEmpty():
        near = found.select(F.col("url").alias("target"), "entry")
        better = forks.join(near, "target").select("url", further(F.col("entry"), F.col("hops")).alias("entry"))
        after = written(found.unionByName(better).groupBy("url").agg(F.min("entry").alias("entry")), folder, f"found-{n}")
        n += 1
        changed = after.join(found.withColumnRenamed("entry", "before"), "url", "left").where("before is null or before <> entry")
        done = changed.isEmpty()
        found = after
        if done:
            break
    near = found.select(F.col("url").alias("target"), "entry")
    along = ends.join(near, "target").select("url", further(F.col("entry"), F.col("hops")).alias("entry"))
    return found.unionByName(along)


def existing(candidates: DataFrame, registry: DataFrame, *columns: str, others: DataFrame | None = None) -> DataFrame:
    """Candidates that the registry has, at their own address or behind a chain of aliases: _pos, url (canonical), name and address of the
    existing entry, which a verdict's evidence links, and the length of the chain. `others` are more (url, target) links, canonical ones."""
    edges = links(candidates, *(columns or ("mirror_of", "redirects_to")))
    edges = edges if others is None else edges.unionByName(others).distinct()
    at = candidates.select("_pos", canonical_url(F.col("url")).alias("url"))
    found = at.join(reached(edges, registry), "url")
    return found.select("_pos", "url", F.col("entry.name").alias("existing_name"), F.col("entry.url").alias("existing_url"), F.col("entry.hops").alias("hops"))
